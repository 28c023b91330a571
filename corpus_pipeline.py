"""Corpus pipeline: language ID, near-duplicates, repeated strings, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Stages are written and read again between, so a lost executor costs
at most its tasks of the running stage.

Defined results: rows that share an id stay or go together, and are taken as often as the most
taken of them; rows with null ids count as one id; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from listingflow.llm import bpe, jaccard, langid, mixing, suffixdedup
from listingflow.llm.common import documents, settle

VOCABULARY = "byte_bpe_50k.tiktoken"
GRAM, PERCENT = 5, 80    # of near-duplicates: words a shingle, hundredths


def language(spark, docs, sf_dir):
    """Rows of which no language can be told (null texts, texts without a letter) go."""
    languages = langid.train(docs.filter(~langid.held_out("doc_id")))
    return langid.with_language(docs, languages)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of linked documents, the one with the smallest id stays."""
    groups = jaccard.jaccard_groups(docs, gram=GRAM, percent=PERCENT)
    stay = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def repeated_strings(spark, docs, sf_dir):
    """Bytes covered by a 400-byte string that starts anywhere else too are taken out."""
    out = suffixdedup.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def source_mix(spark, docs, sf_dir):
    """Documents are repeated or left out so that sources meet their target words."""
    copies = (mixing.mix(docs).filter("copies > 0").groupBy(F.col("doc_id").alias("__id"))
              .agg(F.max("copies").cast("int").alias("__copies")))
    joined = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("__id")))
    return (joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns))


def tokens(spark, docs, sf_dir):
    """Token counts and digests of every row."""
    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("source_mix", source_mix), ("tokens", tokens)]

# Language vectors, byte offsets inside texts and byte-pair merges are not SQL; tests compare each
# stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
