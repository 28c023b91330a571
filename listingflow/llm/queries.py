"""Registered queries of the training-data operators: each over its whole table.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLE`` holds DuckDB SQL where SQL
can express the result. The others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers

from listingflow.llm import (align, bpe, embeddedup, hardneg, jaccard, langid, mixing, sharding, substrdedup, suffixdedup,
                             tokencount, topk, toxicity)
from listingflow.llm.common import documents, embeddings, labels

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
SIDES = ("byte_bpe_50k.json", "piece_bpe_32k.model")        # of the alignment


def op1_embedding_near_dedup(spark, sf_dir):
    return embeddedup.near_duplicates(embeddings(spark, sf_dir))


def op2_byte_bpe(spark, sf_dir):
    return bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path(BYTE_VOCABULARY),
                                public_tokenizers.PATTERN)


def op3_language_id(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


def op4_suffix_array_dedup(spark, sf_dir):
    return suffixdedup.remove_repeats(documents(spark, sf_dir))


def op5_token_counts(spark, sf_dir):
    return tokencount.count_tokens(documents(spark, sf_dir), public_tokenizers.path(BYTE_VOCABULARY),
                                   public_tokenizers.PATTERN)


def op6_topk_maxscore(spark, sf_dir):
    return topk.top_k(embeddings(spark, sf_dir))


def op7_substring_dedup(spark, sf_dir):
    return substrdedup.remove_repeats(documents(spark, sf_dir))


def op8_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def op9_kd_shards(spark, sf_dir):
    return sharding.shard(documents(spark, sf_dir))


def op10_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_groups(documents(spark, sf_dir), gram=4, percent=85)


def op11_hard_negatives(spark, sf_dir):
    return hardneg.hard_negatives(embeddings(spark, sf_dir))


def op12_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op13_tokenizer_alignment(spark, sf_dir):
    a, b = map(public_tokenizers.path, SIDES)
    return align.align_documents(documents(spark, sf_dir), a, b, public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_byte_bpe, op3_language_id, op4_suffix_array_dedup,
    op5_token_counts, op6_topk_maxscore, op7_substring_dedup, op8_mix_sources, op9_kd_shards, op10_ngram_jaccard,
    op11_hard_negatives, op12_toxicity, op13_tokenizer_alignment)}

ORACLE = {"op6_topk_maxscore": topk.ORACLE, "op8_mix_sources": mixing.ORACLE,
          "op11_hard_negatives": hardneg.ORACLE}
