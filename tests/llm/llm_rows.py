"""Small document tables with the awkward cases, shared by the tests of the llm operators."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                     StructField("lang", StringType()), StructField("source", StringType()),
                     StructField("n_chars", LongType())])
# Names that operators use for columns of their own.
CLASHES = ["id", "k1", "k2", "copies", "size", "rep", "token", "shard", "slot", "rank", "anchor", "seg", "component",
           "score", "n", "bits", "kept", "label2", "weight"]


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"Word{rng.randrange(vocabulary)}"
                    for _ in range(n))


def rows(seed=1):
    rng = random.Random(seed)
    texts = [None, "", "   \n\t ", "one", "two words", "1234 5678", "!!! ???", "a\x00b \x1c c d", "ß", "ééé èèè"]
    base = [prose(rng, n) for n in (3, 5, 40, 80, 150, 300)]
    texts += base + base[:4] + [base[3]] * 5                    # copies
    for text in base[2:]:                                       # near copies
        for _ in range(6):
            words = text.split(" ")
            words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
            texts.append(" ".join(words))
    passage = prose(rng, 90, 4000)
    texts += [f"{prose(rng, rng.randrange(60))} {passage} {prose(rng, rng.randrange(60))}" for _ in range(12)]
    texts += ["by " * 200, "ab" * 700, "x" * 1500, prose(rng, 6000, 50000), passage + "\n" + passage]
    return [(i, t, (None, "aa", "bb")[i % 3], (None, "s1", "s2", "é", "")[i % 5], len(t or "")) for i, t in enumerate(texts)]


def frame(spark, data, clash=False):
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def table(df, key):
    """Rows by key, as tuples of the other columns."""
    cols = [c for c in df.columns if c != key]
    out = {}
    for r in df.collect():
        assert r[key] not in out
        out[r[key]] = tuple(r[c] for c in cols)
    return out
