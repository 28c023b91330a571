"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_vectors import vectors

from listingflow.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(data, every=50):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], l) for i, v, l in data
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, v, (l + 1) % 10 if i is not None and i % 7 == 0 else l) for i, v, l in rows]
    out = []
    for n, (q, a, label) in enumerate(rows):
        if q is None or q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i is None, i or 0, m)
                        for m, (i, b, _) in enumerate(rows) if m != n)
        for s, _, _, m in [x for x in scored if rows[x[3]][2] == label][:5]:
            fits = [x for x in scored if rows[x[3]][2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(q, rows[m][0], rank, rows[x[3]][0], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(out, key=repr)


def got(df, **options):
    return sorted(map(tuple, hardneg.hard_negatives(df, **options).collect()), key=repr)


@pytest.mark.parametrize("shard", [4096, 23])
def test_equal_brute_force(spark, shard):
    """Nulls, empty vectors, other widths, ties and copies; one shard and many."""
    rng = np.random.default_rng(8)
    near = [(i, v, 0 if l is None else l) for i, v, l in vectors(3)]
    data = near + [(1000 + i, (np.array(v) + 0.3 * rng.normal(size=len(v))).astype(np.float32).tolist() if v and None not in v else v, (l + 1) % 3)
                   for i, v, l in near]
    df = spark.createDataFrame(data, SCHEMA).repartition(3).withColumn("score", F.lit("x")).withColumn("row", F.lit("y"))
    want = expected(data, 10)
    assert len(want) > 100
    assert got(df, every=10, shard_rows=shard) == want


def test_repeated_and_null_ids(spark):
    """Repeated ids are rows of their own, as anchors too; null ids come last among equal scores."""
    base = [1.0, 0.5, 0.25, 0.0]
    data = [(50, base, 1), (50, base, 1), (50, [1.0, 0.0, 0.0, 0.0], 2), (None, base, 1), (None, [0.9, 0.4, 0.2, 0.0], 3), (3, [0.9, 0.4, 0.2, 0.0], 3),
            (3, [0.9, 0.4, 0.2, 0.0], 4), (8, [0.8, 0.4, 0.2, 0.0], 5), (9, base, None), (10, [0.0] * 4, 1), (100, [], 1), (150, None, 1)]
    df = spark.createDataFrame(data, SCHEMA)
    want = expected(data)
    assert got(df) == want and got(df, shard_rows=2) == want
    assert any(r[1] is None for r in want) and any(r[3] is None for r in expected(data[:5]))
    assert got(spark.createDataFrame(data[:5], SCHEMA)) == expected(data[:5])


def test_empty_table_and_large_components(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    data = [(50, [1e7, 1.0], 1), (1, [9e6, 2.0], 1), (2, [6e6, 3.0], 2), (3, [7e6, -1.0], 2)]
    assert got(spark.createDataFrame(data, SCHEMA)) == expected(data) != []


def test_window_borders():
    """Borders are whole numbers: half a positive's score and 95 hundredths of it, both included."""
    for score in (0, 1, 2, 3, 19, 20, 101):
        low, high = hardneg.bounds(score, 50, 95)
        assert [n for n in range(-5, 200) if 50 * score <= 100 * n <= 95 * score] == list(range(low, high + 1))
