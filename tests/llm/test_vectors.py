"""Embedding near-duplicates and exact top-k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingflow.llm import embeddedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=3, width=16):
    rng = np.random.default_rng(seed)
    out = []
    for label in (0, 1):
        for _ in range(5):
            centre = rng.normal(size=width)
            out += [((centre + rng.normal(size=width) * 0.06).astype(np.float32).tolist(), label) for _ in range(12)]
    out += [(out[0][0], 0)] * 30 + [(out[0][0], 1), (out[0][0], None)]
    odd = [None, [], [0.0] * width, [float("nan")] + [1.0] * (width - 1), [float("inf")] + [0.0] * (width - 1),
           [None] + [1.0] * (width - 1), [1.0, 2.0], [1.0, 2.0], [1e-30] * width, [-0.0] * (width - 1) + [2.0]]
    out += [(v, 0) for v in odd]
    return [(i, v, l) for i, (v, l) in enumerate(out)]


def fine(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("tile", [2048, 7])
def test_links_and_components(spark, tile):
    data = vectors()
    df = spark.createDataFrame(data, SCHEMA).withColumn("rep", F.lit("x")).withColumn("cell", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           embeddedup.near_duplicates(df, tile=tile).collect()}
    parent, links = {r[0]: r[0] for r in data}, {r[0]: 0 for r in data}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [(i, np.array(v, np.float64), l) for i, v, l in data if l is not None and fine(v) and any(v)]
    for k, (i, a, la) in enumerate(good):
        for j, b, lb in good[k + 1:]:
            if la == lb and len(a) == len(b):
                x, y = a / np.abs(a).max(), b / np.abs(b).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    p, q = root(i), root(j)
                    parent[max(p, q)] = min(p, q)
    assert got == {i: (links[i], root(i), root(i) == i) for i in links}
    assert sum(links.values()) > 500
    assert embeddedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pairs_at_the_threshold(spark):
    """Cosines of exactly 0.98, in several widths, places and scales, all link; those just below do not."""
    data, k = [], 0
    for width in (4, 8, 16, 64):
        for shift in range(4):
            for scale in (1.0, 3.0, 1024.0):
                one, two, less = np.zeros((3, width))
                one[shift], two[[shift, (shift + 1) % 4, (shift + 2) % 4, (shift + 3) % 4]] = scale, (49, 9, 3, 3)
                less[[shift, (shift + 1) % 4, (shift + 2) % 4, (shift + 3) % 4]] = 49, 9, 3, 3.01
                for v in (one, two, less):
                    data.append((k, v.tolist(), 1000 * width + 10 * shift + int(scale > 1) + int(scale > 3)))
                    k += 1
    for kind in ("float", "double"):
        got = {r["vec_id"]: r["n_links"] for r in embeddedup.near_duplicates(spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label int")).collect()}
        for i in range(0, k, 3):
            assert (got[i], got[i + 1], got[i + 2]) == (1, 2, 1), data[i]


def test_grid_of_several_dimensions_and_repeated_ids(spark):
    """The range join through cells, and rows that share an id or have none."""
    data = [(i // 2, v, l) for i, v, l in vectors(9) if l is not None and fine(v) and any(v)]
    keyed = [(n, v, l) for n, (_, v, l) in enumerate(data)]
    distinct = spark.createDataFrame([(*r, 1) for r in {(tuple(v), l): (n, v, l) for n, v, l in keyed}.values()],
                                     "rep long, embedding array<float>, label int, copies long")
    links = {dims: sorted((r["rep"], r["n"]) for r in embeddedup.near_links(distinct, grid_dims=dims).groupBy("rep")
                          .agg(F.sum("links").alias("n")).collect()) for dims in (0, 2, 3)}
    assert links[0] == links[2] == links[3] and sum(n for _, n in links[0]) > 200
    data.append((None, data[0][1], data[0][2]))
    keyed.append((len(keyed), data[0][1], data[0][2]))
    by_row = {r["vec_id"]: r for r in embeddedup.near_duplicates(spark.createDataFrame(keyed, SCHEMA)).collect()}
    ids = [r[0] for r in data]
    least = {}
    for n, r in by_row.items():
        least.setdefault(r["component_id"], []).extend([ids[n]] if ids[n] is not None else [])
    want = [(ids[n], r["n_links"], min(least[r["component_id"]], default=None)) for n, r in by_row.items()]
    got = [tuple(r)[:3] for r in embeddedup.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and any(r[0] is None and r[1] for r in got)


def test_top_k_of_repeated_and_null_ids(spark):
    data = [(0, [1.0, 0.5], 0), (1, [0.2, 0.1], 0), (1, [0.9, 0.9], 0), (2, [0.3, 0.3], 0), (None, [0.9, 0.9], 0), (0, [0.1, 2.0], 0)]
    got = sorted((tuple(r) for r in topk.top_k(spark.createDataFrame(data, SCHEMA)).collect()), key=repr)
    want = []
    for n, (q, a, _) in enumerate(data):
        if q == 0:
            scored = sorted((-sum(math.floor(256 * float(np.float32(x))) * math.floor(256 * float(np.float32(y))) for x, y in zip(a, b, strict=True)), i is None, i or 0)
                            for m, (i, b, _) in enumerate(data) if m != n)
            want += [(0, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(scored[:5])]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("rows", [8192, 40])
def test_top_k(spark, rows):
    data = vectors(4)
    data += [(1000 + i, v, l) for i, (_, v, l) in enumerate(vectors(5)[:60])]
    df = spark.createDataFrame(data, SCHEMA).withColumn("score", F.lit("x")).withColumn("v", F.lit(1))
    got = {}
    for r in topk.top_k(df, shard_rows=rows).collect():
        got[r["query_id"], r["rank"]] = (r["vec_id"], r["score"])
    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in data if fine(v)}
    expected = {}
    for q, a in whole.items():
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in whole.items() if i != q)
            expected |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scored[:5])}
    assert got == expected
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_shard_with_pruning_equals_full_scoring():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(1, 1500))
        v = np.floor(rng.normal(size=(8, n)) * 20 * rng.choice([1, 0.05], size=(8, 1)))
        ids, query = rng.permutation(n).astype(np.int64), np.floor(rng.normal(size=8) * 50)
        got = topk.max_score(np.arange(n), ids, v, 0, query, 5, v.max(axis=1), v.min(axis=1))
        scores = query @ v
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != ids[0])[:5]
        assert [(s, int(ids[p])) for s, p in got] == [(int(-s), i) for s, i in best]
