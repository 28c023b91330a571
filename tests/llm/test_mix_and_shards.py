"""Source mixing against SQL and its laws; k-d shards against a direct tree and their laws."""

import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from listingflow.llm import mixing, sharding
from llm_rows import frame, rows


def test_mix_equals_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    got = sorted(map(tuple, mixing.mix(spark.read.parquet(path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = sorted(con.execute(mixing.ORACLE).fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b)


def water(sizes, weights, share=1.5, most=2.0):
    """Targets by handing out the excess again and again."""
    target, open_, left = {}, set(sizes), share * sum(sizes.values())
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * unit > most * sizes[s]}
        if not over:
            return target | {s: weights[s] * unit for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_laws_on_every_case(spark):
    data = rows()
    out = mixing.mix(frame(spark, data, clash=True)).collect()
    again = mixing.mix(frame(spark, data[::-1], clash=True).repartition(3)).collect()
    assert sorted(out) == sorted(again) and len(out) == len(data)
    source = {r[0]: r[3] for r in data}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = water(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    largest = max(r["size"] for r in out)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= largest
        assert all(r["source_size"] == sizes[s] for r in out if source[r["doc_id"]] == s)


def test_mix_of_nothing(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    out = mixing.mix(frame(spark, [(1, None, None, "a", 0), (2, " ", None, None, 0)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2


def test_newton_reaches_the_optimum(spark):
    t = spark.createDataFrame([("a", 1000, 2000.0), ("b", 1000, 1.0), ("c", 10**9, 1.5e9), ("d", 0, 0.0)],
                              "source string, source_size long, target double")
    got = {r["source"]: r["rate"] for r in mixing.rates(t).collect()}
    assert got == pytest.approx({"a": 2.0, "b": 0.001, "c": 1.5, "d": 0.0})


def test_shards_of_every_case(spark):
    data = rows()
    df = frame(spark, data, clash=True)
    out = sharding.shard(df, shards=5).collect()
    again = sharding.shard(frame(spark, data[::-1]).repartition(2), shards=5).collect()
    assert sorted(out) == sorted(again) and len(out) == len(data)
    text = {r[0]: (r[1] or "").encode() for r in data}
    slots = defaultdict(list)
    for r in out:
        assert r["size"] == len(text[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def direct_tree(units, shards):
    """Shard of each unit by the same tree over rows in memory, cut at the exact weighted point."""
    def width(part, d):
        return (max(r[d] for r in part) >> 31) - (min(r[d] for r in part) >> 31)

    whole = {d: width(units, d) for d in sharding.DIMENSIONS}
    shard_of = {}

    def cut(part, first, many):
        if many == 1 or not part:
            shard_of.update((tuple(r[c] for c in sharding.UNIT), first) for r in part)
            return
        widths = {d: width(part, d) / max(1, whole[d]) for d in sharding.DIMENSIONS}
        wide = max(sharding.DIMENSIONS, key=lambda d: (widths[d], -sharding.DIMENSIONS.index(d)))
        at, goal, run = defaultdict(int), sum(r["w"] for r in part) * (many // 2) / many, 0
        for r in part:
            at[r[wide]] += r["w"]
        for key in sorted(at):
            if run + at[key] > goal:
                break
            run += at[key]
        left = key + (run + at[key] - goal < goal - run)
        cut([r for r in part if r[wide] < left], first, many // 2)
        cut([r for r in part if r[wide] >= left], first + many // 2, many - many // 2)

    cut(units, 0, shards)
    return shard_of


@pytest.mark.parametrize("shards", [24, 7])
def test_shards_equal_a_direct_tree(spark, shards):
    """Row by row, on whole documents with copies, sources and languages."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows_ = sharding.in_pieces(sharding.documents(docs), shards).cache()
    want = direct_tree([r.asDict() for r in sharding.units(rows_).collect()], shards)
    by_id = {r["doc_id"]: want[tuple(r[c] for c in sharding.UNIT)] for r in rows_.collect()}
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, shards=shards, tolerance=0).collect()}
    assert got == by_id


def test_shard_sizes_and_groups_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = sharding.shard(docs).collect()
    size, groups, weight = defaultdict(int), defaultdict(set), defaultdict(int)
    for r in out:
        size[r["shard"]] += r["size"]
        groups[r["size"], r["text_crc32"]].add(r["shard"])
        weight[r["size"], r["text_crc32"]] += r["size"]
    mean = sum(size.values()) / 24
    assert sorted(size) == list(range(24)) and all(abs(b - mean) < 0.1 * mean for b in size.values())
    assert all(len(s) == 1 for g, s in groups.items() if weight[g] <= sharding.HEAVY * mean)


def test_cuts_follow_source_and_language(spark):
    """Texts of one size: the tree can cut by source and language only, and keeps them apart."""
    data = [(i, f"text {i:05d}", "en" if i % 2 else "de", f"s{i // 2 % 2}", 0) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n long")
    out = {r["doc_id"]: r["shard"] for r in sharding.shard(df, shards=4, tolerance=0).collect()}
    kinds = defaultdict(set)
    for i, _, lang, source, _ in data:
        kinds[lang, source].add(out[i])
    assert all(len(s) == 1 for s in kinds.values()) and len(set.union(*kinds.values())) == 4


def test_equal_texts_share_a_shard(spark):
    """Whatever their sources and languages."""
    data = [(i, f"text number {i // 3} " * (1 + i // 3 % 7), f"l{i % 2}", f"s{i % 5}", 0) for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n long")
    shards = defaultdict(set)
    for r in sharding.shard(df, shards=6).collect():
        shards[r["doc_id"] // 3].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_one_group_of_copies_is_cut_evenly(spark):
    """It outweighs the shards, so it is cut by id; without ids it is one unit, numbered as a run."""
    data = [(i, "the same text", None, None, 0) for i in range(800)]
    out = sharding.shard(frame(spark, data), shards=8).groupBy("shard").count().collect()
    assert len(out) == 8 and all(70 <= r["count"] <= 130 for r in out)
    alone = frame(spark, data).withColumn("doc_id", F.lit(None).cast("long"))
    out = sharding.shard(alone, shards=8).collect()
    assert len({r["shard"] for r in out}) == 1 and sorted(r["slot"] for r in out) == list(range(800))
    assert sharding.shard(frame(spark, [])).count() == 0


def test_repeated_ids_and_runs_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    data = [(i % 3, "copy" * (1 + i % 2), None, None, 0) for i in range(100)]
    out = sharding.shard(frame(spark, data), shards=3).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert len(out) == 100 and all(sorted(v) == list(range(len(v))) for v in slots.values())
