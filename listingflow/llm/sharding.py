"""Sharding by a k-d tree over the documents' metadata: size, source and language.

A node that stands for m shards is cut, along its widest dimension, at the weighted (m // 2) / m
point, until each leaf is one shard. Weights are bytes, so shard sizes come out near equal (law
``bytes``). The cut is found by distributed histograms: all nodes of a level are counted in one
aggregation, the bucket that holds the cut is divided anew, until it weighs less than a small
part of a shard.

Equal texts are one unit of the tree, placed by the least of their sources and languages, so no
cut goes through them. The law needs one exception: equal texts that weigh more than ``HEAVY`` of
a shard together are several units, told apart by hashed id, each about that heavy.

Only built-in functions. What reaches the driver per round is at most nodes x BUCKETS sums. Of the
texts over ``HEAVY`` there are at most shards / HEAVY, which are broadcast.

Defined results: a null text is 0 bytes and equals an empty one; a null source or language is a
value of its own; repeated ids are separate rows; rows of one text without an id are one unit,
however many; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import stage

SHARDS = 24
DIMENSIONS = ("k0", "k1", "k2")
BUCKETS = 4096          # of a node's range, each round
TOLERANCE = 0.002       # of a shard's bytes: how near a cut comes to its point
HEAVY = 0.05            # of a shard's bytes: what equal texts may weigh as one unit
SLICES = 64             # of the rows of a shard, to number them
RUN = 1 << 16           # equal rows that are numbered at a time
UNIT = ("size", "text_crc32", "text_hash", "piece")


def documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              lang_col: str = "lang") -> DataFrame:
    """``doc_id, size, text_crc32, text_hash, source, lang``, the last two as checksums."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    value = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(0))
    return docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
        value(source_col).alias("source"), value(lang_col).alias("lang"))


def in_pieces(rows: DataFrame, shards: int, heavy: float = HEAVY) -> DataFrame:
    """``rows`` with ``piece``: 0, or for equal texts heavier than ``heavy`` of a shard a number by
    hashed id."""
    texts = rows.groupBy(*UNIT[:3]).agg(F.sum("size").alias("w"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1.0, total / shards * heavy)
    pieces = F.broadcast(texts.filter(F.col("w") > limit).select(*UNIT[:3], F.ceil(F.col("w") / limit).alias("pieces")))
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pieces")))
    return rows.join(pieces, list(UNIT[:3]), "left").withColumn("piece", F.coalesce(own, F.lit(0)).cast("long")).drop("pieces")


def units(rows: DataFrame) -> DataFrame:
    """One row per unit of the tree: ``UNIT``, its weight ``w`` and its keys ``k0, k1, k2``. A key
    orders by size, source or language and, below it, by 31 bits of text and piece."""
    tie = F.pmod(F.xxhash64("text_hash", "piece"), F.lit(1 << 31))
    key = lambda value: F.shiftleft(F.least(value, F.lit((1 << 32) - 1)), 31) + tie
    return (rows.groupBy(*UNIT).agg(F.sum("size").alias("w"), F.min("source").alias("source"), F.min("lang").alias("lang"))
            .select(*UNIT, "w", key(F.col("size")).alias("k0"), key(F.col("source")).alias("k1"), key(F.col("lang")).alias("k2")))


def _cuts(rows: DataFrame, shards: dict[int, int], whole: list[int], tolerance: float) -> dict[int, tuple[int, int]]:
    """For each node with several shards: its widest dimension and the first key right of the cut.
    ``rows`` has ``node``; ``whole`` has the width of the whole table in each dimension. Widths are
    those of the values alone; a node of one value in each dimension is cut by text."""
    spark, keys = rows.sparkSession, range(len(DIMENSIONS))
    live = rows.filter(F.col("node").isin([n for n, m in shards.items() if m > 1]))
    extent = [f(d).alias(f"{n}_{k}") for k, d in enumerate(DIMENSIONS) for n, f in (("min", F.min), ("max", F.max))]
    state = {}
    for r in live.groupBy("node").agg(F.sum("w").alias("w"), *extent).collect():
        wide = max(keys, key=lambda k: (((r[f"max_{k}"] >> 31) - (r[f"min_{k}"] >> 31)) / max(1, whole[k]), -k))
        m = shards[r["node"]]
        state[r["node"]] = {"dim": wide, "lo": r[f"min_{wide}"], "hi": r[f"max_{wide}"] + 1, "before": 0,
                            "goal": r["w"] * (m // 2) / m, "least": r["w"] / m * tolerance, "cut": None}
    while todo := {n: s for n, s in state.items() if s["cut"] is None}:
        step = {n: -(-(s["hi"] - s["lo"]) // BUCKETS) for n, s in todo.items()}
        # At most one row per node; joined rather than written into the plan, so that every round
        # runs the same compiled code.
        ranges = spark.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("node"), F.lit(s["dim"]).alias("dim"), F.lit(s["lo"]).cast("long").alias("lo"),
                     F.lit(step[n]).cast("long").alias("step")) for n, s in todo.items()])))
        low = F.element_at(F.array(*DIMENSIONS), F.col("dim") + 1) - F.col("lo")
        at = F.when(low < 0, -1).otherwise(F.call_function("div", low, F.col("step")))
        inside = (live.join(F.broadcast(ranges), "node").select("node", "w", at.alias("at"))
                  .filter((F.col("at") >= 0) & (F.col("at") < BUCKETS)))
        sums: dict[int, dict[int, int]] = {}
        for r in inside.groupBy("node", "at").agg(F.sum("w").alias("w")).collect():
            sums.setdefault(r["node"], {})[r["at"]] = r["w"]
        for n, s in todo.items():
            run, each = s["before"], sums[n]
            for b in sorted(each):
                if run + each[b] > s["goal"]:
                    break
                run += each[b]
            start, end = s["lo"] + b * step[n], s["lo"] + (b + 1) * step[n]
            if step[n] == 1 or each[b] <= s["least"]:
                near = run + each[b] - s["goal"] < s["goal"] - run      # the nearer side of the bucket
                s["cut"] = end if near else start
            else:
                s |= {"lo": start, "hi": end, "before": run}
    return {n: (s["dim"], s["cut"]) for n, s in state.items()}


def numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (of ``columns``) with ``slot``, gapless from 0 in each shard. The numbers follow the
    rows' hash; equal rows are counted first and numbered as a run."""
    part = F.pmod(F.xxhash64(*columns), F.lit(SLICES)).cast("int")
    runs = rows.groupBy("shard", part.alias("slice"), *columns).agg(F.count("*").alias("n"))
    within = Window.partitionBy("shard", "slice").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("shard", part.alias("slice")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    last = F.col("start") + F.col("n") - 1
    return (runs.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["shard", "slice"])
            .select("shard", *columns, "n", (F.col("before") + F.col("at")).alias("start"))
            .select("shard", *columns, last.alias("last"), _each(F.col("start"), last, RUN).alias("head"))
            .select("shard", *columns, _each(F.col("head"), F.least("last", F.col("head") + RUN - 1), 1).alias("slot")))


def _each(first: Column, last: Column, step: int) -> Column:
    return F.explode(F.sequence(first, last, F.lit(step).cast("long")))


def shard(docs: DataFrame, *, shards: int = SHARDS, tolerance: float = TOLERANCE, heavy: float = HEAVY,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every document."""
    rows = stage(documents(docs, id_col=id_col, text_col=text_col, source_col=source_col, lang_col=lang_col), "shard-rows")
    rows = in_pieces(rows, shards, heavy)
    tree = stage(units(rows).withColumn("node", F.lit(0)), "shard-units")
    value = lambda d: F.shiftright(d, 31)
    first = tree.agg(*[(F.max(value(d)) - F.min(value(d))).alias(d) for d in DIMENSIONS]).first()
    whole = [first[d] or 0 for d in DIMENSIONS]
    nodes = {0: shards}                 # a node is named by its first shard and has so many of them
    while any(m > 1 for m in nodes.values()):
        cuts = _cuts(tree, nodes, whole, tolerance)
        node = F.col("node")
        for n, (dim, cut) in cuts.items():
            right = (F.col("node") == n) & (F.col(DIMENSIONS[dim]) >= F.lit(cut))
            node = F.when(right, n + nodes[n] // 2).otherwise(node)
        tree = stage(tree.withColumn("node", node), "shard-nodes")
        # A node without documents stays one node; its other shards are empty.
        nodes = {k: v for n, m in nodes.items()
                 for k, v in (((n, m // 2), (n + m // 2, m - m // 2)) if n in cuts else ((n, 1),))}
    placed = stage(rows.join(tree.select(*UNIT, F.col("node").alias("shard")), list(UNIT))
                   .select("doc_id", "size", "text_crc32", "shard"), "shard-placed")
    return numbered(placed, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
