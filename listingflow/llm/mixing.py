"""Mixing sources to target weights by entropy balancing.

Document rates r_i are the ones closest to 1 (least sum of size_i * (r_i ln r_i - r_i + 1)) whose
taken words meet the target of each source. The convex dual has one multiplier per source; its
optimum tilts every rate exponentially, r_i = exp(lambda of its source). Newton steps on the dual
run as DataFrame expressions over the distributed sums per source. Rates are then rounded into
copies: documents of a source stand in order of size, and an extra copy is due whenever the
running sum of the rates passes the next half; so neighbours of like size share the rounding and
a source misses its target by at most about one document.

Only built-in functions. No window or group holds a source's documents: ranks come from counts
per (source, size, slice of ids), so the work of a hot source or size is spread.

Defined results: null, empty and blank texts have size 0 and take 0; the null source is a source
of its own, last in order; an empty table gives an empty table; repeated document ids are kept
(each row is a document); ties in size are ordered by slice and id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.common import word_count
from listingflow.session import stage

WEIGHTS = (3, 1, 2)     # by place of the source, repeating
SHARE = 1.5             # of all sizes
MOST = 2.0              # copies of a document, and of a source
SLICES = 64             # of the ids of one source and size
NEWTON_STEPS = 24


def source_targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Each source's target is its weight times a common level, cut at ``most`` times its size; the
    level is raised over the uncut sources until none is above. One row per source; each round
    sends four numbers to the driver, and there are at most as many rounds as sources.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())      # one row per source
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = stage(per_source.select("source", "source_size", weight.cast("double").alias("weight")), "mix-sources")
    cap = F.col("source_size") * most
    total = float(rows.agg(F.sum("source_size").cast("double")).first()[0] or 0.0) * share
    level, cut = None, -1
    while True:
        above = F.col("weight") * F.lit(level or 0.0) > cap
        got = rows.agg(F.sum(F.when(above, 1).otherwise(0)).alias("n"),
                       F.sum(F.when(above, cap).otherwise(0.0)).alias("cut"),
                       F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not got["open"] or (level is not None and got["n"] == cut):
            break
        level, cut = (total - got["cut"]) / got["open"], got["n"]
    return rows.select("source", "source_size", F.least(F.col("weight") * F.lit(level or 0.0), cap).alias("target"))


def rates(targets: DataFrame, *, steps: int = NEWTON_STEPS, most: float = MOST) -> DataFrame:
    """Add ``rate``: Newton on the dual size * exp(x) - target * x, from x = 0, for each source.

    After the first step x is right of the optimum, where steps of the convex dual only come
    closer; a first step to the left is at most 1 since targets are at most ``most`` sizes. Rates
    are kept to nine decimals, so that the last bits of exp do not decide a copy.
    """
    size, target = F.col("source_size").cast("double"), F.col("target")
    step = lambda x, _: x - F.lit(1.0) + target / (size * F.exp(x))
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step)
    rate = F.when((size > 0) & (target > 0), F.least(F.round(F.exp(solved), 9), F.lit(most))).otherwise(F.lit(0.0))
    return targets.withColumn("rate", rate)


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken``, one row per document."""
    narrow = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size")), "mix-docs")
    goal = stage(rates(source_targets(narrow)), "mix-rates")
    part = F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(SLICES)).cast("int")
    rows = narrow.withColumn("slice", part)
    # Documents before each (source, size) and before each slice of it, from counts alone.
    slices = rows.groupBy("source", "size", "slice").agg(F.count("*").alias("n"))
    sizes = slices.groupBy("source", "size").agg(F.sum("n").alias("n"))
    by_size = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before_size = sizes.select("source", "size", F.coalesce(F.sum("n").over(by_size), F.lit(0)).alias("b1"))
    before_slice = slices.select("source", "size", "slice", F.coalesce(F.sum("n").over(by_slice), F.lit(0)).alias("b2"))
    same = lambda a, b, *on: [a[c].eqNullSafe(b[c]) for c in on]
    starts = (before_slice.join(before_size, same(before_slice, before_size, "source", "size"))
              .select(before_slice["source"], before_slice["size"], "slice", (F.col("b1") + F.col("b2")).alias("before")))
    starts = (starts.join(goal, starts["source"].eqNullSafe(goal["source"]))
              .select(starts["source"], "size", "slice", "before", "source_size", "target", "rate"))
    within = Window.partitionBy("source", "size", "slice").orderBy("doc_id")
    ranked = rows.withColumn("rank", F.row_number().over(within))
    joined = ranked.join(starts, same(ranked, starts, "source", "size", "slice"))
    whole = F.floor("rate")
    part = F.col("rate") - whole
    rank = F.col("before") + F.col("rank")
    extra = F.floor(part * rank + 0.5) - F.floor(part * (rank - 1) + 0.5)
    return joined.select("doc_id", ranked["size"], "source_size", "target",
                         (whole + extra).cast("long").alias("copies"),
                         ((whole + extra) * ranked["size"]).cast("long").alias("taken"))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS source_size, [3, 1, 2][((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM d GROUP BY source),
c AS (SELECT *, 2.0 * source_size::DOUBLE AS cap, 2.0 * source_size::DOUBLE / weight AS turn, 1.5 * SUM(source_size) OVER ()::DOUBLE AS total FROM s),
f AS (SELECT *, COALESCE(SUM(cap) OVER before, 0) AS cut, SUM(weight) OVER () - COALESCE(SUM(weight) OVER before, 0) AS left_weight
      FROM c WINDOW before AS (ORDER BY turn, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT ARG_MIN((total - cut) / left_weight, turn) FILTER ((total - cut) / left_weight <= turn) AS level FROM f),
t AS (SELECT source, source_size, LEAST(weight * level, cap) AS target FROM f, l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN LEAST(ROUND(target / source_size, 9), 2.0) ELSE 0.0 END AS rate FROM t),
k AS (SELECT d.doc_id, d.size, r.source_size, r.target, FLOOR(r.rate) AS whole, r.rate - FLOOR(r.rate) AS part,
             ROW_NUMBER() OVER (PARTITION BY d.source ORDER BY d.size, ((d.doc_id % 64) + 64) % 64, d.doc_id) AS pos
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (whole + FLOOR(part * pos + 0.5) - FLOOR(part * (pos - 1) + 0.5))::BIGINT AS copies,
       ((whole + FLOOR(part * pos + 0.5) - FLOOR(part * (pos - 1) + 0.5)) * size)::BIGINT AS taken
FROM k
"""
