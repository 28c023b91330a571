"""Connected components of a link table, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.session import stage


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id that occurs in ``links`` (``a``, ``b``, longs, not null):
    the smallest id reachable by links.

    Each round every id points to the least among itself and its neighbours and the links are
    redrawn between the ids pointed to. Rounds take turns between the order of ids, which folds
    stars at once, and a new hash order, which makes a constant share of ids go away whatever the
    links look like. All steps are joins and minima with partial aggregation; lineage is cut by
    written tables every round.
    """
    links = stage(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    names = None        # original id -> id that stands for it now
    first = links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))).distinct()
    round_ = 0
    while not links.isEmpty():
        def ordered(c, r=round_):
            by = F.xxhash64(F.col(c), F.lit(r)) if r % 2 else F.col(c)
            return F.struct(by.alias("h"), F.col(c).alias("to"))

        both = links.union(links.select("b", "a"))
        points = (both.groupBy(F.col("a").alias("id"))
                  .agg(F.least(F.min(ordered("b")), F.min(ordered("a"))).alias("p"))
                  .select("id", F.col("p.to").alias("to")))
        points = stage(points, "points")
        if names is None:
            names = points
        else:
            moved = names.join(points.withColumnRenamed("id", "was").withColumnRenamed("to", "now"),
                               F.col("to") == F.col("was"), "left")
            names = stage(moved.select("id", F.coalesce("now", "to").alias("to")), "names")
        a = points.select(F.col("id").alias("a"), F.col("to").alias("a2"))
        b = points.select(F.col("id").alias("b"), F.col("to").alias("b2"))
        links = stage(links.join(a, "a").join(b, "b").filter(F.col("a2") != F.col("b2"))
                      .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links")
        round_ += 1
    if names is None:
        return first.select("id", F.col("id").alias("component"))
    least = names.groupBy("to").agg(F.min("id").alias("component"))
    return names.join(least, "to").select("id", "component")
