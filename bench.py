"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON
line with per-query seconds (full execution through the no-op sink, after one warm-up)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "silver_listings",      # raw -> newest version -> cleaning -> means -> validation
    "fact_listings",        # silver -> SCD2 developers, locations, profiles -> fact
    "upsert_listings",      # two silver batches merged by key
    "scd2_history",         # full SCD2 rebuild from history
    "scd2_incremental",     # SCD2 by yearly merges
    "lookup_as_of",         # point-in-time dimension lookup
    "top_developers",       # flagship star query
    "star_measures",
    "quality_summary",
    "chat_context",
    "audit_queries",
    "ingest_stream",
)


def lakehouse_runs(spark, sf_dir: str) -> dict:
    """Batch runner timings: full silver and gold steps, then one incremental run in which 1 % of
    the listings receive a newer version (the scenario of a daily change feed)."""
    import datetime as dt

    from pyspark.sql import functions as F

    from listingflow.plans.lakehouse import RunConfig, gold_step, silver_step
    from listingflow.session import scratch_path
    from listingflow.sources.fixtures import raw_listings
    from listingflow.sources.tables import TableStore

    base = scratch_path(spark, "bench-lakehouse")
    raw = raw_listings(spark, sf_dir)
    raw.write.parquet(f"{base}/bronze")                      # the bronze table (not timed)
    changed = (raw.filter(F.substring("Property_ID", 2, 12).cast("bigint") % 100 == 0)
               .withColumn("bronze_ingested_at", F.col("bronze_ingested_at") + F.expr("INTERVAL 40 YEARS"))
               .withColumn("Total_Price", F.concat(F.col("Total_Price"), F.lit("9"))))
    changed.write.parquet(f"{base}/bronze_delta")
    store = TableStore(spark, f"{base}/tables")
    out = {}
    bronze = spark.read.parquet(f"{base}/bronze")
    cfg = RunConfig(root=store.root, as_of="2021-06-30", run_ts=dt.datetime(2030, 1, 1))
    for name, step in (("lakehouse_silver_step", lambda: silver_step(store, bronze, cfg)),
                       ("lakehouse_gold_step", lambda: gold_step(store, cfg))):
        start = time.perf_counter()
        step()
        out[name] = round(time.perf_counter() - start, 3)
    bronze = bronze.unionByName(spark.read.parquet(f"{base}/bronze_delta"))
    cfg2 = RunConfig(root=store.root, as_of="2021-06-30", run_ts=dt.datetime(2030, 1, 2))
    start = time.perf_counter()
    silver_step(store, bronze, cfg2)
    gold_step(store, cfg2)
    out["lakehouse_incremental_1pct"] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from listingflow.session import get_spark
    from listingflow.plans.registry import QUERIES
    from listingflow.sources.fixtures import raw_listings

    spark = get_spark("listingflow-bench", master=f"local[{cpus}]",
                      shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                      conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                            "spark.ui.showConsoleProgress": "false"})
    # Warm-up (not timed): one raw join and one full silver pass, so JIT compilation of the
    # generated code is not charged to whichever query happens to run first.
    raw_listings(spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["silver_listings"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or list(HEADLINE)
    timings = {}
    for name in names:
        if name == "lakehouse":
            continue
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    if not sys.argv[1:] or "lakehouse" in sys.argv[1:]:
        timings.update(lakehouse_runs(spark, sf_dir))
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": float(sf) if sf else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
