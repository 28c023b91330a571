"""Command line: ``python -m listingflow <step> ...``
(or ``spark-submit --py-files listingflow.zip listingflow/__main__.py <step> ...``).

Steps: ``run`` (ingest new files, silver, gold, calendar), ``ingest``, ``silver``, ``gold``,
``calendar``, ``trim`` (delete the silver batches that gold has taken over).
"""

from __future__ import annotations

import argparse
import json

from listingflow.plans import lakehouse as L
from listingflow.session import get_spark
from listingflow.sources.tables import TableStore
from listingflow.streaming.ingest import read_ingested


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="listingflow")
    parser.add_argument("step", choices=["run", "ingest", "silver", "gold", "calendar", "trim"])
    parser.add_argument("--root", required=True, help="root folder of the tables on shared storage")
    parser.add_argument("--database", help="catalog database of the tables (default: named after the root)")
    parser.add_argument("--raw-dir", help="folder or glob of arriving raw files")
    parser.add_argument("--raw-format", default="parquet")
    parser.add_argument("--as-of", default=None, help="ready-to-move reference date (default today)")
    parser.add_argument("--buckets", type=int, default=64, help="bucket count of new tables")
    parser.add_argument("--quality-gate", action="store_true")
    parser.add_argument("--max-bad-share", type=float, default=0.05)
    parser.add_argument("--means-from", choices=["batch", "history"], default="batch")
    args = parser.parse_args(argv)

    import datetime as dt
    spark = get_spark("listingflow")
    cfg = L.RunConfig(root=args.root, as_of=args.as_of or dt.date.today().isoformat(),
                      raw_dir=args.raw_dir, raw_format=args.raw_format, buckets=args.buckets, database=args.database,
                      quality_gate=args.quality_gate, max_bad_share=args.max_bad_share,
                      means_from=args.means_from,
                      order_cols=("bronze_ingested_at", "source_file_path"))
    store = TableStore(spark, args.root, args.database)
    if args.step == "run":
        out = L.run_lakehouse(spark, None, cfg)
    elif args.step == "ingest":
        out = {"bronze_rows": L.ingest_step(spark, cfg).count()}
    elif args.step == "silver":
        out = L.silver_step(store, read_ingested(spark, f"{args.root}/bronze/data", f"{args.root}/bronze/_schema"), cfg)
    elif args.step == "gold":
        out = L.gold_step(store, cfg)
    elif args.step == "calendar":
        out = L.calendar_step(store)
    else:
        out = {"deleted_batches": L.trim_changes(store)}
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
