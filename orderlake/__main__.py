"""Run the whole pipeline and print the first rows of the metrics.

    python -m orderlake --sources DIR      # the five source files (see sources.files)
    python -m orderlake --sf-dir DIR       # feeds derived from the driver's test tables

Tables go below ``--out`` (default: spark.checkpoint.dir/tables-<run>).
"""

from __future__ import annotations

import argparse
import uuid

from orderlake.plans import pipeline
from orderlake.session import apply_sizing, build_session, input_bytes, work_root
from orderlake.sinks import TableStore
from orderlake.sources import fixtures
from orderlake.sources.files import read_feeds


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="orderlake")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sources", help="folder with the five source files")
    src.add_argument("--sf-dir", help="folder with the driver's parquet tables")
    ap.add_argument("--out", help="root folder for the tables")
    ap.add_argument("--master", help="default: the launcher's master (spark-submit)")
    ap.add_argument("--shuffle-partitions", type=int,
                    help="default: sized from the input (~256 MB per partition)")
    ap.add_argument("--null-gates", choices=["raise", "report"], default="raise")
    ap.add_argument("--as-of", help="tenure reference date (default: today)")
    ap.add_argument("--rows", type=int, default=20,
                    help="first rows of each metric to show (the tables hold all)")
    ap.add_argument("--format", default="parquet", help="table format, for instance delta")
    ap.add_argument("--fx-lines", action="store_true",
                    help="the FX file is JSON Lines, not one JSON array")
    args = ap.parse_args(argv)

    spark = build_session(args.master, args.shuffle_partitions or 16, "orderlake")
    if args.shuffle_partitions is None:
        sized = apply_sizing(spark, input_bytes(spark, [args.sources or args.sf_dir]))
        print(f"shuffle partitions: {sized['spark.sql.shuffle.partitions']}")
    out = args.out or f"{work_root(spark)}/tables-{uuid.uuid4().hex[:8]}"
    store = TableStore(spark, out, fmt=args.format)
    if args.sources:
        feeds = read_feeds(spark, args.sources, fx_multi_line=not args.fx_lines)
        source_file = f"{args.sources}/orders.csv"
    else:
        feeds, source_file = fixtures.sources(spark, args.sf_dir), "raw_orders"
    res = pipeline.run(spark, feeds, store, source_file=source_file,
                       null_gate_mode=args.null_gates, as_of=args.as_of)
    print(f"run {res.run_id}: tables under {out}")
    for key, n in res.counts.items():
        print(f"  {key:32s} {n:>12,d}")
    print("order rows: " + ", ".join(f"{k} {v:,d}" for k, v in res.orders.items()))
    print("order lines left out: " + ", ".join(f"{k} {v:,d}" for k, v in res.lost_lines.items()))
    for name, df in pipeline.metric_frames(store, args.as_of, ordered=True).items():
        print(f"\n== {name}")
        df.show(args.rows, truncate=False)
    pipeline.summary(store).show(50, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
