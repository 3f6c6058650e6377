"""Command line: the stream job, the refresh fed by its output, and catalog inspection.

  python -m flightlake stream  --source DIR --out DIR --checkpoint DIR [--once] [--max-age-minutes 9]
  python -m flightlake refresh (--windows DIR | --window-files DIR) --airframes CSV --models CSV --out DIR
  python -m flightlake inspect --table NAME=PATH [--table ...] [--preview 10]
"""

from __future__ import annotations

import argparse
import logging
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="flightlake")
    ap.add_argument("--master", help="Spark master; left to spark-submit if not given")
    ap.add_argument("--input-bytes", type=int, help="size of the input: sets partitions for it on a cluster")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream", help="window job over landed JSON snapshots")
    s.add_argument("--source", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true", help="process what is there and stop (availableNow)")
    s.add_argument("--max-age-minutes", type=float, default=9.0)
    r = sub.add_parser("refresh", help="newest closed window -> enrichment -> anomalies")
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--windows", help="output folder of the stream command")
    src.add_argument("--window-files", help="root of date=YYYY/MM/DD/window_raw_*.parquet files")
    r.add_argument("--airframes", required=True)
    r.add_argument("--models", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--published", action="store_true", help="publish all outputs in one step, as a version under --out")
    i = sub.add_parser("inspect", help="row counts and columns of Parquet tables")
    i.add_argument("--table", action="append", required=True, help="NAME=PATH")
    i.add_argument("--preview", type=int, default=0)
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    from flightlake.session import build_session, cluster_conf
    spark = build_session(args.master)
    if args.input_bytes:
        cores = spark.sparkContext.defaultParallelism
        for key, value in cluster_conf(args.input_bytes, cores).items():
            if spark.conf.isModifiable(key):
                spark.conf.set(key, value)
    if args.cmd == "stream":
        from flightlake.sources import snapshots
        from flightlake.streaming import windows as sw
        spark.streams.addListener(sw.ProgressLogger(1000))
        src = snapshots.read_snapshots(spark, args.source, stream=True)
        rejects = sw.start_rejects_job(src, f"{args.out}/rejects", f"{args.checkpoint}-rejects", available_now=args.once)
        q = sw.start_window_job(spark, src, args.out, args.checkpoint, available_now=args.once,
                                max_age_minutes=args.max_age_minutes)
        q.awaitTermination()
        rejects.awaitTermination()
    elif args.cmd == "refresh":
        from flightlake.plans import refresh as rf
        from flightlake.sources import windows
        af, md = windows.read_airframes_csv(spark, args.airframes), windows.read_models_csv(spark, args.models)

        def job(folder):
            if args.windows:
                return rf.refresh_from_windows(spark, args.windows, af, md, folder)
            return rf.refresh_from_window_files(spark, args.window_files, af, md, folder)

        out = rf.published(spark, args.out, job) if args.published else job(args.out)
        for row in out.collect():
            print(f"{row.output}\t{row.rows}")
    else:
        from flightlake.sources import catalog
        for spec in args.table:
            name, path = spec.split("=", 1)
            spark.read.parquet(path).createOrReplaceTempView(name)
        names = [t.split("=", 1)[0] for t in args.table]
        for row in catalog.table_profile(spark, names).collect():
            print(f"{row.table_name}\trows={row.row_count}\tcolumns={row.column_types}")
            if args.preview:
                catalog.preview(spark, row.table_name, args.preview).show(truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
