"""Command line: the scheduled jobs and the registered queries.

    python -m velotide land   --landing DIR --raw DIR --month 2026-07
    python -m velotide daily  --raw DIR --out DIR --calendar 2026-01-01:2027-12-31 --as-of "2026-08-01 02:00:00"
                              [--month 2026-07] [--full-refresh] [--compat last_batch_wins] [--strict]
    python -m velotide stream --source kafka --option kafka.bootstrap.servers=... --option subscribe=...
                              --out DIR --checkpoint DIR [--available-now]
    python -m velotide query  NAME --sf-dir DIR [--rows 20]
    python -m velotide sql    --marts DIR "SELECT member_casual, sum(trip_count) FROM agg_daily_trip_summary GROUP BY 1"
"""

from __future__ import annotations

import argparse
import uuid

from velotide.session import cluster_conf, get_session


def _opts(pairs):
    return dict(p.split("=", 1) for p in pairs or [])


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="velotide")
    ap.add_argument("--size", metavar="INPUT_BYTES:CORES", help="size shuffles and splits for this input and cluster")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("land")
    a.add_argument("--landing", required=True)
    a.add_argument("--raw", required=True)
    a.add_argument("--month", required=True)
    a.add_argument("--compat")
    d = sub.add_parser("daily")
    d.add_argument("--raw", required=True, help="folder with trip_history/, station_information/, station_status/")
    d.add_argument("--out", required=True)
    d.add_argument("--calendar", required=True)
    d.add_argument("--as-of", required=True)
    d.add_argument("--month")
    d.add_argument("--full-refresh", action="store_true")
    d.add_argument("--compat")
    d.add_argument("--strict", action="store_true", help="fail when a data test fails")
    d.add_argument("--log")
    d.add_argument("--check-scope", default="all", choices=["all", "run"])
    s = sub.add_parser("stream")
    s.add_argument("--source", default="kafka")
    s.add_argument("--option", action="append")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    x = sub.add_parser("sql")
    x.add_argument("--marts", required=True)
    x.add_argument("statement")
    x.add_argument("--rows", type=int, default=50)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)
    sizing = cluster_conf(*map(int, args.size.split(":"))) if args.size else None
    spark = get_session(app=f"velotide-{args.cmd}", extra=sizing)

    if args.cmd == "land":
        from velotide.plans.jobs import land_month
        print(land_month(spark, args.landing, args.raw, args.month, compat=args.compat))
    elif args.cmd == "daily":
        from velotide.plans.jobs import daily_transform
        from velotide.operators.versions import read_table
        from velotide.sources.ingest import read_landed_trips
        first, last = args.calendar.split(":")
        raw = args.raw.rstrip("/")
        report = daily_transform(
            spark, read_landed_trips(spark, raw, args.compat), read_table(spark, f"{raw}/station_information"),
            spark.read.parquet(f"{raw}/station_status"), args.out, (first, last), args.as_of,
            source_month=args.month,
            full_refresh=args.full_refresh, compat=args.compat, severity="error" if args.strict else "warn",
            log_path=args.log, run_id=uuid.uuid4().hex, check_scope=args.check_scope)
        report.show(100, truncate=False)
    elif args.cmd == "stream":
        from velotide.streaming.status_stream import start_status_stream, status_stream
        events = status_stream(spark, args.source, _opts(args.option))
        q = start_status_stream(events, args.out, args.checkpoint, {"availableNow": True} if args.available_now else None)
        q.awaitTermination()
    elif args.cmd == "sql":
        from velotide.plans.jobs import register_views
        register_views(spark, args.marts)
        spark.sql(args.statement).show(args.rows, truncate=False)
    elif args.cmd == "query":
        from velotide.registry import QUERIES
        QUERIES[args.name](spark, args.sf_dir).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
