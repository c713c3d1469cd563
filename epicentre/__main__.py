"""Command line: ingest landed snapshots, load history, stream, build the models, run the checks.

    python -m epicentre ingest   --warehouse W --snapshots GLOB [--run-ts TS]
    python -m epicentre backfill --warehouse W --snapshots GLOB [--start DATE] [--end DATE] [--min-magnitude M]
    python -m epicentre stream   --warehouse W --landing GLOB --checkpoint C [--interval "5 minutes"]
                                 [--files-per-trigger N] [--transform-every-minutes 10] [--available-now]
    python -m epicentre build    --warehouse W [--as-of DATE] [--run-ts TS] [--select M ...] [--full-refresh]
    python -m epicentre check    --warehouse W [--as-of DATE]

Feed files may hold one document in any layout or JSON Lines. Scheduling is left to the caller
(cron, a workflow tool, or the stream's own trigger).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from dataclasses import replace

from epicentre.params import RunParams


def _params(args) -> RunParams:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    params = RunParams.at(dt.datetime.fromisoformat(args.run_ts) if args.run_ts else now)
    return replace(params, as_of=dt.date.fromisoformat(args.as_of)) if args.as_of else params


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="epicentre")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "backfill", "stream", "build", "check"):
        p = sub.add_parser(name)
        p.add_argument("--warehouse", required=True, help="table root in the shared file system")
        p.add_argument("--run-ts")
        p.add_argument("--as-of")
    for name in ("ingest", "backfill"):
        sub.choices[name].add_argument("--snapshots", required=True)
        sub.choices[name].add_argument("--layout", choices=["auto", "lines", "document"], default="auto")
    f = sub.choices["backfill"]
    f.add_argument("--start", type=dt.date.fromisoformat)
    f.add_argument("--end", type=dt.date.fromisoformat)
    f.add_argument("--min-magnitude", type=float)
    s = sub.choices["stream"]
    s.add_argument("--landing", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--interval", default="5 minutes")
    s.add_argument("--files-per-trigger", type=int)
    s.add_argument("--transform-every-minutes", type=float)
    s.add_argument("--available-now", action="store_true")
    b = sub.choices["build"]
    b.add_argument("--select", nargs="*")
    b.add_argument("--full-refresh", action="store_true")
    b.add_argument("--maintained", action="store_true", help="risk and heatmap from parts that each build changes by its fact rows")
    args = ap.parse_args(argv)

    from epicentre.plans.pipeline import Pipeline
    from epicentre.session import build_session
    from epicentre.sources import feed
    from epicentre.sources.store import TableStore

    spark = build_session()
    store = TableStore(spark, args.warehouse)
    pipe = Pipeline(spark, store, maintain=getattr(args, "maintained", False))
    params = _params(args)
    if args.cmd in ("ingest", "backfill"):
        collections = feed.accepted(feed.parse_documents(feed.read_documents(spark, args.snapshots, args.layout)))
        records = feed.flatten(collections, params.run_ts_col())
        if args.cmd == "ingest":
            done = pipe.ingest_parsed(records, params)
        else:
            given = {"start": args.start, "end": args.end, "min_magnitude": args.min_magnitude}
            done = pipe.backfill(records, params, **{k: v for k, v in given.items() if v is not None})
        print(f"{done['committed']} rows committed, {done['rejected']} rejected")
    elif args.cmd == "stream":
        from epicentre.streaming.ingest import start_ingest, wall_clock

        every = dt.timedelta(minutes=args.transform_every_minutes) if args.transform_every_minutes else None
        clock = (lambda epoch: params) if args.run_ts else wall_clock
        q = start_ingest(spark, args.landing, store, args.checkpoint, clock, available_now=args.available_now,
                         interval=args.interval, max_files_per_trigger=args.files_per_trigger, transform_every=every)
        q.awaitTermination()
    elif args.cmd == "build":
        pipe.run(params, select=args.select or None, full_refresh=args.full_refresh)
    elif args.cmd == "check":
        report = pipe.quality_report(params, from_writes=True)
        failed = report.filter("status = 'fail'").count()
        report.orderBy("table_name", "column_name", "check_name").show(100, truncate=False)
        return 1 if failed else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
