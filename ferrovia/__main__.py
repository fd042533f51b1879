"""Command line: ``python -m ferrovia <command> ...`` (or via spark-submit).

    static  --landing DIR --lake DIR [--as-of YYYY-MM-DD] [--pandas-na] [--fail-on-error]
    gold    --lake DIR [--days 20250110,20250111] [--stale keep|refresh]
    stream  --lake DIR --checkpoints DIR [--trip-updates DIR] [--vehicle-positions DIR]
            [--trigger "5 minutes"|availableNow] [--no-gold]

The master and cluster settings come from the launcher (spark-submit, or
SPARK_* defaults); the engine only adds its required session settings.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ferrovia")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("static", help="landing CSV feeds -> Bronze -> Silver dimensions and schedule")
    s.add_argument("--landing", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--as-of", default=_dt.date.today().isoformat())
    s.add_argument("--pandas-na", action="store_true", help="treat pandas' NA tokens as NULL")
    s.add_argument("--fail-on-error", action="store_true", help="exit 1 when a feed fails validation")

    g = sub.add_parser("gold", help="recompute Gold (all days, or the listed ones) and upsert it")
    g.add_argument("--lake", required=True)
    g.add_argument("--days", default=None, help="comma-separated YYYYMMDD keys")
    g.add_argument("--stale", choices=["keep", "refresh"], default="refresh")

    r = sub.add_parser("stream", help="realtime feeds -> Bronze -> Silver -> Gold, per trigger")
    r.add_argument("--lake", required=True)
    r.add_argument("--checkpoints", required=True)
    r.add_argument("--trip-updates", default=None)
    r.add_argument("--vehicle-positions", default=None)
    r.add_argument("--trigger", default="5 minutes")
    r.add_argument("--layout", choices=["lines", "file"], default="lines")
    r.add_argument("--no-gold", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from ferrovia.plans import jobs
    from ferrovia.session import get_session
    spark = get_session()
    if args.command == "static":
        from ferrovia.sources.feeds import PANDAS_NA_TOKENS
        try:
            verdicts = jobs.run_static(spark, args.landing, args.lake, args.as_of,
                                       null_tokens=PANDAS_NA_TOKENS if args.pandas_na else None,
                                       raise_on_fail=args.fail_on_error)
        except RuntimeError as e:
            print(e, file=sys.stderr)
            return 1
        verdicts.show(truncate=False)
        return 0
    if args.command == "gold":
        days = [int(d) for d in args.days.split(",")] if args.days else None
        jobs.run_gold(spark, args.lake, days=days, stale=args.stale)
        return 0
    from ferrovia.streaming import realtime
    queries = realtime.start_realtime(spark, args.trip_updates, args.vehicle_positions, args.lake,
                                      args.checkpoints, trigger=args.trigger,
                                      refresh_gold=not args.no_gold, layout=args.layout)
    realtime.await_all(queries)
    return 0


if __name__ == "__main__":
    sys.exit(main())
