"""Command line: python -m tenura <step> --root <folder> [--raw <folder>] [--date <day>]."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession

from tenura.operators import quality
from tenura.operators.watermarks import Watermarks
from tenura.plans import daily_run
from tenura.session import configure

STEPS = (
    "run", "backfill", "ingest", "transform", "check", "load", "marts", "month", "health",
    "watermarks", "reset", "reset-all",
)


def _yesterday() -> date:
    return datetime.now(timezone.utc).date() - timedelta(days=1)


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tenura", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of lake, warehouse and marts")
    parser.add_argument("--raw", default=None, help="folder of raw files (default <root>/raw)")
    parser.add_argument("--date", type=date.fromisoformat, default=None, help="batch date")
    parser.add_argument("--from", dest="first", type=date.fromisoformat, default=None)
    parser.add_argument("--step-days", type=int, default=1)
    parser.add_argument("--as-of", type=date.fromisoformat, default=None)
    parser.add_argument("--modes", choices=("reference", "corrected"), default="reference")
    parser.add_argument(
        "--set", dest="choices", action="append", default=[], metavar="MODE=VALUE",
        help="one mode of daily_run.Modes, such as overlap=calendar",
    )
    parser.add_argument("--key", default=None, help="watermark key to reset")
    return parser.parse_args(argv)


def chosen(args: argparse.Namespace) -> daily_run.Modes:
    """The named set of modes with single ones changed."""
    modes = daily_run.CORRECTED if args.modes == "corrected" else daily_run.Modes()
    known = {f.name: f.type for f in fields(modes)}
    changes = {}
    for name, _, value in (c.partition("=") for c in args.choices):
        if name not in known:
            raise SystemExit(f"unknown mode {name}; known: {', '.join(known)}")
        changes[name] = value.lower() == "true" if known[name] == "bool" else value
    return replace(modes, **changes)


def run(spark: SparkSession, args: argparse.Namespace):
    store = daily_run.Store(root=args.root, raw_dir=args.raw or f"{args.root}/raw")
    modes = chosen(args)
    state = Watermarks(spark, store.watermarks)
    day = args.date or _yesterday()
    if args.step == "run":
        return daily_run.run_day(spark, store, day, as_of=args.as_of, modes=modes)
    if args.step == "backfill":
        first = args.first or day
        return daily_run.backfill(spark, store, first, day, step_days=args.step_days, modes=modes)
    if args.step == "ingest":
        return daily_run.ingest_all(spark, store, day)
    if args.step == "transform":
        return daily_run.transform_all(spark, store, day, modes)
    if args.step == "check":
        return quality.enforce(daily_run.check_batch(spark, store, day))
    if args.step == "load":
        return daily_run.load_all(spark, store, day, modes)
    if args.step == "marts":
        return daily_run.refresh_marts(spark, store, args.as_of or day, modes)
    if args.step == "month":
        return daily_run.refresh_month(spark, store, day.year, day.month, modes)
    if args.step == "health":
        return daily_run.refresh_health(spark, store, args.first or day - timedelta(days=2), day, modes)
    if args.step == "reset":
        state.reset(args.key)
    if args.step == "reset-all":
        state.reset_all(args.modes)
    return state.all()


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = configure(SparkSession.builder.appName("tenura").getOrCreate())
    try:
        result = run(spark, args)
    except (quality.DataQualityError, daily_run.RunError) as problem:
        print(problem, file=sys.stderr)
        return 1
    print(json.dumps(result, default=str, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
