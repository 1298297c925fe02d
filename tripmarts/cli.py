"""Command line: one stage, or all of them in one session.

    python -m tripmarts ingest --trip-type yellow --raw-root /data/raw --lake /data/lake
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Sequence

from tripmarts.contracts import KINDS
from tripmarts.operators.marts import marts_of
from tripmarts.plans import stages
from tripmarts.plans.registry import DOMAINS, SUMMARIES
from tripmarts.session import get_session
from tripmarts.settings import MonthRange, default_months
from tripmarts.sources.lake import MODES, Lake

STAGES = ("ingest", "transform", "analytics")


def build_parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--trip-type", choices=KINDS, default="yellow")
    shared.add_argument("--lake", default=os.environ.get("LAKE_ROOT", "lake"))
    shared.add_argument("--raw-root", default=os.environ.get("RAW_ROOT", "raw"))
    shared.add_argument("--zone-lookup", help="CSV file; <lake>/reference/taxi_zone_lookup.csv")
    shared.add_argument("--master", help="for runs without spark-submit")

    default = default_months()
    span = argparse.ArgumentParser(add_help=False)
    span.add_argument("--start-year", type=int, default=default.start_year)
    span.add_argument("--start-month", type=int, default=default.start_month)
    span.add_argument("--end-year", type=int, default=default.end_year)
    span.add_argument("--end-month", type=int, default=default.end_month)

    mode = argparse.ArgumentParser(add_help=False)
    mode.add_argument("--mode", choices=MODES, default="overwrite")
    mode.add_argument("--rebalance", action="store_true",
                      help="shuffle into evenly sized files; for input not ordered by month")

    files = argparse.ArgumentParser(add_help=False)
    files.add_argument("--skip-missing", action="store_true", help="pass over absent files")

    gold = argparse.ArgumentParser(add_help=False)
    gold.add_argument("--skip-gold", action="store_true", help="stop after Silver")
    gold.add_argument("--only-months", action="store_true",
                      help="transform only the local months of the range, keep the others")
    gold.add_argument("--accuracy", type=int, help="sketch quantiles of this accuracy")

    module = argparse.ArgumentParser(add_help=False)
    module.add_argument("--module", choices=("all", *DOMAINS), default="all")

    tables = argparse.ArgumentParser(add_help=False)
    tables.add_argument("--catalog", metavar="NAMESPACE",
                        help="register what was written as tables of this namespace")

    parser = argparse.ArgumentParser(prog="tripmarts")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("ingest", parents=[shared, span, mode, files])
    commands.add_parser("transform", parents=[shared, span, mode, gold, tables])
    commands.add_parser("analytics", parents=[shared, module, tables])
    everything = commands.add_parser("run", parents=[shared, span, mode, files, gold, module, tables])
    everything.add_argument("--stage", choices=("all", *STAGES), default="all")
    return parser


def _months(args: argparse.Namespace) -> MonthRange:
    return MonthRange(args.start_year, args.start_month, args.end_year, args.end_month)


def execute(args: argparse.Namespace, lake: Lake) -> None:
    kind = args.trip_type
    stage = args.stage if args.command == "run" else args.command
    planned = STAGES if stage == "all" else (stage,)
    if "ingest" in planned:
        stages.ingest(
            lake,
            args.raw_root,
            kind,
            _months(args),
            args.mode,
            args.skip_missing,
            args.rebalance,
        )
    if "transform" in planned:
        stages.transform(
            lake,
            args.zone_lookup or f"{args.lake}/reference/taxi_zone_lookup.csv",
            kind,
            _months(args) if args.only_months else None,
            args.mode,
            args.skip_gold,
            accuracy=args.accuracy,
            rebalance=args.rebalance,
        )
        if args.catalog:
            lake.register(args.catalog, f"silver_{kind}", lake.silver_path(kind))
            for mart in () if args.skip_gold else marts_of(kind):
                lake.register(args.catalog, f"{mart}_{kind}", lake.mart_path(mart, kind))
    if "analytics" in planned:
        written = stages.analyse(lake, kind, None if args.module == "all" else args.module)
        if args.catalog:
            for name in written:
                output = SUMMARIES[name].output_name()
                path = lake.summary_path(SUMMARIES[name].domain, output, kind)
                lake.register(args.catalog, f"{output}_{kind}", path)


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    logging.basicConfig(
        level=os.environ.get("LOG_LEVEL", "INFO"),
        format="%(asctime)s %(levelname)s %(name)s: %(message)s",
    )
    spark = get_session(f"tripmarts-{args.command}-{args.trip_type}", args.master)
    try:
        execute(args, Lake(spark, args.lake))
    finally:
        spark.stop()
