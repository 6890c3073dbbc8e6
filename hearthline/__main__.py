"""Command line: ``python -m hearthline archive|stream|load|check|predict``.

``load``, ``check`` and ``predict`` share a catalog table, so run them under a session
whose catalog outlives the process (``spark.sql.catalogImplementation=hive``).
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.formatting import money, thousands
from hearthline.operators.keyed_table import table_exists
from hearthline.operators.quarantine import load_summary
from hearthline.operators.readiness import table_readiness
from hearthline.operators.reports import table_sample
from hearthline.plans.load import (
    curated_sample,
    listing_table,
    load_new,
    load_store,
    load_table,
    stage_archive,
    write_rejected,
)
from hearthline.plans.train import SPLITS, NoListingsError, predict_prices
from hearthline.scratch import clear_scratch
from hearthline.session import build_session
from hearthline.sources.archive import NoInputError
from hearthline.sources.events import event_stream, kafka_options
from hearthline.sources.ledger import LoadLedger
from hearthline.sources.tables import scan_table
from hearthline.streaming.archive import archive_stream
from hearthline.streaming.queries import city_totals, start_query


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.path:
        return event_stream(spark, "text", path=args.path, max_files_per_trigger=args.max_per_trigger)
    return event_stream(spark, options=kafka_options(args.brokers, args.topic, args.max_per_trigger))


def _trigger(args: argparse.Namespace) -> dict[str, object]:
    return {"availableNow": True} if args.once else {"processingTime": args.every}


def run_archive(spark: SparkSession, args: argparse.Namespace) -> int:
    archive_stream(
        _messages(spark, args), args.output, args.checkpoint, _trigger(args)
    ).awaitTermination()
    return 0


def run_stream(spark: SparkSession, args: argparse.Namespace) -> int:
    start_query(
        city_totals(_messages(spark, args), args.unit, args.fractional),
        args.checkpoint,
        fmt=args.format,
        output_mode=args.output_mode,
        trigger=_trigger(args),
        options={"path": args.output} if args.output else None,
    ).awaitTermination()
    return 0


def _load_new(spark: SparkSession, args: argparse.Namespace) -> int:
    """What the ledger does not name, whatever its day unless days are given."""
    if args.format:
        print("--ledger goes with the catalog table", file=sys.stderr)
        return 1
    table = listing_table(spark, args.namespace, args.table, args.buckets)
    ledger, total = LoadLedger(spark, args.ledger), 0
    while count := load_new(
        spark, args.root, ledger, table, args.layout, args.policy, args.start, args.end, args.max_files, args.rejected
    ):
        total += count
        if not args.max_files:
            break
    print(f"{total} new files")
    return 0


def run_load(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.ledger:
        return _load_new(spark, args)
    start = None if args.all else args.start or datetime.now(timezone.utc).date()
    try:
        staged = stage_archive(spark, args.root, start, args.end, args.layout, args.fallback)
    except NoInputError as error:
        print(error, file=sys.stderr)
        return 1
    curated_sample(staged).show(truncate=False)
    if args.rejected:
        write_rejected(staged, args.rejected)
    if args.format:
        load_store(staged, args.format, dict(args.option), args.policy)
    else:
        load_table(staged, listing_table(spark, args.namespace, args.table, args.buckets), args.policy)
    load_summary(staged, args.policy).show()
    return 0


def _listings(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """What the store's connector gives, or the catalog table; None if there is no such table."""
    if args.format:
        return scan_table(spark, fmt=args.format, options=dict(args.option))
    if not table_exists(spark, args.namespace, args.table):
        return None
    return spark.table(f"{args.namespace}.{args.table}")


def run_check(spark: SparkSession, args: argparse.Namespace) -> int:
    listings = _listings(spark, args)
    ok, reason = table_readiness(spark, args.namespace, args.table, listings if args.format else None)
    print(reason)
    if listings is not None and not listings.isEmpty():
        sample = table_sample(listings)
        sample.withColumn("price", F.concat(F.lit("$"), thousands(F.col("price")))).show(truncate=False)
    return 0 if ok else 1


def run_predict(spark: SparkSession, args: argparse.Namespace) -> int:
    listings = _listings(spark, args)
    if listings is None:
        print(f"table {args.namespace}.{args.table} does not exist", file=sys.stderr)
        return 1
    try:
        reports = predict_prices(listings, args.output, args.split, args.max_categories)
    except NoListingsError as error:
        print(error, file=sys.stderr)
        return 1
    print(f"{reports.rows:,} rows, {reports.cleaned:,} with a price")
    reports.sample.show(truncate=False)
    prices = ("avg_actual", "avg_predicted", "min_predicted", "max_predicted")
    reports.overall.select(
        thousands(F.col("total")).alias("total"), *(money(F.col(c)).alias(c) for c in prices)
    ).show(truncate=False)
    reports.by_city.show(truncate=False)
    reports.by_home_type.show(truncate=False)
    reports.holdout.show(truncate=False)
    return 0


def _pair(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not KEY=VALUE")
    return key, value


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hearthline", description=__doc__)
    parser.add_argument("--master")
    parser.add_argument("--packages", default="", help="Maven coordinates of connectors, comma separated")
    commands = parser.add_subparsers(dest="command", required=True)

    def stream_command(name: str, run) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--brokers", default="localhost:9092")
        command.add_argument("--topic", default="listings")
        command.add_argument("--path", help="read text files from a folder instead of a topic")
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--max-per-trigger", type=int)
        command.add_argument("--every", default="10 seconds")
        command.add_argument("--once", action="store_true", help="drain what is there, then stop")
        return command

    stream_command("archive", run_archive).add_argument("--output", required=True)
    stream = stream_command("stream", run_stream)
    stream.add_argument("--format", default="console")
    stream.add_argument("--output", help="target folder of file formats")
    stream.add_argument("--output-mode", default="append", choices=("append", "update", "complete"))
    stream.add_argument("--fractional", action="store_true", help="event times may have a fraction")
    stream.add_argument("--unit", default="ms", choices=("ms", "s"))

    def table_command(name: str, run) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--namespace", default="listings")
        command.add_argument("--table", default="current")
        command.add_argument("--format", help="a store's connector in place of the catalog table")
        command.add_argument(
            "--option", action="append", default=[], type=_pair, help="KEY=VALUE for the connector"
        )
        return command

    load = table_command("load", run_load)
    load.add_argument("--root", required=True)
    load.add_argument("--start", type=date.fromisoformat, help="first ingest date, default today (UTC)")
    load.add_argument("--end", type=date.fromisoformat)
    load.add_argument("--all", action="store_true", help="the whole tree, all dates")
    load.add_argument("--layout", default="lines", choices=("array", "lines"))
    load.add_argument("--fallback", help="root to search when the dates hold nothing")
    load.add_argument("--buckets", type=int, help="buckets of the table, default one per shuffle partition")
    load.add_argument("--policy", default="record", choices=("record", "file"))
    load.add_argument("--rejected", help="folder for rejected records with their text and reason")
    load.add_argument("--ledger", help="table of loaded files: load those it does not name, and name them")
    load.add_argument("--max-files", type=int, help="with --ledger, so many files at a time")
    table_command("check", run_check)
    train = table_command("predict", run_predict)
    train.add_argument("--output", help="folder for the predictions")
    train.add_argument("--split", default="key", choices=tuple(SPLITS))
    train.add_argument("--max-categories", type=int, help="refuse category columns with more values")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    packages = [name for name in args.packages.split(",") if name]
    spark = build_session(master=args.master, packages=packages)
    try:
        return args.run(spark, args)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    sys.exit(main())
