"""Archive to keyed table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from hearthline.operators.curate import curate
from hearthline.operators.keyed_table import KeyedTable, append_to_store
from hearthline.operators.latest import latest_per_key
from hearthline.operators.quarantine import good_records, rejected_records
from hearthline.schemas import EVENT_TIME, KEY, curated_schema
from hearthline.scratch import drop, materialize
from hearthline.sources.archive import MARKS, dated_folders, scan_archive, scan_files, unread_files
from hearthline.sources.ledger import LoadLedger
from hearthline.sources.listing import list_files

# Newest event wins; equal times by file, then by position in it.
LATEST = (EVENT_TIME, "source_file", "record_index")


def listing_table(
    spark: SparkSession, namespace: str, name: str, buckets: int | None = None, location: str | None = None
) -> KeyedTable:
    """The table of current listings: the curated columns and the event time they are from.

    The time is compared, so loading an old day again leaves newer rows alone.
    """
    schema = StructType([*curated_schema().fields, StructField(EVENT_TIME, LongType())])
    return KeyedTable(spark, namespace, name, schema=schema, buckets=buckets, location=location, newer=[EVENT_TIME])


def stage_archive(
    spark: SparkSession,
    root: str,
    start: date | None = None,
    end: date | None = None,
    layout: str = "array",
    fallback_root: str | None = None,
) -> DataFrame:
    """Decode the archive once into a narrow Parquet table with its error marks.

    Upsert, load summary and quarantine all read this instead of the JSON text.
    """
    return _stage(scan_archive(spark, root, start, end, layout, fallback_root))


def _stage(scanned: DataFrame) -> DataFrame:
    marks = [name for name in MARKS if name in scanned.columns]
    return materialize(curate(scanned, keep=(EVENT_TIME, *marks)), "staged")


def stage_files(spark: SparkSession, listed: DataFrame, layout: str = "array") -> DataFrame:
    """The same for listed files (``list_files``). In the array layout every file has a row, read or not.

    The driver holds their names, as Spark's file index does for every scan.
    """
    names = listed.filter("length > 0").select("path").orderBy("path")
    whole = layout == "array"
    staged = _stage(scan_files(spark, [row["path"] for row in names.collect()], layout, skip_broken=whole))
    return staged.unionByName(unread_files(staged, listed)) if whole else staged


def load_new(
    spark: SparkSession,
    root: str,
    ledger: LoadLedger,
    table: KeyedTable,
    layout: str = "array",
    policy: str = "record",
    start: date | None = None,
    end: date | None = None,
    max_files: int | None = None,
    rejected: str | None = None,
) -> int:
    """Load the files below ``root`` that the ledger does not name, and name them; how many there were.

    Whatever their day: a late file is found, a loaded one is not read again, a changed one
    is. ``max_files`` bounds what is taken at a time, in order of path; call again until 0. If a load
    ends between the table and the ledger the next one repeats it, which leaves the table as it
    is. Rejected records, and in the array layout files that cannot be read, go to ``rejected``.
    """
    listed = list_files(spark, dated_folders(root, start, end, layout))
    new = ledger.new_files(listed).orderBy("path")
    taken = materialize(new.limit(max_files) if max_files else new, "new-files")
    count = taken.count()
    if count:
        staged = stage_files(spark, taken, layout)
        if rejected:
            write_rejected(staged, rejected)
        load_table(staged, table, policy)
        ledger.record(taken)
    drop(taken)
    return count


def load_table(staged: DataFrame, table: KeyedTable, policy: str = "record") -> None:
    """Upsert the good records into a catalog table."""
    table.ensure().upsert(good_records(staged, policy), LATEST)


def write_rejected(staged: DataFrame, path: str) -> None:
    """Append every rejected record as JSON: file, position, text and reason."""
    rejected_records(staged).write.mode("append").option("ignoreNullFields", False).json(path)


def curated_sample(staged: DataFrame, limit: int = 10) -> DataFrame:
    """A look at the curated columns of a few good records, the first by key and then by the others."""
    names = curated_schema().names
    first = [KEY, *(name for name in names if name != KEY)]
    return staged.filter("record_ok").select(*names).orderBy(*first).limit(limit)


def load_store(
    staged: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    policy: str = "record",
) -> None:
    """Upsert the good records through a keyed store's connector."""
    newest = latest_per_key(good_records(staged, policy), [KEY], LATEST)
    append_to_store(newest.select(*curated_schema().names), fmt, options)
