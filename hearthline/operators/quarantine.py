"""Set bad input aside: whole files, or single records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = ("file", "record")


def good_records(scanned: DataFrame, policy: str = "record") -> DataFrame:
    """Records to load.

    ``record`` leaves out the bad ones, ``file`` every record of a file that holds a bad
    one. Marker rows of empty files are left out either way. Where the scan has no
    ``file_ok`` (its layout splits files between tasks) ``file`` looks for the names of bad
    files first; adaptive execution sends them to every task or splits the rows of a large
    file, by their size.
    """
    _check(policy)
    records = scanned.filter("record_ok")
    if policy == "record":
        return records
    if "file_ok" in scanned.columns:
        return records.filter("file_ok")
    bad = bad_records(scanned).select("source_file").distinct()
    return records.join(bad, "source_file", "left_anti").select(*(F.col(f"`{c}`") for c in scanned.columns))


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")


def bad_records(scanned: DataFrame) -> DataFrame:
    """Records that do not fit, with the file they came from."""
    return scanned.filter(~F.col("record_ok"))


def rejected_records(scanned: DataFrame) -> DataFrame:
    """What to look at afterwards: ``source_file``, ``record_index``, ``record_text``, ``reject_reason``."""
    return bad_records(scanned).select("source_file", "record_index", "record_text", "reject_reason")


def file_status(scanned: DataFrame) -> DataFrame:
    """One row per file: ``source_file``, ``records``, ``bad_records``."""
    return scanned.groupBy("source_file").agg(
        F.count("record_ok").alias("records"),
        F.count_if(~F.col("record_ok")).alias("bad_records"),
    )


def load_summary(scanned: DataFrame, policy: str = "record") -> DataFrame:
    """Files found, processed and failed, and records loaded and rejected, one row.

    Under ``file`` a file with a bad record has failed, under ``record`` one without a good
    one. An empty array counts as processed.
    """
    _check(policy)
    good = F.col("records") - F.col("bad_records")
    has_failed = F.col("bad_records") > 0
    loaded = F.when(has_failed, 0).otherwise(good)
    if policy == "record":
        has_failed, loaded = has_failed & (good == 0), good
    failed = F.count_if(has_failed)
    return file_status(scanned).agg(
        F.count("*").alias("found"),
        (F.count("*") - failed).alias("processed"),
        failed.alias("failed"),
        F.coalesce(F.sum(loaded), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.col("records") - loaded), F.lit(0)).alias("rejected"),
    )
