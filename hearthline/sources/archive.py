"""Scan of the message archive, with per-file and per-record error marks.

Two layouts are read:

``array``  ``<root>/YYYY/MM/DD/<file>``, each file one JSON array of records.
``lines``  ``<root>/year=YYYY/month=MM/day=DD/**/<file>``, one JSON object per line,
           as written by ``hearthline.streaming.archive``. Files can be split
           between tasks, so this is the layout for large files.

Both give the wire fields plus

``source_file``   path of the file,
``record_index``  position in the file (``array``; null for a file with no record),
``record_ok``     false for a record with any field that does not fit the schema
                  or with a null key,
``record_text``   text of a bad record (null where a file is no array at all),
``reject_reason`` why it is bad,
``file_ok``       false if any record of the file is bad or the file is not an
                  array (``array`` only: in ``lines`` it needs a shuffle and is worked
                  out by ``operators.quarantine``).

Every field of a record is checked, whatever is selected later: Spark decodes and
checks only the columns a query uses, so an error in another one would pass unseen.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hearthline.schemas import KEY, wire_schema
from hearthline.scratch import no_rows
from hearthline.sources.listing import plain_path
from hearthline.sources.packed import counts, packed_days

MARKS = ("source_file", "record_index", "record_ok", "record_text", "reject_reason", "file_ok")
NO_FIT, NO_KEY, NO_ARRAY = "does not fit the schema", "has no key", "is not a JSON array"
EMPTY, BROKEN, NO_TEXT = "is empty", "cannot be read", "is not UTF-8 text"
_ERROR = "_record_error"


class NoInputError(RuntimeError):
    """Neither the dated folders nor the fallback root hold any file."""


def scan_archive(
    spark: SparkSession,
    root: str,
    start: date | None = None,
    end: date | None = None,
    layout: str = "array",
    fallback_root: str | None = None,
    fallback_names: str = "*.json",
    schema: StructType | None = None,
    key: str = KEY,
    skip_broken: bool = False,
) -> DataFrame:
    """Records ingested from ``start`` to ``end`` (inclusive; ``end`` defaults to ``start``).

    Without ``start`` the whole tree is read. When the dated folders are missing
    or empty, every file below ``fallback_root`` whose name matches
    ``fallback_names`` is read instead. A file that cannot be read (a truncated archive, say) ends the
    scan. With ``skip_broken``, for the array layout, it gives no row; ``unread_files`` then
    tells which these are.
    """
    schema = schema or wire_schema()
    reader, day_pattern, decode = _layout(layout, skip_broken)
    anywhere = lambda: _options(reader(spark, schema), skip_broken)
    # Read before the files are listed: what is packed later leaves these where they are.
    packed = counts(spark, root, _packed_days(spark, root, start, end), F.col("source_file")) if layout == "lines" else None
    found = _load(anywhere(), dated_folders(root, start, end, layout))
    if found is not None and packed is not None:
        found = found.filter(packed)
    if _nothing(found) and fallback_root:
        found = _load(anywhere().option("pathGlobFilter", fallback_names), fallback_root)
    if _nothing(found):
        where = " or ".join(filter(None, (root, fallback_root)))
        raise NoInputError(f"no archive files under {where}")
    return decode(found, schema, key)


def scan_files(
    spark: SparkSession,
    files: Sequence[str],
    layout: str = "array",
    schema: StructType | None = None,
    key: str = KEY,
    skip_broken: bool = False,
) -> DataFrame:
    """The same from the named files and no others; no rows if none is named."""
    schema = schema or wire_schema()
    reader, _, decode = _layout(layout, skip_broken)
    if files:
        # A name is no pattern, whatever it holds.
        literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", name) for name in files]
        found = _options(reader(spark, schema), skip_broken).load(literal)
        found = found.select("*", F.col("_metadata.file_path").alias("source_file"))
    else:
        text = StructType([StructField("value", StringType())])
        content = text if layout == "array" else _with_error(schema)
        found = no_rows(spark, StructType([*content, StructField("source_file", StringType())]))
    return decode(found, schema, key)


def _packed_days(spark: SparkSession, root: str, start: date | None, end: date | None) -> list[date]:
    if start is None:
        return packed_days(spark, root)
    return [start + timedelta(n) for n in range(((end or start) - start).days + 1)]


def dated_folders(root: str, start: date | None = None, end: date | None = None, layout: str = "array") -> str:
    """The folders of the days only, as one pattern: nothing else is listed, however old the archive."""
    if start is None:
        return root
    day_pattern = _layout(layout)[1]
    days = [start + timedelta(n) for n in range(((end or start) - start).days + 1)]
    return f"{root}/{{{','.join(day.strftime(day_pattern) for day in days)}}}"


def unread_files(scanned: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed files that a scan with ``skip_broken`` gave no row of, as rejected rows of that scan.

    ``listed`` is what ``list_files`` gives. Read ``scanned`` from where it has been written:
    this looks at the names of its files once more.
    """
    read = scanned.select(plain_path(F.col("source_file")).alias("path")).distinct()
    reason = F.when(F.col("length") == 0, EMPTY).otherwise(BROKEN)
    marks = {
        "source_file": F.col("path"),
        "record_ok": F.lit(False),
        "reject_reason": reason,
        "file_ok": F.lit(False),
    }
    missing = listed.join(read, "path", "left_anti")
    return missing.select(
        *(marks.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in scanned.schema)
    )


def _layout(layout: str, skip_broken: bool = False):
    if layout not in _LAYOUTS:
        raise ValueError(f"layout must be one of {tuple(_LAYOUTS)}, not {layout!r}")
    if skip_broken and layout != "array":
        raise ValueError("only a file of the array layout is read whole or not at all")
    return _LAYOUTS[layout]


def _options(reader: DataFrameReader, skip_broken: bool) -> DataFrameReader:
    return reader.option("recursiveFileLookup", True).option("ignoreCorruptFiles", skip_broken)


def _nothing(found: DataFrame | None) -> bool:
    return found is None or found.select("source_file").isEmpty()


def _load(reader: DataFrameReader, path: str) -> DataFrame | None:
    """Content with its file path, or None where ``path`` matches nothing."""
    try:
        return reader.load(path).select("*", F.col("_metadata.file_path").alias("source_file"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _with_error(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(_ERROR, StringType())])


# --- lines ----------------------------------------------------------------------------------


def _lines_reader(spark: SparkSession, schema: StructType) -> DataFrameReader:
    reader = spark.read.format("json").schema(_with_error(schema))
    return reader.option("columnNameOfCorruptRecord", _ERROR)


def _decode_lines(found: DataFrame, schema: StructType, key: str) -> DataFrame:
    names = [f"`{name}`" for name in _with_error(schema).names]
    # No field need be set, so every row stays; but the scan has to read all fields.
    checked = found.dropna(thresh=0, subset=names)
    fits, keyed = F.col(_ERROR).isNull(), F.col(f"`{key}`").isNotNull()
    text = F.coalesce(F.col(_ERROR), F.to_json(F.struct(*_fields(schema))))
    return checked.select(
        *_fields(schema),
        "source_file",
        F.lit(None).cast("int").alias("record_index"),
        (fits & keyed).alias("record_ok"),
        F.when(~(fits & keyed), text).alias("record_text"),
        F.when(~fits, NO_FIT).when(~keyed, NO_KEY).alias("reject_reason"),
    )


# --- array ----------------------------------------------------------------------------------


def _array_reader(spark: SparkSession, schema: StructType) -> DataFrameReader:
    return spark.read.format("text").option("wholetext", True)


def _record(text: Column, schema: StructType) -> Column:
    return F.from_json(text, _with_error(schema), {"columnNameOfCorruptRecord": _ERROR})


def _fits(record: Column, key: str) -> Column:
    return record.isNotNull() & record[_ERROR].isNull() & record[key].isNotNull()


def _decode_arrays(found: DataFrame, schema: StructType, key: str) -> DataFrame:
    """One row per file up to ``posexplode``, one per record after it.

    The JSON reader would do for good files, but it gives no row for an empty array,
    ignores what follows the first one, and for every record of a bad file reads the
    file again. A filter on the generated columns stays above the decoding; on
    projected ones it would be pushed below and decode every record twice.
    """
    # The outer brackets make anything after the first array an error or a second element.
    arrays = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<array<string>>")
    texts = F.when(F.size("arrays") == 1, F.col("arrays")[0])
    # A file that is no array becomes one null record, so that it still yields a row.
    no_array = F.array(_record(F.lit(None).cast("string"), schema))
    records = F.when(F.col("texts").isNull(), no_array).otherwise(
        F.transform("texts", lambda one: _record(one, schema))
    )
    file_ok = F.forall("records", lambda one: _fits(one, key))
    # Zipped in, not captured by a lambda: that would check the whole file once per record.
    flags = F.array_repeat("file_ok", F.size("records"))
    rows = (
        found.select("source_file", F.is_valid_utf8("value").alias("is_text"), arrays.alias("arrays"))
        .select("source_file", "is_text", texts.alias("texts"))
        .select("source_file", "is_text", records.alias("records"))
        .select("source_file", "is_text", "records", file_ok.alias("file_ok"))
        .select("source_file", "is_text", "records", flags.alias("flags"))
        .select(
            "source_file",
            "is_text",
            F.posexplode_outer(F.arrays_zip("records", "flags")).alias("record_index", "item"),
        )
    )
    record = F.col("item.records")
    fits = _fits(record, key)
    bad = F.col("record_index").isNotNull() & ~fits
    text = F.coalesce(record[_ERROR], F.to_json(F.struct(*_fields(schema, "item.records."))))
    no_array = F.when(F.col("is_text"), NO_ARRAY).otherwise(NO_TEXT)
    reason = F.when(record.isNull(), no_array).when(record[_ERROR].isNotNull(), NO_FIT).otherwise(NO_KEY)
    return rows.select(
        *_fields(schema, "item.records."),
        "source_file",
        "record_index",
        F.when(F.col("record_index").isNotNull(), fits).alias("record_ok"),
        F.when(bad & record.isNotNull(), text).alias("record_text"),
        F.when(bad, reason).alias("reject_reason"),
        F.coalesce("item.flags", F.lit(True)).alias("file_ok"),
    )


def _fields(schema: StructType, prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}`{name}`").alias(name) for name in schema.names]


_LAYOUTS = {
    "array": (_array_reader, "%Y/%m/%d", _decode_arrays),
    "lines": (_lines_reader, "year=%Y/month=%m/day=%d", _decode_lines),
}
