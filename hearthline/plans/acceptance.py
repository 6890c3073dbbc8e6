"""The operators run over the given tables, each beside the SQL that must give the same rows.

``events`` stands in for the message stream, ``orders`` for the keyed upsert input,
``part`` for model input, ``lineitem`` for predictions. They hold no nulls, so both
sides derive some the same way.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hearthline.functions.event_time import date_parts, event_time
from hearthline.functions.formatting import money, thousands
from hearthline.functions.payload import encode_payload, json_array, parse_events
from hearthline.functions.split import hash_bucket, split_at_random, split_by_key
from hearthline.operators.clean import fill_missing, with_price
from hearthline.operators.curate import curate
from hearthline.operators.features import feature_stages
from hearthline.operators.keyed_table import KeyedTable
from hearthline.operators.latest import latest_per_key, merge_latest
from hearthline.operators.merge_table import MergeTable
from hearthline.operators.model import fit_model, predict, regression_metrics
from hearthline.operators.quarantine import bad_records, good_records, load_summary, rejected_records
from hearthline.operators.readiness import readiness, table_readiness
from hearthline.operators.reports import (
    group_report,
    overall_statistics,
    prediction_sample,
    row_count,
    table_sample,
)
from hearthline.operators.stored_totals import StoredTotals
from hearthline.operators.wide_index import index_wide, wide_index
from hearthline.operators.windows import CITY_FIELDS, CITY_MEASURES, flatten_window, window_totals
from hearthline.plans.load import curated_sample, listing_table, load_new, stage_archive, stage_files
from hearthline.schemas import wire_schema
from hearthline.scratch import materialize, scratch_path
from hearthline.sources.archive import NoInputError, scan_archive
from hearthline.sources.events import event_stream
from hearthline.sources.files import write_bytes
from hearthline.sources.ledger import LoadLedger
from hearthline.sources.listing import list_files
from hearthline.sources.tables import scan_table
from hearthline.streaming.archive import archive_batch, archive_stream, dated_messages, write_array_files
from hearthline.streaming.compaction import compact_day
from hearthline.streaming.late import read_batches, split_late
from hearthline.streaming.queries import (
    await_any,
    city_totals,
    drain,
    for_each_batch,
    merge_stream,
    start_query,
    upsert_stream,
)
from hearthline.streaming.state import open_windows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ONCE = {"availableNow": True}


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, fmt="parquet", path=f"{sf_dir}/{name}.parquet")


def _ntz(column: Column | str, name: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(name)


def _rounded(name: str, places: int = 6) -> Column:
    return F.round(name, places).alias(name)


# --- events as listing messages -------------------------------------------------------------


def _wire_columns(event_ts: Column | None = None) -> list[Column]:
    k = F.get_json_object("props", "$.k").cast("int")
    when = F.col("ts") if event_ts is None else event_ts
    return [
        F.unix_millis(when.cast("timestamp")).alias("timestamp"),
        F.col("event_id").alias("zpid"),
        F.col("event_type").alias("city"),
        F.concat(F.lit("TYPE_"), F.col("user_id") % 4).alias("homeType"),
        F.round(F.col("value") * 100).cast("long").alias("price"),
        (F.col("user_id") * 3).cast("int").alias("zestimate"),
        F.col("value").alias("lotAreaValue"),
        (k % 5).alias("bathrooms"),
        k.alias("bedrooms"),
        F.col("user_id").cast("int").alias("livingArea"),
        (F.col("event_id") % 2 == 0).alias("isFeatured"),
        (F.col("event_id") % 3 == 0).alias("isShowcaseListing"),
        F.when(F.col("event_id") % 4 == 0, "BUILDER_SPEC").alias("newConstructionType"),
        (F.col("event_id") % 5 == 0).alias("listingSubType.is_newHome"),
    ]


def event_messages(events: DataFrame, event_ts: Column | None = None) -> DataFrame:
    """Events as binary JSON messages, the form a topic delivers."""
    return events.select(encode_payload(*_wire_columns(event_ts)).cast("binary").alias("value"))


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream. The braces make it a pattern, which may name a file or a folder."""
    schema = _table(spark, sf_dir, name).schema
    return event_stream(spark, "parquet", path=f"{sf_dir}/{{{name}}}.parquet", schema=schema)


_WIRE_SQL = """
    event_id::VARCHAR AS zpid, event_type AS city, 'TYPE_' || (user_id % 4) AS hometype,
    round(value * 100)::BIGINT AS price, value AS lotareavalue,
    ((props->>'k')::INTEGER % 5)::INTEGER AS bathrooms, (props->>'k')::INTEGER AS bedrooms,
    user_id::INTEGER AS livingarea, event_id % 2 = 0 AS isfeatured,
    event_id % 3 = 0 AS isshowcaselisting,
    CASE WHEN event_id % 4 = 0 THEN 'BUILDER_SPEC' END AS newconstructiontype,
    event_id % 5 = 0 AS listingsubtype_is_newhome"""


@_register(
    "json_parse_flatten",
    f"""SELECT date_trunc('milliseconds', ts) AS event_ts, (user_id * 3)::INTEGER AS zestimate,
        {_WIRE_SQL.replace("round(value * 100)::BIGINT", "round(value * 100)::DOUBLE")} FROM events""",
)
def _json_parse_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_events(event_messages(_table(spark, sf_dir, "events")))
    listings = curate(parsed, keep=("timestamp", "zestimate"))
    return listings.withColumn("event_ts", _ntz("timestamp", "event_ts")).drop("timestamp")


@_register(
    "event_time_millis",
    "SELECT event_id, date_trunc('milliseconds', ts) AS event_ts FROM events",
)
def _event_time_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = _table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")
    )
    return millis.select("event_id", event_time(F.col("ms")).cast("timestamp_ntz").alias("event_ts"))


@_register(
    "date_parts",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day FROM events""",
)
def _date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", *date_parts(F.col("ts")))


@_register("curate_project", f"SELECT {_WIRE_SQL} FROM events")
def _curate_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = _table(spark, sf_dir, "events").select(*_wire_columns())
    return curate(wire).withColumn("zpid", F.col("zpid").cast("string"))


# --- archive --------------------------------------------------------------------------------


_NOT_JSON = "event_id % 10 = 0"


def _tenth_not_json(events: DataFrame) -> DataFrame:
    good = encode_payload(*_wire_columns())
    return events.select(F.when(F.expr(_NOT_JSON), "not json").otherwise(good).cast("binary").alias("value"))


@_register("json_array_scan", f"SELECT {_WIRE_SQL} FROM events WHERE event_id % 10 <> 0")
def _json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth message is not JSON; the others of its array are read all the same."""
    path, rejected = scratch_path(spark, "arrays"), scratch_path(spark, "rejected")
    write_array_files(_tenth_not_json(_table(spark, sf_dir, "events")), path, 10_000, rejected)
    return curate(good_records(scan_archive(spark, path), "file"))


@_register(
    "archive_scan_day_array",
    f"SELECT {_WIRE_SQL} FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)",
)
def _archive_scan_day_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files in dated folders, the last day and all others."""
    path = scratch_path(spark, "dated-arrays")
    events = _table(spark, sf_dir, "events")
    day = events.agg(F.to_date(F.max("ts")).alias("day")).first()["day"]
    last = F.to_date("ts") == F.lit(day)
    for rows, folder in ((last, f"{day:%Y/%m/%d}"), (~last, "2001/01/01")):
        write_array_files(event_messages(events.filter(rows)), f"{path}/{folder}", 10_000)
    return curate(good_records(scan_archive(spark, path, day), "file"))


def _archived(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Events in a dated tree, with their own date in place of the ingest date."""
    path = scratch_path(spark, "archive")
    events = _table(spark, sf_dir, "events")
    archive_batch(
        events.select(encode_payload(*_wire_columns()).alias("value"), "ts"), path, F.col("ts")
    )
    return events, path


@_register(
    "archive_scan_day",
    f"SELECT {_WIRE_SQL} FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)",
)
def _archive_scan_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = _archived(spark, sf_dir)
    day = events.agg(F.to_date(F.max("ts")).alias("day")).first()["day"]
    return curate(good_records(scan_archive(spark, path, day, layout="lines")))


@_register("archive_scan_fallback", f"SELECT {_WIRE_SQL} FROM events")
def _archive_scan_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records lie beside the ``.json`` files under another extension, which is not read."""
    path = scratch_path(spark, "loose")
    events = _table(spark, sf_dir, "events").select(*_wire_columns())
    events.write.json(f"{path}/a/b")
    columns = (F.col(f"`{name}`") for name in events.columns)
    events.select(encode_payload(*columns).alias("value")).write.text(f"{path}/a/c")
    no_such_day = date(1999, 1, 1)
    scanned = scan_archive(spark, f"{path}/dated", no_such_day, layout="lines", fallback_root=path)
    return curate(good_records(scanned))


@_register("archive_roundtrip", f"SELECT {_WIRE_SQL} FROM events")
def _archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    messages = event_messages(_table_stream(spark, sf_dir, "events"))
    drain(archive_stream(messages, path, scratch_path(spark, "checkpoint"), ONCE))
    return curate(good_records(scan_archive(spark, path, layout="lines")))


@_register("archive_mixed", f"SELECT {_WIRE_SQL} FROM events")
def _archive_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One root, written half by a stream and half by a batch before and after it."""
    path = scratch_path(spark, "archive")
    events, stream = _table(spark, sf_dir, "events"), _table_stream(spark, sf_dir, "events")
    archive_batch(event_messages(events.filter("event_id % 4 = 0")), path)
    halved = event_messages(stream.filter("event_id % 2 = 1"))
    drain(archive_stream(halved, path, scratch_path(spark, "checkpoint"), ONCE))
    archive_batch(event_messages(events.filter("event_id % 4 = 2")), path)
    return curate(good_records(scan_archive(spark, path, layout="lines")))


@_register("archive_compacted", f"SELECT {_WIRE_SQL} FROM events")
def _archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day written in many small files, packed, added to, packed again and added to."""
    path, day = scratch_path(spark, "archive"), date(2024, 1, 1)
    events = _table(spark, sf_dir, "events")
    for number in range(4):
        rows = events.filter(F.col("event_id") % 4 == number).repartition(6)
        dated_messages(event_messages(rows), F.lit(day)).withColumn("part", F.lit(f"small-{number}")).write.mode(
            "append"
        ).partitionBy("year", "month", "day", "part").text(path)
        if number in (1, 2):
            compact_day(spark, path, day)
    return curate(good_records(scan_archive(spark, path, day, layout="lines")))


_CAP = 8


@_register("archive_capped", "SELECT (event_id % 8 // 2)::BIGINT AS batch, count(*) AS messages FROM events GROUP BY 1")
def _archive_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight lots of four files each, at most eight files a trigger: four flushes, counted from their folders."""
    source, path = scratch_path(spark, "source"), scratch_path(spark, "archive")
    events = _table(spark, sf_dir, "events")
    for lot in range(8):  # one after another: a file stream takes the oldest files first
        events.filter(F.col("event_id") % 8 == lot).repartition(4).write.mode("append").parquet(source)
    stream = event_stream(spark, "parquet", path=source, schema=events.schema, max_files_per_trigger=_CAP)
    drain(archive_stream(event_messages(stream), path, scratch_path(spark, "checkpoint"), ONCE))
    batch = F.regexp_extract("source_file", r"/part=[^/]*-(\d+)/", 1).cast("long").alias("batch")
    scanned = scan_archive(spark, path, layout="lines")
    return scanned.groupBy(batch).agg(F.count("*").alias("messages"))


_FILE_SIZE = 500
_BAD = f"event_id % {7 * _FILE_SIZE} = 0"


def _flawed_messages(events: DataFrame) -> DataFrame:
    """Consecutive events in files; in every seventh file the first price is no number."""
    id_and_city = (F.col("event_id").alias("zpid"), F.col("event_type").alias("city"))
    price = F.round(F.col("value") * 100).cast("long")
    message = F.when(F.expr(_BAD), encode_payload(*id_and_city, F.lit("n/a").alias("price"))).otherwise(
        encode_payload(*id_and_city, price.alias("price"))
    )
    return events.select(F.floor(F.col("event_id") / _FILE_SIZE).alias("file"), message.alias("value"))


def _flawed_archive(spark: SparkSession, sf_dir: str, layout: str = "array") -> DataFrame:
    """Scan of the flawed files. ``event_id`` is the table's key, so its range bounds each file."""
    path = scratch_path(spark, "flawed")
    messages = _flawed_messages(_table(spark, sf_dir, "events"))
    if layout == "array":
        files = messages.groupBy("file").agg(json_array(F.collect_list("value")).alias("value"))
        files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    else:  # a folder for each file, written by one task
        messages.repartition("file").write.partitionBy("file").text(path)
    return scan_archive(spark, path, layout=layout, schema=wire_schema(("zpid", "city", "price")))


_FLAWED_SQL = f"""WITH marked AS (
    SELECT event_id, event_type, value, event_id // {_FILE_SIZE} AS file,
           {_BAD} AS bad,
           bool_or({_BAD}) OVER (PARTITION BY event_id // {_FILE_SIZE}) AS bad_file
    FROM events)"""


@_register(
    "load_summary",
    f"""{_FLAWED_SQL} SELECT count(*) AS found, count_if(NOT bad)::BIGINT AS processed,
        count_if(bad)::BIGINT AS failed, sum(CASE WHEN bad THEN 0 ELSE n END)::BIGINT AS loaded,
        sum(CASE WHEN bad THEN n ELSE 0 END)::BIGINT AS rejected
        FROM (SELECT bool_or(bad) AS bad, count(*) AS n FROM marked GROUP BY file)""",
)
def _load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_summary(_flawed_archive(spark, sf_dir), "file")


@_register(
    "load_summary_record",
    f"""{_FLAWED_SQL} SELECT count(DISTINCT file) AS found, count(DISTINCT file) AS processed,
        0::BIGINT AS failed, count_if(NOT bad)::BIGINT AS loaded, count_if(bad)::BIGINT AS rejected FROM marked""",
)
def _load_summary_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a file with good and bad records the good ones are loaded, so it has not failed."""
    return load_summary(_flawed_archive(spark, sf_dir), "record")


_GOOD_SQL = "SELECT event_id::VARCHAR AS zpid, event_type AS city, round(value * 100)::BIGINT AS price"


@_register("quarantine_file", f"{_FLAWED_SQL} {_GOOD_SQL} FROM marked WHERE NOT bad_file")
def _quarantine_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(_flawed_archive(spark, sf_dir), "file").select("zpid", "city", "price")


@_register("quarantine_lines_file", f"{_FLAWED_SQL} {_GOOD_SQL} FROM marked WHERE NOT bad_file")
def _quarantine_lines_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(_flawed_archive(spark, sf_dir, "lines"), "file").select("zpid", "city", "price")


@_register("quarantine_lines_record", f"{_FLAWED_SQL} {_GOOD_SQL} FROM marked WHERE NOT bad")
def _quarantine_lines_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(_flawed_archive(spark, sf_dir, "lines")).select("zpid", "city", "price")


_REJECTED_SQL = """SELECT format('{{"zpid":{},"city":"{}","price":"n/a"}}', event_id, event_type) AS record_text,
    'does not fit the schema' AS reject_reason FROM marked WHERE bad"""


@_register(
    "rejected_records",
    f"{_FLAWED_SQL}, rejected AS ({_REJECTED_SQL}) SELECT 'array' AS layout, * FROM rejected"
    " UNION ALL SELECT 'lines', * FROM rejected",
)
def _rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of bad records of both layouts."""
    both = (
        rejected_records(_flawed_archive(spark, sf_dir, layout)).select(
            F.lit(layout).alias("layout"), "record_text", "reject_reason"
        )
        for layout in ("array", "lines")
    )
    return reduce(DataFrame.unionByName, both)


@_register("quarantine_record", f"{_FLAWED_SQL} {_GOOD_SQL} FROM marked WHERE NOT bad")
def _quarantine_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(_flawed_archive(spark, sf_dir), "record").select("zpid", "city", "price")


@_register(
    "quarantined_records",
    f"{_FLAWED_SQL} SELECT event_id::VARCHAR AS zpid, event_type AS city FROM marked WHERE bad",
)
def _quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_records(_flawed_archive(spark, sf_dir)).select("zpid", "city")


@_register(
    "load_summary_unreadable",
    f"""SELECT 3 + count(DISTINCT event_id // {_FILE_SIZE}) AS found, count(DISTINCT event_id // {_FILE_SIZE}) AS processed,
        3::BIGINT AS failed, count(*)::BIGINT AS loaded, 3::BIGINT AS rejected FROM events""",
)
def _load_summary_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good files beside one of zero bytes, a gzip archive that ends too early and one that is not text."""
    path = scratch_path(spark, "unreadable")
    events = _table(spark, sf_dir, "events")
    file = F.floor(F.col("event_id") / _FILE_SIZE).alias("file")
    messages = events.select(file, encode_payload(*_wire_columns()).alias("value"))
    files = messages.groupBy("file").agg(json_array(F.collect_list("value")).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/a", compression="gzip")
    some = messages.orderBy("value").limit(100).agg(json_array(F.collect_list("value")).alias("value")).first()["value"]
    whole = gzip.compress(some.encode())
    broken = {"empty.json": b"", "cut.json.gz": whole[: len(whole) // 2], "noise.json": whole}
    for name, data in broken.items():
        write_bytes(spark, f"{path}/b/{name}", data)
    return load_summary(stage_files(spark, list_files(spark, path, "*.{gz,json}")), "file")


@_register("load_sample", f"SELECT {_WIRE_SQL} FROM events ORDER BY event_id::VARCHAR LIMIT 10")
def _load_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows by key of a staged load."""
    path = scratch_path(spark, "sampled")
    write_array_files(event_messages(_table(spark, sf_dir, "events")), path, 1000)
    return curated_sample(stage_archive(spark, path))


def _verdicts(spark: SparkSession, rows: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """(check, result) for each, beside the rows of the table that the check is about."""
    named = (df.agg(F.count("*").alias("rows")).select(F.lit(c).alias("check"), F.lit(r).alias("result"), "rows") for df, c, r in rows)
    return reduce(DataFrame.unionByName, named)


@_register(
    "input_checks",
    """SELECT unnest(['no folder of the day', 'null messages', 'the fallback']) AS check,
       unnest(['no input', 'left out', 'read']) AS result,
       unnest([(SELECT count(*) FROM events), (SELECT count(*) FROM events WHERE event_id % 3 <> 0), (SELECT count(*) FROM events WHERE event_id % 3 <> 0)]) AS rows""",
)
def _input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day without files is told, not an empty load; a message of null is no record."""
    path, events = scratch_path(spark, "checked"), _table(spark, sf_dir, "events")
    holed = event_messages(events).withColumn("value", F.when(F.expr("get_json_object(CAST(value AS STRING), '$.zpid') % 3 <> 0"), F.col("value")))
    archive_batch(holed, path)
    try:
        scan_archive(spark, path, date(1999, 1, 1), layout="lines")
        told = "nothing said"
    except NoInputError:
        told = "no input"
    scanned = scan_archive(spark, path, layout="lines")
    loose = scan_archive(spark, path, date(1999, 1, 1), layout="lines", fallback_root=path, fallback_names="*.txt")
    left = "left out" if scanned.filter("zpid IS NULL").isEmpty() else "kept"
    return _verdicts(spark, [(events, "no folder of the day", told), (scanned, "null messages", left), (loose, "the fallback", "read")])


@_register(
    "table_checks",
    """SELECT unnest(['no namespace', 'no table', 'no rows', 'rows']) AS check,
       unnest(['False', 'False', 'False', CASE WHEN n >= 100 THEN 'True' ELSE 'False' END]) AS result,
       unnest([0, 0, 0, n]) AS rows FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders)""",
)
def _table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's readiness, from before its namespace exists until it is loaded."""
    orders = _table(spark, sf_dir, "orders")
    name, none = f"acceptance_{uuid.uuid4().hex}", orders.filter(F.lit(False))
    verdict = lambda: str(table_readiness(spark, name, "orders")[0])
    found = [(none, "no namespace", verdict())]
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{scratch_path(spark, name)}'")
    found.append((none, "no table", verdict()))
    table = KeyedTable(spark, name, "orders", ["o_custkey"], StructType([StructField(f.name, f.dataType) for f in orders.schema])).ensure()
    found.append((none, "no rows", verdict()))
    table.upsert(orders, _ORDER)
    found.append((table.read(), "rows", verdict()))
    return _verdicts(spark, found)


@_register("load_incremental", f"SELECT {_WIRE_SQL} FROM events")
def _load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with files added between, also to the first day; a third finds nothing to read."""
    path, name = scratch_path(spark, "incremental"), f"acceptance_{uuid.uuid4().hex}"
    events = _table(spark, sf_dir, "events")
    ledger = LoadLedger(spark, scratch_path(spark, "ledger"))
    table = listing_table(spark, name, "listings", location=scratch_path(spark, name))
    for number in range(3):
        if number < 2:
            added = event_messages(events.filter(F.col("event_id") % 2 == number))
            for day in range(number + 1):
                rows = added.filter(F.crc32("value") % (number + 1) == day)
                write_array_files(rows, f"{path}/2024/01/0{day + 1}", 1000)
        found = load_new(spark, path, ledger, table)
        if (found > 0) != (number < 2):
            raise AssertionError(f"load {number} took {found} files")
    return table.read().drop("timestamp")


# --- cleaning -------------------------------------------------------------------------------


@_register(
    "clean_filter",
    """SELECT * FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal
       FROM customer) WHERE c_acctbal IS NOT NULL AND c_acctbal > 0""",
)
def _clean_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", balance)
    return with_price(customer, "c_acctbal")


@_register(
    "clean_fillna",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS segment,
       CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_acctbal END AS balance,
       CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_nationkey END AS nation,
       CASE WHEN c_custkey % 6 = 0 THEN FALSE ELSE c_acctbal > 0 END AS solvent FROM customer""",
)
def _clean_fillna(spark: SparkSession, sf_dir: str) -> DataFrame:
    def holed(column: Column, every: int) -> Column:
        return F.when(F.col("c_custkey") % every != 0, column)

    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey",
        holed(F.col("c_mktsegment"), 3).alias("segment"),
        holed(F.col("c_acctbal"), 5).alias("balance"),
        holed(F.col("c_nationkey"), 4).alias("nation"),
        holed(F.col("c_acctbal") > 0, 6).alias("solvent"),
    )
    return fill_missing(customer, ("segment",), ("balance", "nation", "solvent"))


# --- time windows ---------------------------------------------------------------------------


def _totals_sql(where: str = "TRUE", source: str = "events") -> str:
    return f"""SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
        time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
        event_type AS city,
        round(avg(round(value * 100)), 6) AS average_price,
        sum(user_id)::BIGINT AS total_living_area,
        round(avg(user_id * 3), 6) AS average_zestimate,
        sum((props->>'k')::INTEGER)::BIGINT AS total_bedrooms
        FROM {source} WHERE {where} GROUP BY ALL"""


def _flat_totals(totals: DataFrame) -> DataFrame:
    return _comparable(flatten_window(totals))


def _comparable(flat: DataFrame) -> DataFrame:
    """Zoneless times and rounded averages, as the SQL gives them."""
    return flat.select(
        _ntz("window_start", "window_start"),
        _ntz("window_end", "window_end"),
        "city",
        *(_rounded(c) if how == "avg" else F.col(c) for c, (how, _) in CITY_MEASURES.items()),
    )


@_register("window_agg", _totals_sql())
def window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_totals(city_totals(event_messages(_table(spark, sf_dir, "events"))))


@_register(
    "window_null_time",
    _totals_sql(
        "ts IS NOT NULL",
        """(SELECT * REPLACE (CASE WHEN event_id % 3 <> 0 AND event_id % 10 <> 0 AND event_id % 11 <> 0
            THEN ts END AS ts) FROM events)""",
    ),
)
def _window_null_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the event times are null, every tenth message is not JSON, some times are absurd."""
    no_time = F.when(F.col("event_id") % 3 != 0, F.col("ts"))
    absurd = F.when(F.col("event_id") % 2 == 0, F.lit(2**63 - 1)).otherwise(F.lit(-(2**62)))
    wire = _wire_columns(no_time)
    payload = (
        F.when(F.expr(_NOT_JSON), "not json")
        .when(F.col("event_id") % 11 == 0, encode_payload(absurd.alias("timestamp"), *wire[1:]))
        .otherwise(encode_payload(*wire))
    )
    return _flat_totals(city_totals(_table(spark, sf_dir, "events").select(payload.alias("value"))))


@_register("window_totals_merged", _totals_sql())
def _window_totals_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads, one of them twice, the first time with rows that are not its own."""
    events = _table(spark, sf_dir, "events")
    totals = StoredTotals(spark, scratch_path(spark, "totals"))
    for load, rows in ((0, "TRUE"), (1, "event_id % 4 = 1"), (2, "event_id % 4 = 2"), (0, "event_id % 4 = 0"), (3, "event_id % 4 = 3")):
        totals.put(f"load {load}", parse_events(event_messages(events.filter(rows)), CITY_FIELDS))
    return _flat_totals(totals.read())


@_register("stream_window_complete", _totals_sql())
def _stream_window_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trigger hands over the whole result, so the last one written is the answer."""
    out = scratch_path(spark, "complete")
    written: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        written.append(f"{out}/batch={batch_id}")
        batch.write.mode("overwrite").parquet(written[-1])

    totals = flatten_window(city_totals(event_messages(_table_stream(spark, sf_dir, "events"))))
    drain(for_each_batch(totals, write, scratch_path(spark, "checkpoint"), "complete", ONCE))
    return _comparable(spark.read.parquet(written[-1]))


@_register(
    "stream_window_append",
    _totals_sql(
        """time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute'
           <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '1 minute'"""
    ),
)
def _stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows the watermark has closed; the others stay in the state."""
    out = scratch_path(spark, "append")
    totals = flatten_window(city_totals(event_messages(_table_stream(spark, sf_dir, "events"))))
    drain(
        start_query(
            totals, scratch_path(spark, "checkpoint"), "parquet", "append", ONCE, {"path": out}
        )
    )
    return _comparable(spark.read.parquet(out))


_LATE_PERCENT = 5


def _ordered_files(spark: SparkSession, sf_dir: str) -> tuple[list[str], StructType]:
    """Events by time in four folders, and the first of them (by time) once more in a fifth."""
    events, folder = _table(spark, sf_dir, "events"), scratch_path(spark, "ordered")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    late, *cuts = (low + (high - low) * percent // 100 for percent in (_LATE_PERCENT, 25, 50, 75))
    bounds = [low - 1, *cuts, high]
    parts = [(at > a) & (at <= b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    paths = []
    for number, rows in enumerate([*parts, at <= late]):
        paths.append(f"{folder}/{number}")
        events.filter(rows).write.parquet(paths[-1])
    return paths, events.schema


def _restarted(spark: SparkSession, sf_dir: str, output_mode: str, write) -> None:
    """The ordered folders through one checkpoint, the query stopped and started again for each."""
    paths, schema = _ordered_files(spark, sf_dir)
    source, checkpoint = scratch_path(spark, "source"), scratch_path(spark, "checkpoint")
    for path in paths:
        spark.read.schema(schema).parquet(path).write.mode("append").parquet(source)
        stream = event_stream(spark, "parquet", path=source, schema=schema)
        totals = flatten_window(city_totals(event_messages(stream)))
        drain(for_each_batch(totals, write, checkpoint, output_mode, ONCE))


_LATE_SQL = f"""epoch_us(ts) <= (SELECT min(epoch_us(ts))
    + (max(epoch_us(ts)) - min(epoch_us(ts))) * {_LATE_PERCENT} // 100 FROM events)"""


@_register(
    "stream_restart",
    _totals_sql(source=f"(SELECT * FROM events UNION ALL SELECT * FROM events WHERE {_LATE_SQL})"),
)
def _stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode keeps every window over four restarts, and counts the late rows in them."""
    out = scratch_path(spark, "restarted")
    written: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        written.append(f"{out}/batch={batch_id}")
        batch.write.mode("overwrite").parquet(written[-1])

    _restarted(spark, sf_dir, "complete", write)
    return _comparable(spark.read.parquet(written[-1]))


@_register("stream_late_update", _totals_sql())
def _stream_late_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode drops the rows behind the watermark; the last update of a window is its total."""
    out = scratch_path(spark, "updates")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/part={batch_id}")

    _restarted(spark, sf_dir, "update", write)
    updates = spark.read.parquet(out).drop("part")
    return _comparable(latest_per_key(updates, ["window_start", "city"], ["batch"]))


@_register(
    "stream_open_windows",
    _totals_sql(
        """time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute'
           > (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '1 minute'"""
    ),
)
def _stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the append stream has not given out, read from its state."""
    checkpoint = scratch_path(spark, "checkpoint")
    totals = flatten_window(city_totals(event_messages(_table_stream(spark, sf_dir, "events"))))
    drain(start_query(totals, checkpoint, "parquet", "append", ONCE, {"path": scratch_path(spark, "append")}))
    return _comparable(open_windows(spark, checkpoint))


def _split_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The ordered folders through one checkpoint, the first of them once more at the end: on time, and late."""
    paths, schema = _ordered_files(spark, sf_dir)
    on_time, late, source, checkpoint = (scratch_path(spark, name) for name in ("on-time", "late", "source", "checkpoint"))
    for path in paths:
        spark.read.schema(schema).parquet(path).write.mode("append").parquet(source)
        stream = event_stream(spark, "parquet", path=source, schema=schema)
        drain(split_late(parse_events(event_messages(stream)), on_time, late, checkpoint, trigger=ONCE))
    return on_time, late


@_register("stream_late_rows", f"SELECT {_WIRE_SQL.split(', event_type')[0]}, date_trunc('milliseconds', ts) AS event_ts FROM events WHERE {_LATE_SQL}")
def _stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that come again when the watermark has long passed them."""
    _, late = _split_stream(spark, sf_dir)
    return read_batches(spark, late).select("zpid", _ntz("timestamp", "event_ts"))


@_register("stream_late_totals", _totals_sql(source=f"(SELECT * FROM events UNION ALL SELECT * FROM events WHERE {_LATE_SQL})"))
def _stream_late_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on time and late rows together are all rows."""
    both = (read_batches(spark, path) for path in _split_stream(spark, sf_dir))
    return _flat_totals(window_totals(reduce(DataFrame.unionByName, both)))


# --- keyed upsert ---------------------------------------------------------------------------

_ORDER = ("o_orderdate", "o_orderkey")
_NEWEST = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
_NEWEST_ODD_FIRST = """row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC) = 1"""


@_register("upsert_latest", f"SELECT * FROM orders QUALIFY {_NEWEST}")
def _upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_table(spark, sf_dir, "orders"), ["o_custkey"], _ORDER)


def _even_and_odd(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = _table(spark, sf_dir, "orders")
    return orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 2 = 1")


@_register("upsert_merge", f"SELECT * FROM orders QUALIFY {_NEWEST_ODD_FIRST}")
def _upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (latest_per_key(df, ["o_custkey"], _ORDER) for df in _even_and_odd(spark, sf_dir))
    return merge_latest(old, new, ["o_custkey"])


def _orders_table(spark: SparkSession, schema: StructType, newer: tuple[str, ...] = ()) -> KeyedTable:
    namespace = f"acceptance_{uuid.uuid4().hex}"
    return KeyedTable(
        spark,
        namespace,
        "orders",
        ["o_custkey"],
        StructType([StructField(f.name, f.dataType) for f in schema.fields]),
        location=scratch_path(spark, namespace),
        newer=newer,
    ).ensure()


@_register("upsert_table", f"SELECT * FROM orders QUALIFY {_NEWEST_ODD_FIRST}")
def _upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _even_and_odd(spark, sf_dir)
    table = _orders_table(spark, old.schema)
    table.upsert(old, _ORDER)
    table.upsert(new, _ORDER)
    return table.read()


@_register("upsert_older_day", f"SELECT * FROM orders QUALIFY {_NEWEST}")
def _upsert_older_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the dates is loaded first; the earlier half must not replace it."""
    orders = _table(spark, sf_dir, "orders")
    middle = orders.agg(F.percentile_approx("o_orderdate", 0.5).alias("day")).first()["day"]
    table = _orders_table(spark, orders.schema, newer=_ORDER)
    table.upsert(orders.filter(F.col("o_orderdate") >= F.lit(middle)), _ORDER)
    table.upsert(orders.filter(F.col("o_orderdate") < F.lit(middle)), _ORDER)
    return table.read()


@_register(
    "upsert_null_keys",
    f"SELECT * FROM orders WHERE o_orderkey % 5 <> 0 QUALIFY {_NEWEST}",
)
def _upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key are left out, and the same batch again changes nothing."""
    orders = _table(spark, sf_dir, "orders")
    keyed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")))
    table = _orders_table(spark, orders.schema)
    for _ in range(2):
        table.upsert(keyed, _ORDER)
    return table.read()


@_register("stream_any", f"SELECT * FROM orders QUALIFY {_NEWEST}")
def _stream_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, one of which would never end: when the other does, both are stopped."""
    orders = _table_stream(spark, sf_dir, "orders")
    table = _orders_table(spark, orders.schema)
    drain(upsert_stream(orders, table, _ORDER, scratch_path(spark, "checkpoint"), ONCE))
    idle = start_query(orders, scratch_path(spark, "idle"), "noop", "append", {"processingTime": "1 second"})
    done = upsert_stream(orders, table, _ORDER, scratch_path(spark, "again"), ONCE)
    await_any([idle, done])
    if idle.isActive or done.isActive:
        raise AssertionError("a stream is still running")
    return table.read()


@_register("stream_upsert", f"SELECT * FROM orders QUALIFY {_NEWEST}")
def _stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table_stream(spark, sf_dir, "orders")
    table = _orders_table(spark, orders.schema)
    drain(upsert_stream(orders, table, _ORDER, scratch_path(spark, "checkpoint"), ONCE))
    return table.read()


def _merge_table(spark: SparkSession, schema: StructType) -> MergeTable:
    return MergeTable(spark, scratch_path(spark, "merge-table"), ["o_custkey"], _ORDER, schema, buckets=8)


def _thirds(orders: DataFrame) -> list[DataFrame]:
    return [orders.filter(F.crc32(F.col("o_orderkey").cast("string")) % 3 == n) for n in range(3)]


@_register("upsert_delta", f"SELECT * FROM orders QUALIFY {_NEWEST}")
def _upsert_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches with a compaction between: base and one delta, merged on read."""
    orders = _table(spark, sf_dir, "orders")
    table = _merge_table(spark, orders.schema)
    for number, batch in enumerate(_thirds(orders)):
        if number == 2:
            table.compact()
        table.upsert(batch)
    return table.read()


@_register("stream_upsert_delta", f"SELECT * FROM orders QUALIFY {_NEWEST}")
def _stream_upsert_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's batches as deltas, each of them handed over twice."""
    orders = _table_stream(spark, sf_dir, "orders")
    table = _merge_table(spark, orders.schema)
    for checkpoint in ("checkpoint", "checkpoint"):
        drain(merge_stream(orders, table, scratch_path(spark, checkpoint), ONCE))
    return table.read()


_WANTED_KEYS = "SELECT DISTINCT c_custkey FROM customer WHERE c_custkey % 50 = 0"


@_register("table_lookup", f"SELECT * FROM orders WHERE o_custkey IN ({_WANTED_KEYS}) QUALIFY {_NEWEST}")
def _table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers of a keyed table."""
    orders = _table(spark, sf_dir, "orders")
    table = _orders_table(spark, orders.schema)
    table.upsert(orders, _ORDER)
    return table.lookup(_wanted_customers(spark, sf_dir), max_keys=1_000_000)


@_register("table_lookup_delta", f"SELECT * FROM orders WHERE o_custkey IN ({_WANTED_KEYS}) QUALIFY {_NEWEST}")
def _table_lookup_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a table that merges on read."""
    orders = _table(spark, sf_dir, "orders")
    table = _merge_table(spark, orders.schema)
    for batch in _thirds(orders):
        table.upsert(batch)
    return table.lookup(_wanted_customers(spark, sf_dir), max_keys=1_000_000)


def _wanted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    return customer.filter(F.col("c_custkey") % 50 == 0).select(F.col("c_custkey").alias("o_custkey"))


# --- reports --------------------------------------------------------------------------------


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their discounted price standing in for a prediction."""
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("city"),
        F.col("l_linestatus").alias("hometype"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("prediction"),
    )


_PREDICTED = "l_extendedprice * (1 - l_discount)"
_AVERAGES = f"""round(avg(l_extendedprice), 6) AS avg_actual,
    round(avg({_PREDICTED}), 6) AS avg_predicted"""


@_register("table_scan_count", "SELECT count(*) AS row_count FROM lineitem")
def _table_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_table(spark, sf_dir, "lineitem"))


@_register(
    "pred_stats_overall",
    f"""SELECT count(*) AS total, {_AVERAGES}, round(min({_PREDICTED}), 6) AS min_predicted,
        round(max({_PREDICTED}), 6) AS max_predicted FROM lineitem""",
)
def _pred_stats_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = overall_statistics(_predictions(spark, sf_dir))
    return stats.select("total", *(_rounded(c) for c in stats.columns if c != "total"))


def _report(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    report = group_report(_predictions(spark, sf_dir), group)
    return report.select(group, "count", _rounded("avg_actual"), _rounded("avg_predicted"))


@_register(
    "pred_by_city",
    f"""SELECT l_returnflag AS city, count(*) AS count, {_AVERAGES} FROM lineitem
        GROUP BY 1 ORDER BY avg({_PREDICTED}) DESC, 1 LIMIT 20""",
)
def _pred_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "city")


@_register(
    "pred_by_hometype",
    f"""SELECT l_linestatus AS hometype, count(*) AS count, {_AVERAGES} FROM lineitem
        GROUP BY 1 ORDER BY avg({_PREDICTED}) DESC, 1 LIMIT 20""",
)
def _pred_by_hometype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "hometype")


@_register(
    "pred_by_part",
    f"""SELECT l_partkey, count(*) AS count, {_AVERAGES.replace("6", "7")} FROM lineitem
        GROUP BY 1 ORDER BY avg({_PREDICTED}) DESC, 1 LIMIT 20""",
)
def _pred_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grouped report over many groups, where the top 20 cut counts.

    Seven places: averages of 32 amounts in cents can end in a 5 at the seventh.
    """
    lines = _table(spark, sf_dir, "lineitem").withColumn("prediction", F.expr(_PREDICTED))
    report = group_report(lines, "l_partkey", "l_extendedprice")
    return report.select("l_partkey", "count", _rounded("avg_actual", 7), _rounded("avg_predicted", 7))


@_register(
    "pred_sample",
    """SELECT p_partkey, p_brand, p_type, p_size, p_retailprice AS actual_price,
       p_retailprice * 1.1::DOUBLE AS predicted_price FROM part ORDER BY p_partkey LIMIT 20""",
)
def _pred_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").withColumn("prediction", F.col("p_retailprice") * 1.1)
    columns = ("p_partkey", "p_brand", "p_type", "p_size")
    return prediction_sample(part, columns, "p_retailprice", order=("p_partkey",))


@_register(
    "formatted_numbers",
    """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS price,
       format('{:,d}', o_orderkey * 1000) AS thousand_keys FROM orders""",
)
def _formatted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        money(F.col("o_totalprice")).alias("price"),
        thousands(F.col("o_orderkey") * 1000).alias("thousand_keys"),
    )


@_register(
    "table_sample",
    "SELECT p_brand, p_type, p_size, p_retailprice FROM part ORDER BY p_partkey LIMIT 5",
)
def _table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("p_brand", "p_type", "p_size", "p_retailprice")
    return table_sample(_table(spark, sf_dir, "part"), columns, ("p_partkey",))


@_register(
    "regression_metrics",
    f"""SELECT count(*) AS rows, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
        round(1 - avg(e * e) / var_pop(y), 9) AS r2
        FROM (SELECT l_extendedprice AS y, l_extendedprice - {_PREDICTED} AS e FROM lineitem)""",
)
def _regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = regression_metrics(_predictions(spark, sf_dir))
    return metrics.select("rows", _rounded("rmse"), _rounded("mae"), _rounded("r2", 9))


_SIZED = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events")


@_register(
    "readiness",
    "SELECT table_name, row_count, CASE WHEN row_count = 0 THEN 'NO DATA'"
    " WHEN row_count < 100 THEN 'NOT ENOUGH DATA' WHEN row_count < 500 THEN 'MINIMAL DATA'"
    " ELSE 'READY' END AS status, row_count >= 100 AS ok FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in _SIZED
    )
    + ")",
)
def _readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = (
        readiness(_table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        for name in _SIZED
    )
    return reduce(DataFrame.unionByName, verdicts)


# --- features and model ---------------------------------------------------------------------

_CATEGORIES = ("p_brand", "p_type")
_NUMERICS = ("p_size", "is_large")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    return part.withColumn("is_large", F.col("p_size") > 25)


@_register(
    "split_hash",
    """SELECT p_partkey, bucket, bucket < 8 AS in_train FROM (
       SELECT p_partkey, (('0x' || substr(md5(p_partkey::VARCHAR), 1, 4))::INTEGER % 10) AS bucket
       FROM part)""",
)
def _split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out = split_by_key(_table(spark, sf_dir, "part"), "p_partkey")
    marked = train.withColumn("in_train", F.lit(True)).unionByName(
        held_out.withColumn("in_train", F.lit(False))
    )
    return marked.select("p_partkey", hash_bucket(F.col("p_partkey")).alias("bucket"), "in_train")


@_register("split_random", "SELECT p_partkey, p_retailprice, 1::BIGINT AS parts, TRUE AS fair FROM part")
def _split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the number of parts it is in, and whether the training part has four fifths."""
    rows = _table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    train, held_out = split_at_random(rows)
    both = train.withColumn("in_train", F.lit(1)).unionByName(held_out.withColumn("in_train", F.lit(0)))
    share = both.agg(F.avg("in_train")).first()[0]
    return both.groupBy("p_partkey", "p_retailprice").agg(
        F.count("*").alias("parts"), F.lit(abs(share - 0.8) < 0.1).alias("fair")
    )


def _featured(spark: SparkSession, sf_dir: str, stages: int) -> DataFrame:
    parts = _parts(spark, sf_dir)
    return Pipeline(stages=feature_stages(_CATEGORIES, _NUMERICS)[:stages]).fit(parts).transform(parts)


def _digits(vector: str) -> Column:
    """Whole-numbered vector as text, to compare as one value."""
    whole = F.transform(vector_to_array(F.col(vector)), lambda x: x.cast("int").cast("string"))
    return F.array_join(whole, ",").alias(vector)


def _index_sql(column: str) -> str:
    return f"""(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i,
        count(*) OVER () AS n FROM part GROUP BY {column})"""


_INDEXED_SQL = f"""FROM part JOIN {_index_sql("p_brand")} b USING (p_brand)
    JOIN {_index_sql("p_type")} t USING (p_type)"""


def _one_hot_sql(side: str) -> str:
    return f"""array_to_string(list_transform(range({side}.n + 1),
        lambda j: CASE WHEN j = {side}.i THEN 1 ELSE 0 END), ',')"""


@_register(
    "string_index",
    f"""SELECT p_partkey, b.i::DOUBLE AS p_brand_index, t.i::DOUBLE AS p_type_index
        {_INDEXED_SQL}""",
)
def _string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark, sf_dir, 1).select("p_partkey", "p_brand_index", "p_type_index")


@_register(
    "string_index_wide",
    """SELECT l_orderkey, l_linenumber, l_partkey_index FROM lineitem JOIN (
           SELECT l_partkey, (row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1)::DOUBLE AS l_partkey_index
           FROM lineitem GROUP BY 1) USING (l_partkey)""",
)
def _string_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of many values, none of which passes through the driver."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return index_wide(lines, "l_partkey", wide_index(lines, "l_partkey")).drop("l_partkey")


@_register(
    "one_hot",
    f"""SELECT p_partkey, {_one_hot_sql("b")} AS p_brand_vec, {_one_hot_sql("t")} AS p_type_vec
        {_INDEXED_SQL}""",
)
def _one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark, sf_dir, 2).select("p_partkey", _digits("p_brand_vec"), _digits("p_type_vec"))


@_register(
    "features",
    f"""SELECT p_partkey, {_one_hot_sql("b")} || ',' || {_one_hot_sql("t")} || ',' || p_size || ','
        || (p_size > 25)::INTEGER AS features {_INDEXED_SQL}""",
)
def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark, sf_dir, 3).select("p_partkey", _digits("features"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two features of a dozen combinations. Trees that all see the same data then agree, and
    each prediction is the training part's mean of its combination."""
    parts = materialize(_parts(spark, sf_dir), "parts")
    train, _ = split_by_key(parts, "p_partkey")
    model = fit_model(
        train, ("p_type",), ("is_large",), "p_retailprice", bootstrap=False, feature_subset="all"
    )
    return predict(model, parts)


_SCORED_SQL = """WITH marked AS (
    SELECT *, (('0x' || substr(md5(p_partkey::VARCHAR), 1, 4))::INTEGER % 10) < 8 AS in_train FROM part
), means AS (
    SELECT p_type, p_size > 25 AS is_large, avg(p_retailprice) AS prediction
    FROM marked WHERE in_train GROUP BY ALL
), scored AS (
    SELECT m.*, prediction FROM marked m JOIN means ON m.p_type = means.p_type AND (p_size > 25) = is_large)"""


@_register(
    "ml_predict",
    f"{_SCORED_SQL} SELECT p_partkey, p_retailprice, round(prediction, 6) AS prediction FROM scored",
)
def _ml_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("p_partkey", "p_retailprice", _rounded("prediction"))


@_register(
    "ml_holdout",
    f"""{_SCORED_SQL} SELECT count(*) AS rows, round(sqrt(avg(e * e)), 6) AS rmse,
        round(avg(abs(e)), 6) AS mae, round(1 - avg(e * e) / var_pop(p_retailprice), 9) AS r2
        FROM (SELECT *, p_retailprice - prediction AS e FROM scored WHERE NOT in_train)""",
)
def _ml_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, held_out = split_by_key(_scored(spark, sf_dir), "p_partkey")
    metrics = regression_metrics(held_out, "p_retailprice")
    return metrics.select("rows", _rounded("rmse"), _rounded("mae"), _rounded("r2", 9))
