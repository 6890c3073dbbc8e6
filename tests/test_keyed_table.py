import re
import uuid
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthline.operators.keyed_table import (
    KeyedTable,
    append_to_store,
    namespace_exists,
    table_exists,
)
from hearthline.operators.latest import latest_per_key, merge_latest
from hearthline.sources.events import event_stream
from hearthline.sources.tables import scan_table
from hearthline.streaming.queries import drain, upsert_stream
from tests.conftest import plan

ROW = "k string, t long, v string"


@pytest.fixture
def table(spark):
    schema = spark.createDataFrame([], ROW).schema
    return KeyedTable(spark, f"ns_{uuid.uuid4().hex}", "current", ["k"], schema, buckets=4)


def frame(spark, *rows):
    return spark.createDataFrame(rows, ROW)


def content(df):
    return sorted(map(tuple, df.collect()))


def test_latest_wins_with_its_nulls(spark):
    df = frame(spark, ("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), ("b", None, "z"), ("b", 0, "w"))
    assert content(latest_per_key(df, ["k"], ["t"])) == [("a", 3, None), ("b", 0, "w")]
    assert latest_per_key(df, ["k"], ["t"]).columns == ["k", "t", "v"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.sampled_from("xyz"))))
def test_latest_equals_brute_force(spark, rows):
    newest = {}
    for key, t, v in rows:
        newest[key] = max(newest.get(key, (-1, "")), (t, v))
    got = latest_per_key(frame(spark, *rows).repartition(3), ["k"], ["t", "v"])
    assert content(got) == sorted((k, *tv) for k, tv in newest.items())


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"),
    )
    newest = latest_per_key(df, ["k"], ["t"])
    assert "partial_max" in plan(newest)
    assert newest.filter("k = 'hot'").first()["t"] == 99_999
    assert newest.count() == 66_667


def test_merge_keeps_untouched_rows(spark):
    old = frame(spark, ("a", 1, "x"), ("b", 1, "y"))
    new = frame(spark, ("b", 0, None), ("c", 1, "z"))
    assert content(merge_latest(old, new, ["k"])) == [("a", 1, "x"), ("b", 0, None), ("c", 1, "z")]


def test_upsert_is_idempotent_and_later_writes_win(spark, table):
    table.ensure().ensure()
    assert table_exists(spark, table.namespace, "current")
    first = frame(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"))
    for _ in range(2):
        table.upsert(first, ["t"])
        assert content(table.read()) == [("a", 2, "y"), ("b", 1, "z")]
    table.upsert(frame(spark, ("a", 0, "older event, later write")), ["t"])
    assert content(table.read())[0] == ("a", 0, "older event, later write")


def test_an_older_row_replaces_nothing_where_times_are_compared(spark):
    schema = spark.createDataFrame([], ROW).schema
    table = KeyedTable(spark, f"ns_{uuid.uuid4().hex}", "current", ["k"], schema, buckets=2, newer=["t"]).ensure()
    table.upsert(frame(spark, ("a", 5, "new"), ("b", None, "no time")), ["t"])
    table.upsert(frame(spark, ("a", 4, "old"), ("b", 1, "time"), ("c", 1, "x")), ["t"])
    assert content(table.read()) == [("a", 5, "new"), ("b", 1, "time"), ("c", 1, "x")]
    table.upsert(frame(spark, ("a", 5, "same time, later write")), ["t"])
    assert content(table.read())[0] == ("a", 5, "same time, later write")


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 1, None)]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        assert content(latest_per_key(frame(spark, *order).coalesce(1), ["k"], ["t"])) == [("a", 1, "y")]
    maps = spark.createDataFrame([("a", 1, {"x": 1})], "k string, t long, m map<string,int>")
    assert latest_per_key(maps, ["k"], ["t"]).count() == 1


def test_rows_without_a_key_are_left_out_and_a_repeat_changes_nothing(spark, table):
    table.ensure()
    batch = frame(spark, (None, 1, "x"), ("a", 1, "y"))
    for _ in range(2):
        table.upsert(batch, ["t"])
        assert content(table.read()) == [("a", 1, "y")]
    table.upsert(frame(spark, (None, 1, "x")), ["t"])
    assert content(table.read()) == [("a", 1, "y")]


def test_an_upsert_leaves_the_files_of_other_buckets_alone(spark):
    schema = spark.createDataFrame([], ROW).schema
    table = KeyedTable(spark, f"ns_{uuid.uuid4().hex}", "current", ["k"], schema, buckets=8).ensure()
    table.upsert(spark.range(100).selectExpr("CAST(id AS STRING) k", "id t", "'x' v"), ["t"])
    before = set(table.read().inputFiles())
    reader = table.read()
    table.upsert(frame(spark, ("7", 200, "y")), ["t"])
    after = set(table.read().inputFiles())
    assert len(before) == len(after) == 8 and len(before & after) == 7
    assert table.read().count() == 100 and table.read().filter("v = 'y'").count() == 1
    assert reader.count() == 100
    assert table.vacuum(timedelta(hours=1)) == 0
    assert table.vacuum(timedelta(0)) == 0, "seven buckets still use the first version"
    table.upsert(spark.range(100).selectExpr("CAST(id AS STRING) k", "id + 300 t", "'z' v"), ["t"])
    assert table.vacuum(timedelta(0)) == 2
    assert table.read().filter("v = 'z'").count() == 100


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, table):
    table.ensure().upsert(frame(spark, ("a", 1, "x")), ["t"])
    broken = frame(spark, ("b", 1, "x")).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(broken, ["t"])
    assert content(table.read()) == [("a", 1, "x")]
    table.upsert(frame(spark, ("c", 1, "x")), ["t"])
    assert content(table.read()) == [("a", 1, "x"), ("c", 1, "x")]


def test_one_file_per_bucket_whatever_the_shuffle(spark):
    schema = spark.createDataFrame([], ROW).schema
    table = KeyedTable(spark, f"ns_{uuid.uuid4().hex}", "current", ["k"], schema, buckets=16)
    table.ensure()
    for first in (0, 500):
        rows = spark.range(first, first + 1000).selectExpr("CAST(id AS STRING) k", "id t", "'x' v")
        table.upsert(rows, ["t"])
        assert len(table.read().inputFiles()) == 16
    assert table.read().count() == 1500


def test_existence_checks(spark):
    assert not namespace_exists(spark, "nowhere")
    assert not table_exists(spark, "nowhere", "t")
    assert not table_exists(spark, "default", "no_such_table")


def test_stream_upsert_replays_safely(spark, table, tmp_path):
    table.ensure()
    source = str(tmp_path / "in")
    schema = table.schema
    for n, rows in enumerate(([("a", 1, "x"), ("b", 1, "y")], [("a", 2, "z")])):
        frame(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        stream = event_stream(spark, "parquet", path=source, schema=schema)
        # A fresh checkpoint replays every earlier file as well.
        drain(upsert_stream(stream, table, ["t"], str(tmp_path / f"c{n}"), {"availableNow": True}))
    assert content(table.read()) == [("a", 2, "z"), ("b", 1, "y")]


def test_any_format_can_be_store_and_source(spark, tmp_path):
    path = str(tmp_path / "store")
    append_to_store(frame(spark, ("a", 1, "x")), "parquet", {"path": path})
    append_to_store(frame(spark, ("b", 1, "x")), "parquet", {"path": path})
    assert scan_table(spark, fmt="parquet", path=path).count() == 2
    with pytest.raises(ValueError):
        scan_table(spark)


def test_lookup_lists_the_partitions_of_its_keys(spark):
    schema = spark.createDataFrame([], ROW).schema
    wide = KeyedTable(spark, f"ns_{uuid.uuid4().hex}", "current", ["k"], schema, buckets=16).ensure()
    wide.upsert(spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("t"), F.lit("v").alias("v")), ["t"])
    keys = frame(spark, ("17", 0, "x"), ("17", 1, "y"), ("absent", 0, None), (None, 0, None)).select("k", "t")
    found = wide.lookup(keys)
    assert content(found) == [("17", 1, "v")]
    buckets = {row[0] for row in keys.dropna().select(wide._bucket()).collect()}
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan(found))[1]
    assert {int(n) for n in re.findall(r"(?<![#\d])\d+(?=[,)\]])", filters)} == buckets and len(buckets) <= 2
    with pytest.raises(ValueError, match="more than 1 keys"):
        wide.lookup(keys, max_keys=1)
