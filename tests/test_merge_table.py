"""The table that merges on read: what it reads, what it writes, who may write."""

import os
import uuid
from datetime import timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearthline.operators.merge_table import MergeTable
from hearthline.sources.events import event_stream
from hearthline.sources.files import FileConflictError, read_text, write_new
from hearthline.streaming.queries import drain, merge_stream
from tests.conftest import plan

ROW = "k string, t long, v string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, ROW)


def open_table(spark, folder, buckets=4):
    return MergeTable(spark, str(folder), ["k"], ["t"], frame(spark).schema, buckets)


def content(df):
    return sorted(map(tuple, df.collect()))


def data_bytes(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_newest_row_of_base_and_deltas(spark, tmp_path):
    table = open_table(spark, tmp_path / "t")
    assert content(table.read()) == [] and table.compact() == []
    table.upsert(frame(spark, ("a", 1, "old"), ("b", 5, "kept"), ("c", 1, None), (None, 1, "no key")))
    assert content(table.read()) == [("a", 1, "old"), ("b", 5, "kept"), ("c", 1, None)]
    table.upsert(frame(spark, ("a", 2, "new"), ("b", 3, "late"), ("d", None, "no time")))
    now = [("a", 2, "new"), ("b", 5, "kept"), ("c", 1, None), ("d", None, "no time")]
    assert content(table.read()) == now
    assert table.compact()
    assert table.manifest().deltas == {} and content(table.read()) == now
    table.upsert(frame(spark, ("a", 2, "equal and later"), ("d", 0, "a time")))
    now[0], now[3] = ("a", 2, "equal and later"), ("d", 0, "a time")
    assert content(table.read()) == now
    assert content(open_table(spark, tmp_path / "t", buckets=99).read()) == now, "it keeps its buckets"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 3), st.sampled_from("xyz"))), st.booleans()), max_size=5))
def test_any_history_equals_brute_force(spark, tmp_path, batches):
    table, newest = open_table(spark, tmp_path / uuid.uuid4().hex, buckets=2), {}
    for rows, then_compact in batches:
        table.upsert(frame(spark, *rows))
        best = {}
        for key, t, v in rows:
            best[key] = max(best.get(key, (-1, "")), (t, v))
        for key, (t, v) in best.items():
            if t >= newest.get(key, (-1, ""))[0]:
                newest[key] = (t, v)
        if then_compact:
            table.compact()
    assert content(table.read()) == sorted((k, *tv) for k, tv in newest.items())


def test_an_upsert_writes_its_batch_whatever_the_size_of_the_table(spark, tmp_path):
    def rows(n, t):
        return spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(t).cast("long").alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("v"))

    written = []
    for size in (2_000, 200_000):
        folder = tmp_path / str(size)
        table = open_table(spark, folder)
        table.upsert(rows(size, 1))
        table.compact()
        before = {f: f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}
        base = data_bytes(folder)
        table.upsert(rows(200, 2))
        written.append(data_bytes(folder) - base)
        assert all(f.stat().st_mtime_ns == time for f, time in before.items()), "no file of the base is touched"
        assert table.read().filter("t = 2").count() == 200
    assert written[1] <= 1.1 * written[0] < base / 20


def test_compaction_writes_only_the_buckets_that_deltas_touch(spark, tmp_path):
    table = open_table(spark, tmp_path / "t", buckets=16)
    table.upsert(spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("t"), F.lit("v").alias("v")))
    table.compact()
    (first,) = table.manifest().base
    table.upsert(frame(spark, ("7", 2, "new")))
    touched = table.compact()
    assert len(touched) == 1
    base = table.manifest().base
    assert sorted(b for buckets in base.values() for b in buckets) == list(range(16))
    assert len(base) == 2 and len(base[first]) == 15
    assert table.read().count() == 4000 and content(table.read().filter("t = 2")) == [("7", 2, "new")]


def test_a_batch_shows_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    table = open_table(spark, tmp_path / "t")
    table.upsert(frame(spark, ("a", 1, "x")))
    seen = table.read()
    monkeypatch.setattr(table, "_commit", lambda manifest: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.upsert(frame(spark, ("a", 2, "y"), ("b", 2, "y")))
    monkeypatch.undo()
    assert content(table.read()) == [("a", 1, "x")], "what was written without a manifest does not count"
    table.upsert(frame(spark, ("b", 3, "z")))
    assert content(table.read()) == [("a", 1, "x"), ("b", 3, "z")]
    table.compact()
    assert content(seen) == [("a", 1, "x")], "an older reader keeps its files"


def test_of_two_writers_at_a_time_one_fails(spark, tmp_path, monkeypatch):
    one, two = open_table(spark, tmp_path / "t"), open_table(spark, tmp_path / "t")
    one.upsert(frame(spark, ("a", 1, "x")))
    stale = two.manifest()
    one.upsert(frame(spark, ("a", 2, "y")))
    monkeypatch.setattr(two, "manifest", lambda: stale)
    with pytest.raises(FileConflictError):
        two.upsert(frame(spark, ("a", 3, "z")))
    assert content(one.read()) == [("a", 2, "y")]
    assert not [f for f in os.listdir(tmp_path / "t/manifest") if f.startswith(".0") and not f.endswith(".crc")]


def test_vacuum_keeps_what_manifests_name(spark, tmp_path):
    table = open_table(spark, tmp_path / "t")
    for t in range(3):
        table.upsert(frame(spark, ("a", t, "x"), (f"b{t}", t, "y")))
    table.compact()
    now = content(table.read())
    assert table.vacuum(timedelta(hours=1)) == 0
    assert table.vacuum(timedelta(0)) == 3
    assert len(os.listdir(tmp_path / "t/data")) == 1
    assert content(table.read()) == now


def test_a_replayed_batch_of_a_stream_changes_nothing(spark, tmp_path):
    table = open_table(spark, tmp_path / "t")
    assert table.upsert(frame(spark, ("a", 1, "x")), "s", 0)
    assert not table.upsert(frame(spark, ("a", 1, "again")), "s", 0)
    assert table.upsert(frame(spark), "s", 1), "an empty batch counts"
    assert not table.upsert(frame(spark, ("a", 9, "z")), "s", 1)
    assert table.upsert(frame(spark, ("a", 1, "other stream")), "t", 0)
    assert content(table.read()) == [("a", 1, "other stream")]


def test_a_stream_restarted_without_its_last_commit(spark, tmp_path):
    source, checkpoint = tmp_path / "in", tmp_path / "c"
    table = open_table(spark, tmp_path / "t")
    for n in range(3):
        frame(spark, ("a", n, f"v{n}"), (f"b{n}", 0, "w")).coalesce(1).write.mode("append").parquet(str(source))
        stream = event_stream(spark, "parquet", path=str(source), schema=table.schema)
        drain(merge_stream(stream, table, str(checkpoint), {"availableNow": True}))
        if n == 1:  # as if the process had died between the table and the stream's own log
            for name in (f"{n}", f".{n}.crc"):
                (checkpoint / "commits" / name).unlink()
    assert content(table.read()) == [("a", 2, "v2"), ("b0", 0, "w"), ("b1", 0, "w"), ("b2", 0, "w")]
    assert len(table.manifest().deltas) == 3


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_path):
    table = open_table(spark, tmp_path / "t", buckets=16)
    table.upsert(spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("t"), F.lit("v").alias("v")))
    table.compact()
    table.upsert(frame(spark, ("17", 2, "new"), ("new", 1, "n")))
    keys = spark.createDataFrame([("17", 0), ("17", 1), ("new", 0), ("absent", 0), (None, 0)], "k string, other int")
    found = table.lookup(keys)
    assert content(found) == [("17", 2, "new"), ("new", 1, "n")]
    assert "PushedFilters: [In(k" in plan(found)
    wanted = {row[0] for row in keys.dropna().select(table._bucket(16)).collect()}
    gone = [f for f in (tmp_path / "t").rglob("*.parquet") if int(f.parent.name.split("=")[1]) not in wanted]
    for file in gone:
        file.unlink()
    assert len(gone) >= 13 and content(table.lookup(keys)) == [("17", 2, "new"), ("new", 1, "n")], "other buckets are not read"
    with pytest.raises(ValueError, match="more than 2 keys"):
        table.lookup(keys, max_keys=2)
    assert table.lookup(keys.limit(0)).count() == 0


def test_small_files_are_written_once(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    assert read_text(spark, path) is None
    write_new(spark, path, "eins ä")
    with pytest.raises(FileConflictError):
        write_new(spark, path, "zwei")
    assert read_text(spark, path) == "eins ä"
