"""Packing of archive days: the same messages in fewer files, whenever one looks."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hearthline.sources.archive import scan_archive
from hearthline.sources.files import FileConflictError
from hearthline.streaming import compaction
from hearthline.streaming.archive import archive_batch
from hearthline.streaming.compaction import compact_day, remove_packed

DAY, NEXT = date(2024, 1, 1), date(2024, 1, 2)


def put(spark, root, first, last, day=DAY, files=5):
    rows = spark.range(first, last, 1, files).select(F.to_json(F.struct(F.col("id").cast("string").alias("zpid"))).alias("value"))
    # As a stream writes: a file for each task.
    from hearthline.streaming.archive import _write, dated_messages

    _write(dated_messages(rows, F.lit(day)), root, f"s-{first}")


def keys(spark, root, *days):
    return sorted(int(r.zpid) for r in scan_archive(spark, root, *days, layout="lines").select("zpid").collect())


def texts(root, day=DAY):
    folder = f"{root}/{day:year=%Y/month=%m/day=%d}"
    from pathlib import Path

    return sorted(Path(folder).rglob("*.txt"))


def test_fewer_files_with_the_same_messages(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, 0, 100)
    put(spark, root, 100, 150)
    put(spark, root, 900, 920, NEXT)
    before = len(texts(root))
    assert compact_day(spark, root, DAY) == before - 1
    assert keys(spark, root, DAY) == list(range(150)) and keys(spark, root, DAY, NEXT) == [*range(150), *range(900, 920)]
    assert keys(spark, root) == [*range(150), *range(900, 920)], "the whole tree"
    assert compact_day(spark, root, DAY) == 0, "nothing to gain"
    put(spark, root, 150, 200)
    assert keys(spark, root, DAY) == list(range(200)), "what is added counts at once"
    assert compact_day(spark, root, DAY) > 0
    assert keys(spark, root, DAY) == list(range(200))
    assert remove_packed(spark, root, DAY, timedelta(hours=1)) == 0
    assert remove_packed(spark, root, DAY, timedelta(0)) == 4, "three small parts and the first packed one"
    assert len(texts(root)) == 1 and keys(spark, root, DAY) == list(range(200))
    assert compact_day(spark, root, NEXT, target_bytes=1) == 0


def test_files_have_the_target_size(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, 0, 4000, files=40)
    size = sum(f.stat().st_size for f in texts(root))
    compact_day(spark, root, DAY, target_bytes=size // 4)
    packed = [f for f in texts(root) if "part=packed-" in str(f)]
    assert 4 <= len(packed) <= 6 and max(f.stat().st_size for f in packed) <= size // 4 + 2000
    assert keys(spark, root, DAY) == list(range(4000))


def test_a_reader_at_any_moment_of_the_swap_sees_each_message_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, 0, 100)
    began = scan_archive(spark, root, DAY, layout="lines")
    seen = []
    real = compaction.write_new

    def swap(spark, path, text):
        seen.append(keys(spark, root, DAY))  # packed and small parts both lie there
        real(spark, path, text)
        seen.append(keys(spark, root, DAY))

    monkeypatch.setattr(compaction, "write_new", swap)
    compact_day(spark, root, DAY)
    assert seen == [list(range(100))] * 2
    assert began.count() == 100, "a reader that listed before keeps its files"
    assert keys(spark, root, DAY) == list(range(100))


def test_a_compaction_that_dies_leaves_the_day_as_it_is(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, 0, 50)
    monkeypatch.setattr(compaction, "write_new", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compact_day(spark, root, DAY)
    monkeypatch.undo()
    assert keys(spark, root, DAY) == keys(spark, root) == list(range(50))
    assert compact_day(spark, root, DAY) > 0 and keys(spark, root) == list(range(50))


def test_of_two_compactions_one_counts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, 0, 50)
    real = compaction.write_new

    def late(spark, path, text):
        monkeypatch.setattr(compaction, "write_new", real)
        assert compact_day(spark, root, DAY) > 0
        real(spark, path, text)

    monkeypatch.setattr(compaction, "write_new", late)
    with pytest.raises(FileConflictError):
        compact_day(spark, root, DAY)
    assert keys(spark, root, DAY) == list(range(50))


def test_batches_and_packed_days_share_a_root(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(30).select(F.lit(json.dumps({"zpid": "x"})).alias("value"))
    archive_batch(rows, root, F.lit(DAY))
    put(spark, root, 0, 20)
    compact_day(spark, root, DAY)
    assert scan_archive(spark, root, DAY, layout="lines").count() == 50
