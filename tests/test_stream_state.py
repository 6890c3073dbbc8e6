"""Open windows, watermarks of batches, and late rows."""

import json

import pytest
from pyspark.sql import functions as F

from hearthline.functions.payload import parse_events
from hearthline.operators.windows import flatten_window, window_totals
from hearthline.sources.events import event_stream
from hearthline.streaming.late import is_late, read_batches, split_late
from hearthline.streaming.queries import city_totals, drain, start_query
from hearthline.streaming.state import batch_watermark, open_windows

MINUTE = 60_000
BASE = 1763174640000  # 2025-11-15 02:44:00 UTC
ONCE = {"availableNow": True}


def put(folder, name, *events):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"timestamp": None if m is None else BASE + int(m * MINUTE), "city": city, "price": price, "livingArea": area, "zestimate": 2, "bedrooms": 1})
        for m, city, price, area in events
    ]
    (folder / name).write_text("\n".join(lines))


def minutes(rows):
    return sorted(((r.window_start.timestamp() * 1000 - BASE) / MINUTE, r.city, r.average_price, r.total_living_area, r.average_zestimate) for r in rows)


def test_open_windows_are_those_that_append_has_not_given(spark, tmp_path):
    source, checkpoint, out = tmp_path / "in", str(tmp_path / "c"), str(tmp_path / "out")

    def run():
        totals = flatten_window(city_totals(event_stream(spark, "text", path=str(source))))
        drain(start_query(totals, checkpoint, "parquet", "append", ONCE, {"path": out}))

    put(source, "1", (0, "A", 10, 1), (0.5, "A", 20, None), (0.5, "B", None, 3), (2.5, "A", 5, 5))
    run()
    assert minutes(spark.read.parquet(out).collect()) == [(0, "A", 15.0, 1, 2.0), (0, "B", None, 3, 2.0)]
    assert minutes(open_windows(spark, checkpoint).collect()) == [(2, "A", 5.0, 5, 2.0)]
    put(source, "2", (2.75, "A", 7, 1), (3.1, "C", 1, 1))
    run()
    assert minutes(open_windows(spark, checkpoint).collect()) == [(2, "A", 6.0, 6, 2.0), (3, "C", 1.0, 1, 2.0)]
    given_and_open = spark.read.parquet(out).unionByName(open_windows(spark, checkpoint))
    everything = window_totals(parse_events(spark.read.text(str(source))))
    assert minutes(given_and_open.collect()) == minutes(flatten_window(everything).collect())
    assert minutes(open_windows(spark, checkpoint, batch=1).collect()) == [(2, "A", 5.0, 5, 2.0)], "an earlier batch"
    with pytest.raises(ValueError, match="the state holds"):
        open_windows(spark, checkpoint, measures={"one": ("sum", "price")})


def split(spark, source, tmp_path):
    events = parse_events(event_stream(spark, "text", path=str(source)))
    drain(split_late(events, str(tmp_path / "on"), str(tmp_path / "late"), str(tmp_path / "c"), trigger=ONCE))
    return [sorted(r.price for r in read_batches(spark, str(tmp_path / part)).collect()) for part in ("on", "late")]


def test_rows_behind_the_watermark_go_aside(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1", (0, "A", 1, 1), (9, "A", 2, 1), (0.2, "A", 3, 1), (None, "A", 4, 1))
    assert split(spark, source, tmp_path) == [[1, 2, 3, 4], []], "rows of one batch are not late by each other"
    assert batch_watermark(spark, str(tmp_path / "c"), 0) == 0
    # The watermark is at minute 8: the window of minute 7 has ended, that of minute 8 has not.
    put(source, "2", (7.9, "A", 5, 1), (8, "A", 6, 1), (0, "B", 7, 1), (None, "B", 8, 1), (20, "A", 9, 1))
    assert split(spark, source, tmp_path) == [[1, 2, 3, 4, 6, 8, 9], [5, 7]]
    assert batch_watermark(spark, str(tmp_path / "c"), 1) == BASE + 8 * MINUTE
    with pytest.raises(FileNotFoundError):
        batch_watermark(spark, str(tmp_path / "c"), 99)


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    source, commits = tmp_path / "in", tmp_path / "c" / "commits"
    put(source, "1", (9, "A", 1, 1))
    split(spark, source, tmp_path)
    put(source, "2", (0, "A", 2, 1), (9, "A", 3, 1))
    first = split(spark, source, tmp_path)
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink()
    assert split(spark, source, tmp_path) == first == [[1, 3], [2]]


def test_on_time_rows_are_those_that_append_counts(spark, tmp_path):
    """Through the same batches, the append stream and the split agree on what is late."""
    source = tmp_path / "in"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "append")
    batches = [[(0, "A", 1, 1), (5, "A", 2, 1)], [(3.5, "A", 3, 1), (4.5, "A", 4, 1), (12, "B", 5, 1)], [(4, "A", 6, 1), (30, "A", 7, 1)]]
    for n, events in enumerate(batches):
        put(source, str(n), *events)
        totals = flatten_window(city_totals(event_stream(spark, "text", path=str(source))))
        drain(start_query(totals, checkpoint, "parquet", "append", ONCE, {"path": out}))
        split(spark, source, tmp_path)
    counted = spark.read.parquet(out).unionByName(open_windows(spark, checkpoint))
    on_time = flatten_window(window_totals(read_batches(spark, str(tmp_path / "on"))))
    assert minutes(counted.collect()) == minutes(on_time.collect())


def test_when_a_window_is_closed(spark):
    rows = spark.createDataFrame([(0,), (59_999,), (60_000,), (None,)], "ms long").select(F.timestamp_millis("ms").alias("t"))
    assert [r[0] for r in rows.select(is_late(F.col("t"), 60_000)).collect()] == [True, True, False, False]
    assert [r[0] for r in rows.select(is_late(F.col("t"), 59_999)).collect()] == [False, False, False, False]
