import threading
import json
from datetime import datetime

import pytest

from hearthline.operators.windows import flatten_window
from hearthline.sources.events import event_stream, kafka_options
from hearthline.streaming.queries import await_any, city_totals, drain, start_query
from tests.conftest import plan

MINUTE = 60_000
BASE = 1763174640000  # 2025-11-15 02:44:00 UTC


def message(minute, price, city="Encino", millis=0, **fields):
    record = {"timestamp": BASE + minute * MINUTE + millis, "city": city, "price": price}
    return json.dumps({**record, "livingArea": 10, "zestimate": price * 2, "bedrooms": 3, **fields})


def batch(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(df):
    return sorted(map(tuple, flatten_window(df).collect()))


def test_totals_per_minute_and_city(spark):
    totals = city_totals(
        batch(
            spark,
            message(0, 100),
            message(0, 200, millis=59_999),
            message(1, 400),
            message(0, 500, "Glendale", livingArea=None),
            "not json",
            '{"city": "Encino", "price": 1}',
        )
    )
    assert totals.columns == [
        "window",
        "city",
        "average_price",
        "total_living_area",
        "average_zestimate",
        "total_bedrooms",
    ]
    at = [datetime(2025, 11, 15, 2, 44 + n) for n in range(3)]
    assert rows(totals) == [
        (at[0], at[1], "Encino", 150.0, 20, 300.0, 6),
        (at[0], at[1], "Glendale", 500.0, None, 1000.0, 3),
        (at[1], at[2], "Encino", 400.0, 10, 800.0, 3),
    ]


def test_aggregates_partially_before_the_shuffle_and_decodes_once(spark):
    text = plan(city_totals(batch(spark, message(0, 1))))
    assert "partial_avg" in text and "partial_sum" in text
    assert text.count("from_json") <= 2  # once as an operator, at most once in a column list


def test_stream_equals_batch(spark, tmp_path):
    texts = [message(n % 7, n + 1, "ABC"[n % 3]) for n in range(60)]
    batch(spark, *texts).repartition(6).write.text(str(tmp_path / "in"))
    stream = event_stream(spark, "text", path=str(tmp_path / "in"), max_files_per_trigger=2)
    query = start_query(
        city_totals(stream),
        str(tmp_path / "checkpoint"),
        "memory",
        trigger={"availableNow": True},
        name="stream_equals_batch",
    )
    drain(query)
    assert rows(spark.table("stream_equals_batch")) == rows(city_totals(batch(spark, *texts)))


@pytest.mark.parametrize(
    ("mode", "gap", "kept"),
    [("complete", 2, True), ("update", 2, False), ("append", 2, False), ("update", 1, True)],
)
def test_late_rows(spark, tmp_path, mode, gap, kept):
    """A row five minutes late, ``gap`` micro-batches after the watermark passed it.

    A micro-batch filters by the watermark of the one before, so one batch later it still counts
    (unless a batch without data came between, which Spark runs to close windows: off here).
    """
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    source = str(tmp_path / "in")
    name = f"late_{mode}_{gap}"

    def send(*texts):
        batch(spark, *texts).coalesce(1).write.mode("append").text(source)

    send(message(0, 100), message(10, 1))
    query = start_query(
        city_totals(event_stream(spark, "text", path=source)),
        str(tmp_path / "checkpoint"),
        "memory",
        mode,
        name=name,
    )
    dropped = 0
    try:
        query.processAllAvailable()
        if gap == 2:
            send(message(11, 1))
            query.processAllAvailable()
        send(message(5, 900))
        query.processAllAvailable()
        send(message(20, 1))
        query.processAllAvailable()
        for progress in query.recentProgress:
            dropped += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    seen = any(row.average_price == 900 for row in spark.table(name).collect())
    assert seen is kept
    assert (dropped > 0) is not kept


def test_console_sink_runs(spark, tmp_path):
    batch(spark, message(0, 100)).write.text(str(tmp_path / "in"))
    stream = event_stream(spark, "text", path=str(tmp_path / "in"))
    query = start_query(city_totals(stream), str(tmp_path / "c"), trigger={"availableNow": True})
    progress = drain(query).lastProgress
    assert "Console" in progress.sink.description and progress.numInputRows == 1


def test_await_any_stops_the_rest_and_raises_the_failure(spark, tmp_path):
    (tmp_path / "in").mkdir()
    idle = start_query(
        city_totals(event_stream(spark, "text", path=str(tmp_path / "in"))),
        str(tmp_path / "c1"),
        "noop",
        "update",
    )
    batch(spark, message(0, 100)).write.text(str(tmp_path / "in2"))
    done = start_query(
        city_totals(event_stream(spark, "text", path=str(tmp_path / "in2"))),
        str(tmp_path / "c2"),
        "noop",
        "update",
        trigger={"availableNow": True},
    )
    await_any([idle, done])
    assert not idle.isActive and not done.isActive


def test_await_any_does_not_mind_queries_that_ended_before(spark, tmp_path):
    batch(spark, message(0, 100)).write.text(str(tmp_path / "in"))

    def start(name, trigger=None):
        stream = event_stream(spark, "text", path=str(tmp_path / "in"))
        return start_query(city_totals(stream), str(tmp_path / name), "noop", "update", trigger=trigger)

    drain(start("ended", {"availableNow": True}))
    running = start("running")
    waiting = threading.Thread(target=await_any, args=([running], 0.1))
    waiting.start()
    waiting.join(2)
    assert waiting.is_alive() and running.isActive
    running.stop()
    waiting.join(20)
    assert not waiting.is_alive()


def test_kafka_options():
    assert kafka_options("a:1,b:2", "t", 500) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "500",
    }
