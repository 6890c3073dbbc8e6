import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hearthline.functions.event_time import date_parts, event_time
from hearthline.functions.formatting import money, thousands
from hearthline.functions.payload import decode_payload, encode_batches, encode_payload, parse_events
from hearthline.operators.curate import curate
from hearthline.schemas import WIRE_FIELDS, curated_schema, wire_schema


def messages(spark, *texts):
    return spark.createDataFrame([(t.encode(),) for t in texts], "value binary")


def one(spark, text, **options):
    return parse_events(messages(spark, text), **options).first()


def test_epoch_unit_is_explicit(spark):
    assert one(spark, '{"timestamp": 1763174687104}')["timestamp"] == datetime(
        2025, 11, 15, 2, 44, 47, 104000
    )
    assert one(spark, '{"timestamp": 1763174687}', unit="s")["timestamp"] == datetime(
        2025, 11, 15, 2, 44, 47
    )
    millis_as_seconds = parse_events(messages(spark, '{"timestamp": 1763174687104}'), unit="s")
    assert millis_as_seconds.select(F.year("timestamp")).first()[0] == 57842


def test_fractional_event_time_only_when_asked(spark):
    text = '{"timestamp": 1763174687104.5}'
    assert one(spark, text)["timestamp"] is None
    assert one(spark, text, fractional=True)["timestamp"] == datetime(2025, 11, 15, 2, 44, 47, 104000)


def test_bad_messages_become_nulls_and_good_fields_stay(spark):
    assert set(one(spark, "not json").asDict().values()) == {None}
    row = one(spark, '{"zpid": 336424216, "price": "xx", "bedrooms": 99999999999, "x": 9}')
    assert row["zpid"] == "336424216"
    assert row["price"] is None and row["bedrooms"] is None
    assert len(row) == len(WIRE_FIELDS) == 44


@pytest.mark.parametrize("unit", ["ms", "s"])
def test_absurd_event_times_are_null(spark, unit):
    times = [2**63 - 1, -(2**63), 10**17, None, 0, 1_000_000_000]
    rows = spark.createDataFrame([(t,) for t in times], "t long").select(event_time(F.col("t"), unit).alias("t"))
    assert [r.t is None for r in rows.collect()] == [True] * 4 + [False] * 2
    fractions = spark.createDataFrame([(float("nan"),), (float("inf"),), (1e300,), (1.5,)], "t double")
    rows = fractions.select(event_time(F.col("t"), unit).alias("t")).collect()
    assert [r.t is None for r in rows] == [True] * 3 + [False]


def test_dotted_names_survive_to_the_curated_table(spark):
    text = '{"zpid": 1, "listingSubType.is_newHome": true, "homeType": "CONDO"}'
    row = curate(decode_payload(messages(spark, text), wire_schema())).first()
    assert row["listingsubtype_is_newhome"] is True and row["hometype"] == "CONDO"
    assert list(row.asDict()) == curated_schema().names


def test_only_named_fields_are_decoded_and_once(spark):
    df = parse_events(messages(spark, '{"city": "Encino"}'), ("timestamp", "city")).filter(
        "timestamp is not null"
    )
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1 and "brokerName" not in text


def test_event_time_need_not_be_among_the_fields(spark):
    assert parse_events(messages(spark, '{"city": "Encino"}'), ("city",)).first()["city"] == "Encino"


def test_encode_writes_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(df.select(encode_payload("a", "b")).first()[0]) == {"a": 1, "b": None}


def test_batches_hold_every_message_once_and_never_too_many(spark):
    df = spark.range(0, 95, 1, 3).select(encode_payload("id").alias("value"))
    batches = [json.loads(row.value) for row in encode_batches(df, 10).collect()]
    assert max(map(len, batches)) <= 10
    assert sorted(r["id"] for batch in batches for r in batch) == list(range(95))


def test_date_parts_are_padded(spark):
    df = spark.sql("SELECT timestamp '2025-01-05 23:59:59' AS t").select(*date_parts(F.col("t")))
    assert df.first().asDict() == {"year": "2025", "month": "01", "day": "05"}


def test_formatting(spark):
    df = spark.sql("SELECT 1234567.5D AS x").select(money(F.col("x")), thousands(F.lit(1234567)))
    assert tuple(df.first()) == ("$1,234,567.50", "1,234,567")
