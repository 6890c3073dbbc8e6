"""Places of many values, and totals stored in parts."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from hearthline.operators.stored_totals import StoredTotals
from hearthline.operators.wide_index import index_wide, wide_index
from hearthline.operators.windows import flatten_window, window_totals
from tests.conftest import plan

EVENT = "timestamp timestamp, city string, price double, livingArea int, zestimate int, bedrooms int"


def test_places_are_those_of_the_indexer(spark):
    draw = random.Random(1)
    values = [draw.choice("abcdefgh") * draw.randrange(1, 40) for _ in range(3000)] + ["hot"] * 2000 + [None] * 5
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, n int").repartition(6)
    index = wide_index(df, "v")
    got = {r.n: r.v_index for r in index_wide(df, "v", index).collect()}
    fitted = StringIndexer(inputCol="v", outputCol="v_index", handleInvalid="keep").fit(df)
    assert got == {r.n: r.v_index for r in fitted.transform(df).collect()}
    assert sorted(r["index"] for r in index.collect()) == list(range(len(set(values)) - 1))
    assert {r.v_index for r in index_wide(df.limit(3).withColumn("v", F.lit("unseen")), "v", index).collect()} == {float(index.count())}


def test_numbers_dates_and_nothing(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (2,), (None,)], "`a.b` int")
    index = wide_index(df, "a.b")
    assert sorted((r["a.b"], r["rows"], r["index"]) for r in index.collect()) == [(1, 1, 1), (2, 1, 2), (3, 2, 0)]
    assert sorted(r.place for r in index_wide(df, "a.b", index, "place").collect()) == [0, 0, 1, 2, 3]
    assert wide_index(df.limit(0), "a.b").count() == 0
    assert [r["a.b_index"] for r in index_wide(df.limit(1), "a.b", wide_index(df.limit(0), "a.b")).collect()] == [0.0]


def test_values_are_sorted_by_ranges_and_not_collected(spark, monkeypatch):
    df = spark.range(5000).select(F.sha1(F.col("id").cast("string")).alias("v"))
    written = []
    from hearthline.operators import wide_index as module

    monkeypatch.setattr(module, "materialize", lambda rows, name: written.append(plan(rows)) or rows)
    assert wide_index(df, "v").agg(F.max("index")).first()[0] == 4999
    assert "rangepartitioning" in written[0]


def events(spark, rows):
    shaped = [(t and f"2024-01-01 00:{t:02d}:30", c, p, a, z, b) for t, c, p, a, z, b in rows]
    raw = spark.createDataFrame(shaped, EVENT.replace("timestamp timestamp", "timestamp string"))
    return raw.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def totals(df):
    return sorted(((str(r[0]), *r[2:]) for r in flatten_window(df).collect()), key=str)


number = st.one_of(st.none(), st.integers(-5, 5))
row = st.tuples(st.one_of(st.none(), st.integers(1, 3)), st.sampled_from(["A", "B", None]), number, number, number, number)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.lists(row, max_size=8)), min_size=1, max_size=5))
def test_parts_of_loads_make_the_totals_of_their_rows(spark, tmp_path_factory, loads):
    stored, kept = StoredTotals(spark, str(tmp_path_factory.mktemp("totals"))), {}
    for load, rows in loads:
        rows = [(t, c, None if p is None else float(p), a, z, b) for t, c, p, a, z, b in rows]
        stored.put(str(load), events(spark, rows))
        kept[load] = rows
    everything = [r for rows in kept.values() for r in rows]
    wanted = totals(window_totals(events(spark, everything)))
    found = stored.read()
    assert (totals(found) if found is not None else []) == wanted
    assert stored.loads() == sorted(str(load) for load, rows in kept.items() if any(r[0] for r in rows))


def test_nothing_stored(spark, tmp_path):
    stored = StoredTotals(spark, str(tmp_path / "t"))
    assert stored.read() is None and stored.loads() == []


def test_a_load_touches_no_other(spark, tmp_path):
    stored = StoredTotals(spark, str(tmp_path / "t"))
    for load in ("2024-01-01", "2024-01-02"):
        stored.put(load, events(spark, [(1, "A", 2.0, 1, 1, 1)]))
    files = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("load=2024-01-01/*.parquet")}
    stored.put("2024-01-02", events(spark, [(1, "A", 4.0, 1, 1, 1), (2, "B", None, None, 1, 1)]))
    assert files == {f: f.stat().st_mtime_ns for f in tmp_path.rglob("load=2024-01-01/*.parquet")}
    assert [r[1:4] for r in totals(stored.read())] == [("A", 3.0, 2), ("B", None, None)]
    assert "partial_sum" in plan(stored.read())


@pytest.mark.parametrize("measures", [{"most": ("sum", "price")}, {"mean": ("avg", "price"), "price_sum": ("sum", "price")}])
def test_other_measures(spark, tmp_path, measures):
    stored = StoredTotals(spark, str(tmp_path / "t"), measures=measures)
    stored.put("1", events(spark, [(1, "A", 2.0, 1, 1, 1), (1, "A", 5.0, 1, 1, 1)]))
    expected = {"most": [7.0], "mean": [3.5, 7.0]}[next(iter(measures))]
    assert list(stored.read().drop("window", "city").first()) == expected
