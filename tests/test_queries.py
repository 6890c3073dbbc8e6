"""Every registered query beside its SQL on the smallest given tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hearthline.plans import acceptance
from hearthline.plans.acceptance import QUERIES
from tests.conftest import plan

TABLES = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="given tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).values.tolist()

    def value(cell):
        missing = cell is None or (isinstance(cell, float) and math.isnan(cell))
        return "" if missing else str(cell)

    return columns, sorted([value(cell) for cell in row] for row in plain)


@pytest.mark.parametrize("name", list(QUERIES))  # tests/llm has its own for the rest
def test_query(spark, oracle, name):
    result = queries()[name](spark, str(TABLES))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert unwanted not in plan(result)
    got = result.toPandas()
    assert len(got)
    if name in oracle_sql():
        assert normal(got) == normal(oracle.execute(oracle_sql()[name]).df())


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_parts_of_the_restarted_streams_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    sf_dir, roots = str(tmp_path / "tables"), str(tmp_path / "scratch")
    spark.read.parquet(f"{TABLES}/events.parquet").repartition(4).write.parquet(f"{sf_dir}/events.parquet")
    monkeypatch.setattr(acceptance, "scratch_path", lambda spark, name: f"{roots}/{name}")
    # As if the small files were large: one task for each.
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        acceptance._restarted(spark, sf_dir, "complete", lambda batch, _: batch.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    parts = [len(list(Path(roots, "ordered", str(n)).glob("part-*"))) for n in range(4)]
    assert min(parts) > 1
    assert len(list(Path(roots, "source").glob("part-*"))) >= sum(parts)
