import pytest

from hearthline.operators.readiness import readiness, table_readiness
from hearthline.operators.reports import group_report, overall_statistics, row_count, table_sample
from tests.conftest import plan


@pytest.mark.parametrize(
    ("rows", "status", "ok"),
    [
        (0, "NO DATA", False),
        (1, "NOT ENOUGH DATA", False),
        (99, "NOT ENOUGH DATA", False),
        (100, "MINIMAL DATA", True),
        (499, "MINIMAL DATA", True),
        (500, "READY", True),
    ],
)
def test_readiness_edges(spark, rows, status, ok):
    assert tuple(readiness(spark.range(rows)).first()) == (rows, status, ok)


def test_readiness_of_a_table(spark):
    assert table_readiness(spark, "nowhere", "t") == (False, "namespace nowhere does not exist")
    assert table_readiness(spark, "default", "t")[1] == "table default.t does not exist"
    spark.range(1234).write.saveAsTable("ready")
    assert table_readiness(spark, "default", "ready") == (True, "1,234 rows: READY")


def test_averages_skip_nulls_and_counts_do_not(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 4.0)], "price long, prediction double")
    assert tuple(overall_statistics(df).first()) == (2, 1.0, 3.0, 2.0, 4.0)
    assert row_count(df).first()["row_count"] == 2


def test_groups_come_by_prediction_then_name(spark):
    df = spark.createDataFrame(
        [("b", 1, 5.0), ("a", 1, 5.0), ("c", 1, 9.0), ("d", 1, 1.0)],
        "city string, price long, prediction double",
    )
    report = group_report(df, "city", limit=3)
    assert [r.city for r in report.collect()] == ["c", "a", "b"]
    text = plan(report)
    assert "TakeOrderedAndProject" in text and "partial_avg" in text


def test_table_sample_is_fixed(spark):
    df = spark.range(100).selectExpr("id AS zpid", "id AS v").repartition(7)
    assert [r.v for r in table_sample(df, ["v"]).collect()] == [0, 1, 2, 3, 4]
