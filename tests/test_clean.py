import pytest

from hearthline.operators.clean import clean_listings, fill_missing, with_price
from hearthline.schemas import curated_schema
from tests.conftest import plan


@pytest.fixture
def table(spark, tmp_path):
    full = ("1", "Encino", "CONDO", 5, 1.5, 1, 2, 3, True, True, "BUILDER_SPEC", True)
    rows = [
        full,
        ("2", *[None] * 2, 7, *[None] * 8),
        ("3", *full[1:3], None, *full[4:]),
        ("4", *full[1:3], 0, *full[4:]),
        ("5", *full[1:3], -1, *full[4:]),
    ]
    spark.createDataFrame(rows, curated_schema()).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_only_positive_prices_stay(table):
    assert sorted(r.zpid for r in with_price(table).collect()) == ["1", "2"]


def test_nulls_are_filled_by_kind(table):
    row = fill_missing(table).filter("zpid = '2'").first()
    assert tuple(row) == ("2", "UNKNOWN", "UNKNOWN", 7, 0.0, 0, 0, 0, False, False, "UNKNOWN", False)
    assert fill_missing(table).filter("zpid = '3'").first()["price"] is None


def test_price_filter_reaches_the_scan(table):
    assert "GreaterThan(price,0)" in plan(clean_listings(table))
