"""Reports on predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.schemas import KEY

# Columns of the prediction sample before the two prices.
SAMPLE_COLUMNS = ("zpid", "city", "hometype", "bedrooms", "bathrooms", "livingarea")

# Columns of the table sample.
TABLE_SAMPLE_COLUMNS = ("city", "price", "bedrooms", "bathrooms", "livingarea", "hometype")


def overall_statistics(
    df: DataFrame, actual: str = "price", predicted: str = "prediction"
) -> DataFrame:
    """One row: total, averages of both prices, range of the predictions."""
    return df.agg(
        F.count("*").alias("total"),
        F.avg(actual).alias("avg_actual"),
        F.avg(predicted).alias("avg_predicted"),
        F.min(predicted).alias("min_predicted"),
        F.max(predicted).alias("max_predicted"),
    )


def group_report(
    df: DataFrame,
    group: str,
    actual: str = "price",
    predicted: str = "prediction",
    limit: int = 20,
) -> DataFrame:
    """Groups with the highest average prediction first; equal averages by group."""
    return (
        df.groupBy(group)
        .agg(
            F.count("*").alias("count"),
            F.avg(actual).alias("avg_actual"),
            F.avg(predicted).alias("avg_predicted"),
        )
        .orderBy(F.desc("avg_predicted"), F.asc(group))
        .limit(limit)
    )


def report_by_city(df: DataFrame, **columns: str) -> DataFrame:
    return group_report(df, "city", **columns)


def report_by_home_type(df: DataFrame, **columns: str) -> DataFrame:
    return group_report(df, "hometype", **columns)


def prediction_sample(
    df: DataFrame,
    columns: Sequence[str] = SAMPLE_COLUMNS,
    actual: str = "price",
    predicted: str = "prediction",
    order: Sequence[str] = (KEY,),
    limit: int = 20,
) -> DataFrame:
    """Actual beside predicted price for the first rows by key."""
    prices: list[Column] = [
        F.col(actual).alias("actual_price"),
        F.col(predicted).alias("predicted_price"),
    ]
    return df.orderBy(*order).limit(limit).select(*columns, *prices)


def table_sample(
    df: DataFrame,
    columns: Sequence[str] = TABLE_SAMPLE_COLUMNS,
    order: Sequence[str] = (KEY,),
    limit: int = 5,
) -> DataFrame:
    """A few rows of the keyed table, the first by key."""
    return df.orderBy(*order).limit(limit).select(*columns)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
