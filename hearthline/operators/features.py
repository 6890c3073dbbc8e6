"""Features for the price model: category index, one-hot vectors, one assembled vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.schemas import CATEGORY_COLUMNS, NUMERIC_COLUMNS

def require_bounded_categories(df: DataFrame, categories: Sequence[str], limit: int) -> None:
    """Refuse columns with more than ``limit`` values (by estimate) to be categories.

    An indexer keeps every value on the driver and in every task, and one-hot features
    are as wide as the number of values, so a job may want to know before it fits.
    """
    counts = df.agg(*(F.approx_count_distinct(c).alias(c) for c in categories)).first()
    wide = {c: counts[c] for c in categories if counts[c] > limit}
    if wide:
        raise ValueError(f"too many distinct values for categories (limit {limit}): {wide}")


def category_indexer(categories: Sequence[str] = CATEGORY_COLUMNS) -> StringIndexer:
    """Most frequent value first, ties by value; unseen values share one further index."""
    return StringIndexer(
        inputCols=list(categories),
        outputCols=[f"{c}_index" for c in categories],
        handleInvalid="keep",
    )


def one_hot_encoder(categories: Sequence[str] = CATEGORY_COLUMNS) -> OneHotEncoder:
    """Vectors one wider than the number of values in the fit."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in categories],
        outputCols=[f"{c}_vec" for c in categories],
        handleInvalid="keep",
    )


def feature_assembler(
    categories: Sequence[str] = CATEGORY_COLUMNS,
    numerics: Sequence[str] = NUMERIC_COLUMNS,
    output: str = "features",
) -> VectorAssembler:
    """One-hot vectors, then numbers and flags."""
    return VectorAssembler(
        inputCols=[*(f"{c}_vec" for c in categories), *numerics],
        outputCol=output,
        handleInvalid="keep",
    )


def feature_stages(
    categories: Sequence[str] = CATEGORY_COLUMNS, numerics: Sequence[str] = NUMERIC_COLUMNS
) -> list:
    return [
        category_indexer(categories),
        one_hot_encoder(categories),
        feature_assembler(categories, numerics),
    ]
