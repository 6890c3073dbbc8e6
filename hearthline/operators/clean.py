"""Clean the keyed table before training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from hearthline.schemas import CATEGORY_COLUMNS, NUMERIC_COLUMNS


def with_price(df: DataFrame, price: str = "price") -> DataFrame:
    """Rows whose price is known and positive."""
    return df.filter(F.col(price).isNotNull() & (F.col(price) > 0))


def fill_missing(
    df: DataFrame,
    categories: Sequence[str] = CATEGORY_COLUMNS,
    numerics: Sequence[str] = NUMERIC_COLUMNS,
    unknown: str = "UNKNOWN",
) -> DataFrame:
    """Null categories become ``unknown``, null numbers 0, null flags false."""
    flags = {f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)}
    fills: dict[str, str | int | bool] = {name: unknown for name in categories}
    fills |= {name: False if name in flags else 0 for name in numerics}
    return df.fillna(fills)


def clean_listings(
    df: DataFrame,
    price: str = "price",
    categories: Sequence[str] = CATEGORY_COLUMNS,
    numerics: Sequence[str] = NUMERIC_COLUMNS,
) -> DataFrame:
    """Filter, then fill: the price filter stays on a stored column and reaches the scan."""
    return fill_missing(with_price(df, price), categories, numerics)
