"""Keyed upsert on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, nulls in it included.

    Equal ``order`` falls to the remaining columns, as far as they can be ordered, so the
    winner does not depend on the order of rows.
    An aggregate, so it also runs before the shuffle: each task sends at most one
    row per key and a hot key cannot flood one task. ``row_number() = 1`` gets the
    same treatment but sorts by key and order where this sorts by key alone; it
    measured about a fifth slower.
    """
    rest = [name for name in df.columns if name not in keys]
    ties = [f.name for f in df.schema if f.name in rest and f.name not in order and _orderable(f.dataType)]
    rank = F.struct(*map(_quoted, [*order, *ties]))
    newest = F.max_by(F.struct(*map(_quoted, rest)), rank)
    return (
        df.groupBy(*map(_quoted, keys))
        .agg(newest.alias("_newest"))
        .select(*(_quoted(n) if n in keys else F.col(f"_newest.`{n}`").alias(n) for n in df.columns))
    )


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, MapType | VariantType)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def merge_latest(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], newer: Sequence[str] = ()
) -> DataFrame:
    """``new`` over ``existing``, both with unique keys; a new row replaces an old one whole.

    With ``newer`` it does so only if these columns are not smaller than the old row's.
    One full outer join on the key instead of a union and a second ranking; unique keys
    leave nothing to skew. Keys must not be null: a null is equal to nothing.
    """
    marked = new.select(*existing.columns, F.lit(True).alias("_is_new"))
    old, fresh = existing.alias("old"), marked.alias("fresh")
    same_key = reduce(and_, (F.col(f"old.{k}") == F.col(f"fresh.{k}") for k in keys))
    replaces = F.col("fresh._is_new")
    if newer:
        old_rank, new_rank = (F.struct(*(F.col(f"{side}.{c}") for c in newer)) for side in ("old", "fresh"))
        replaces = replaces & (F.col(f"old.{keys[0]}").isNull() | (new_rank >= old_rank))
    return old.join(fresh, same_key, "full_outer").select(
        *(
            F.when(replaces, F.col(f"fresh.{name}"))
            .otherwise(F.col(f"old.{name}"))
            .alias(name)
            for name in existing.columns
        )
    )
