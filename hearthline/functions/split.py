"""Train and hold-out splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int = 10) -> Column:
    """Bucket of a key from the first 16 bits of its MD5: same on every engine and layout."""
    prefix = F.substring(F.md5(key.cast("string")), 1, 4)
    return F.conv(prefix, 16, 10).cast("int") % buckets


def in_train(key: Column, tenths: int = 8) -> Column:
    """Whether a key belongs to the training part. A null key has no bucket and does not."""
    return F.coalesce(hash_bucket(key) < tenths, F.lit(False))


def split_by_key(df: DataFrame, key: str, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Repeatable split that depends on the key only, not on partitioning or file order."""
    chosen = in_train(F.col(key), tenths)
    return df.filter(chosen), df.filter(~chosen)


def split_at_random(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split; its members change with the partitioning of ``df``."""
    left, right = df.randomSplit([train, 1 - train], seed)
    return left, right
