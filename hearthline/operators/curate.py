"""Wire records to the curated listing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.schemas import CURATED_FROM_WIRE


def curate(
    df: DataFrame,
    columns: Mapping[str, str] = CURATED_FROM_WIRE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Select and rename in one projection.

    ``columns`` maps new names to old ones (old names may contain dots). ``keep``
    carries further columns along unchanged, such as those that order an upsert.
    """
    renamed = [F.col(f"`{old}`").alias(new) for new, old in columns.items()]
    return df.select(*renamed, *(F.col(f"`{name}`") for name in keep))
