"""Presentation of numbers in printed reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(column: Column) -> Column:
    """``1234.5`` to ``$1,234.50``; null stays null."""
    return F.concat(F.lit("$"), F.format_number(column, 2))


def thousands(column: Column) -> Column:
    """``1234567`` to ``1,234,567``."""
    return F.format_number(column, 0)
