"""Which parts of an archive's days count after compaction."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from hearthline.sources.files import list_names, read_text

LIVE_PREFIX = "packed-"


def state_folder(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/_packed/{day:%Y-%m-%d}"


def packed_state(spark: SparkSession, root: str, day: date) -> tuple[int, set[str], set[str]]:
    """Version, and the names of the packed parts that count and of the parts that no longer do."""
    versions = [name for name, _ in list_names(spark, state_folder(root, day)) if name.endswith(".json") and name[0] != "."]
    if not versions:
        return 0, set(), set()
    found = json.loads(read_text(spark, f"{state_folder(root, day)}/{versions[-1]}"))
    return int(versions[-1][:-5]), set(found["live"]), set(found["dead"])


def packed_days(spark: SparkSession, root: str) -> list[date]:
    return [date.fromisoformat(name) for name, _ in list_names(spark, f"{root.rstrip('/')}/_packed")]


def counts(spark: SparkSession, root: str, days: Iterable[date], path: Column) -> Column:
    """Whether a file counts: one name for each replaced part is kept, a part being packed does not count yet."""
    live: set[str] = set()
    dead: set[str] = set()
    for day in days:
        _, now, gone = packed_state(spark, root, day)
        live, dead = live | now, dead | gone
    part = F.regexp_extract(path, r"/part=([^/]+)/", 1)
    stays = ~part.startswith(LIVE_PREFIX) & ~part.isin(sorted(dead))
    return stays | part.isin(sorted(live - dead))
