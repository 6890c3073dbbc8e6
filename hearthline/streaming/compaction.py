"""Compaction of the message archive: a day's small files become files of a target size.

The messages of small parts are copied to a part whose name begins with ``packed-``, and one
small file below ``_packed/<day>`` of the root says that it counts and the others no longer do. It
is renamed into place, so a reader sees every message once, before, during and after the
swap. ``scan_archive`` knows these files; ``remove_packed`` deletes replaced parts above an age.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hearthline.scratch import remove
from hearthline.sources.files import list_names, now_millis, write_new
from hearthline.sources.listing import list_files
from hearthline.sources.packed import LIVE_PREFIX, packed_state, state_folder

TARGET_BYTES = 128 << 20


def _day_folder(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/{day:year=%Y/month=%m/day=%d}"


def compact_day(spark: SparkSession, root: str, day: date, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the parts of a day whose files are small on average; how many files went into how many fewer.

    Parts that streams write meanwhile are left for the next time. Spark packs files into tasks of
    about ``target_bytes`` and each task writes one file: nothing is shuffled, and a large file is
    read by many tasks. A day with nothing to gain stays as it is.
    """
    version, live, dead = packed_state(spark, root, day)
    folder = _day_folder(root, day)
    part = F.regexp_extract("path", r"/part=([^/]+)/", 1)
    files = list_files(spark, folder).withColumn("part", part).filter((F.col("part") != "") & (F.col("length") > 0))
    if dead:
        files = files.filter(~F.col("part").isin(sorted(dead)))
    files = files.filter(~F.col("part").startswith(LIVE_PREFIX) | F.col("part").isin(sorted(live)))
    parts = files.groupBy("part").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    small = parts.filter(F.col("bytes") < F.col("files") * (target_bytes // 2)).orderBy("part").collect()
    before, size = sum(row["files"] for row in small), sum(row["bytes"] for row in small)
    after = -(-size // target_bytes)
    if before <= after:
        return 0
    name = f"{LIVE_PREFIX}{uuid.uuid4().hex}"
    packing = spark.newSession()  # its own sizes, the same tables
    for key, value in (("maxPartitionBytes", target_bytes), ("openCostInBytes", 0), ("minPartitionNum", 1)):
        packing.conf.set(f"spark.sql.files.{key}", str(value))
    lines = packing.read.text([f"{folder}/part={row['part']}" for row in small], recursiveFileLookup=True)
    lines.select("value").write.text(f"{folder}/part={name}")
    replaced = {row["part"] for row in small}
    state = {"live": sorted((live - replaced) | {name}), "dead": sorted(dead | replaced)}
    write_new(spark, f"{state_folder(root, day)}/{version + 1:010d}.json", json.dumps(state))
    return before - after


def remove_packed(spark: SparkSession, root: str, day: date, older_than: timedelta) -> int:
    """Delete the parts of a day that were replaced longer ago than an age; how many.

    The age must exceed that of the longest read.
    """
    version, live, dead = packed_state(spark, root, day)
    states = dict(list_names(spark, state_folder(root, day)))
    if not dead or states[f"{version:010d}.json"] > now_millis(spark) - older_than.total_seconds() * 1000:
        return 0
    folder = _day_folder(root, day)
    there = {name for name, _ in list_names(spark, folder)}
    gone = [part for part in sorted(dead) if f"part={part}" in there]
    for part in gone:
        remove(spark, f"{folder}/part={part}")
    # Their names stay in the file: a reader that began before may still ask for them.
    return len(gone)
