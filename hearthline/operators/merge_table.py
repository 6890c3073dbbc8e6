"""Keyed table that merges on read: an upsert writes its batch and nothing else.

Below the table's folder lie ``data/_part=<number>-<id>/_bucket=<n>/`` with Parquet files sorted by
key, and ``manifest/<version>.json``. The manifest with the highest version says which parts
count: the base, with one part for each bucket, and the deltas of the upserts since. It
is written aside and renamed, so a batch shows whole or not at all, and of two writers at a time
one fails. ``read`` takes the newest row of each key among base and deltas; ``compact`` writes
the buckets that deltas touch anew, and ``vacuum`` removes what no manifest of some age names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from hearthline.operators.latest import latest_per_key
from hearthline.scratch import no_rows, remove
from hearthline.sources.files import list_names, now_millis, read_text, write_new

PART, BUCKET = "_part", "_bucket"


@dataclass
class Manifest:
    version: int
    buckets: int
    base: dict[str, list[int]] = field(default_factory=dict)  # buckets of each part
    deltas: dict[str, list[int]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)  # last batch of each stream


class MergeTable:
    """One row per key: the one with the greatest ``order``, of equals that of the later upsert.

    Null in ``order`` is smaller than any value. ``buckets`` counts when the table is created.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        schema: StructType,
        buckets: int = 16,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)
        self.schema = StructType([StructField(f.name, f.dataType) for f in schema])
        self.buckets = buckets

    # --- manifest ---------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        names = (name for name, _ in list_names(self.spark, f"{self.path}/manifest"))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def manifest(self) -> Manifest:
        versions = self._versions()
        if not versions:
            return Manifest(0, self.buckets)
        return Manifest(**json.loads(read_text(self.spark, f"{self.path}/manifest/{versions[-1]:010d}.json")))

    def _commit(self, manifest: Manifest) -> None:
        manifest.version += 1
        write_new(self.spark, f"{self.path}/manifest/{manifest.version:010d}.json", json.dumps(asdict(manifest)))

    # --- reading ----------------------------------------------------------------------------

    def _scan(self, parts: dict[str, list[int]]) -> DataFrame:
        """Rows of parts with their part and bucket; only the folders of these buckets are read."""
        whole = StructType([*self.schema, StructField(PART, StringType()), StructField(BUCKET, IntegerType())])
        if not parts:
            return no_rows(self.spark, whole)
        folders = [f"{self.path}/data/{PART}={part}" for part in parts]
        rows = self.spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*folders)
        mine = ((F.col(PART) == part) & F.col(BUCKET).isin(buckets) for part, buckets in parts.items())
        return rows.filter(reduce(or_, mine))

    def _merged(self, manifest: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        """Current rows, with their bucket; buckets without a delta are passed on as they are."""
        parts = {**manifest.base, **manifest.deltas}
        if buckets is not None:
            wanted = set(buckets)
            parts = {part: kept for part, its in parts.items() if (kept := sorted(wanted.intersection(its)))}
        changed = {b for part, its in parts.items() if part in manifest.deltas for b in its}
        alike = {part: kept for part, its in parts.items() if part in manifest.base and (kept := sorted(set(its) - changed))}
        apart = {part: kept for part, its in parts.items() if (kept := sorted(changed.intersection(its)))}
        newest = latest_per_key(self._scan(apart), [*self.keys, BUCKET], [*self.order, PART])
        return self._scan(alike).unionByName(newest) if alike else newest

    def read(self) -> DataFrame:
        return self._merged(self.manifest()).select(*self._columns())

    def lookup(self, keys: DataFrame, max_keys: int = 10_000) -> DataFrame:
        """The rows of some keys: only their buckets' files are read, and of these only row groups that may hold them.

        ``keys`` has the key columns and ``max_keys`` distinct rows at most.
        """
        manifest = self.manifest()
        wanted = keys.select(*map(_quoted, self.keys)).dropna().distinct()
        found = wanted.withColumn(BUCKET, self._bucket(manifest.buckets)).limit(max_keys + 1).collect()
        if len(found) > max_keys:
            raise ValueError(f"more than {max_keys} keys; join with read() instead")
        rows = self._merged(manifest, sorted({row[BUCKET] for row in found}))
        for name in self.keys:  # pushed to the files; sorted, they tell which row groups to skip
            rows = rows.filter(_quoted(name).isin([row[name] for row in found]))
        if len(self.keys) > 1:
            rows = rows.join(wanted, self.keys, "left_semi")
        return rows.select(*self._columns())

    def _columns(self) -> list[Column]:
        return [_quoted(name) for name in self.schema.names]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*map(_quoted, self.keys)), F.lit(buckets)).cast("int")

    # --- writing ----------------------------------------------------------------------------

    def _write(self, rows: DataFrame, version: int, buckets: int) -> tuple[str, list[int]]:
        part = f"{version + 1:010d}-{uuid.uuid4().hex}"
        folder = f"{self.path}/data/{PART}={part}"
        # Adaptive execution makes few files of a small batch and splits a large bucket.
        bucketed = rows.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET)
        (
            bucketed.sortWithinPartitions(BUCKET, *map(_quoted, self.keys))
            .write.partitionBy(BUCKET)
            .parquet(folder)
        )
        prefix = f"{BUCKET}="
        written = (name for name, _ in list_names(self.spark, folder))
        return part, sorted(int(name[len(prefix) :]) for name in written if name.startswith(prefix))

    def upsert(self, batch: DataFrame, stream: str | None = None, number: int = 0) -> bool:
        """Add a batch; whether it was new.

        Rows with a null in the key are left out. With the name of a ``stream``, a batch whose
        ``number`` is not above the last one of that stream is a replay and changes nothing.
        The bytes written are those of the batch, whatever the table's size.
        """
        manifest = self.manifest()
        if stream is not None:
            if number <= manifest.batches.get(stream, -1):
                return False
            manifest.batches[stream] = number
        keyed = batch.dropna(subset=list(map(_name, self.keys)))
        newest = latest_per_key(keyed.select(*self._columns()), self.keys, self.order)
        part, buckets = self._write(newest, manifest.version, manifest.buckets)
        if buckets:
            manifest.deltas[part] = buckets
        if buckets or stream is not None:
            self._commit(manifest)
        return True

    def compact(self) -> list[int]:
        """Fold the deltas into the base; the buckets that were written anew."""
        manifest = self.manifest()
        touched = sorted({b for buckets in manifest.deltas.values() for b in buckets})
        if touched:
            merged = self._merged(manifest, touched).select(*self._columns())
            part, buckets = self._write(merged, manifest.version, manifest.buckets)
            left = {name: sorted(set(its) - set(touched)) for name, its in manifest.base.items()}
            manifest.base = {**{name: its for name, its in left.items() if its}, part: buckets}
            manifest.deltas = {}
            self._commit(manifest)
        return touched

    def vacuum(self, older_than: timedelta) -> int:
        """Remove parts and manifests above an age that no younger manifest names; how many parts went.

        Keep the age above that of the longest read or write, which may still need them.
        """
        limit = now_millis(self.spark) - older_than.total_seconds() * 1000
        versions = self._versions()
        times = dict(list_names(self.spark, f"{self.path}/manifest"))
        old = [v for v in versions[:-1] if times[f"{v:010d}.json"] <= limit]
        used = set()
        for version in sorted(set(versions) - set(old)):
            kept = json.loads(read_text(self.spark, f"{self.path}/manifest/{version:010d}.json"))
            used |= {f"{PART}={part}" for part in (*kept["base"], *kept["deltas"])}
        gone = 0
        for name, modified in list_names(self.spark, f"{self.path}/data"):
            if name not in used and modified <= limit:
                remove(self.spark, f"{self.path}/data/{name}")
                gone += 1
        for version in old:
            remove(self.spark, f"{self.path}/manifest/{version:010d}.json")
        return gone


def _name(column: str) -> str:
    return f"`{column}`"


def _quoted(column: str) -> Column:
    return F.col(_name(column))
