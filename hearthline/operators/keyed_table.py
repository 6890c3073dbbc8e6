"""Keyed table in the catalog, partitioned by hash buckets of the key.

Parquet has no row-level update. An upsert writes new files for the buckets that the batch
touches and then points those partitions at them; the other buckets' files stay as they
are, so the cost follows the batch's spread and not the table. Readers of a replaced bucket
keep its old files until ``vacuum`` removes those older than an age. A job that dies
half-way has replaced some buckets or none; repeating the batch finishes it. A connector
to a store with its own upsert is used through ``append_to_store`` instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.operators.latest import latest_per_key, merge_latest
from hearthline.schemas import KEY, curated_schema
from hearthline.scratch import drop, materialize

BUCKET = "_bucket"


def namespace_exists(spark: SparkSession, namespace: str) -> bool:
    return spark.catalog.databaseExists(namespace)


def table_exists(spark: SparkSession, namespace: str, table: str) -> bool:
    return namespace_exists(spark, namespace) and spark.catalog.tableExists(f"{namespace}.{table}")


class KeyedTable:
    """One row per key, later writes replace earlier ones.

    ``newer`` names columns of the schema that a replacing row must not have smaller; with
    it an older batch that is loaded late changes nothing that is newer.
    """

    def __init__(
        self,
        spark: SparkSession,
        namespace: str,
        name: str,
        keys: Sequence[str] = (KEY,),
        schema: StructType | None = None,
        buckets: int | None = None,
        location: str | None = None,
        newer: Sequence[str] = (),
    ):
        self.spark = spark
        self.namespace = namespace
        self.name = name
        self.keys = list(keys)
        self.schema = schema or curated_schema()
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.location = location
        self.newer = list(newer)
        self.table = f"`{namespace}`.`{name}`"

    def ensure(self) -> KeyedTable:
        """Create namespace and table if they are not there. An existing table keeps its buckets."""
        where = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`{where}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, `{BUCKET}` int) USING parquet "
            f"PARTITIONED BY (`{BUCKET}`) TBLPROPERTIES ('buckets' = '{self.buckets}')"
        )
        kept = self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('buckets')").first()["value"]
        self.buckets = int(kept)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*(F.col(f"`{c}`") for c in self.schema.names))

    def lookup(self, keys: DataFrame, max_keys: int = 10_000) -> DataFrame:
        """The rows of some keys: ``max_keys`` distinct ones at most, with the table's key columns.

        Only their buckets' partitions are listed and read, and of these only row groups that
        may hold them, as a bucket's files are sorted by key.
        """
        names = [f"`{k}`" for k in self.keys]
        wanted = keys.select(*names).dropna().distinct()
        found = wanted.withColumn(BUCKET, self._bucket()).limit(max_keys + 1).collect()
        if len(found) > max_keys:
            raise ValueError(f"more than {max_keys} keys; join with read() instead")
        rows = self.spark.table(self.table).filter(F.col(BUCKET).isin(sorted({row[BUCKET] for row in found})))
        for key, name in zip(self.keys, names, strict=True):
            rows = rows.filter(F.col(name).isin([row[key] for row in found]))
        if len(names) > 1:
            rows = rows.join(wanted, self.keys, "left_semi")
        return rows.select(*(F.col(f"`{c}`") for c in self.schema.names))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in self.keys)), F.lit(self.buckets)).cast("int")

    def upsert(self, batch: DataFrame, order: Sequence[str]) -> None:
        """Merge a batch; within it the row with the greatest ``order`` wins.

        Rows with a null in the key can't be told apart and are left out (a scan marks them as
        rejected). Merging the same batch again gives the same table, so a replay is harmless.
        One writer at a time. The driver handles one number for each touched bucket.
        """
        keyed = batch.dropna(subset=[f"`{k}`" for k in self.keys])
        newest = latest_per_key(keyed, self.keys, order).select(*self.schema.names)
        # Written first: a micro-batch is then read once, and the join knows its size.
        new = materialize(newest.withColumn(BUCKET, self._bucket()), "upsert-batch")
        touched = sorted(row[0] for row in new.select(BUCKET).distinct().collect())
        if touched:
            old = self.spark.table(self.table).filter(F.col(BUCKET).isin(touched))
            merged = merge_latest(old.drop(BUCKET), new.drop(BUCKET), self.keys, self.newer)
            self._replace(merged.withColumn(BUCKET, self._bucket()), touched)
        drop(new)

    def _versions(self) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}")
        location = described.filter("col_name = 'Location'").first()["data_type"]
        return f"{location.rstrip('/')}/versions"

    def _replace(self, content: DataFrame, buckets: Sequence[int]) -> None:
        folder = f"{self._versions()}/{uuid.uuid4().hex}"
        (
            content.repartition(len(buckets), BUCKET)
            .sortWithinPartitions(BUCKET, *(f"`{k}`" for k in self.keys))
            .write.partitionBy(BUCKET)
            .parquet(folder)
        )
        parts = {b: (f"PARTITION (`{BUCKET}` = {b})", f"LOCATION '{folder}/{BUCKET}={b}'") for b in buckets}
        known = {int(row[0].split("=")[1]) for row in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}
        added = [" ".join(parts[b]) for b in buckets if b not in known]
        if added:  # one statement for all new ones
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(added)}")
        for bucket in known.intersection(buckets):
            which, where = parts[bucket]
            self.spark.sql(f"ALTER TABLE {self.table} {which} SET {where}")
        self.spark.catalog.refreshTable(self.table)

    def vacuum(self, older_than: timedelta) -> int:
        """Remove replaced files older than an age that no reader needs any more; how many versions went."""
        used = {name.split("/")[-3] for name in self.spark.table(self.table).inputFiles()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._versions())
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return 0
        limit = self.spark._jvm.java.lang.System.currentTimeMillis() - older_than.total_seconds() * 1000
        gone = 0
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if name not in used and status.getModificationTime() <= limit:
                gone += bool(files.delete(status.getPath(), True))
        return gone


def append_to_store(df: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Append through a connector whose store replaces rows by primary key itself.

    Give it one row per key (``latest_per_key``): rows of one write arrive in no order.
    """
    df.write.format(fmt).mode("append").options(**options).save()
