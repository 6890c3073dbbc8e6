"""Spark session with the settings every job here relies on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "hearthline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    packages: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.

    ``packages`` takes Maven coordinates of optional connectors (a Kafka source,
    a keyed store). ``shuffle_partitions`` also fixes the number of state
    partitions of a stream at its first start, so size it for the state, not for
    one micro-batch. Streaming state is kept in RocksDB: the default provider
    holds every window on the executor heap. Commits upload the changes only. A task
    that writes to a few date folders keeps their files open together; otherwise
    Spark sorts all its rows by folder first.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if packages:
        builder = builder.config("spark.jars.packages", ",".join(packages))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
