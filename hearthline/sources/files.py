"""Small files by any file system that Spark's Hadoop configuration knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


class FileConflictError(RuntimeError):
    """Another writer has taken the name."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file; None if there is none."""
    files = _system(spark, path)
    if not files.exists(_path(spark, path)):
        return None
    stream = files.open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    stream = _system(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Put a file there whole, or raise ``FileConflictError`` if there is one."""
    folder, _, name = path.rpartition("/")
    jvm = spark._jvm
    temporary = f"{folder}/.{name}.{jvm.java.util.UUID.randomUUID().toString()}"
    write_bytes(spark, temporary, text.encode())
    qualified = _system(spark, path).makeQualified(_path(spark, path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, temporary), qualified, no_options)
    except Exception as error:  # noqa: BLE001  py4j wraps what Java throws
        if "already exists" not in str(error):
            raise
        _system(spark, path).delete(_path(spark, temporary), False)
        raise FileConflictError(path) from error


def list_names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names in a folder and their modification times in milliseconds; none if it is not there."""
    files = _system(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(_path(spark, folder)))


def now_millis(spark: SparkSession) -> int:
    return spark._jvm.java.lang.System.currentTimeMillis()
