"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}
#: Spark's own setting that lets the shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Below spark.checkpoint.dir. Without that setting only a local master, as in tests, goes on. Removed when the driver's Python ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
            root = "file:///tmp/checkpoints"
        _folders[app] = f"{root.rstrip('/')}/weftmatch-tables-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM is gone
        return


def drop(df: DataFrame) -> None:
    """Removes a stored table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        if "/weftmatch-tables-" in file:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read again: both sides of a self-join then read one table, and a lost executor costs a file read."""
    spark = df.sparkSession
    path, before = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}", spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # nothing reads the shuffles of the write after it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
