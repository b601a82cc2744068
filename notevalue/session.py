"""Session settings, lineage cuts and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "notevalue", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are planned for; nothing here depends on data size."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="notevalue-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` once as Parquet below the shared folder and go on from the written table.

    Used where several branches read one costly result, or where a Python scorer must not be
    called again for rows it has already answered. Later readers scan only the columns they need.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for tables one run writes and reads again.

    The folder of the application is removed when its JVM ends.
    """
    root = f"{shared_dir(spark).rstrip('/')}/notevalue/{spark.sparkContext.applicationId}"
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(location):
        files.mkdirs(location)
        files.deleteOnExit(location)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists on whatever file system it names."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)
