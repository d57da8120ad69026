"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders that a task writes at once, before it sorts what is left.
OPEN_FOLDERS = 24


def build_session(
    app: str = "fungo",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with UTC, ANSI and adaptive execution on.

    ``master`` and ``shuffle_partitions`` are left to the cluster's own defaults unless given.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the context's own setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty location below the shared folder."""
    return f"{shared_folder(spark)}/fungo/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return a scan of it.

    For frames with several consumers. The written table survives lost executors, and each
    consumer reads only the columns it needs.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def open_folders(spark: SparkSession, most: int = OPEN_FOLDERS) -> Iterator[None]:
    """Within it, a task that writes partitions keeps a file open for each instead of sorting its rows by them.

    For few partitions, months for one: rows are then written where they lie, and neither a shuffle nor a
    sort, which spills, stands before the write. A task with more than ``most`` sorts the rest.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_by_month(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``df`` with its columns ``year`` and ``month`` in month folders; every task adds its file to a month."""
    with open_folders(df.sparkSession):
        df.write.mode(mode).partitionBy("year", "month").parquet(path)
