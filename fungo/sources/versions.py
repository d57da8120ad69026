"""Numbered versions of a small table: written apart, published by one row, read whole.

A version is a folder of its own. It counts from the moment its row is in the list of versions, so a reader
sees the former version until then and also if a write dies, and a version that is already
published under a number is not made again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fungo.sources.loads import opened

_LIST = "number long, folder string"


def published(spark: SparkSession, path: str) -> Row | None:
    """``number`` and ``folder`` of the newest version, None before the first."""
    listed = opened(spark, f"{path}/_versions", _LIST)
    return listed.orderBy(F.desc("number"), "folder").first() if listed else None


def publish(df: DataFrame, path: str, number: int) -> None:
    spark = df.sparkSession
    folder = f"version={number}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/{folder}")
    row = spark.createDataFrame([(number, folder)], _LIST).coalesce(1)
    row.write.parquet(f"{path}/_versions/{folder.replace('=', '-')}")


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version."""
    newest = published(spark, path)
    return spark.read.parquet(f"{path}/{newest.folder}") if newest else None
