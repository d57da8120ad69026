"""The record of loads of a landing folder, and which of their folders make up the table.

A load writes its own folder, ``load=<id>``, and then one row of the record below ``_loads``. That row is
what publishes the load: before it, and if the load dies, nobody sees the folder. A full refresh replaces the
loads before it, a merge replaces single months of them; nothing that was written is overwritten, so a reader
keeps the version it began with, and an old version can be read until its folders are removed by age
(``replaced_folders``).

Loads may run at once, each counts its own folder. Two refreshes, or two merges of one month, must not: each
would replace what it saw at its start, and both would stay.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

APPEND, REFRESH, MERGE = "append", "full-refresh", "merge"
MODES = (APPEND, REFRESH, MERGE)

RECORD = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("committed_at", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("rows_extracted", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField(
            "months",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("year", T.IntegerType()),
                        T.StructField("month", T.IntegerType()),
                        T.StructField("n", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField("replaced", T.ArrayType(T.StringType())),
        T.StructField("other_columns", T.StringType()),
    ]
)

Month = tuple[int | None, int | None]
EACH_FOLDER = ("recursiveFileLookup", "true")
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Load:
    """One row of the record. ``months`` holds the rows of each calendar month of the load's folder,
    ``replaced`` the loads whose months (all of them after a full refresh) no longer count, and
    ``other_columns`` the types of the columns that are not declared."""

    load_id: str
    mode: str
    rows_extracted: int
    rows_loaded: int
    months: dict[Month, int]
    replaced: tuple[str, ...]
    other_columns: T.StructType

    def folder(self, path: str) -> str:
        return load_folder(path, self.load_id)


def new_load_id() -> str:
    """Ids sort by the time they were given."""
    return f"l{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def load_folder(path: str, load_id: str) -> str:
    return f"{path}/load={load_id}"


def record_folder(path: str) -> str:
    return f"{path}/_loads"


def opened(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """A scan of ``path``, or None before the first write. A record lies in a folder for each of its rows."""
    reader = spark.read if schema is None else spark.read.schema(schema).option(*EACH_FOLDER)
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def commit(spark: SparkSession, path: str, load: Load) -> None:
    """Publish the load: one file, which appears in one step.

    It has a folder of its own, since two writes to one folder at once would clear away each other's.
    """
    months = [(year, month, n) for (year, month), n in load.months.items()]
    row = (
        load.load_id, time.time_ns() // 1000, load.mode, load.rows_extracted, load.rows_loaded, months,
        list(load.replaced), load.other_columns.json(),
    )
    record = spark.createDataFrame([row], RECORD).coalesce(1)
    record.write.parquet(f"{record_folder(path)}/{load.load_id}")


def as_load(row: Row) -> Load:
    return Load(
        row.load_id,
        row.mode,
        row.rows_extracted,
        row.rows_loaded,
        {(m.year, m.month): m.n for m in row.months},
        tuple(row.replaced),
        T.StructType.fromJson(json.loads(row.other_columns)),
    )


def history(spark: SparkSession, path: str) -> list[Load]:
    """Every published load, a row each, in the order they were begun."""
    record = opened(spark, record_folder(path), RECORD)
    return sorted(map(as_load, record.collect()), key=lambda load: load.load_id) if record else []


def months_that_count(loads: Sequence[Load]) -> list[tuple[Load, list[Month]]]:
    """Each load with those of its months that no other load replaced; loads without any are left out."""
    gone: dict[str, set[Month]] = {}
    months_of = {load.load_id: set(load.months) for load in loads}
    for load in loads:
        for replaced in load.replaced:
            theirs = months_of.get(replaced, set())
            gone.setdefault(replaced, set()).update(
                theirs if load.mode == REFRESH else theirs & set(load.months)
            )
    left = [
        (load, [month for month in load.months if month not in gone.get(load.load_id, ())])
        for load in loads
    ]
    return [(load, months) for load, months in left if months]


def folders(path: str, load: Load, months: Sequence[Month]) -> list[str]:
    """The load's folder, or those of ``months`` if it has others too."""
    if len(months) == len(load.months):
        return [load.folder(path)]
    return [
        f"{load.folder(path)}/year={_named(year)}/month={_named(month)}" for year, month in months
    ]


def _named(value: int | None) -> str:
    return NO_PARTITION if value is None else str(value)


def replaced_folders(spark: SparkSession, path: str, older_than_days: float) -> list[str]:
    """Folders that no longer count because of loads of more than so many days ago; they can be removed."""
    record = opened(spark, record_folder(path), RECORD)
    if record is None:
        return []
    limit = time.time_ns() // 1000 - int(older_than_days * 86_400 * 1_000_000)
    rows = record.collect()
    old = [as_load(row) for row in rows if row.committed_at < limit]
    counting = {load.load_id: set(months) for load, months in months_that_count(old)}
    found = []
    for load in old:
        gone = [month for month in load.months if month not in counting.get(load.load_id, set())]
        found += folders(path, load, gone) if gone else []
    return found
