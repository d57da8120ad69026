"""Landing zone: pitches by month and reference tables, each load in a folder of its own.

See ``loads`` for how a load is published and what a refresh or merge replaces.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from fungo.functions.dates import ns_between, ns_to_date
from fungo.functions.numeric import nan_to_null
from fungo.schemas import (
    LANDED_PITCHES,
    PITCHES,
    RAW_SCHEMAS,
    conform,
    reconciled,
    widened,
)
from fungo.session import materialize, write_by_month
from fungo.sources import loads
from fungo.sources.loads import Load, Month

PITCH_KEY = ("game_pk", "at_bat_number", "pitch_number")
# Keys of a merge that one task compares.
KEYS_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class LoadAudit:
    """What one load took in and what it added to the destination, counted in its own folder.

    A merge writes the stored rows of its months again; these are not counted as loaded.
    """

    destination: str
    mode: str
    rows_extracted: int
    rows_loaded: int
    load_id: str | None = None


def month_number() -> Column:
    """Calendar month of a landed row as one number."""
    return F.col("year") * 12 + F.col("month")


def months_of(landed: DataFrame) -> list[int | None]:
    """Distinct calendar months, a dozen a season; None for rows without a date."""
    return [row.n for row in landed.select(month_number().alias("n")).distinct().collect()]


def in_months(months: list[int | None]) -> Column:
    """Whether a landed row lies in one of ``months``, rows without a date included."""
    dated = month_number().isin([month for month in months if month is not None])
    undated = month_number().isNull() if None in months else F.lit(False)
    return F.coalesce(dated, F.lit(False)) | undated


def with_partition_columns(raw_pitches: DataFrame) -> DataFrame:
    """Add the year and month of each row's own date."""
    day = ns_to_date(F.col("game_date"))
    return raw_pitches.withColumns({"year": F.year(day), "month": F.month(day)})


def write_months(pitches: DataFrame, path: str) -> None:
    """Write pitches that have their partition columns as a new table ``year=YYYY/month=M`` at ``path``.

    The rows, a hundred columns wide, are written where they lie: each task adds one file to each of its
    months, so a hot month is in as many files as there are tasks and no row is shuffled or sorted for it.
    """
    write_by_month(pitches, path)


def land_pitches(raw_pitches: DataFrame, path: str, mode: str = loads.APPEND) -> LoadAudit:
    """Check the declared columns, write the months with every delivered column, publish, report.

    ``append`` adds the rows, ``full-refresh`` replaces the table by them, and ``merge`` adds the pitches
    whose key is not there yet and replaces those whose key is: only the months that the load touches are
    written again, the folders of all others stay. An extract without rows publishes nothing, also
    under full refresh; so does one with a column whose type can not be brought together with that of
    loads before. The extract runs once for an append or refresh; a merge also reads its keys and months.
    """
    if mode not in loads.MODES:
        raise ValueError(f"mode must be one of {loads.MODES}, not {mode!r}")
    spark = raw_pitches.sparkSession
    extract = conform(raw_pitches, PITCHES, keep_others=True)
    # A column of nulls without a type can not be stored.
    extract = extract.drop(*(f.name for f in extract.schema if isinstance(f.dataType, NullType)))
    others = _not_declared(extract)
    before = loads.history(spark, path)
    counting = loads.months_that_count(before)
    if mode != loads.REFRESH:
        reconciled([*(load.other_columns for load, _ in counting), others])
    load_id = loads.new_load_id()
    seen = Observation()
    if mode == loads.MERGE:
        rows, extracted = _merged(spark, path, extract)
        others = _not_declared(rows)
    else:
        rows = extract
    rows = with_partition_columns(nan_to_null(rows))
    if mode != loads.MERGE:
        # Counted last: what is between two steps over a hundred columns has every row copied once more.
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_months(rows, loads.load_folder(path, load_id))
    months = _rows_by_month(spark, path, load_id)
    written = sum(months.values())
    if not written:
        return LoadAudit(path, mode, 0, 0)
    if mode != loads.MERGE:
        extracted = seen.get["rows"]
    replaced = _replaced(spark, path, mode, before, load_id, months)
    held = sum(
        load.months[month]
        for load, theirs in counting
        for month in theirs
        if mode == loads.MERGE and month in months
    )
    load = Load(load_id, mode, extracted, written - held, months, replaced, others)
    loads.commit(spark, path, load)
    return LoadAudit(path, mode, extracted, written - held, load_id)


def _not_declared(pitches: DataFrame) -> StructType:
    return StructType([field for field in pitches.schema if field.name not in PITCHES.names])


def _rows_by_month(spark: SparkSession, path: str, load_id: str) -> dict[Month, int]:
    """Rows of one load, counted from the footers of its own files."""
    folder = loads.load_folder(path, load_id)
    counted = spark.read.schema(LANDED_PITCHES).parquet(folder).groupBy("year", "month").count()
    return {(row.year, row.month): row["count"] for row in counted.collect()}


def _replaced(
    spark: SparkSession, path: str, mode: str, before: list[Load], load_id: str, months: dict[Month, int]
) -> tuple[str, ...]:
    """A refresh replaces every load begun before it, a merge those whose months it has read."""
    if mode == loads.REFRESH:
        return tuple(load.load_id for load in loads.history(spark, path) if load.load_id < load_id)
    if mode == loads.MERGE:
        return tuple(load.load_id for load in before if set(months) & set(load.months))
    return ()


def _dealt(keys: DataFrame, n_rows: int) -> DataFrame:
    """``keys`` moved together by pitch key, so many rows to a task whatever the session's number of partitions."""
    return keys.repartition(1 + n_rows // KEYS_AT_ONCE, *PITCH_KEY)


def _once(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """One of ``rows`` for each pitch key, that with the least hash over all its columns.

    ``keys`` are the keys of these rows, all of them full, already dealt. Only rows whose key comes more than
    once are ranked, all others stay where they lie.
    """
    several = keys.groupBy(*PITCH_KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(*PITCH_KEY)
    several = materialize(several, "merge-repeats")
    if several.isEmpty():
        return rows
    # The text of a row, as a hash takes neither maps nor variants.
    content = F.xxhash64(F.to_json(F.struct(*(f"`{name}`" for name in rows.columns))))
    rank, key = "merge_rank", list(PITCH_KEY)
    # Taken before the join, which puts the key first: the hash depends on the order of the columns.
    ranked = rows.withColumn("merge_content", content).join(several, key, "left_semi")
    least = Window.partitionBy(*PITCH_KEY).orderBy("merge_content")
    ranked = ranked.withColumn(rank, F.row_number().over(least)).where(F.col(rank) == 1)
    return rows.join(several, key, "left_anti").unionByName(ranked.drop(rank, "merge_content"))


def _merged(spark: SparkSession, path: str, extract: DataFrame) -> tuple[DataFrame, int]:
    """The stored rows of the months in ``extract`` with its rows, one for each pitch key, and the number of its rows.

    A delivered row goes before a stored one, and of several delivered ones that with the least hash over
    all its columns, so the same rows give the same table in any order. Rows without a full key can not be told
    apart and stay.

    What is decided, is decided on keys alone. Delivered rows are written where they lie; of the stored ones
    only those months are read in which a key is left that was not delivered.
    """
    keys = with_partition_columns(extract.select("game_date", *PITCH_KEY)).drop("game_date")
    keys = materialize(keys, "merge-keys")
    n_extracted = keys.count()
    touched = months_of(keys)
    stored = read_landed(spark, path, every_column=True).where(in_months(touched))
    together = reconciled([stored.drop("year", "month").schema, extract.schema])
    keyed = F.lit(True)
    for name in PITCH_KEY:
        keyed = keyed & F.col(name).isNotNull()

    n_rows = n_extracted + stored.count()
    taken = _dealt(keys.where(keyed).select(*PITCH_KEY), n_rows)
    delivered = widened(nan_to_null(extract), together)
    merged = _once(delivered.where(keyed), taken).unionByName(delivered.where(~keyed))

    def left(rows: DataFrame, of_keys: DataFrame) -> DataFrame:
        return rows.join(of_keys, list(PITCH_KEY), "left_anti")

    held = _dealt(stored.where(keyed).select(*PITCH_KEY, "year", "month"), n_rows)
    months_left = months_of(left(held, taken))
    if months_left:
        some = stored.where(in_months(months_left) & keyed)
        kept = widened(left(some, keys.select(*PITCH_KEY)).drop("year", "month"), together)
        kept_keys = left(_dealt(some.select(*PITCH_KEY), n_rows), taken)
        merged = merged.unionByName(_once(kept, kept_keys))
    nameless = widened(stored.where(~keyed).drop("year", "month"), together)
    return merged.unionByName(nameless), n_extracted


def land_table(df: DataFrame, path: str, mode: str = loads.REFRESH) -> LoadAudit:
    """Write one reference table as a new version; the default replaces what was there."""
    if mode not in (loads.APPEND, loads.REFRESH):
        raise ValueError(f"mode must be append or full-refresh, not {mode!r}")
    spark = df.sparkSession
    load_id = loads.new_load_id()
    folder = loads.load_folder(path, load_id)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    loaded = spark.read.schema(df.schema).parquet(folder).count()
    if not loaded:
        return LoadAudit(path, mode, 0, 0)
    before = loads.history(spark, path)
    replaced = _replaced(spark, path, mode, before, load_id, {})
    load = Load(load_id, mode, seen.get["rows"], loaded, {(None, None): loaded}, replaced, StructType())
    loads.commit(spark, path, load)
    return LoadAudit(path, mode, seen.get["rows"], loaded, load_id)


def _scan(
    spark: SparkSession, path: str, schema: StructType, parts: Sequence[tuple[Load, list[Month]]]
) -> DataFrame:
    """The months that count of some loads, in ``schema``; the load itself is no column."""
    found = [folder for load, months in parts for folder in loads.folders(path, load, months)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found).drop("load")


def read_landed(
    spark: SparkSession, path: str, every_column: bool = False, only: Collection[str] | None = None
) -> DataFrame:
    """Scan of the landed pitches with the declared schema and its partition columns.

    ``only`` names loads; what others brought is left out. ``every_column`` adds what loads delivered beyond it, in the common type of all loads, null where a
    load did not have it: one scan for each different set of such columns.
    """
    parts = loads.months_that_count(loads.history(spark, path))
    parts = [part for part in parts if only is None or part[0].load_id in only]
    if not every_column:
        return _scan(spark, path, LANDED_PITCHES, parts)
    by_columns: dict[str, list] = {}
    for load, months in parts:
        by_columns.setdefault(load.other_columns.json(), []).append((load, months))
    together = reconciled([LANDED_PITCHES, *(load.other_columns for load, _ in parts)])
    scans = [
        widened(
            _scan(spark, path, StructType([*PITCHES, *own[0][0].other_columns, *LANDED_PITCHES[-2:]]), own),
            together,
        )
        for own in by_columns.values()
    ]
    return union_chunks(scans) if scans else spark.createDataFrame([], together)


def read_reference(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The published version of a reference table."""
    parts = loads.months_that_count(loads.history(spark, path))
    found = [load.folder(path) for load, _ in parts]
    if not found:
        return spark.createDataFrame([], RAW_SCHEMAS[name])
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(*found)


def in_date_range(landed: DataFrame, first: date, last: date) -> DataFrame:
    """Rows dated ``first`` to ``last``, both included.

    The month test prunes folders and the integer bounds are pushed to the scan; the test on
    the date itself decides.
    """
    return landed.where(
        month_number().between(first.year * 12 + first.month, last.year * 12 + last.month)
        & ns_between(F.col("game_date"), first, last)
        & ns_to_date(F.col("game_date")).between(F.lit(first), F.lit(last))
    )


def union_chunks(chunks: list[DataFrame]) -> DataFrame:
    """Stack extracts of several date chunks; a chunk may lack columns or rows."""
    if not chunks:
        raise ValueError("no chunk to stack")
    stacked, *others = chunks
    for chunk in others:
        stacked = stacked.unionByName(chunk, allowMissingColumns=True)
    return stacked


def without_repeats(raw_pitches: DataFrame) -> DataFrame:
    """Opt-in: one row per pitch key. Appending a range twice otherwise counts it twice.

    The rows are moved before they are sorted by key: the files of a load are dense, and a task that sorted
    the rows of its share of them, to find the few repeats in it, would run out of memory and spill.
    """
    return raw_pitches.repartition(*PITCH_KEY).dropDuplicates(list(PITCH_KEY))
