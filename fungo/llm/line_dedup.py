"""Removal of lines that many documents share, through levelled sorted runs of line hashes.

The key of a line is the line without blanks at its ends and with A-Z in lower case. Keys of at least
``LEAST_POINTS`` code points that ``LEAST_DOCS`` documents hold lose their lines in all documents but the
one with the largest id.

``LineRuns`` keeps what is known of the keys: per hash of 128 bits the number of documents and the largest id.
A batch of documents is counted, merge-anti-joined with every run, so that keys already held by enough
documents and by a larger id are not written again, and what is left becomes a sorted run of level 0.
When a level has ``FAN_OUT`` runs, they are compacted into one run of the next level, so a key is rewritten
once a level and a new batch meets few runs. Runs are tables in the shared folder, bucketed and sorted by hash:
the anti-join shuffles the batch's counts only. Batches may come in any order; all rows of one id have
to be in the same batch. ``drop_shared_lines`` takes a whole table, largest ids first, which settles frequent
keys in the first batches.

A key in a third of all documents is one row of each task when it is counted, because counts combine before
the shuffle. Texts travel once, compressed, to the list of their own dropped keys, which is no longer
than the text.

Null or empty text: one empty line. Null ``doc_id``: all rows without an id count as one document, below all
others. Repeated rows: one document, returned for each row; different texts under one id are one document
too. Long texts are processed whole; empty table: empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.session import fresh_folder, shared_folder

LEAST_POINTS, LEAST_DOCS = 40, 5
BATCHES, FAN_OUT = 8, 4
NO_ID = -(1 << 63)
# Lines that leave a task at once.
CHUNK = 1 << 16

KEY = ["h", "g"]
ENTRY = "h long, g long, n_docs long, last_doc long"


def _keys(lines: list[bytes], least_points: int) -> list[bytes | None]:
    """The hash of each line's key, None if the key is too short."""
    digest = xxhash.xxh3_128_digest
    found = []
    for line in lines:
        key = line.strip().lower()
        long_enough = len(key) >= least_points and (
            key.isascii() or len(key) >= 4 * least_points or len(key.decode("utf-8")) >= least_points
        )
        found.append(digest(key) if long_enough else None)
    return found


def _identity(text: bytes) -> int:
    """A hash that tells the texts of one id apart."""
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def line_keys(docs: DataFrame, least_points: int = LEAST_POINTS) -> DataFrame:
    """``doc``, ``part`` (which text of the id) and ``h``, ``g`` of every different key of a row."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "part", *KEY]
        for batch in batches:
            owners, parts, keys = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = (text.as_py() or "").encode("utf-8")
                own = set(_keys(value.split(b"\n"), least_points)) - {None}
                owners.append(np.full(len(own), doc))
                parts.append(np.full(len(own), _identity(value)))
                keys.extend(own)
                if len(keys) >= CHUNK:
                    yield _key_batch(owners, parts, keys, names)
                    owners, parts, keys = [], [], []
            if keys:
                yield _key_batch(owners, parts, keys, names)

    return _documents(docs).select("doc", "text").mapInArrow(build, "doc long, part long, h long, g long")


def _key_batch(owners: list, parts: list, keys: list[bytes], names: list[str]) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    columns = [np.concatenate(owners), np.concatenate(parts), halves[:, 0], halves[:, 1]]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)


def _documents(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(doc.alias("doc"), F.col("text").cast("string").alias("text"))


class LineRuns:
    """What is known of line keys, in levels of sorted runs."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fan_out: int = FAN_OUT) -> None:
        shared_folder(spark)
        self.spark = spark
        self.least_docs = least_docs
        self.fan_out = fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Name and path of each run.
        self.levels: list[list[tuple[str, str]]] = [[]]

    def add(self, keys: DataFrame) -> None:
        """Take in a batch of ``line_keys``, with all rows of the ids in it."""
        new = keys.groupBy(*KEY).agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last_doc"))
        for name, _ in self._all():
            run = self.spark.table(name)
            settled = run.where(F.col("n_docs") >= self.least_docs)
            known = settled.select(*KEY, F.col("last_doc").alias("known_last"))
            same = [F.col(f"new.{k}") == F.col(f"known.{k}") for k in KEY]
            later = F.col("known_last") >= F.col("last_doc")
            new = new.alias("new").join(known.alias("known"), [*same, later], "left_anti")
        self._put(new, 0)

    def _all(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def runs(self) -> list[DataFrame]:
        """Plain scans: Spark 4.1 takes a union of bucketed scans for one that is dealt by key already,
        and then reads them without their buckets."""
        return [self.spark.read.schema(ENTRY).parquet(path) for _, path in self._all()]

    def merged(self) -> DataFrame:
        """``h``, ``g``, ``n_docs`` (exact below ``least_docs``, else at least it) and ``last_doc``."""
        return self._merge(self.runs())

    def shared(self) -> DataFrame:
        """Keys that enough documents hold, with the largest id that does."""
        return self.merged().where(F.col("n_docs") >= self.least_docs).select(*KEY, "last_doc")

    def forget(self) -> None:
        """Take the runs out of the catalog; their files stay in the shared folder."""
        for name, _ in self._all():
            self.spark.sql(f"drop table if exists {name}")
        self.levels = [[]]

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        together = runs[0]
        for run in runs[1:]:
            together = together.unionByName(run)
        return together.groupBy(*KEY).agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")
        )

    def _put(self, entries: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", fresh_folder(self.spark, "line-run")
        writer = entries.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", path).saveAsTable(name)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append((name, path))
        if len(self.levels[level]) == self.fan_out:
            old, self.levels[level] = self.levels[level], []
            scans = [self.spark.read.schema(ENTRY).parquet(own) for _, own in old]
            self._put(self._merge(scans), level + 1)
            for run, _ in old:
                self.spark.sql(f"drop table {run}")


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """The number of a document's batch, largest ids first; no id is in two batches."""
    if batches == 1:
        return F.lit(0)
    shares = [k / batches for k in range(1, batches)]
    edges = docs.agg(F.percentile_approx("doc", shares, 1000).alias("edges")).first().edges or []
    return sum((F.when(F.col("doc") <= edge, 1).otherwise(0) for edge in sorted(set(edges))), F.lit(0))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [(text.as_py() or "").encode("utf-8") for text in batch.column(1)]
        columns = [
            batch.column(0), pa.array([_identity(text) for text in texts], pa.int64()),
            pa.array([compress(text) for text in texts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "part", "packed"])


def drop_shared_lines(
    docs: DataFrame,
    least_points: int = LEAST_POINTS,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped``, ``kept_sha256``, ``kept_text`` for every row of ``docs``."""
    spark = docs.sparkSession
    documents = _documents(docs)
    path = fresh_folder(spark, "line-keys")
    keys = line_keys(docs, least_points).withColumn("batch", _batch_of(documents, batches))
    keys.write.partitionBy("batch").parquet(path)
    written = spark.read.schema("doc long, part long, h long, g long, batch int").parquet(path)
    runs = LineRuns(spark, least_docs, fan_out)
    for batch in range(batches):
        runs.add(written.where(F.col("batch") == batch))
    shared_path = fresh_folder(spark, "shared-lines")
    runs.shared().write.parquet(shared_path)
    runs.forget()
    shared = spark.read.schema("h long, g long, last_doc long").parquet(shared_path)

    going = written.join(shared, KEY).where(F.col("doc") < F.col("last_doc"))
    dropped = going.groupBy("doc", "part").agg(F.collect_set(F.struct(*KEY)).alias("dropped"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        names = ["doc", "n_lines", "n_dropped", "kept_sha256", "kept_text"]
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for packed, gone in zip(batch.column(1), batch.column(2)):
                lines = left = decompress(packed.as_py()).split(b"\n")
                if gone.is_valid:
                    halves = np.array([[key[k] for k in KEY] for key in gone.as_py()], np.int64)
                    hashes = {half.tobytes() for half in halves}
                    hashed = zip(lines, _keys(lines, least_points))
                    left = [line for line, key in hashed if key is None or key not in hashes]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            columns = [
                batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                pa.array([hashlib.sha256(text).hexdigest() for text in kept], pa.string()),
                pa.array([text.decode("utf-8") for text in kept], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    travelling = documents.mapInArrow(_packed, "doc long, part long, packed binary")
    joined = travelling.join(dropped, ["doc", "part"], "left").select("doc", "packed", "dropped")
    result = joined.mapInArrow(
        cut, "doc long, n_lines long, n_dropped long, kept_sha256 string, kept_text string"
    )
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    return result.select(doc_id, "n_lines", "n_dropped", "kept_sha256", "kept_text")
