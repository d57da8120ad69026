"""Exact histogram of encoded lengths, and suffix sums over it.

Documents are encoded where they are read; only their lengths are shuffled, counted on the map side
first. The histogram has a row for each distinct length, so what follows does not grow with the number
of documents. Suffix sums are taken in two steps, within blocks of lengths and over the blocks, so that
no task sorts the whole histogram.

A null or empty text has length 0. Repeated rows count as often as they occur. An empty table gives
an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fungo.llm.tokens import PIECES_FILE, RANKS_FILE, encoder
from fungo.session import materialize

BLOCK = 1024


def encoded_lengths(
    docs: DataFrame, text: str = "text", pieces_file: str = PIECES_FILE, ranks_file: str = RANKS_FILE
) -> DataFrame:
    """``length``: the number of ids of each text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(pieces_file, ranks_file).ids
        for batch in batches:
            lengths = [len(ids(value.as_py())) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["length"])

    return docs.select(F.col(text)).mapInArrow(count, "length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``length``, ``n_docs``: the documents of each length.

    Written to the shared folder, as the sums read it twice and encoding is the work.
    """
    counted = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))
    return materialize(counted, "length-histogram")


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """For every length L of the histogram what a context limit of L means.

    ``docs_at_least`` and ``tokens_at_least`` sum over lengths >= L, ``truncated_tokens`` is the sum of
    min(length, L) over all documents, ``docs_share`` the share of documents of at most L tokens.
    """
    tokens = F.col("length") * F.col("n_docs")
    rows = histogram.withColumns(
        {"n_tokens": tokens, "_block": F.floor(F.col("length") / F.lit(block)).cast("long")}
    )
    within = Window.partitionBy("_block").orderBy(F.desc("length"))
    over = Window.orderBy(F.desc("_block"))
    everything = Window.partitionBy()
    blocks = (
        rows.groupBy("_block")
        .agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
        .select(
            "_block",
            (F.sum("_docs").over(over) - F.col("_docs")).alias("_docs_above"),
            (F.sum("_tokens").over(over) - F.col("_tokens")).alias("_tokens_above"),
            F.sum("_docs").over(everything).alias("total_docs"),
            F.sum("_tokens").over(everything).alias("total_tokens"),
        )
    )
    summed = rows.join(blocks, "_block").select(
        "length", "n_docs", "n_tokens", "total_docs", "total_tokens",
        (F.sum("n_docs").over(within) + F.col("_docs_above")).alias("docs_at_least"),
        (F.sum("n_tokens").over(within) + F.col("_tokens_above")).alias("tokens_at_least"),
    )
    longer = F.col("docs_at_least") - F.col("n_docs")
    return summed.withColumns(
        {
            "truncated_tokens": F.col("total_tokens")
            - F.col("tokens_at_least")
            + F.col("length") * F.col("docs_at_least"),
            "docs_share": (F.col("total_docs") - longer) / F.col("total_docs"),
        }
    )


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """One row: documents and tokens that exceed ``limit``, and the tokens left when texts are cut there."""
    above = F.col("length") > limit
    longer = F.coalesce(F.max(F.when(above, F.col("docs_at_least"))), F.lit(0))
    beyond = F.coalesce(F.max(F.when(above, F.col("tokens_at_least"))), F.lit(0))
    total = F.coalesce(F.max("total_tokens"), F.lit(0))
    return sums.agg(
        longer.alias("docs_above"),
        beyond.alias("tokens_above"),
        (total - beyond + F.lit(limit) * longer).alias("truncated_tokens"),
    )


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the least length that at least ``share`` of all documents do not exceed."""
    return sums.where(F.col("docs_share") >= share).agg(F.min("length").alias("length"))
