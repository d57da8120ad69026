"""The corpus queries by name, and DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.llm import (
    hamming_search,
    host_rules,
    language_id,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    pseudonyms,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_counts,
    whitening,
)
from fungo.llm.common import table, words_of
from fungo.llm.texts import ORACLE  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"))
    return token_counts.suffix_sums(token_counts.length_histogram(lengths))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = [f"shard-{k:04d}" for k in range(512)]
    placed = sharding.place(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"), shards)
    return placed.select("doc_id", "slot", "shard")


@query
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op9_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.group(table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", text.alias("fingerprint"), "component_id")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(table(spark, sf_dir, "documents"), pseudonyms.DEMO_KEY)


@query
def op3_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = hamming_search.coded(table(spark, sf_dir, "embeddings"))
    return hamming_search.nearest(codes, codes.where(F.col("id") % 20 == 0))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("order")


@query
def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic tail in the texts whose id's checksum ends in 0, as the query's contract says."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = words_of(F.col("text"))
    n = F.size("words").cast("long")
    start = F.floor(F.col("checksum") / 10) % n
    period = 1 + F.floor((n - F.col("start")) / (3 + F.floor(F.col("checksum") / 10) % 8))
    tail = F.transform(
        F.sequence(F.col("start"), n - 1),
        lambda i: F.get("words", (F.col("start") + (i - F.col("start")) % F.col("period")).cast("int")),
    )
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("start").cast("int")), tail), " ")
    chosen = docs.select("doc_id", "text", checksum.alias("checksum"))
    chosen = chosen.withColumn("words", F.when(F.col("checksum") % 10 == 0, words))
    chosen = chosen.withColumn("start", F.when(n > 0, start)).withColumn("period", F.when(n > 0, period))
    return chosen.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    best = F.array_max(ranked)
    length, start, period = best["length"], -best["col2"], -best["col3"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
