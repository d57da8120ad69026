"""A corpus from documents to packed training sequences, in five stages.

``STAGES`` lists them in order. Each takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept; ``run`` writes every result as Parquet in the shared folder and reads it again for the next. All
but the last return the columns of ``documents``:

1. language ID: documents whose language can not be told go;
2. near duplicates: one document of each SimHash group stays;
3. personal data: numbers, dates and addresses become keyed pseudonyms;
4. mixing: documents in the order that gives each source its target weight at every moment, sources that
   run out beginning again;
5. packing: token pieces of all documents in sequences of 1024.

Null texts, null ids, repeated rows and empty tables are treated as each operator's module says; a null
text has no language and goes in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.llm import language_id, mixing, packing, pseudonyms, simhash_dedup
from fungo.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A language is told if it wins each of its duels.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents and drops those it finds no language for."""
    model = language_id.learn(docs.where(language_id.fold() != 0).select("doc_id", "text", "lang"))
    judged = language_id.predict(docs.select(*COLUMNS), model)
    told = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(told).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.group(docs)
    return simhash_dedup.survivors(docs.select(*COLUMNS), groups).select(*COLUMNS)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    turned = pseudonyms.pseudonymize_column(docs.select(*COLUMNS), pseudonyms.DEMO_KEY)
    return turned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs.select(*COLUMNS), mixing.mix(docs)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", without_near_duplicates),
    ("pii_pseudonyms", without_personal_data),
    ("source_mixing", mixed),
    ("packing", packed),
]

# Hashes, trained weights and token ids have no DuckDB text; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
