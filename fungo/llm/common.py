"""What the corpus operators share: the word rule, table reading, and prefix sums in two steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are the longest runs of characters outside this class: space, and tab to carriage return.
# Python's ``bytes.split()`` cuts at the same six characters.
WORD_BREAK = r"[\x20\x09-\x0D]"

# Rows of a document without an id count as one document behind all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of ``text``, none for a null."""
    pieces = F.split(F.coalesce(text, F.lit("")), f"{WORD_BREAK}+")
    return F.filter(pieces, lambda word: word != "")


def word_lists(texts) -> list[list[bytes]]:
    """The words of each text of an Arrow column as UTF-8 bytes, none for a null."""
    return [text.encode("utf-8").split() if text else [] for text in texts.to_pylist()]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like those wanted that ``df`` does not have, whatever the case of its own."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
