"""Sets of ids as words of bits, stored by day and joined together for any longer time.

A number of different players or games does not add up over days, but the sets do: the ids of a day are
bits of words, 64 ids to a word, and the set of a month is its days' words joined by OR. A distinct count at any
grain is then a sum over the words and needs no pass over the facts, and a day that changes is
built again by itself.

A word is a number, so a hash table keeps it and joins words before they are shuffled. The ids of a day lie
far apart when games are many: a set costs at most a row of two numbers for an id, where a bitmap of fixed length
would cost its whole length for each of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUBJECT, WORD, BITS = "subject", "word", "bits"
# A word holds 64 ids: so many bits of an id are its place in the word.
PLACE_BITS = 6

# Grains from the finest; the season is the whole table.
GRAINS = ("day", "month", "season")


def day_sets(facts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``subject``, ``game_date``, ``word``, ``bits`` of the ids of each subject.

    ``facts`` gives for each subject a fact table and its id column. A table is scanned once for all its
    subjects; its ids become bits, and bits words, on the map side first.
    """
    by_table: dict[int, tuple[DataFrame, list]] = {}
    for subject, (fact, column) in facts.items():
        by_table.setdefault(id(fact), (fact, []))[1].append(
            F.struct(F.lit(subject).alias(SUBJECT), F.col(column).cast("bigint").alias("id"))
        )
    parts = [
        fact.select("game_date", F.explode(F.array(*pairs)).alias("one")).select("game_date", "one.*")
        for fact, pairs in by_table.values()
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionAll(part)
    place = F.col("id").bitwiseAND((1 << PLACE_BITS) - 1).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return (
        together.where(F.col("id").isNotNull())
        .groupBy(SUBJECT, "game_date", F.shiftright("id", PLACE_BITS).alias(WORD))
        .agg(F.bit_or(bit).alias(BITS))
    )


def _start_of(grain: str) -> Column:
    if grain == "day":
        return F.col("game_date")
    return F.trunc("game_date", "month") if grain == "month" else F.lit(None).cast("date")


def distinct_counts(sets: DataFrame, counted: Mapping[str, Sequence[str]]) -> DataFrame:
    """``grain``, ``starts_on``, ``counted``, ``n`` for every grain and each entry of ``counted``.

    An entry names the subjects whose ids are counted together: a player who bats and pitches is one. The
    season's period has no start. Each grain is made of the one below it, the days of the stored sets.
    """
    chosen = F.explode(
        F.array(
            *(
                F.when(F.col(SUBJECT).isin(*subjects), F.lit(name))
                for name, subjects in counted.items()
            )
        )
    )
    finer = sets.select("game_date", WORD, BITS, chosen.alias("counted")).where("counted is not null")
    results = []
    for grain in GRAINS:
        start = _start_of(grain)
        finer = finer.groupBy("counted", start.alias("game_date"), WORD).agg(F.bit_or(BITS).alias(BITS))
        sizes = finer.groupBy("counted", "game_date").agg(F.sum(F.bit_count(BITS)).alias("n"))
        results.append(
            sizes.select(F.lit(grain).alias("grain"), F.col("game_date").alias("starts_on"), "counted", "n")
        )
    return results[0].unionAll(results[1]).unionAll(results[2])
