"""Exact nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into m segments. If two codes differ in at most r m + j bits, then they differ in at
most r bits in some segment, or in fewer in all but the first j + 1; so after segments have been searched
to radius r, and the first j + 1 of them in the last step, every code within r m + j is found. Each
round widens the search of the queries that are not done, compares whole codes in the join, and
keeps only what the radius covers; a query is done when that holds its k-th neighbour.

Codes and queries are distinct codes with their least ids, k + 1 at most, so a vector with a third of all
rows is one code, and a common query is searched once. Rounds are written to the shared folder.

Vectors that are null, hold a null or a NaN or have not 64 dimensions have no code and are left out; a null
id likewise. Ties go to the lesser id. Repeated ids with one code count once. A table with fewer than k other
vectors gives them all. The query itself is not its own neighbour.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fungo.session import materialize

CODE_BITS = 64
K = 10
SEGMENTS = 5
LEAST_SEGMENTS = 4
# Radii searched in all segments before a round ends. Then a radius is added segment by segment, as most
# codes have their neighbours there and each step of distance doubles what is covered; then whole radii
# again, for the few outliers.
FIRST_RADII, STEPWISE_RADIUS = (1, 2, 3), 4


def sign_code(embedding: Column) -> Column:
    """A bit for each dimension above zero, the first dimension lowest; null unless there are 64."""
    bits = F.transform(
        embedding, lambda x, i: F.when(F.isnan(x), None)
        .when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i))
        .when(x.isNotNull(), F.lit(0).cast("long"))
    )
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda total, bit: total.bitwiseOR(bit))
    return F.when(F.size(embedding) == CODE_BITS, code)


def _segment_bounds(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    cuts = [k * CODE_BITS // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(code: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(code, start).bitwiseAND(F.lit((1 << width) - 1))


def _masks(spark: SparkSession, segments: int) -> DataFrame:
    """Every pattern of each segment's bits: two to the width, whatever the data."""
    parts = [
        spark.range(1 << w).select(
            F.lit(s).alias("m_segment"), F.col("id").alias("mask"), F.bit_count("id").alias("weight")
        )
        for s, (_, w) in enumerate(_segment_bounds(segments))
    ]
    return reduce(DataFrame.unionAll, parts)


def coded(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``id``, ``code`` of the rows that have both."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), sign_code(F.col(embedding)).alias("code"))
    return rows.where(F.col("id").isNotNull() & F.col("code").isNotNull())


def _members(codes: DataFrame, keep: int) -> DataFrame:
    """``code``, ``id``: the ``keep`` least ids of each code."""
    rank = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    return codes.distinct().withColumn("rank", rank).where(F.col("rank") <= keep).select("code", "id")


def _cut(codes: DataFrame, column: str, segments: int) -> DataFrame:
    """A row for each segment of each code: ``column``, ``segment``, ``value``."""
    entries = [
        F.struct(F.lit(s).alias("segment"), _segment(F.col(column), a, w).alias("value"))
        for s, (a, w) in enumerate(_segment_bounds(segments))
    ]
    return codes.select(column, F.inline(F.array(*entries)))


def _probes(queries: DataFrame, masks: DataFrame, radii: list[int]) -> DataFrame:
    """Every value that a query searches in each segment."""
    radius = F.get(F.array(*[F.lit(r) for r in radii]), F.col("m_segment"))
    wanted = F.broadcast(masks.where(F.col("weight") <= radius))
    own = _cut(queries, "query", len(radii))
    probed = own.join(wanted, F.col("segment") == F.col("m_segment"))
    value = F.col("value").bitwiseXOR(F.col("mask"))
    return probed.select("query", F.col("segment").alias("q_segment"), value.alias("q_value"))


def _rounds(segments: int) -> list[tuple[list[int], int]]:
    """Radii by segment and the distance that is covered then, until every code is."""
    rounds = [([r] * segments, r * segments + segments - 1) for r in FIRST_RADII]
    for j in range(segments):
        radii = [STEPWISE_RADIUS - (place > j) for place in range(segments)]
        rounds.append((radii, STEPWISE_RADIUS * segments + j))
    while rounds[-1][1] < CODE_BITS:
        radius = rounds[-1][0][0] + 1
        rounds.append(([radius] * segments, radius * segments + segments - 1))
    return rounds


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, segments: int = SEGMENTS
) -> DataFrame:
    """``query_id``, ``rank``, ``neighbor_id``, ``distance`` for the rows of ``queries``.

    Both tables have ``id`` and ``code``, as ``coded`` gives them; a query finds every other id.
    ``segments`` is best near 64 / log2 of the number of codes.
    """
    if segments < LEAST_SEGMENTS:
        raise ValueError(f"at least {LEAST_SEGMENTS} segments")
    members = materialize(_members(vectors, k + 1), "codes")
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct()
    asked = materialize(asked, "queries")
    index = materialize(_cut(members.select("code").distinct(), "code", segments), "segments")
    masks = _masks(vectors.sparkSession, segments)
    active = asked.select("query").distinct()
    # With no more than this many ids in all, a query can not find k + 1.
    wanted = min(k + 1, members.count())
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for radii, covered in _rounds(segments):
        difference = F.col("query").bitwiseXOR(F.col("code"))
        meeting = (
            (F.col("q_segment") == F.col("segment"))
            & (F.col("q_value") == F.col("value"))
            & (F.bit_count(difference) <= covered)
        )
        # A query becomes thousands of probes, which Spark does not foresee: it would broadcast them.
        probes = _probes(active.repartition(tasks, "query"), masks, radii).hint("merge")
        near = probes.join(index, meeting).select("query", "code").distinct()
        ids = near.join(members, "code").withColumn("distance", F.bit_count(difference))
        best = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
        top = ids.withColumn("place", best).where(F.col("place") <= k + 1)
        top = materialize(top.select("query", "id", "distance", "place"), "nearest")
        full = top.where(F.col("place") == wanted).select("query")
        done = top.join(full, "query", "left_semi")
        found = done if found is None else found.unionAll(done)
        active = materialize(active.join(full, "query", "left_anti"), "open-queries")
        if active.isEmpty():
            break
    pairs = asked.join(found, "query").where(F.col("query_id") != F.col("id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    ranked = pairs.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(
        "query_id", F.col("rank").cast("long"), F.col("id").alias("neighbor_id"), F.col("distance").cast("long")
    )
