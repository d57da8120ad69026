"""Quality rules whose failures are judged by host.

Per document: word characters, symbols, repeated lines and words in repeated 5-word windows, each an
expression over the row's own text, so nothing is shuffled and no text is cut. Per host: how many
documents fail each rule, counted on the map side first, so a host with a third of all rows costs one
partial sum in each task. A host's failure rate is drawn towards the rate of all hosts by a beta prior
fitted to the hosts (method of moments for unequal sizes), so a host with three pages is not condemned
for two of them. A host fails if the shrunk rate of any rule exceeds ``max_rate``; its documents go,
as do documents that fail the base rules by themselves.

Null text: no words. Null host: a host of its own. Repeated rows count each. Empty table: empty result.
Windows are compared by a 64-bit hash of their five words within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.llm.common import WORD_BREAK, words_of
from fungo.session import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MAX_RATE = 0.5
RULES = ("too_short", "repeats_itself", "many_symbols", "repeated_lines")


def _windows(words: Column, n_words: Column) -> Column:
    """A hash of each run of five words."""
    starts = F.when(n_words >= WINDOW, F.sequence(F.lit(0), n_words - WINDOW))
    hashed = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    return F.coalesce(hashed, F.array().cast("array<bigint>"))


def _repeated_starts(ranked: Column) -> Column:
    """Starts of windows that occur more than once; ``ranked`` is sorted by hash, then start."""

    def shared(item: Column, i: Column) -> Column:
        same = [F.get(ranked, i + k)["h"] == item["h"] for k in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    kept = F.filter(ranked, shared)
    return F.sort_array(F.transform(kept, lambda item: item["i"]))


def _covered(starts: Column) -> Column:
    """Words under at least one of the windows that begin at ``starts``."""
    steps = F.transform(
        starts, lambda x, i: F.coalesce(F.least(F.get(starts, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
    )
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def document_signals(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``host`` and the counts of every document, with the base verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{WORD_BREAK[1:-1]}]"))
    split = docs.select(
        "doc_id", F.col(host).alias("host"), text.alias("text"), words_of(F.col("text")).alias("words")
    ).withColumns({"n": F.size("words"), "lines": lines})
    windows = split.withColumn("windows", _windows(F.col("words"), F.col("n")))
    paired = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ranked = windows.withColumn(
        "ranked",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(paired)),
    )
    starts = ranked.withColumn("starts", _repeated_starts(F.col("ranked")))
    n_words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return starts.select(
        "doc_id",
        "host",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (n_words < 10) | (100 * repeated > 20 * n_words))


def rule_failures() -> dict[str, Column]:
    """Whether a document fails each of ``RULES``."""
    col = F.col
    return dict(
        zip(
            RULES,
            (
                col("n_words") < 10,
                100 * col("n_repeat_words") > 20 * col("n_words"),
                10 * col("n_symbols") > col("word_chars"),
                10 * col("n_dup_lines") > 3 * col("n_lines"),
            ),
        )
    )


def host_rates(signals: DataFrame) -> DataFrame:
    """``host``, ``rule``, documents, failures and the failure rate after shrinking."""
    counts = signals.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(failed.cast("long")).alias(rule) for rule, failed in rule_failures().items()],
    )
    hosts = counts.unpivot(["host", "n"], list(RULES), "rule", "failures")
    # A row for each rule: no more than RULES has, however many hosts there are.
    means = hosts.groupBy("rule").agg(
        (F.sum("failures") / F.sum("n")).alias("mean"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("docs"),
        F.sum(F.lit(1.0) / F.col("n")).alias("inverse"),
        F.sum(F.col("failures") * F.col("failures") / F.col("n")).alias("squares"),
    )
    mean, k = F.col("mean"), F.col("hosts")
    # sum n (p - mean)^2 = sum f^2 / n - mean^2 sum n
    spread = F.when(
        k > 1, k * (F.col("squares") - mean * mean * F.col("docs")) / ((k - 1) * F.col("docs"))
    )
    noise = mean * (1 - mean) * F.col("inverse") / k
    strength = F.greatest(mean * (1 - mean) - F.col("spread"), F.lit(0.0)) / (F.col("spread") - F.col("noise"))
    priors = (
        means.withColumns({"spread": spread, "noise": noise})
        .withColumn("strength", F.when(F.col("spread") > F.col("noise"), strength))
        .select("rule", "mean", "strength")
    )
    weight = F.col("strength")
    shrunk = F.when(weight.isNull(), mean).otherwise(
        (F.col("failures") + mean * weight) / (F.col("n") + weight)
    )
    return hosts.join(F.broadcast(priors), "rule").select(
        "host", "rule", "n", "failures", shrunk.alias("shrunk_rate")
    )


def host_verdicts(rates: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``host``, ``host_failed``."""
    return rates.groupBy("host").agg(F.bool_or(F.col("shrunk_rate") > max_rate).alias("host_failed"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The signals of each document with ``base_failed``, ``host_failed`` and ``kept``.

    The signals, a few numbers a document, are written once to the shared folder: they are read for
    the hosts and again for the documents.
    """
    signals = materialize(document_signals(docs, host), "host-rules")
    verdicts = host_verdicts(host_rates(signals), max_rate).withColumnRenamed("host", "_host")
    judged = signals.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    return judged.withColumn("kept", ~(F.col("base_failed") | F.col("host_failed")))
