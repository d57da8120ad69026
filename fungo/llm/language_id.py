"""Language identification in two steps: the family, then one-versus-one linear SVMs within it.

A text becomes the square roots of the shares of its hashed byte trigrams (ASCII letters in lower case,
other ASCII characters as space), a vector of length 1. Linear support vector machines separate
every pair of families, trained on all their languages, and every pair of languages of one family. The
family with the most votes wins, then the language with the most votes within it; of equal votes, the
larger sum of margins, then the name.

Families come from a table of common languages. A language that is not in it joins the family, or the other
unlisted languages, whose mean vectors point the same way as its own once the mean of all
languages is taken off; with none it is a family of its own.

The classifiers are fitted on a bounded sample of labelled texts: ``per_language`` of each language, the
least by a hash of the id, and ``FAMILY_SAMPLES`` times as many of each family, evenly from its languages. All
machines are fitted in one job, each in a task on the texts of its two sides alone. Prediction reads
every text whole where it lies, with the weights as the only thing sent, so it neither shuffles nor
depends on how many documents there are.

A text that is null or has no letter is ``und`` with score 0. A null ``lang`` is no label. A null
``doc_id`` is never held out and never learned from. With one learned language every text with a letter
has it; with none, all are ``und``. More than 200 different labels (``MOST_LANGUAGES``) raise ``ValueError``.
Repeated rows are judged each; empty table: empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fungo.llm.common import free_names
from fungo.session import materialize

BITS = 11
SIZE = 1 << BITS
PER_LANGUAGE = 600
FAMILY_SAMPLES = 2
PENALTY = 1e-3
MOST_LANGUAGES = 200
FOLDS = 5
UNKNOWN = "und"

# Families of common languages; the others find theirs by likeness.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "ca": "romance", "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic",
    "bg": "slavic", "hi": "indo-aryan", "bn": "indo-aryan", "ur": "indo-aryan", "fi": "uralic",
    "et": "uralic", "hu": "uralic",
}

_PLAIN = bytes(
    code if code >= 128 or chr(code).isalpha() and chr(code).islower()
    else code + 32 if chr(code).isupper() else 32
    for code in range(256)
)
_SPACE = 32


def features(text: str) -> np.ndarray:
    """The vector of a whole text."""
    codes = np.frombuffer(b" " + text.encode("utf-8").translate(_PLAIN) + b" ", np.uint8)
    left, middle, right = (codes[k : len(codes) - 2 + k].astype(np.uint32) for k in range(3))
    trigrams = ((left << 16 | middle << 8 | right) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    counts = np.bincount(trigrams[middle != _SPACE], minlength=SIZE)
    return np.sqrt(counts / max(1, counts.sum()))


@dataclass(frozen=True)
class Duel:
    """A linear machine: a positive margin speaks for ``first``."""

    first: str
    second: str
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class Model:
    families: Mapping[str, tuple[str, ...]]
    family_duels: tuple[Duel, ...]
    language_duels: Mapping[str, tuple[Duel, ...]]

    def predict(self, text: str) -> tuple[str, float]:
        """Language and score of a text with a letter."""
        if not self.families:
            return UNKNOWN, 0.0
        vector = features(text)
        family, sure = _vote(tuple(self.families), self.family_duels, vector)
        language, surer = _vote(self.families[family], self.language_duels.get(family, ()), vector)
        return language, min(sure, surer)


def _vote(names: tuple[str, ...], duels: tuple[Duel, ...], vector: np.ndarray) -> tuple[str, float]:
    """The winner, and the logistic of its least margin."""
    if len(names) == 1:
        return names[0], 1.0
    votes, sums = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
    margins = {}
    for duel in duels:
        margin = float(duel.weights @ vector) + duel.intercept
        for name, own in ((duel.first, margin), (duel.second, -margin)):
            votes[name] += own > 0
            sums[name] += own
            margins.setdefault(name, []).append(own)
    best = min(names, key=lambda name: (-votes[name], -sums[name], name))
    return best, float(1 / (1 + np.exp(-np.clip(2 * min(margins[best]), -50, 50))))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of each vector that are not zero."""
    for batch in batches:
        rows = [features(text) for text in batch.column("text").to_pylist()]
        places = [np.flatnonzero(row) for row in rows]
        values = [row[at] for row, at in zip(rows, places)]
        columns = [
            batch.column("lang"), batch.column("rank"),
            pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "rank", "places", "values"])


def fit(rows: np.ndarray, signs: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights of the machine with squared hinge loss, the intercept last.

    Newton steps on the rows within the margin, halved while they do not descend; the loss is convex and
    piecewise quadratic, so a few steps reach its one minimum.
    """
    rows = np.hstack([rows, np.ones((len(rows), 1))])
    weights = np.zeros(rows.shape[1])
    ridge = penalty * len(rows)

    def loss(at: np.ndarray) -> float:
        return ridge * float(at @ at) + float((np.maximum(0, 1 - signs * (rows @ at)) ** 2).sum())

    now = loss(weights)
    for _ in range(50):
        inside = signs * (rows @ weights) < 1
        near, target = rows[inside], signs[inside]
        if len(near) < near.shape[1]:
            step = near.T @ np.linalg.solve(near @ near.T + ridge * np.eye(len(near)), target) - weights
        else:
            step = np.linalg.solve(near.T @ near + ridge * np.eye(near.shape[1]), near.T @ target) - weights
        size = 1.0
        while size > 1e-6 and loss(weights + size * step) > now:
            size /= 2
        before, weights = now, weights + size * step
        now = loss(weights)
        if before - now <= 1e-10 * before:
            break
    return weights


def _fit_duel(group: pd.DataFrame) -> pd.DataFrame:
    rows = np.zeros((len(group), SIZE))
    for row, places, values in zip(rows, group["places"], group["values"]):
        row[places] = values
    weights = fit(rows, group["sign"].to_numpy(float))
    return pd.DataFrame({"duel": [group["duel"].iloc[0]], "weights": [weights]})


def sample_vectors(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang``, ``rank``, ``places``, ``values`` of at most ``per_language`` texts of each language."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # A hash lets about 1.5 times the sample through, so that no window sees a whole language.
    order = F.xxhash64("doc_id", "text")
    share = F.coalesce(
        F.lit(None).cast("double"),
        *[F.when(F.col("lang") == r["lang"], F.lit(1.5 * per_language / r["count"])) for r in counts],
    )
    near = usable.where(F.pmod(order, F.lit(1_000_000)) < share * 1_000_000)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(order)))
    taken = ranked.where(F.col("rank") <= per_language).select("lang", "rank", "text")
    schema = "lang string, rank int, places array<int>, values array<double>"
    return materialize(taken.mapInArrow(_vectors, schema), "language-sample")


def _centres(sample: DataFrame) -> dict[str, np.ndarray]:
    """Mean vector of each language, at most ``MOST_LANGUAGES`` of them."""
    pairs = sample.select("lang", F.inline(F.arrays_zip("places", "values")))
    sums = pairs.groupBy("lang", "places").agg(F.sum("values").alias("total")).toPandas()
    centres = {}
    for lang, group in sums.groupby("lang"):
        centre = np.zeros(SIZE)
        centre[group["places"].to_numpy()] = group["total"]
        centres[lang] = centre / np.linalg.norm(centre)
    return centres


def group_languages(
    listed: Mapping[str, str], centres: Mapping[str, np.ndarray]
) -> dict[str, tuple[str, ...]]:
    """Families of all languages: those listed, which never join each other, and the rest by likeness.

    The two groups with the greatest mean cosine between their languages, taken from the mean of all, join as long
    as it is above zero. A new family has the name of its first language.
    """
    names = sorted(centres)
    if not names:
        return {}
    off = np.array([centres[name] for name in names])
    off = off - off.mean(axis=0)
    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-12)
    groups: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        groups.setdefault(listed.get(name, name), []).append(k)
    fixed = {listed[name] for name in names if name in listed}
    like = off @ off.T
    while True:
        pairs = [
            (float(like[np.ix_(groups[a], groups[b])].mean()), a, b)
            for a, b in itertools.combinations(sorted(groups), 2)
            if not (a in fixed and b in fixed)
        ]
        best = max(pairs, default=(0.0, "", ""), key=lambda pair: pair[0])
        if best[0] <= 1e-9:
            break
        _, a, b = best
        stays, goes = (b, a) if b in fixed else (a, b)
        groups[stays] += groups.pop(goes)
    return {name: tuple(names[k] for k in sorted(members)) for name, members in sorted(groups.items())}


def _fit_all(
    sample: DataFrame, families: Mapping[str, tuple[str, ...]], per_language: int
) -> tuple[tuple[Duel, ...], dict[str, tuple[Duel, ...]]]:
    """Every machine in one job; a task holds the texts of two sides."""
    duels: list[tuple[str | None, str, str]] = [(None, a, b) for a, b in itertools.combinations(families, 2)]
    sides = []
    for number, (_, *pair) in enumerate(duels):
        for sign, name in zip((1.0, -1.0), pair):
            most = max(1, FAMILY_SAMPLES * per_language // len(families[name]))
            sides += [(lang, number, sign, most) for lang in families[name]]
    for family, langs in families.items():
        for a, b in itertools.combinations(langs, 2):
            sides += [(a, len(duels), 1.0, per_language), (b, len(duels), -1.0, per_language)]
            duels.append((family, a, b))
    if not duels:
        return (), {}
    table = sample.sparkSession.createDataFrame(sides, "lang string, duel int, sign double, most int")
    rows = sample.join(F.broadcast(table), "lang").where(F.col("rank") <= F.col("most"))
    dealt = rows.select("duel", "sign", "places", "values").repartition(min(len(duels), 200), "duel")
    fitted = dealt.groupBy("duel").applyInPandas(_fit_duel, "duel int, weights array<double>").collect()
    found = [
        (duels[r["duel"]][0], Duel(*duels[r["duel"]][1:], np.array(r["weights"][:-1]), r["weights"][-1]))
        for r in sorted(fitted, key=lambda r: r["duel"])
    ]
    language_duels = {name: tuple(duel for family, duel in found if family == name) for name in families}
    return tuple(duel for family, duel in found if family is None), language_duels


def learn(
    labelled: DataFrame,
    families: Mapping[str, str] = FAMILIES,
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Fit on ``doc_id``, ``text``, ``lang``: at most ``per_language`` texts of each language.

    The driver receives a mean vector for each language and the weights, both bounded by ``MOST_LANGUAGES``.
    """
    sample = sample_vectors(labelled, per_language)
    members = group_languages(families, _centres(sample))
    if not members:
        return Model({}, (), {})
    return Model(members, *_fit_all(sample, members, per_language))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of the same name.

    Texts are handed to Python a hundred at a time: an Arrow batch of ten thousand whole texts is held
    several times over by each task.
    """

    @F.udf("lang_pred string, score double", useArrow=False)
    def judge(text: str | None, letter: bool) -> tuple[str, float]:
        return model.predict(text) if letter and text else (UNKNOWN, 0.0)

    kept = [name for name in docs.columns if name not in ("lang_pred", "score")]
    (judged,) = free_names(docs, "judged")
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    marked = docs.select(*kept, judge("text", letter).alias(judged))
    return marked.select(*kept, f"{judged}.lang_pred", f"{judged}.score")


def fold(doc_id: str = "doc_id"):
    """The remainder by which documents are held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: learned from the documents not held out."""
    model = learn(docs.where(fold() != 0).select("doc_id", "text", "lang"))
    marked = docs.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "text")
    return predict(marked, model).select("doc_id", "held_out", "lang_pred", "score")
