from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fungo.llm.line_dedup import LineRuns, drop_shared_lines, line_keys
from fungo.llm.queries import op12_line_dedup

SCHEMA = "doc_id long, text string"
BLANKS = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows: list[tuple], least_points: int = 40, least_docs: int = 5) -> list[tuple]:
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_points:
                holders[key_of(line)].add(-(1 << 63) if doc_id is None else doc_id)
    gone = {key: max(docs) for key, docs in holders.items() if len(docs) >= least_docs}
    result = []
    for doc_id, text in rows:
        own = -(1 << 63) if doc_id is None else doc_id
        lines = (text or "").split("\n")
        kept = [line for line in lines if gone.get(key_of(line), own) == own]
        joined = "\n".join(kept)
        result.append(
            (doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(joined.encode()).hexdigest(), joined)
        )
    return result


def drawn(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    common = [f"line {k} " + "wörd " * rng.randrange(4, 12) for k in range(30)]
    rows = []
    for k in range(n):
        lines = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(common) if rng.random() < 0.8 else f"own {rng.random()} " + "x" * rng.randrange(60)
            line = line.upper() if rng.random() < 0.2 else line
            lines.append(rng.choice(["", " ", "\t"]) + line + rng.choice(["", "  ", "\r"]))
        rows.append((k * 7 - 100, "\n".join(lines)))
    return rows


def got(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.mark.parametrize("batches,fan_out", [(1, 4), (8, 4), (7, 2)])
def test_equals_counting_plainly(spark, batches, fan_out):
    rows = drawn(200, 5)
    cut = drop_shared_lines(spark.createDataFrame(rows, SCHEMA), batches=batches, fan_out=fan_out)
    expected = sorted(plain(rows), key=str)
    assert got(cut) == expected
    assert sum(row[2] for row in expected) > 50


def test_odd_rows(spark):
    shared = "A line that is long enough to count as one of many."
    rows = [(k, shared) for k in range(4)]
    assert all(row[2] == 0 for row in plain(rows))
    rows += [(None, f"{shared}\nmore"), (None, "other"), (None, None), (9, ""), (10, None), (11, "\n\n")]
    rows += [(3, shared), (3, f"different text\n{shared.lower()}"), (12, "é" * 39), (13, "é" * 40)]
    rows += [(k, "É" * 40 + "\x85") for k in range(20, 26)] + [(k, "é" * 40) for k in range(26, 29)]
    rows += [(40, f"{shared}\n{shared} \nend")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as doc", "2 as part", "3 as h", "4 as batch")
    expected = sorted(plain(rows), key=str)
    assert got(drop_shared_lines(docs)) == expected
    by_id = {(row[0], row[4]): row for row in expected}
    assert by_id[(None, "more")][2] == 1 and by_id[(40, f"{shared}\n{shared} \nend")][2] == 0


def test_a_third_of_the_rows_alike(spark):
    shared = "The same passage stands in very many of these documents."
    rows = [(7, f"{shared}\n{shared}")] * 60 + [(k, f"{k}\n{shared}") for k in range(10, 90)] + drawn(40, 1)
    assert got(drop_shared_lines(spark.createDataFrame(rows, SCHEMA))) == sorted(plain(rows), key=str)


def test_very_long_text(spark):
    long = "\n".join(f"line number {k % 5000} of a very long text that never ends" for k in range(20_000))
    rows = [(k, long) for k in range(5)] + [(9, "x" * 3_000_000)]
    assert got(drop_shared_lines(spark.createDataFrame(rows, SCHEMA))) == sorted(plain(rows), key=str)


def test_empty_table(spark):
    assert drop_shared_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_are_levelled_and_settled_keys_not_written_again(spark):
    line = "this line is in every document of the corpus, surely"
    runs = LineRuns(spark, least_docs=5, fan_out=3)

    def batch(first: int) -> None:
        rows = [(k, f"{line}\nown line of document number {k:06d}, unlike others") for k in range(first, first + 6)]
        runs.add(line_keys(spark.createDataFrame(rows, SCHEMA)))

    shapes = []
    for first in (900, 800, 700, 600):
        batch(first)
        shapes.append([len(level) for level in runs.levels])
    assert shapes == [[1], [2], [0, 1], [1, 1]]
    newest = runs.runs()[0]
    assert newest.count() == 6 and newest.agg(F.max("n_docs")).first()[0] == 1
    assert runs.merged().count() == 25
    (shared,) = runs.shared().collect()
    assert shared.last_doc == 905
    batch(1000)
    assert [row.last_doc for row in runs.shared().collect()] == [1005]
    (name, _) = runs.levels[0][0]
    sizes = spark.sql(f"describe extended {name}").where("col_name in ('Num Buckets', 'Sort Columns')").collect()
    assert sorted(row.data_type for row in sizes) == ["4", "[`h`, `g`]"]
    runs.forget()
    assert runs.runs() == []


def test_query(spark, tmp_path):
    rows = drawn(120, 9)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_line_dedup(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert got(found) == sorted((row[:4] for row in plain(rows)), key=str)
