from __future__ import annotations

import random
import re

import pytest

from fungo.llm import host_rules as h
from fungo.llm.texts import ORACLE

SCHEMA = "doc_id long, text string, source string, host int, n long, words string"


def plain_signals(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), sum(c in h.SYMBOLS for c in text),
        len(lines), len(lines) - len(set(lines)), len(covered),
    )


def plain_verdicts(rows):
    """Host to failed, by the formulas of the beta prior written out."""
    hosts = {}
    for _, text, source, *_ in rows:
        n_words, chars, symbols, lines, dup, repeat = plain_signals(text)
        fails = (n_words < 10, 100 * repeat > 20 * n_words, 10 * symbols > chars, 10 * dup > 3 * lines)
        hosts.setdefault(source, []).append(fails)
    failed = dict.fromkeys(hosts, False)
    for rule in range(4):
        n = {host: len(rows) for host, rows in hosts.items()}
        f = {host: sum(row[rule] for row in rows) for host, rows in hosts.items()}
        docs, k = sum(n.values()), len(hosts)
        mean = sum(f.values()) / docs
        spread = k * sum(n[x] * (f[x] / n[x] - mean) ** 2 for x in n) / ((k - 1) * docs) if k > 1 else 0
        noise = mean * (1 - mean) * sum(1 / n[x] for x in n) / k
        for host in hosts:
            rate = mean
            if spread > noise:
                weight = max(mean * (1 - mean) - spread, 0) / (spread - noise)
                rate = (f[host] + mean * weight) / (n[host] + weight)
            failed[host] |= rate > h.MAX_RATE
    return failed


def test_equals_brute_force(spark):
    rng = random.Random(8)
    words = ["a", "bb", "é", "#x", "|", "ccc", "z\x1c"]
    say = lambda n: rng.choice([" ", "  ", "\t", "\n"]).join(rng.choice(words) for _ in range(n))
    rows = []
    for k in range(150):
        host = rng.choice(["hot", "hot", "hot", "h1", "h2", None, "spam"])
        text = say(rng.randint(0, 12)) if host == "spam" else f"{' '.join(f'u{k}-{j}' for j in range(20))} {say(rng.randint(0, 25))}"
        rows.append((k, text, host, 1, 2, "x"))
    rows += [(500, None, "h1", 1, 1, None), (501, "", "new", 1, 1, ""), (None, "one\none\none", "h2", 1, 1, "")]
    rows += [(502, "word " * 30_000, "h1", 1, 1, ""), rows[0], rows[0], (503, "solo " * 4, "alone", 1, 1, "")]
    rows += [(504, " \n \n\x0b\n", "h1", 1, 1, "")]
    found = h.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    verdicts = plain_verdicts(rows)
    assert len(found) == len(rows) and verdicts["spam"] and not verdicts["hot"]
    by_id = {row.doc_id: row for row in found}
    for doc, text, source, *_ in rows:
        row = by_id[doc]
        signals = plain_signals(text) if len(text or "") < 10_000 else (30_000, 120_000, 0, 1, 0, 30_000)
        assert signals == (
            row.n_words, row.word_chars, row.n_symbols, row.n_lines, row.n_dup_lines, row.n_repeat_words
        ), text
        base = signals[0] < 10 or 100 * signals[5] > 20 * signals[0]
        assert row.base_failed == base and row.kept == (not base and not verdicts[source])


def test_shrinking_spares_small_hosts(spark):
    good = " ".join(f"w{k}" for k in range(12))
    rows = [(k, good, f"h{k % 30}", 1, 1, "") for k in range(3000)]
    rows += [(9000 + k, "short", f"h{k % 30}", 1, 1, "") for k in range(300)]
    rows += [(9500, "short", "tiny", 1, 1, "")] + [(9600 + k, "short", "bad", 1, 1, "") for k in range(200)]
    rates = h.host_rates(h.document_signals(spark.createDataFrame(rows, SCHEMA)))
    failed = {r.host for r in h.host_verdicts(rates).where("host_failed").collect()}
    assert "bad" in failed and not any(host.startswith("h") for host in failed)
    shrunk = {r.host: r.shrunk_rate for r in rates.where("rule = 'too_short'").collect()}
    assert shrunk["tiny"] < 1.0 and shrunk["bad"] > 0.9


def test_empty_table(spark):
    assert h.judge(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    from fungo.llm.queries import QUERIES
    from tests.compare import connect, differences

    assert differences(connect(sf_dir), ORACLE[name], QUERIES[name](spark, sf_dir)) == []
