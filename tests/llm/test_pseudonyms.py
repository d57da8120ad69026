from __future__ import annotations

import random
import re

import pytest

from fungo.llm import pseudonyms as p

KEY = b"test key"
SCHEMA = "doc_id long, text string, n_card string, key int"
VALUES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "378282246310005", "5500-0000-0000-0004"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "ssn": ["219-09-9999", "001-01-0001", "899-99-9999"],
    "phone": ["+1 (017) 555-7713", "(212) 555-0123", "212-555-0123", "+1 212 555 0123"],
    "ipv4": ["97.51.17.173", "8.8.8.8", "255.255.255.255", "0.0.0.0"],
    "date": ["2021-02-28", "28.02.2021", "02/28/2021", "1900-01-01", "2099-12-31"],
    "email": ["desleleenpa.90@mail2.example.com", "A.b+9@x.org"],
}
LEFT = [
    "4111111111111112", "9807915762804490", "2021-02-30", "32.01.2020", "256.1.1.1", "666-12-1234",
    "DE88370400440532013000", "12345678901234567890", "1.2.3.4.5", "3.14", "v2.0.4", "no values @ all",
]


def turned(text, back=False):
    counts = {}
    return p.rewrite(text, p.Turner(KEY, back), counts), counts


@pytest.mark.parametrize("kind", VALUES)
def test_values_keep_format_and_turn_back(kind):
    for value in VALUES[kind]:
        for left, right in (("", ""), ("say ", ", so"), ("(", ")"), ("é ", "!!"), ("a|", "***")):
            new, counts = turned(f"{left}{value}{right}")
            assert counts == {kind: 1}, value
            new = new[len(left) : len(new) - len(right)]
            assert new != value
            if kind != "ipv4":
                shape = lambda x: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", x)))
                assert shape(new) == shape(value)
            assert turned(new) [1] == {kind: 1}
            assert turned(new, back=True)[0] == value


def test_numbers_that_fail_their_check_stay():
    for value in LEFT:
        assert turned(f"see {value} here") == (f"see {value} here", {}), value


BESIDE = [
    ("DE89370400440532013000", "", " BIC COBADEFF", "iban"),
    ("DE89 3704 0044 0532 0130 00", "", " 12 BIC", "iban"),
    ("GB82 WEST 1234 5698 7654 32", "IBAN ", " UNTIL 2030", "iban"),
    ("4111 1111 1111 1111", "", " 123", "card"),
    ("4111111111111111", "12 ", "", "card"),
    ("4111111111111111", "12 ", " 7", "card"),
    ("4111 1111 1111 1111", "1234 ", " 9", "card"),
    ("5500-0000-0000-0004", "12 ", " 123", "card"),
    ("4111 1111 1111 1111", "AB12 ", "", "card"),
    ("2021-02-28", "", " 10 15 31", "date"),
    ("desleleenpa@example.com", "", "", "email"),
    ("DE89ABCDEFGHIJKLM@example.com", "", "", "email"),
]


@pytest.mark.parametrize("value, left, right, kind", BESIDE)
def test_values_beside_words_and_numbers_are_found_and_turn_back(value, left, right, kind):
    for key in range(40):
        counts, back = {}, {}
        new = p.rewrite(left + value + right, p.Turner(b"%d" % key), counts)
        assert counts == {kind: 1}
        assert new.startswith(left) and new.endswith(right) and value not in new
        assert p.rewrite(new, p.Turner(b"%d" % key, True), back) == left + value + right


@pytest.mark.parametrize(
    "value", ["3/4/2024", "3/14/2024", "12/5/2024", "03/4/2024", "3/04/2024", "2024-1-5", "5.1.2024", "31.1.2024"]
)
def test_dates_with_one_digit_keep_their_form_and_turn_back(value):
    form = lambda text: [(len(part), part[0] == "0") for part in re.split("[-/.]", text)]
    for key in range(60):
        turner, counts = p.Turner(b"%d" % key), {}
        new = p.rewrite(f"on {value}, at", turner, counts)[3:-4]
        assert counts == {"date": 1} and form(new) == form(value)
        assert p.rewrite(new, p.Turner(b"%d" % key, True), {}) == value


def test_a_time_may_follow_a_date():
    for rest in ("T10:00:00", "T10:00:00Z", "T23:59"):
        new, counts = turned(f"2024-02-29{rest}")
        assert counts == {"date": 1} and new.endswith(rest) and not new.startswith("2024-02-29")
        assert turned(new, back=True)[0] == f"2024-02-29{rest}"
    for left in ("2024-02-29Tx", "2024-02-29T", "2024-02-291", "012/01/2024", "1/2/24"):
        assert turned(left) == (left, {})


def test_every_value_is_found_at_any_place(spark):
    """Each value, among random words and signs and others, is turned as it is by itself."""
    rng = random.Random(8)
    values = [value for group in VALUES.values() for value in group]
    rows, expected = [], []
    for k in range(400):
        chosen = [rng.choice(values) for _ in range(rng.randint(0, 4))]
        words = [rng.choice(["so", "é", "und.", "(x)", "*", "\n"]) for _ in range(len(chosen) + 1)]
        text = "".join(f"{word} {value}, " for word, value in zip(words, chosen)) + words[-1]
        rows.append((k, text, "x", 1))
        plain = "".join(f"{word} {turned(value)[0]}, " for word, value in zip(words, chosen)) + words[-1]
        expected.append(plain)
    found = p.pseudonymize(spark.createDataFrame(rows, SCHEMA), KEY).collect()
    assert [row.text for row in sorted(found)] == expected


def test_equal_numbers_stay_linked_across_forms():
    digits = [re.sub(r"\D", "", turned(v)[0])[-10:] for v in ("+1 (212) 555-0123", "212-555-0123")]
    assert digits[0] == digits[1]
    days = [turned(v)[0] for v in ("2021-02-28", "28.02.2021")]
    assert "".join(days[0].split("-")) == "".join(reversed(days[1].split(".")))


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_network_is_a_permutation(size):
    network = p.Feistel(KEY, "t", size)
    image = [network.forward(k) for k in range(size)]
    assert sorted(image) == list(range(size))
    assert [network.backward(k) for k in image] == list(range(size))


def test_tables(spark):
    rng = random.Random(3)
    rows = [(k, f"word {rng.choice(VALUES[kind])} word", "x", 1) for k, kind in enumerate(list(VALUES) * 3)]
    rows += [(100, None, None, None), (101, "", "x", 1), (None, "8.8.8.8", "x", 1), rows[0], rows[0]]
    rows += [(102, "long text " * 40_000 + " 8.8.8.8", "x", 1), (103, "clean words only.", "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = p.pseudonymize(frame, KEY).collect()
    assert [row.doc_id for row in found] == [row[0] for row in rows]
    for row, (_, text, _, _) in zip(found, rows):
        counts = {}
        expected = p.rewrite(text, p.Turner(KEY), counts) if text else text
        assert row.text == expected and row.n_values == sum(counts.values())
        assert {k: row[f"n_{k}"] for k in p.KINDS if row[f"n_{k}"]} == counts
    back = p.pseudonymize(p.pseudonymize(frame, KEY), KEY, back=True).collect()
    assert [row.text for row in back] == [row[1] for row in rows]
    column = p.pseudonymize_column(frame, KEY)
    assert column.columns == frame.columns
    assert [row.text for row in column.collect()] == [row.text for row in found]


def test_empty_table(spark):
    assert p.pseudonymize(spark.createDataFrame([], SCHEMA), KEY).collect() == []
