"""Personal numbers, dates and addresses replaced by keyed pseudonyms of the same format.

A value that passes its check is read as a number below the count of all valid values of its kind,
permuted there by a keyed Feistel network, and written back into the places the value came from:
separators, country code, number of digits and check digits stay valid. The permutation is one to one,
so equal values get equal pseudonyms in every document and different values different ones, and who holds
the key can turn them back. Nothing is looked up or stored, so no shuffle is needed and a lost task can be
repeated anywhere.

Kinds: IBAN (check digits), card numbers of 13 to 19 digits (Luhn), US social security numbers (ranges),
North American phone numbers (form), IPv4 addresses (bytes), dates from 1900 to 2099 (calendar), e-mail local
parts (form). Numbers that fail their check, as order numbers do, stay. A date that writes day or month with
one digit is permuted among the dates written like it, so it is linked to those, not to the same day
with two digits. A time may follow a date behind ``T``.

Where an IBAN or card number and what follows or precedes it after a space read as one value that fails, every
shorter value between spaces is tried, an IBAN of its country's length first, and other kinds inside. Should
a new value make a failed one valid, it is permuted once more, so that it can still be turned back;
only then do equal values differ between texts. Where two replaced values are part of one that failed, turning
back is not assured.

Null text stays null, empty text empty. Text without such values comes back unchanged. Rows are
returned as they come, repeated or not; whole texts are read.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("iban", "card", "ssn", "phone", "ipv4", "date", "email")
DEMO_KEY = b"not a secret: give your own key"


class Feistel:
    """A keyed permutation of 0 .. size - 1: a balanced network over enough bits, walked until inside."""

    def __init__(self, key: bytes, tweak: str, size: int) -> None:
        self._size = size
        self._half = max(1, ((size - 1).bit_length() + 1) // 2)
        self._mask = (1 << self._half) - 1
        # With every size its own permutation, equal digits of different formats are not alike.
        self._keyed = hashlib.blake2b(f"{tweak}/{size}".encode(), key=key, digest_size=32).digest()

    def _round(self, step: int, half: int) -> int:
        width = (self._half + 7) // 8
        message = bytes([step]) + half.to_bytes(width, "little")
        digest = hashlib.blake2b(message, key=self._keyed, digest_size=max(8, width)).digest()
        return int.from_bytes(digest, "little") & self._mask

    def _pass(self, value: int, steps: range, back: bool) -> int:
        left, right = value >> self._half, value & self._mask
        for step in steps:
            if back:
                left, right = right ^ self._round(step, left), left
            else:
                left, right = right, left ^ self._round(step, right)
        return left << self._half | right

    def _walk(self, value: int, steps: range, back: bool) -> int:
        while True:
            value = self._pass(value, steps, back)
            if value < self._size:
                return value

    def forward(self, value: int) -> int:
        return self._walk(value, range(ROUNDS), False)

    def backward(self, value: int) -> int:
        return self._walk(value, range(ROUNDS - 1, -1, -1), True)


def luhn_sum(digits: str) -> int:
    """0 if the last digit checks."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        doubled = int(digit) * (1 + place % 2)
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10


def _refill(template: str, digits: str) -> str:
    """``template`` with its digits replaced in order."""
    following = iter(digits)
    return "".join(next(following) if char.isdigit() else char for char in template)


Turn = Callable[[str, int, int], int]  # (tweak, size, value) -> value


def _card(value: str, turn: Turn) -> str | None:
    """All digits but the last are permuted; the last checks again."""
    digits = re.sub(r"\D", "", value)
    if len(digits) < 13 or luhn_sum(digits):
        return None
    body = f"{turn('card', 10 ** (len(digits) - 1), int(digits[:-1])):0{len(digits) - 1}d}"
    return _refill(value, f"{body}{-luhn_sum(body + '0') % 10}")


def _iban_check(country: str, account: str) -> int:
    number = "".join(str(int(char, 36)) for char in f"{account}{country}00")
    return 98 - int(number) % 97


# Characters of an IBAN by country.
_IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
        32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def _iban(value: str, turn: Turn) -> str | None:
    """The digits of the account are permuted, its letters stay, the check digits are made anew."""
    compact = value.replace(" ", "")
    country, check, account = compact[:2], compact[2:4], compact[4:]
    if not 11 <= len(account) <= 30 or int(check) != _iban_check(country, account):
        return None
    digits = re.sub(r"\D", "", account)
    if not digits:
        return None
    turned = f"{turn(f'iban {country}', 10 ** len(digits), int(digits)):0{len(digits)}d}"
    account = _refill(account, turned)
    following = iter(f"{country}{_iban_check(country, account):02d}{account}")
    return "".join(char if char == " " else next(following) for char in value)


def _phone(found: re.Match, turn: Turn) -> str | None:
    """Ten digits behind the country code, permuted as one number."""
    prefix, rest = found["country"] or "", found["number"]
    digits = re.sub(r"\D", "", rest)
    return prefix + _refill(rest, f"{turn('phone', 10**10, int(digits)):010d}")


def _ssn(found: re.Match, turn: Turn) -> str | None:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area, group, serial = (int(part) for part in found[0].split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(turn("ssn", 898 * 99 * 9999, rank), 9999)
    area, group = divmod(rank, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(found: re.Match, turn: Turn) -> str | None:
    parts = [int(part) for part in found[0].split(".")]
    if max(parts) > 255:
        return None
    value = turn("ipv4", 1 << 32, int.from_bytes(bytes(parts), "big"))
    return ".".join(str(part) for part in value.to_bytes(4, "big"))


FIRST_DAY = datetime.date(1900, 1, 1)
DAYS = (datetime.date(2100, 1, 1) - FIRST_DAY).days


@functools.lru_cache(maxsize=16)
def _days_written(month: str, day: str) -> list[int]:
    """Ranks of the days whose month and day have these forms: ``3``, ``03`` or ``12``."""
    held = {"3": range(1, 10), "03": range(1, 10), "12": range(10, 32)}
    dates = (FIRST_DAY + datetime.timedelta(days=rank) for rank in range(DAYS))
    return [rank for rank, date in enumerate(dates) if date.month in held[month] and date.day in held[day]]


def _form(part: str) -> str:
    return "3" if len(part) == 1 else "03" if part[0] == "0" else "12"


def _date(found: re.Match, turn: Turn) -> str | None:
    """A calendar day from 1900 to 2099. Year first, else day first after points, month first after slashes."""
    a, mark, b, c = found["a"], found["mark"], found["b"], found["c"]
    year_first = len(a) == 4
    year, month, day = (a, b, c) if year_first else (c, b, a) if mark == "." else (c, a, b)
    if len(month) > 2 or len(day) > 2:
        return None
    try:
        rank = (datetime.date(int(year), int(month), int(day)) - FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= rank < DAYS:
        return None
    if len(month) == len(day) == 2:
        rank = turn("date", DAYS, rank)
    else:
        forms = _form(month), _form(day)
        alike = _days_written(*forms)
        rank = alike[turn(f"date {forms[0]} {forms[1]}", len(alike), bisect.bisect_left(alike, rank))]
    new = FIRST_DAY + datetime.timedelta(days=rank)
    year, month, day = f"{new.year:04d}", f"{new.month:0{len(month)}d}", f"{new.day:0{len(day)}d}"
    parts = (year, month, day) if year_first else (day, month, year) if mark == "." else (month, day, year)
    return mark.join(parts)


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ALPHABET_OF = {char: alphabet for alphabet in _ALPHABETS for char in alphabet}


def _email(found: re.Match, turn: Turn) -> str | None:
    """Letters and digits of the local part, permuted within their classes; signs and domain stay."""
    local, domain = found[0].rsplit("@", 1)
    alphabets = [_ALPHABET_OF[char] for char in local if char in _ALPHABET_OF]
    if not alphabets:
        return None
    value, size = 0, 1
    for char in local:
        if char in _ALPHABET_OF:
            alphabet = _ALPHABET_OF[char]
            value, size = value * len(alphabet) + alphabet.index(char), size * len(alphabet)
    shape = "".join("dlu"[_ALPHABETS.index(alphabet)] for alphabet in alphabets)
    value = turn(f"email {shape} {domain.lower()}", size, value)
    turned = []
    for alphabet in reversed(alphabets):
        value, place = divmod(value, len(alphabet))
        turned.append(alphabet[place])
    following = iter(reversed(turned))
    return "".join(next(following) if char in _ALPHABET_OF else char for char in local) + "@" + domain


_CHECKED = {"iban": _iban, "card": _card}
_WRITE = {"ssn": _ssn, "phone": _phone, "ipv4": _ipv4, "date": _date, "email": _email}

# One scan finds every kind. The sides keep out longer numbers, versions and identifiers.
_SIDE = r"(?<![0-9A-Za-z_])(?<![0-9][-/.])"
_IBAN = r"(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![0-9A-Za-z_])"
_CARD = r"(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![0-9A-Za-z_]|-[0-9])"
_NUMBERS = (
    r"(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z_]|-[0-9])"
    r"|(?P<phone>(?P<country>\+?1[ .-]?)?(?P<number>(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}))"
    r"(?![0-9A-Za-z_]|-[0-9])"
)
_OTHERS = (
    r"(?P<date>(?P<a>[0-9]{1,4})(?P<mark>[-/.])(?P<b>[0-9]{1,2})(?P=mark)(?P<c>[0-9]{1,4}))"
    r"(?![0-9A-SU-Za-z_]|T(?![0-9]{2}:)|[-/.][0-9])"
    r"|(?P<ipv4>(?:[0-9]{1,3}\.){3}[0-9]{1,3})(?![0-9A-Za-z_]|\.[0-9])"
    r"|(?P<email>[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})(?![0-9A-Za-z_])"
)
_FIND = re.compile(f"{_SIDE}(?:{_IBAN}|{_NUMBERS}|{_CARD}|{_OTHERS})")
# What else may begin where an IBAN or a card number fails.
_FIND_OTHER = re.compile(f"{_SIDE}(?:{_OTHERS})")
# Texts without an at sign or two neighbouring digits hold nothing to replace.
_WORTH = re.compile(r"@|[0-9][0-9]|[0-9][/.-][0-9]").search


def _same(tweak: str, size: int, value: int) -> int:
    return value


def _ends(kind: str, value: str) -> list[int]:
    """Lengths at which a value that may be followed by others can end: the likeliest first."""
    ends = [len(value), *(at for at in range(len(value) - 1, 0, -1) if value[at] == " ")]
    if kind == "iban":
        length = _IBAN_LENGTHS.get(value[:2])
        ends.sort(key=lambda end: end - value.count(" ", 0, end) != length)
    return ends


def rewrite(text: str, turn: Turn, counts: dict[str, int]) -> str:
    """``text`` with every valid value turned; adds to ``counts`` by kind."""
    if not _WORTH(text):
        return text
    parts: list[str] = []
    done = at = 0
    failed: list[tuple[str, int, int]] = []  # (kind, start, end) of checks that may read what comes next

    def put(kind: str, start: int, end: int, new: str, write: Callable[[str], str]) -> None:
        nonlocal done, at
        while any(
            _CHECKED[other](f"{text[a:start]}{new}{text[end:b]}"[: b - a], _same) for other, a, b in failed
        ):
            new = write(new)
        counts[kind] = counts.get(kind, 0) + 1
        parts.extend((text[done:start], new))
        done = at = end

    def checked(kind: str, start: int, value: str) -> bool:
        write = _CHECKED[kind]
        for length in _ends(kind, value):
            end = start + length
            new = write(text[start:end], turn)
            if new is None:
                failed.append((kind, start, end))
                continue
            put(kind, start, end, new, lambda value: write(value, turn))
            return True
        return False

    while found := _FIND.search(text, at):
        kind = next(kind for kind in KINDS if found[kind] is not None)
        start, end = found.span()
        failed = [span for span in failed if span[2] > start]
        if kind in _CHECKED:
            if checked(kind, start, found[0]):
                continue
            # The next value may begin behind the next space.
            at = text.find(" ", start, end) + 1 or end
            found = _FIND_OTHER.match(text, start)
            if found is None:
                continue
            kind, end = next(kind for kind in KINDS if found.groupdict().get(kind) is not None), found.end()
        new = _WRITE[kind](found, turn)
        if new is not None:
            put(kind, start, end, new, lambda value, kind=kind: _WRITE[kind](_FIND.fullmatch(value), turn))
        else:
            at = max(at, end)
    parts.append(text[done:])
    return "".join(parts)


class Turner:
    """Permutes values under one key, or turns them back."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self._key, self._back = key, back
        self._networks: dict[tuple[str, int], Feistel] = {}

    def __call__(self, tweak: str, size: int, value: int) -> int:
        network = self._networks.get((tweak, size))
        if network is None:
            if len(self._networks) > 4096:
                self._networks.clear()
            network = self._networks[tweak, size] = Feistel(self._key, tweak, size)
        return network.backward(value) if self._back else network.forward(value)


def pseudonymize(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``doc_id``, ``text`` and how many values of each kind were replaced (``n_card`` ... and ``n_values``).

    ``back=True`` restores the values from pseudonyms made with the same key.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turner = Turner(key, back)
        for batch in batches:
            texts, counted = [], []
            for value in batch.column(1):
                counts: dict[str, int] = {}
                text = value.as_py()
                texts.append(rewrite(text, turner, counts) if text else text)
                counted.append(counts)
            columns = [batch.column(0), pa.array(texts, pa.string())]
            columns += [pa.array([c.get(kind, 0) for c in counted], pa.int64()) for kind in KINDS]
            columns.append(pa.array([sum(c.values()) for c in counted], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names)

    counts = [*(f"n_{kind}" for kind in KINDS), "n_values"]
    names = ["doc_id", "text", *counts]
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    schema = "doc_id long, text string, " + ", ".join(f"{name} long" for name in counts)
    return chosen.mapInArrow(turn, schema)


def pseudonymize_column(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with the values in ``text`` replaced; every other column as it is."""

    @F.pandas_udf("string")
    def turned(texts: pd.Series) -> pd.Series:
        turner = Turner(key)
        return texts.map(lambda value: rewrite(value, turner, {}) if value else value)

    return docs.withColumn(text, turned(F.col(text)))
