"""Short texts as whole numbers in the same order, so that a hash table can keep their maximum.

The number holds up to seven bytes, left aligned, and their count in the last three bits: order and length
are those of the bytes, and the text comes back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST = 7
_LENGTH_BITS = 3


def to_code(text: Column) -> Column:
    """The number of ``text``; a text of more than ``LONGEST`` bytes fails."""
    size = F.octet_length(text)
    # One plain letter, the usual case, needs no hexadecimal digits.
    letter = F.shiftleft(F.ascii(text).cast("bigint"), 8 * (LONGEST - 1))
    digits = F.rpad(F.hex(text.cast("binary")), 2 * LONGEST, "0")
    aligned = F.when(size == 1, letter).otherwise(F.conv(digits, 16, 10).cast("bigint"))
    cut = F.raise_error(F.concat(F.lit("longer than 7 bytes: "), text)).cast("bigint")
    return F.when(size > LONGEST, cut).otherwise(F.shiftleft(aligned, _LENGTH_BITS) + size)


def to_text(code: Column) -> Column:
    size = code.bitwiseAND((1 << _LENGTH_BITS) - 1).cast("int")
    digits = F.lpad(F.hex(F.shiftright(code, _LENGTH_BITS)), 2 * LONGEST, "0")
    return F.decode(F.unhex(F.substring(digits, F.lit(1), 2 * size)), "UTF-8")
