"""Lenient parsing of delimited text: a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace stripped from both ends of a field, and endings and prefixes with
# which a cast would read more than a plain numeral.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029"
    "\u202f\u205f\u3000"
)
NOT_A_NUMERAL = r"(?iU)[0-9.][df]\s*$|0x"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def to_long(text: Column) -> Column:
    """A whole number. A cast ignores ASCII blanks; other blanks are tried only if it fails."""
    return F.coalesce(text.try_cast("bigint"), strip(text).try_cast("bigint"))


def to_double(text: Column) -> Column:
    """Decimal numerals, ``nan`` and ``inf``; type suffixes and hexadecimals do not count."""
    value = F.coalesce(text.try_cast("double"), strip(text).try_cast("double"))
    return F.when(~text.rlike(NOT_A_NUMERAL), value)


def field(fields: Column, position: int) -> Column:
    """The field at a zero-based position, null when the line is too short."""
    return F.get(fields, position)


def fields_of(line: Column) -> Column:
    """All fields of a line, split on ``::`` where the line has one and on commas otherwise."""
    return F.when(line.contains("::"), F.split(line, "::", -1)).otherwise(F.split(line, ",", -1))


def split_list(text: Column, separator: str = "|") -> Column:
    """Text to an array: parts trimmed, empty parts dropped."""
    parts = F.split(text, rf"\Q{separator}\E", -1)
    return F.filter(F.transform(parts, strip), lambda part: part != "")
