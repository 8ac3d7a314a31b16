"""Lenient conversions of text fields: what cannot be read becomes NULL, never an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from orderloom.functions.rounding import round_scaled
from orderloom.schemas import MONEY

# A plain decimal or an infinity. Spark's own cast would also take a type suffix such as ``1d``.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
# Every character that counts as white space when text is stripped.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_VISIBLE = (33, 126)
MISSING_TEXT = "None"


def timestamp_or_null(text: Column) -> Column:
    """ISO-8601 text, with or without a fraction, each row read by itself."""
    return text.try_cast("timestamp_ntz")


def number_or_null(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def money_or_null(number: Column) -> Column:
    """Two places, by the multiply-out rule. Infinite or too large amounts become NULL."""
    return round_scaled(number, 2).try_cast(MONEY)


def whole_or_null(number: Column) -> Column:
    """Integer nearest to ``number``, halves away from zero; NULL when out of range."""
    return F.round(number).try_cast("int")


def stripped_text(text: Column) -> Column:
    """Text without white space at its ends; a missing value becomes the word ``None``.

    Most text begins and ends with a visible ASCII character and is not searched."""
    ends = (F.ascii(end).between(*_VISIBLE) for end in (text, F.substring(text, -1, 1)))
    stripped = F.when(reduce(Column.__and__, ends), text).otherwise(F.btrim(text, F.lit(_SPACES)))
    return F.coalesce(stripped, F.lit(MISSING_TEXT))


def truth(text: Column) -> Column:
    """Booleans and the words for them; otherwise non-zero numbers and non-empty text are true, NULL false."""
    return F.coalesce(text.try_cast("boolean"), number_or_null(text) != 0, F.length(text) > 0, F.lit(False))
