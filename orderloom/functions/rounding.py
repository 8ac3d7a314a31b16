"""Rounding rules that differ from Spark's own ``round``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLITTER = float(2**27 + 1)


def round_scaled(value: Column, places: int) -> Column:
    """``value`` rounded by multiplying out: nearest even after ``value * 10**places``, as a double.

    Vectorised numeric libraries round this way, so 1.005 gives 1.0 and 0.125 gives 0.12."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def units_exact(value: Column, scale: Column | float) -> Column:
    """The whole number nearest to the *exact* product of a double and a small power of ten.

    ``value * scale`` is split in a rounded product and its exact error (both halves of the value have at
    most 27 bits, so their products with the small scale are exact); the error settles values that look like
    ties. A true tie goes to the even neighbour. This is correctly rounded decimal output."""
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    value = value.cast("double")
    spread = value * F.lit(_SPLITTER)
    high = spread - (spread - value)
    low = value - high
    product = value * scale
    error = (high * scale - product) + low * scale
    below = F.floor(product)
    beyond_half = (product - below.cast("double") - F.lit(0.5)) + error
    up = (beyond_half > 0) | ((beyond_half == 0) & (below % 2 != 0))
    return below + up.cast("bigint")


def round_exact(value: Column, places: int) -> Column:
    """Correctly rounded ``value`` (see :func:`units_exact`) as a double."""
    return units_exact(value, 10**places).cast("double") / F.lit(float(10**places))
