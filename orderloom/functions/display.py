"""Text forms of figures for dashboards."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderloom.functions.rounding import units_exact

# Currency sign and the steps of the short number forms.
RUPEE = "₹"
CRORE, LAKH, THOUSAND = 10_000_000.0, 100_000.0, 1000.0


def _stepped(value: Column, steps: tuple[tuple[float, str], ...], small: Column) -> Column:
    """One decimal place and the suffix of the first step ``value`` reaches, or ``small`` below all of them."""
    divisor = suffix = F
    for step, name in steps:
        reached = value >= step
        divisor, suffix = divisor.when(reached, F.lit(step)), suffix.when(reached, F.lit(name))
    tenths = units_exact(value / divisor, 10)
    return F.coalesce(F.concat((tenths.cast("decimal(20,0)") / 10).cast("decimal(20,1)").cast("string"), suffix), small)


def format_currency(value: Column) -> Column:
    """``₹1.2Cr``, ``₹1.2L``, ``₹1.2K`` or ``₹12``."""
    value = value.cast("double")
    whole = units_exact(value, 1).cast("string")
    return F.concat(F.lit(RUPEE), _stepped(value, ((CRORE, "Cr"), (LAKH, "L"), (THOUSAND, "K")), whole))


def format_number(value: Column) -> Column:
    """``1.2L``, ``1.2K`` or the integer."""
    return _stepped(value.cast("double"), ((LAKH, "L"), (THOUSAND, "K")), value.cast("bigint").cast("string"))


def short_label(text: Column, width: int = 30) -> Column:
    return F.substring(text, 1, width)


def short_id(text: Column, width: int = 8) -> Column:
    return F.concat(F.substring(text, 1, width), F.lit("..."))


def format_amount(value: Column) -> Column:
    """``₹1,234.50``."""
    return F.concat(F.lit(RUPEE), F.format_number(value, 2))


def format_time(moment: Column) -> Column:
    """``05 Jan 13:45``."""
    return F.date_format(moment, "dd MMM HH:mm")
