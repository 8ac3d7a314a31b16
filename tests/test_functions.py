import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom.functions import coerce, display
from orderloom.functions.rounding import round_exact, round_scaled


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in df.select(expression(F.col("x"))).collect()]


def test_rounding_rules(spark):
    rng = random.Random(1)
    values = [1.005, 0.125, 0.375, 2.675, 0.045, 0.135, 1.15, 0.004, -1.005, 0.0, 5e-324]
    values += [rng.randint(0, 10**7) * 18 / 10000 for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(2000)]
    assert column(spark, values, "double", lambda x: round_exact(x, 2)) == [round(v, 2) for v in values]
    assert column(spark, values, "double", lambda x: round_scaled(x, 2)) == list(np.round(np.array(values), 2))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0, 1e10), min_size=20, max_size=200))
def test_exact_rounding_of_any_amount(spark, values):
    assert column(spark, values, "double", lambda x: round_exact(x, 1)) == [round(v, 1) for v in values]


def currency(value):
    for step, suffix in ((10_000_000, "Cr"), (100_000, "L"), (1000, "K")):
        if value >= step:
            return f"₹{value / step:.1f}{suffix}"
    return f"₹{value:.0f}"


def test_currency_and_number_formats(spark):
    values = [0.0, 0.5, 1.5, 2.5, 999.5, 1000.0, 1050.0, 1150.0, 1250.0, 1350.0, 99960.0, 115000.0, 1e7, 1.25e7, -5.0]
    values += [float(v) for v in range(1000, 60000, 37)]
    assert column(spark, values, "double", display.format_currency) == [currency(v) for v in values]
    counts = [0, 7, 999, 1000, 1050, 1250, 99949, 99950, 100000, 115000, 12345678]
    expected = [f"{v / 1e5:.1f}L" if v >= 1e5 else f"{v / 1000:.1f}K" if v >= 1000 else str(v) for v in counts]
    assert column(spark, counts, "bigint", display.format_number) == expected


def test_small_display_forms(spark):
    row = spark.sql("select timestamp_ntz '2024-01-05 13:45:10' as t, 1234567.5 as a, '12345678-9abc' as i").select(
        display.format_time(F.col("t")), display.format_amount(F.col("a")), display.short_id(F.col("i")),
        display.short_label(F.col("i"), 4)).first()
    assert list(row) == ["05 Jan 13:45", "₹1,234,567.50", "12345678...", "1234"]


@pytest.mark.parametrize("text, number", [
    ("12", 12.0), (" 12.5 ", 12.5), ("-.5", -0.5), ("1e3", 1000.0), ("abc", None), ("", None), ("1d", None),
    ("2f", None), ("nan", None), (None, None), ("inf", float("inf")),
])
def test_numbers(spark, text, number):
    assert column(spark, [text], "string", coerce.number_or_null) == [number]


def test_money_out_of_range_is_null(spark):
    values = [float("inf"), 1e12, 1.005, 0.125, None]
    got = column(spark, values, "double", coerce.money_or_null)
    assert [None if v is None else float(v) for v in got] == [None, None, 1.0, 0.12, None]


def test_text_is_stripped_like_python(spark):
    values = [" a b ", "\tBooks\n", "　x\xa0", "\x1f y ", "", None]
    assert column(spark, values, "string", coerce.stripped_text) == [
        "None" if v is None else v.strip() for v in values]


def test_truth(spark):
    values = ["true", "false", "1", "0", "0.0", "2", "maybe", "", None]
    assert column(spark, values, "string", coerce.truth) == [True, False, True, False, False, True, True, False, False]


def test_timestamps_are_read_row_by_row(spark):
    values = ["2024-01-05T10:00:00.123456", "2024-01-05T10:00:00", "2024-01-05", "garbage", None]
    got = column(spark, values, "string", coerce.timestamp_or_null)
    assert [str(v) for v in got] == ["2024-01-05 10:00:00.123456", "2024-01-05 10:00:00", "2024-01-05 00:00:00",
                                     "None", "None"]


def test_a_price_beyond_the_column_is_null_and_not_an_error(spark):
    from orderloom.operators.enrich import price_orders
    rows = spark.sql("select * from values (1, 9999999999.99D, 5), (2, 1e300D, 1), (3, 10.0D, 2) as t(id, unit_price, quantity)")
    got = {r["id"]: r["total_amount"] for r in price_orders(rows).collect()}
    assert got[1] is None and got[2] is None and float(got[3]) == 20.0
