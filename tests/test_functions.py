"""Column functions: display formats, exact money sums, safe ratio, patterns."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veritab.functions import (
    count_text,
    extract_first,
    money_sum,
    money_text,
    not_matching,
    percent_text,
    ratio,
    strip_pattern,
)
from veritab.operators.aggregate import ratio_breakdown
from veritab.plans import reports as R


def _one(spark, expr, value, ddl="x double"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("value, text", [
    (1500.0, "1,500.00"), (0.125, "0.13"), (2.675, "2.68"), (-1234.5, "-1,234.50"),
    (1234567.891, "1,234,567.89"), (0.0, "0.00"), (None, None)])
def test_money_text_is_java_half_up(spark, value, text):
    assert _one(spark, money_text("x"), value) == text


@pytest.mark.parametrize("value, text", [(75.0, "75.00 %"), (75.125, "75.13 %"),
                                         (100.0, "100.00 %"), (None, None)])
def test_percent_text(spark, value, text):
    assert _one(spark, percent_text("x"), value) == text


@pytest.mark.parametrize("value, text", [(15, "15"), (1500, "1,500"), (-1234567, "-1,234,567"),
                                         (None, None)])
def test_count_text(spark, value, text):
    assert _one(spark, count_text("x"), value, "x long") == text


def test_whole_number_money_column_still_formats(spark):
    assert _one(spark, money_text("x"), 1500, "x int") == "1,500.00"


def test_money_sum_does_not_depend_on_the_order(spark):
    # 0.1 added ten times in one sequence of doubles is 0.9999999999999999
    for parts in (1, 3, 10):
        df = spark.createDataFrame([(0.1,)] * 10, "x double").repartition(parts)
        assert df.agg(money_sum("x").alias("s")).collect()[0]["s"] == 1.0


def test_money_sum_of_thirds_and_of_nothing(spark):
    import math
    values = [k / 3 for k in range(1, 400)]
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "x double")
    assert df.agg(money_sum("x").alias("s")).collect()[0]["s"] == pytest.approx(math.fsum(values), rel=1e-15)
    assert df.where("x IS NULL").agg(money_sum("x").alias("s")).collect()[0]["s"] is None
    assert df.where("false").agg(money_sum("x").alias("s")).collect()[0]["s"] is None


def _totals(spark, groups, parts=3):
    rows = [(g, x, 1, 2) for g, values in groups.items() for x in values]
    df = spark.createDataFrame(rows, "area string, amount double, ok long, made long").repartition(parts)
    return {r["area"]: r["total_sales"] for r in ratio_breakdown(df, ["area"], "amount", "ok", "made").collect()}


def _wide_amounts(rng, n):
    """From 1e-30 to 1e30, with values that cancel and repeated magnitudes."""
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-30, 30) for _ in range(n)]
    return values + [-x for x in values[::3]] + [rng.choice([1e30, -1e30, 1e-30, 2.0 ** 70, 0.0]) for _ in range(n // 3)]


def test_totals_of_any_amounts_are_rounded_once(spark):
    rng = random.Random(11)
    groups = {f"g{k}": _wide_amounts(rng, rng.randint(1, 60)) + [1e25] for k in range(60)}
    groups |= {"cancel": [1e30, 1.0, -1e30], "tiny": [1e-30] * 7, "both": [2.0 ** 60, 2.0 ** 0, 2.0 ** -60, -2.0 ** 60],
               "half even": [2.0 ** 80, 2.0 ** 27], "half up": [2.0 ** 80, 2.0 ** 27, 2.0 ** -40], "minus": [-1e22, 3.0],
               "nothing": [1e22, -1e22], "ends": [1e300, 1e-300, -1e300, 5e-324], "max": [1.7e308, -1.6e308]}
    want = {g: math.fsum(values) for g, values in groups.items()}
    for parts in (1, 5):
        shuffled = {g: rng.sample(values, len(values)) for g, values in groups.items()}
        assert _totals(spark, shuffled, parts) == want


def test_totals_of_plain_amounts_nulls_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    got = _totals(spark, {"a": [0.1] * 10, "none": [None, None], "nan": [nan, 1.0], "inf": [inf, 1e30], "mix": [inf, -inf],
                          "some": [None, 2.5], "deep": [0.001234567890123456, 1e-19], "large": [1e19, 0.1]})
    assert got["a"] == 1.0 and got["none"] is None and got["some"] == 2.5
    assert math.isnan(got["nan"]) and got["inf"] == inf and math.isnan(got["mix"])
    assert got["deep"] == math.fsum([0.001234567890123456, 1e-19]) and got["large"] == math.fsum([1e19, 0.1])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.floats(min_value=-1e30, max_value=1e30), min_size=1, max_size=30), min_size=1, max_size=8))
def test_totals_against_fsum(spark, lists):
    groups = {str(k): [*values, 1e22] for k, values in enumerate(lists)}   # not all plain: doubles as they are
    assert _totals(spark, groups) == {g: math.fsum(values) for g, values in groups.items()}


def test_breakdown_total_uses_exact_sum(spark):
    calls = spark.createDataFrame([(i, "IT", 1, 1) for i in range(10)],
                                  "id long, area string, calls_made long, calls_successful long")
    details = spark.createDataFrame([(i, 0.1) for i in range(10)], "id long, sales_amount double")
    row = R.department_breakdown(calls, details, None, display=False).collect()[0]
    assert float(row["total_sales"]) == 1.0


def test_ratio_is_null_on_zero_or_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2), (2, None)], "a long, b long")
    assert [r["r"] for r in df.select(ratio("a", "b").alias("r")).collect()] == [
        0.25, None, None, None]


def test_pattern_functions(spark):
    df = spark.createDataFrame([("Lindehof 5, 4133 HB, Nederhemert",), ("no code",), (None,)],
                               "a string")
    rows = df.select(extract_first("a").alias("z"), strip_pattern("a").alias("rest"),
                     not_matching("a").alias("bad")).collect()
    assert [tuple(r) for r in rows] == [("4133 HB", "Lindehof 5, Nederhemert", True),
                                        ("", "no code", True), (None, None, True)]
