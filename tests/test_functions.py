from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException, PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tradeloom import functions as fn
from tradeloom.constants import GENDER_CODES, GENDER_DEFAULT


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_age_counts_completed_years(spark):
    born = [date(1960, 1, 1), date(1960, 1, 2), date(1960, 2, 29), None]
    assert column(spark, born, "date", lambda c: fn.whole_years(c, date(1997, 1, 1))) == [37, 36, 36, None]


def test_leap_day_birthday_counts_from_first_of_march(spark):
    for day, age in ((date(1997, 2, 28), 36), (date(1997, 3, 1), 37), (date(1996, 2, 29), 36)):
        assert column(spark, [date(1960, 2, 29)], "date", lambda c, d=day: fn.whole_years(c, d)) == [age]


def test_impossible_dates_are_null(spark):
    parts = [(2018, 2, 28), (2018, 2, 29), (2016, 2, 29), (2018, 4, 31), (2018, 13, 1), (2018, 1, 0), (None, 1, 1)]
    df = spark.createDataFrame(parts, "y int, m int, d int")
    got = [r[0] for r in df.select(fn.date_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [date(2018, 2, 28), None, date(2016, 2, 29), None, None, None, None]


def test_months_before_clips_to_month_end(spark):
    got = spark.range(1).select(fn.months_before(date(2020, 2, 29), 12)).first()[0]
    assert got == date(2019, 2, 28)


def test_strict_date_fails_on_a_day_that_does_not_exist(spark):
    assert column(spark, ["2/3/2017", "12/31/2017"], "string", fn.strict_us_date) == [
        date(2017, 2, 3), date(2017, 12, 31),
    ]
    with pytest.raises(PySparkException):
        column(spark, ["02/30/2017"], "string", fn.strict_us_date)


def test_tolerant_date(spark):
    values = ["1980-01-31", "unknown", "1980-02-30", None]
    assert column(spark, values, "string", fn.tolerant_date) == [date(1980, 1, 31), None, None, None]


def test_decimal_comma(spark):
    values = ["12,5", "12.50", "abc", "", None, "1000"]
    assert column(spark, values, "string", fn.decimal_from_text) == [
        Decimal("12.50"), Decimal("12.50"), None, None, None, Decimal("1000.00"),
    ]


def test_number_that_does_not_fit_fails(spark):
    for text in ("123456789.50", "-1e9"):
        with pytest.raises(ArithmeticException):
            column(spark, [text], "string", fn.decimal_from_text)


def test_unknown_gender_spellings_fall_to_default(spark):
    values = ["Male", "Female", "F", "U", "M", "Femal", None]
    got = column(spark, values, "string", lambda c: fn.map_values(c, GENDER_CODES, GENDER_DEFAULT))
    assert got == ["M", "F", "F", "U", "U", "U", "U"]


def test_rename_values_leaves_others(spark):
    df = spark.createDataFrame([("VIC",), ("Victoria",), ("QLD",), (None,)], "s string")
    got = rows(fn.rename_values(df, "s", {"VIC": "Victoria", "New South Wales": "NSW"}))
    assert got == [("Victoria",), ("Victoria",), ("QLD",), (None,)]


def test_missing_value_text(spark):
    df = spark.createDataFrame([("n/a", 1), ("", 2), ("NULL", 3), ("Health", 4), (" n/a", 5)], "s string, i int")
    assert rows(fn.blank_to_null(df)) == [(None, 1), (None, 2), (None, 3), ("Health", 4), (" n/a", 5)]


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 5), (1, 8)], "a bigint, b bigint")
    assert rows(df.select(fn.percent_of(F.col("a"), F.col("b")))) == [(33.33,), (None,), (0.0,), (12.5,)]


def test_rounded_mean_rounds_the_exact_mean_once(spark):
    # 2 000 001 values: the mean is just below 0.005, which six digits would round up to 0.005.
    n = 2_000_001
    df = spark.range(n).select(
        F.lit(1).alias("k"), F.when(F.col("id") < 1_000_000, 0.01).otherwise(0).cast("decimal(10,2)").alias("v")
    )
    assert df.groupBy("k").agg(fn.rounded_mean(df, "v", 2).alias("m")).first()["m"] == Decimal("0.00")


def test_rounded_mean_half_goes_up(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "v decimal(10,2)")
    assert df.agg(fn.rounded_mean(df, "v", 2)).first()[0] == Decimal("0.02")
    whole = spark.createDataFrame([(1,), (2,), (2,), (2,)], "v int")
    assert whole.agg(fn.rounded_mean(whole, "v", 1)).first()[0] == 1.8


def test_title_with_year(spark):
    df = spark.createDataFrame([("A", 1940), ("B", None), (None, 1940)], "t string, y int")
    assert rows(df.select(fn.title_with_year(F.col("t"), F.col("y")))) == [("A (1940)",), ("B (N/A)",), (None,)]


def test_summed_product_is_exact_on_both_paths(spark):
    data = [(1, 3, "0.10"), (1, -2, "19.99"), (1, 7, "-1.50"), (1, None, "5.00"), (1, 5, None), (2, None, "1.00")]
    for money_type in ("decimal(10,2)", "decimal(20,4)"):
        df = spark.createDataFrame(data, "k int, q int, p string").withColumn("p", F.col("p").cast(money_type))
        got = df.groupBy("k").agg(fn.summed_product(df, "q", "p").alias("s")).orderBy("k")
        assert [(r["k"], r["s"]) for r in got.collect()] == [(1, Decimal("-50.18")), (2, None)]


def test_summed_product_holds_more_than_a_long_of_cents(spark):
    df = spark.range(40).select(
        F.lit(2_000_000_000).alias("q"), F.lit(Decimal("99999999.99")).cast("decimal(10,2)").alias("p")
    )
    assert df.agg(fn.summed_product(df, "q", "p")).first()[0] == 40 * 2_000_000_000 * Decimal("99999999.99")
