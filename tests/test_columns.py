import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermart.functions import columns as c


def values(spark, schema, rows, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def texts(spark, items, expression):
    return values(spark, "t string", [(i,) for i in items], expression)


def test_numbers_from_text(spark):
    items = ["34_", "34.5", "", "-500", None, "abc", "_1_0_"]
    assert texts(spark, items, c.as_int(c.without_underscores(F.col("t")))) == [
        34, 34, None, -500, None, None, 10,
    ]
    assert texts(spark, items, c.as_float(c.without_underscores(F.col("t"))))[1] == 34.5


def test_duration(spark):
    items = ["22 Years and 1 Months", "3 Months", "1 Year and 0 Month", "", None, "5 Years"]
    assert texts(spark, items, c.duration_months(F.col("t"))) == [265, None, 12, None, None, 60]
    assert texts(spark, items, c.duration_months(F.col("t"), 0)) == [265, 3, 12, 0, None, 60]


def test_placeholder_keeps_null(spark):
    items = ["_______", "_", "a_b", "", None]
    assert texts(spark, items, c.placeholder_to_unknown(F.col("t"))) == [
        "Unknown", "Unknown", "a_b", "", None,
    ]


def test_flag_and_ratio_with_missing_values(spark):
    rows = [(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (None, 1.0), (1.0, None)]
    assert values(spark, "a double, b double", rows, c.ratio_if_positive(F.col("a"), F.col("b"))) == [
        0.5, None, None, None, None,
    ]
    assert values(spark, "a double, b double", rows, c.flag(F.col("b") > 0)) == [
        True, False, False, True, False,
    ]


def test_ratio_divides_single_precision_as_double(spark):
    ratio = F.ceil(F.col("a").cast("double") / F.col("b").cast("double"))
    assert values(spark, "a float, b float", [(99.9, 33.3)], ratio) == [4]


def test_clip_keeps_missing(spark):
    rows = [(-1.0,), (0.5,), (2.0,), (None,)]
    assert values(spark, "a double", rows, c.clip(F.col("a"), 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_band_ends(spark):
    rows = [(0.0,), (40.0,), (40.5,), (100.0,), (101.0,), (None,)]
    right = c.band(F.col("a"), [0, 40, 100], ["low", "high"])
    left = c.band(F.col("a"), [0, 40, 100], ["low", "high"], closed="left")
    assert values(spark, "a double", rows, right) == [None, "low", "high", "high", None, None]
    assert values(spark, "a double", rows, left) == ["low", "high", "high", None, None, None]
    with pytest.raises(ValueError):
        c.band(F.col("a"), [0, 1], ["a", "b"])


def test_any_null(spark):
    rows = [(1, 2), (None, 2), (None, None)]
    assert values(spark, "a int, b int", rows, c.any_null(["a", "b"])) == [False, True, True]
    assert values(spark, "a int, b int", rows, c.any_null([])) == [False] * 3


def test_equal_width_bins(spark):
    rows = [(0.0,), (0.99,), (1.0,), (9.99,), (10.0,)]
    place = c.equal_width_bin(F.col("a"), F.lit(0.0), F.lit(10.0), 10)
    assert values(spark, "a double", rows, place) == [0, 0, 1, 9, 9]
    same = c.equal_width_bin(F.col("a"), F.lit(3.0), F.lit(3.0), 10)
    assert values(spark, "a double", [(3.0,)], same) == [5]


def test_title_words(spark):
    items = ["home-equity loan", "PAYDAY LOAN", "o'neil", None]
    assert texts(spark, items, c.title_words(F.col("t"))) == [
        "Home-Equity Loan", "Payday Loan", "O'Neil", None,
    ]


def test_iso_day(spark):
    items = ["2024-12-01T00:00:00.000Z", "2024-12-01", "soon", None]
    day = dt.date(2024, 12, 1)
    assert texts(spark, items, c.iso_day(F.col("t"))) == [day, day, None, None]
