import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions import chance, clock
from stratalake.functions.text import decimal_comma
from stratalake.operators import clean


def test_decimal_comma_codes_become_null(spark, rows):
    df = spark.createDataFrame([("1,5",), ("Ip",), ("",), (None,), ("-0,25",), ("7",)], "x string")
    assert [r[0] for r in df.select(decimal_comma(F.col("x"))).collect()] == [1.5, None, None, None, -0.25, 7.0]


def test_decimal_comma_cast_skips_absent_columns(spark):
    df = spark.createDataFrame([("2,5", "a")], "x string, y string")
    assert clean.decimal_comma_cast(df, ["x", "absent"]).first() == (2.5, "a")


def test_time_round_trip_and_edges(spark):
    df = spark.createDataFrame([("09:30",), ("Desconocido",), ("7",), (None,), ("",), ("23:59",)], "x string")
    hours = [r[0] for r in df.select(clock.time_to_decimal(F.col("x"))).collect()]
    assert hours[:5] == [9.5, None, None, None, None]
    back = spark.createDataFrame([(7.995,), (8.999,), (None,), (0.0,), (23.5,)], "x double")
    texts = [r[0] for r in back.select(clock.decimal_to_time(F.col("x"))).collect()]
    assert texts == ["08:00", "09:00", None, "00:00", "23:30"]


def test_parse_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("x",), (None,)], "x string")
    assert [r[0] for r in df.select(clock.parse_date(F.col("x"))).collect()] == [dt.date(2024, 2, 29), None, None, None]


def test_recode_passes_null_and_unmapped(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert rows(clean.normalize_values(df, "x", {"a": "A"})) == sorted([("A",), ("b",), (None,)], key=repr)
    assert rows(clean.normalize_values(df, "x", {})) == rows(df)


def test_impute_string_handles_dates_and_empty_text(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), ""), (None, None)], "d date, t string")
    got = clean.impute_string(df, "Desconocido", ["d", "t"])
    assert [tuple(r) for r in got.collect()] == [("2024-01-02", "Desconocido"), ("Desconocido", "Desconocido")]


def test_impute_string_default_is_string_columns_only(spark):
    df = spark.createDataFrame([(None, None)], "n int, t string")
    assert clean.impute_string(df, "-").first() == (None, "-")


def test_impute_numeric_arguments(spark):
    df = spark.createDataFrame([(None, None, "x")], "n int, d double, t string")
    assert clean.impute_numeric(df, -9999).first() == (-9999, -9999.0, "x")
    assert clean.impute_numeric(df, 1, ["n"]).first() == (1, None, "x")
    with pytest.raises(ValueError):
        clean.impute_numeric(df, 1, ["absent"])
    with pytest.raises(TypeError):
        clean.impute_numeric(df, "1")
    with pytest.raises(TypeError):
        clean.impute_numeric([1], 1)
    with pytest.warns(UserWarning):
        assert clean.impute_numeric(df, 1, ["n", "t"]).first() == (1, None, "x")


def test_drop_nulls_and_complete_row_agree_on_nan(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, t string")
    assert rows(clean.drop_nulls(df)) == [(1.0, "a")]
    assert rows(df.filter(clean.complete_row(df))) == [(1.0, "a")]


def test_fill_numeric_replaces_null_and_nan(spark, rows):
    df = spark.createDataFrame([(float("nan"), None), (None, "b")], "x double, t string")
    assert rows(clean.fill_numeric(df, 0), "x") == [(0.0,), (0.0,)]


def test_filter_pairs_long_list_equals_short_list(spark, rows):
    df = spark.createDataFrame([(i % 7, str(i % 5)) for i in range(100)], "a long, b string")
    pairs = [(a, str(b)) for a in range(3) for b in range(2)]
    padding = [(100 + i, "z") for i in range(40)]
    short = clean.filter_pairs(df, ["a", "b"], pairs)
    long = clean.filter_pairs(df, ["a", "b"], pairs + padding)
    assert rows(short) == rows(long) and len(rows(short)) > 0


def test_filter_with_no_pairs_keeps_nothing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert clean.filter_pairs(df, ["a"], []).count() == 0


def test_reject_split_is_complete(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    good, bad = clean.reject_split(df, F.col("x") > 3)
    assert rows(good) == [(5,)]
    assert rows(bad) == sorted([(1,), (None,)], key=repr)


def test_project_renamed_rejects_unknown_names(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        clean.project_renamed(df, {"b": "c"})
    assert clean.project_existing(df, ["b", "a"]).columns == ["a"]


def test_clip_and_jitter_bounds(spark):
    df = spark.createDataFrame([(-0.5,), (0.4,), (1.7,), (None,)], "x double")
    assert [r[0] for r in df.select(chance.clip(F.col("x"))).collect()] == [0.0, 0.4, 1.0, None]
    noisy = [r[0] for r in df.select(chance.jitter(F.col("x"), 0.02, seed=1)).collect()]
    assert all(n is None or abs(n - x) <= 0.02 for n, x in zip(noisy, [-0.5, 0.4, 1.7, None]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 24 * 60 - 1), min_size=1, max_size=20))
def test_clock_round_trip(spark, minutes):
    texts = [f"{m // 60:02d}:{m % 60:02d}" for m in minutes]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    back = df.select("t", clock.decimal_to_time(clock.time_to_decimal(F.col("t"))).alias("b")).collect()
    assert all(r["t"] == r["b"] for r in back)
