import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.operators import joins, quality, reshape


def test_expand_quarter_keeps_quarter_rows_and_fills_others(spark, rows):
    df = spark.createDataFrame([("a", 3, 7.5, 1), ("a", 5, 2.0, 2), ("a", 12, 1.0, 3)], "p string, m int, x double, n int")
    got = rows(reshape.expand_quarter_to_month(df, "m", ["x"]), "m", "x", "n")
    assert got == sorted(
        [(1, -99.0, 1), (2, -99.0, 1), (3, 7.5, 1), (5, 2.0, 2), (10, -99.0, 3), (11, -99.0, 3), (12, 1.0, 3)], key=repr
    )


def test_expand_quarter_keeps_null_months(spark, rows):
    df = spark.createDataFrame([(None, 1.0)], "m int, x double")
    assert rows(reshape.expand_quarter_to_month(df, "m", ["x"])) == [(None, 1.0)]


def test_copy_period_touches_one_period_only(spark, rows):
    df = spark.createDataFrame([(2020, 3, "x"), (2021, 3, "y"), (2020, 4, "z")], "y int, m int, v string")
    got = rows(reshape.copy_period(df, "y", "m", (2020, 3), [4, 5]))
    assert got == sorted([(2020, 3, "x"), (2020, 4, "x"), (2020, 5, "x"), (2021, 3, "y"), (2020, 4, "z")], key=repr)


@pytest.mark.parametrize("length", [0, 1, 13, 14, 15, 29, 30, 364])
def test_intervals_cover_without_gap_or_overlap(spark, length):
    start = dt.date(2024, 1, 5)
    end = start + dt.timedelta(days=length)
    df = spark.createDataFrame([(start, end)], "a date, b date")
    got = reshape.date_intervals(df, "a", "b").orderBy("interval_start").collect()
    assert len(got) == -(-(length + 1) // 15)
    assert got[0]["interval_start"] == start and got[-1]["interval_end"] == end
    for one, two in zip(got, got[1:]):
        assert two["interval_start"] - one["interval_end"] == dt.timedelta(days=1)
        assert (one["interval_end"] - one["interval_start"]).days == 14
    assert got[0]["start_text"] == "2024-01-05T00:00:00UTC"


def test_intervals_of_reversed_span_are_empty(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1), dt.date(2024, 1, 1))], "a date, b date")
    assert reshape.date_intervals(df, "a", "b").count() == 0


def test_explode_keep(spark, rows):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k int, xs array<int>")
    assert rows(reshape.explode_keep(df, "xs", "x"), "k", "x") == sorted([(1, 1), (1, 2), (2, None), (3, None)], key=repr)


def test_union_needs_a_frame():
    with pytest.raises(ValueError):
        reshape.union_all([])


ORDERS = [
    ("a", 2020, 1, 1.0), ("a", 2020, 1, None), ("a", 2020, 4, 2.0), ("a", 2021, 2, None),
    ("b", 2020, 7, None), ("z", 2020, 1, 1.0),
]


def _expected():
    return {
        "a": (4, 2, 2, 2, 4, 2, 2020, 1, 2020, 4, "ok"),
        "b": (1, 1, 0, 0, 0, 0, None, None, None, None, "no data"),
        "c": (0, 0, 0, 0, 0, 0, None, None, None, None, "no data"),
    }


def test_quality_report_forms_agree(spark):
    df = spark.createDataFrame(ORDERS, "k string, y int, m int, x double")
    two_sided = quality.quality_report(df, df.dropna(), "k", "y", "m", ["a", "b", "c"])
    marked = quality.quality_report_marked(df, F.col("x").isNotNull(), "k", "y", "m", ["a", "b", "c"])
    for report in (two_sided, marked):
        assert {r[0]: tuple(r)[1:] for r in report.collect()} == _expected()


def test_quality_report_without_wanted_lists_all_keys(spark):
    df = spark.createDataFrame(ORDERS, "k string, y int, m int, x double")
    report = quality.quality_report(df, df.dropna(), "k", "y", "m")
    got = {r["k"]: r for r in report.collect()}
    assert set(got) == {"a", "b", "z"}
    for r in got.values():
        assert r["rows_before"] - r["rows_dropped"] == r["rows_after"]


def test_quality_report_hot_key_is_combined_before_the_key_shuffle(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"),
        (F.lit(2000) + F.col("id") % 5).cast("int").alias("y"),
        (F.col("id") % 12 + 1).cast("int").alias("m"),
    )
    hot = quality.quality_report(df, df, "k", "y", "m").filter("k = -1").first()
    assert hot["rows_before"] == 33_333 and hot["months_present"] == 40 and hot["months_expected"] == 59


def test_coverage_lists_absent_keys(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("q",)], "k string")
    assert rows(quality.coverage_check(df, "k", ["a", "b"])) == [("a", 2, True), ("b", 0, False)]


def test_panel_join_rolls_up_or_fans_out(spark, rows):
    base = spark.createDataFrame([(1, 10), (2, 20)], "k int, b int")
    fine = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, d string, v int")
    side = (fine, {"v": F.sum("v")})
    assert rows(joins.panel_join(base, [side], ["k"]), "k", "v") == [(1, 3), (2, None)]
    assert rows(joins.panel_join(base, [side], ["k"], keep_fanout=True), "k", "v") == [(1, 1), (1, 2), (2, None)]


def test_attach_dimension_avoids_ambiguous_names(spark, rows):
    fact = spark.createDataFrame([(1, "fact"), (9, "fact")], "id int, nombre string")
    dim = spark.createDataFrame([(1, "dim", "p")], "id int, nombre string, provincia string")
    got = joins.attach_dimension(fact, dim, "id", "id", ["provincia"])
    assert rows(got) == [(1, "fact", "p"), (9, "fact", None)]
    assert rows(joins.attach_dimension(fact, dim, "id", "id", ["provincia"], how="inner")) == [(1, "fact", "p")]


def test_semi_and_anti_joins_ignore_repeats(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    members = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(joins.keep_members(fact, members, "k", "k")) == [(1,), (3,)]
    assert rows(joins.keep_members(fact, members, "k", "k", unique=False)) == [(1,), (3,)]
    assert rows(joins.pending(fact, members, ["k"])) == [(2,)]


def test_lag_orders(spark):
    df = spark.createDataFrame([("a", 2020, 12, 1), ("a", 2021, 1, 2), ("a", 2021, 2, 3)], "p string, y int, m int, v int")
    forward = joins.lag_features(df, ["p"], ["y", "m"], ["v"])
    assert {(r["y"], r["m"]): r["v_lag1"] for r in forward.collect()} == {(2020, 12): None, (2021, 1): 1, (2021, 2): 2}
    down = joins.lag_features(df, ["p"], ["m"], ["v"], descending=True, ties=["y"])
    assert {(r["y"], r["m"]): r["v_lag1"] for r in down.collect()} == {(2020, 12): None, (2021, 2): 1, (2021, 1): 3}


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_join_keys_are_split(spark):
    """A third of the rows share one key; with thresholds fit for the small data the join is marked as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("fk"), F.col("id").alias("v")
        )
        dim = spark.range(60_000).select(F.col("id").alias("dk"), (F.col("id") % 25).alias("nation"))
        repeated = dim.union(dim.filter("dk = 7").withColumn("nation", F.explode(F.sequence(F.lit(1), F.lit(5000)))))
        joined = joins.attach_dimension(fact, dim, "fk", "dk", ["nation"])
        assert "skew=true" in _final_plan(joined.groupBy("nation").agg(F.sum("v")))
        assert "skew=true" in _final_plan(joins.keep_members(fact, dim, "fk", "dk").agg(F.sum("v")))
        thinned = joins.keep_members(fact, repeated, "fk", "dk", unique=False)
        assert "skew=true" in _final_plan(thinned.agg(F.sum("v")))
        assert thinned.count() == 100_000 + 40_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
