import hashlib
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import evaluate, labels, learn, ordered, score
from stratalake.plans.recommend import recommend_batch
from stratalake.plans.training import bad_month_conditions


def _values(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "x double")


def _disc(xs, p):
    xs = sorted(xs)
    return xs[max(math.ceil(round(p * len(xs), 6)), 1) - 1]


def test_quantiles_on_one_to_ten(spark):
    assert ordered.exact_quantiles(_values(spark, [float(i) for i in range(1, 11)]), "x", [0.33, 0.66]) == [4.0, 7.0]


def test_quantiles_ignore_null_and_nan(spark):
    assert ordered.exact_quantiles(_values(spark, [1.0, None, float("nan"), 3.0]), "x", [0.5, 1.0]) == [1.0, 3.0]
    assert ordered.exact_quantiles(_values(spark, [None, float("nan")]), "x", [0.5]) == [None]


@pytest.mark.parametrize("in_a_range", [50, 250_000])
def test_bracketed_quantiles_equal_plain_ones(spark, monkeypatch, in_a_range):
    """A third of the rows share one value, and the brackets are taken from a sketch."""
    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", in_a_range)
    rng = random.Random(3)
    xs = [7.0 if i % 3 == 0 else round(rng.gauss(0, 100), 2) for i in range(20_000)]
    probs = [0.0, 0.05, 0.33, 0.5, 0.66, 1.0]
    got = ordered.exact_quantiles(_values(spark, xs), "x", probs, slack=0.06)
    assert got == [_disc(xs, p) for p in probs]


def test_quantiles_survive_a_useless_sketch(spark, monkeypatch):
    """Brackets that miss the quantiles are noticed."""
    xs = [float(i) for i in range(5000)]
    wrong = F.array(*[F.lit(float(v)) for v in (10, 20, 4990, 4995)])
    monkeypatch.setattr(ordered.F, "percentile_approx", lambda *args: F.first(wrong))
    assert ordered.exact_quantiles(_values(spark, xs), "x", [0.33, 0.66], slack=0.1) == [_disc(xs, 0.33), _disc(xs, 0.66)]


@pytest.mark.parametrize("ranges", [None, 2, 7, 64])
def test_running_totals_do_not_depend_on_ranges(spark, rows, ranges):
    rng = random.Random(5)
    counts = sorted({round(rng.expovariate(1), 3) for _ in range(500)})
    weights = [rng.randint(0, 9) for _ in counts]
    df = spark.createDataFrame(list(zip(counts, weights)), "v double, n long")
    got = {r["v"]: r["n_before"] for r in ordered.running_totals(df, "v", ["n"], ranges).collect()}
    total = 0
    for v, n in zip(counts, weights):
        assert got[v] == total
        total += n


def test_running_totals_with_infinite_values(spark):
    ends = [(float("-inf"), 2), (float("inf"), 3)]
    for rows, want in ((ends, [0, 2]), ([ends[0], (1.0, 5), ends[1]], [0, 2, 7])):
        df = spark.createDataFrame(rows, "v double, n long")
        got = ordered.running_totals(df, "v", ["n"], ranges=4).orderBy("v").collect()
        assert [r["n_before"] for r in got] == want


def test_sketched_thresholds(spark):
    df = _values(spark, [float(i) for i in range(1000)] + [float("nan"), None])
    got = {r["prob"]: r["value"] for r in ordered.quantile_thresholds(df, ["x"], [0.33, 0.66], 0.01).collect()}
    assert abs(got[0.33] - 330) <= 11 and abs(got[0.66] - 660) <= 11


def _auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=1, max_size=40))
def test_auc_equals_pair_count(spark, pairs):
    df = spark.createDataFrame([(y, s / 6) for y, s in pairs], "y int, s double")
    got = evaluate.eval_auc(df, "y", "s").first()["auc"]
    want = _auc([(y, s / 6) for y, s in pairs])
    assert got is None if want is None else abs(got - want) < 1e-12


def test_auc_over_many_ranges_with_a_hot_score(spark, monkeypatch):
    monkeypatch.setattr(ordered, "VALUES_PER_RANGE", 10)
    rng = random.Random(11)
    pairs = [(rng.randint(0, 1), 0.5 if i % 3 == 0 else round(rng.random(), 3)) for i in range(1500)]
    got = evaluate.eval_auc(spark.createDataFrame(pairs, "y int, s double"), "y", "s").first()["auc"]
    assert abs(got - _auc(pairs)) < 1e-12


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.8)], "y int, s double")
    assert evaluate.eval_auc(df, "y", "s").first()["auc"] == 0.875


def test_confusion_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = evaluate.eval_confusion(df, "y", "p").first()
    assert (row["tn"], row["accuracy"], row["precision"], row["recall"], row["f1"]) == (2, 1.0, 0.0, 0.0, 0.0)


def test_published_confusion_counts(spark):
    cells = [(1, 1)] * 75 + [(0, 1)] * 8 + [(1, 0)] * 3 + [(0, 0)] * 197
    row = evaluate.eval_confusion(spark.createDataFrame(cells, "y int, p int"), "y", "p").first()
    got = [round(row[c], 5) for c in ("accuracy", "f1", "precision", "recall")]
    assert got == [0.96113, 0.93168, 0.90361, 0.96154]


def test_label_rules_null_is_not_bad(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (9.0, None), (None, 50.0)], "a double, b double")
    got = labels.label_rules(df, [F.col("a") < 5, F.col("b") > 30])
    assert [r["label"] for r in got.collect()] == [1, 0, 1, 0]


def test_bad_month_conditions(spark):
    panel = spark.createDataFrame(
        [(float(i), float(i), 10.0, 20.0, 3) for i in range(100)] + [(99.0, 99.0, 4.0, 20.0, 3), (99.0, 99.0, 10.0, 31.0, 3),
         (99.0, 99.0, 10.0, 20.0, 11)],
        "aire_pct_buena double, apt_availability_score double, temp_min_media_mes double, temp_max_media_mes double, dias_lluvia_mes int",
    )
    got = labels.label_rules(panel, bad_month_conditions(panel, rel_err=0))
    assert got.filter("label = 0").count() == 33 + 3


@pytest.mark.parametrize("n,share", [(1, 0.2), (7, 0.2), (400, 0.2), (400, 0.5), (50, 0.0), (50, 1.0)])
def test_split_shares_are_exact(spark, n, share):
    df = spark.createDataFrame([(i, i % 3) for i in range(n)], "id long, y int")
    marked = labels.split_stratified(df, "y", "id", share)
    assert marked.count() == n
    for y in range(3):
        size = len(range(y, n, 3))
        assert marked.filter((F.col("y") == y) & F.col("is_test")).count() == math.floor(size * share + 0.5 + 1e-9)


def test_split_is_the_same_after_reshuffling(spark, rows):
    df = spark.createDataFrame([(i, i % 2) for i in range(300)], "id long, y int")
    one = labels.split_stratified(df, "y", "id")
    two = labels.split_stratified(df.repartition(7).orderBy(F.desc("id")), "y", "id")
    assert rows(one) == rows(two)


def test_split_refines_crowded_slices(spark, monkeypatch):
    """Slices of one digit hold many digests each."""
    monkeypatch.setattr(labels, "_SLICE", 1)
    df = spark.createDataFrame([(i, i % 2) for i in range(2000)], "id long, y int")
    coarse = labels.split_stratified(df, "y", "id").filter("is_test")
    monkeypatch.undo()
    assert coarse.count() == 400
    assert coarse.exceptAll(labels.split_stratified(df, "y", "id").filter("is_test")).count() == 0


def test_split_share_is_exact_with_null_keys(spark):
    """Rows without key are taken one by one; (NULL, 'a') and ('a', NULL) are different."""
    df = spark.createDataFrame([(None if i < 900 else i, i % 7, 0) for i in range(1000)], "id long, v long, y int")
    assert abs(labels.split_stratified(df.withColumn("row", F.monotonically_increasing_id()), "y", "id").filter("is_test").count() - 200) == 0
    two = spark.createDataFrame([(None, "a", i) for i in range(500)] + [("a", None, i) for i in range(500)], "k1 string, k2 string, v long")
    assert labels.split_stratified(two.withColumn("y", F.lit(1)), "y", ["k1", "k2"]).filter("is_test").count() == 200


def test_split_keeps_rows_of_one_key_together(spark):
    df = spark.createDataFrame([(i % 10, 0) for i in range(100)], "id long, y int")
    sides = labels.split_stratified(df, "y", "id").groupBy("id").agg(F.countDistinct("is_test").alias("n"))
    assert sides.filter("n > 1").count() == 0


@pytest.mark.parametrize(("n", "folds"), [(3, 2), (7, 5), (400, 10), (1000, 3)])
def test_folds_are_exact_within_each_class(spark, n, folds):
    df = spark.createDataFrame([(i, i % 3 if i % 11 else None) for i in range(n)], "id long, y int")
    got = labels.stratified_folds(df, "y", "id", folds).collect()
    assert len(got) == n and all((r["fold"] is None) == (r["y"] is None) for r in got)
    for y in range(3):
        own = sorted((hashlib.md5(str(r["id"]).encode()).hexdigest(), r["fold"]) for r in got if r["y"] == y)
        assert [f for _, f in own] == [r * folds // len(own) for r in range(len(own))]


def test_folds_refine_crowded_slices_and_keep_keys_together(spark, monkeypatch, rows):
    df = spark.createDataFrame([(i, i % 2) for i in range(2000)], "id long, y int")
    fine = rows(labels.stratified_folds(df, "y", "id", 7))
    monkeypatch.setattr(labels, "_SLICE", 1)
    assert rows(labels.stratified_folds(df.repartition(9), "y", "id", 7)) == fine
    monkeypatch.undo()
    same = spark.createDataFrame([(i % 40, 0) for i in range(1200)] + [(None, i) for i in range(0)], "id long, y int")
    assert labels.stratified_folds(same, "y", "id", 4).groupBy("id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0
    whole = spark.createDataFrame([(None if i < 900 else i, i, 0) for i in range(1000)], "id long, v long, y int")
    for key in ("id", None):
        assert rows(labels.stratified_folds(whole, "y", key, 5).groupBy("fold").count()) == [(f, 200) for f in range(5)]
    assert rows(labels.stratified_folds(df.limit(0), "y", "id")) == []
    with pytest.raises(ValueError):
        labels.stratified_folds(df, "y", "id", 1)


def test_search_uses_the_stratified_folds(spark):
    """The mean AUC of each point is that of models fitted by hand on all folds but one."""
    rng = random.Random(8)
    data = [(i, float(i % 7), rng.random(), int(i % 7 + 3 * rng.random() > 5)) for i in range(300)]
    df = spark.createDataFrame(data, "id long, a double, b double, label int").withColumn("weight", F.lit(1.0)).coalesce(1)
    grid = {"maxDepth": [1, 3]}
    found = learn.grid_search(df, ["a", "b"], grid, folds=3, parallelism=2, key="id", maxIter=2)
    dealt = labels.stratified_folds(df, "label", "id", 3).coalesce(1).cache()
    for point, depth in enumerate(grid["maxDepth"]):
        aucs = []
        for f in range(3):
            model = learn.train(dealt.filter(F.col("fold") != f), ["a", "b"], maxDepth=depth, maxIter=2)
            scored = learn.score_with(model, dealt.filter(F.col("fold") == f), ["a", "b"])
            aucs.append(evaluate.eval_auc(scored, "label", "probability").first()["auc"])
        assert abs(found.avgMetrics[point] - sum(aucs) / 3) < 0.02


def test_sampled_split_takes_part_of_each_class(spark):
    df = spark.range(2000).withColumn("y", F.col("id") % 2)
    share = labels.split_sampled(df, "y", [0, 1], 0.2).count() / 2000
    assert 0.1 < share < 0.3


def test_class_weight(spark, rows):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (1,)], "y int")
    assert {tuple(r) for r in labels.class_weight(df, "y").collect()} == {(0, 1.0), (1, 1.5)}
    none = spark.createDataFrame([(0,)], "y int")
    assert labels.class_balance(none, "y").first()["ratio"] is None


# ---- scoring --------------------------------------------------------------

def test_bias_table_is_complete():
    rows = score.season_bias_rows()
    assert len(rows) == 60
    table = {(p, m): b for p, m, b in rows}
    assert table["Barcelona", 5] == 0.45 and table["Valencia", 7] == -0.40 and table["Sevilla", 3] == 0.15
    assert table["Madrid", 11] == 0.20 and table["Illes Balears", 3] == 0.25 and table["Sevilla", 12] == 0.05


def test_seasonal_blend(spark):
    df = spark.createDataFrame([("Sevilla", 7, 0.6), ("Bilbao", 1, 0.5), ("Madrid", 4, None)], "c string, m int, p double")
    got = {r["c"]: r for r in score.seasonal_adjust(df, "p", "c", "m").collect()}
    want = 0.55 * 0.6 + 0.45 / (1 + math.exp(-((0.6 - 0.5) * 4 - 0.85)))
    assert abs(got["Sevilla"]["adjusted"] - want) < 1e-12
    assert got["Sevilla"]["season_prediction"] == (1 if want > 0.5 else 0)
    assert got["Bilbao"]["adjusted"] == 0.5 and got["Bilbao"]["season_prediction"] == 1
    assert got["Madrid"]["adjusted"] is None and got["Madrid"]["season_prediction"] is None


def test_climate_penalty_edges(spark):
    df = spark.createDataFrame(
        [(0.5, 8.0, 10.0), (0.5, 18.0, 0.0), (0.5, None, float("nan")), (0.05, 28.0, 40.0), (None, 1.0, 1.0)],
        "p double, r double, t double",
    )
    got = [r["adjusted"] for r in score.climate_penalty(df, "p", "r", "t").collect()]
    assert got[0] == 0.5 and abs(got[1] - 0.35) < 1e-12 and got[2] == 0.5 and got[3] == 0.0 and got[4] is None
    assert score.climate_penalty(df, "p", "absent", "absent2").first()["adjusted"] == 0.5


def test_verdict_threshold_is_inclusive(spark):
    df = spark.createDataFrame([("Madrid", 0.34), ("Valencia", 0.52), ("Lugo", 0.5), ("Lugo", None)], "c string, p double")
    got = [(r["threshold"], r["recommended"], r["verdict"]) for r in score.verdict(df, "p", "c").collect()]
    assert got[0] == (0.34, 1, "✅ Es un buen momento para viajar a Madrid (34.0% de probabilidad favorable)")
    assert got[1] == (0.53, 0, "⚠️ No es un buen momento para viajar a Valencia (52.0% de probabilidad favorable)")
    assert got[2][:2] == (0.5, 1) and got[3] == (0.5, None, None)


def test_month_fallback(spark):
    features = spark.createDataFrame(
        [("a", 2, 1.0), ("a", 4, 2.0), ("a", 6, 3.0), ("b", 2, 1.0), ("b", 5, 9.0)], "city string, month int, x double"
    )
    requests = spark.createDataFrame(
        [("a", "2024-02-10"), ("a", "2024-07-01"), ("b", "2024-07-01"), ("c", "2024-02-01")], "city string, day string"
    ).withColumn("day", F.to_date("day"))
    got = {(r["city"], r["month"]): (r["used_month"], r["x"], r["found"]) for r in
           score.score_month_fallback(requests, features, "city", "day", ["x"]).collect()}
    assert got == {
        ("a", 2): (2, 1.0, True),
        ("a", 7): (4, 2.0, True),  # the median month has features
        ("b", 7): (None, None, False),  # the median 3.5 is no month
        ("c", 2): (None, None, False),
    }


def test_recommend_keeps_requests_without_features(spark):
    features = spark.createDataFrame([("Madrid", 4, 0.0, 20.0)], "city string, month int, dias_lluvia_mes_lag1 double, temp_media_mes double")
    requests = spark.createDataFrame([("Madrid", "2024-04-01"), ("Lugo", "2024-04-01")], "city string, day string").withColumn(
        "day", F.to_date("day")
    )
    got = {r["city"]: r for r in recommend_batch(requests, features, "city", "day", ["dias_lluvia_mes_lag1", "temp_media_mes"], F.lit(0.9)).collect()}
    assert got["Madrid"]["recommended"] == 1 and got["Madrid"]["prediction"] == 1
    assert got["Lugo"]["prediction"] is None and got["Lugo"]["verdict"] is None


def test_rescale_scores(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    got = [r["probability"] for r in score.rescale_scores(df, "x").collect()]
    assert got[0] == 0.05 and abs(got[1] - 0.5) < 1e-6 and abs(got[2] - 0.95) < 1e-6
