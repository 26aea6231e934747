"""Labels, thresholds, splits, metrics, learning and batch scoring."""

from pyspark.sql import functions as F

from stratalake.operators import evaluate, labels, learn, ordered, score
from stratalake.plans.recommend import recommend_batch as recommend
from stratalake.plans.training import below, build_training_set, low_thresholds
from stratalake.sources.literal import literal_dim
from stratalake.sources.scratch import scratch_dir, store
from suite.monthly import MONTHLY_KEYS, NATION_ORDERS_SQL, nation_orders
from suite.registry import Tables, money, query

# ---- labels and thresholds ------------------------------------------------

@query("""
SELECT count(*) FILTER (quality = 0) AS n_neg, count(*) FILTER (quality = 1) AS n_pos,
       round(count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1), 9) AS ratio
FROM labels
""")
def class_balance(t: Tables):
    return labels.class_balance(t.labels, "quality").withColumn("ratio", F.round("ratio", 9))


@query("""
SELECT doc_id, quality, round(CASE WHEN quality = 1 THEN (SELECT count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1) FROM labels)
                              ELSE 1.0 END, 9) AS weight FROM labels
""")
def class_weight(t: Tables):
    rows = t.labels.select("doc_id", "quality")
    return labels.class_weight(rows, "quality").withColumn("weight", F.round("weight", 9))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 AND c_acctbal < 0 OR c_nationkey > 20 OR c_mktsegment = 'BUILDING'
                       THEN 0 ELSE 1 END AS label
FROM customer
""")
def label_rules(t: Tables):
    balance = F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal"))
    conditions = [balance < 0, F.col("c_nationkey") > 20, F.col("c_mktsegment") == "BUILDING"]
    return labels.label_rules(t.customer, conditions).select("c_custkey", "label")


@query("""
SELECT 'o_totalprice' AS column_name, unnest([0.33, 0.66])::DOUBLE AS prob, unnest((SELECT quantile_disc(o_totalprice, [0.33, 0.66]) FROM orders)) AS value
UNION ALL
SELECT 'price_gap', unnest([0.33, 0.66])::DOUBLE, unnest((SELECT quantile_disc(CASE WHEN o_orderkey % 4 <> 0 THEN round(o_totalprice / 1000) END, [0.33, 0.66]) FROM orders))
""")
def quantile_thresholds(t: Tables):
    """Exact discrete quantiles of two columns, one with NULLs and many repeated values."""
    rows = t.orders.select(
        "o_totalprice", F.when(F.col("o_orderkey") % 4 != 0, F.round(F.col("o_totalprice") / 1000)).alias("price_gap")
    )
    return ordered.quantile_thresholds(rows, ["o_totalprice", "price_gap"], [0.33, 0.66])


@query("""
SELECT unnest(['o_totalprice', 'o_totalprice', 'o_custkey', 'o_custkey']) AS column_name,
       unnest([0.33, 0.66, 0.33, 0.66])::DOUBLE AS prob, true AS within_error
""")
def quantile_approx(t: Tables):
    """Sketched quantiles, with their rank error counted over the whole table."""
    rows = t.orders.select("o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    found = ordered.quantile_thresholds(rows, ["o_totalprice", "o_custkey"], [0.33, 0.66], rel_err=0.01)
    cut = found.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.concat("column_name", F.lit("@"), F.col("prob").cast("string")), "value")))).scalar()
    tests = [(c, p) for c in ("o_totalprice", "o_custkey") for p in (0.33, 0.66)]
    counted = rows.withColumn("_cut", cut).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c) < F.col("_cut")[f"{c}@{p}"]).alias(f"lt_{c}_{i}") for i, (c, p) in enumerate(tests)],
        *[F.count_if(F.col(c) <= F.col("_cut")[f"{c}@{p}"]).alias(f"le_{c}_{i}") for i, (c, p) in enumerate(tests)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(p).alias("prob"),
            (
                (F.col(f"lt_{c}_{i}") <= (p + 0.01) * F.col("n")) & (F.col(f"le_{c}_{i}") >= (p - 0.01) * F.col("n"))
            ).alias("within_error"),
        )
        for i, (c, p) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*entries)))


@query("""
SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)))
       <= floor(0.2 * count(*) OVER (PARTITION BY quality) + 0.5) AS is_test
FROM labels
""")
def split_stratified(t: Tables):
    return labels.split_stratified(t.labels.select("doc_id", "quality"), "quality", "doc_id", 0.2)


@query("""
SELECT quality, count(*) AS n_rows, CAST(floor(count(*) * 0.2 + 0.5 + 1e-9) AS BIGINT) AS n_test FROM labels GROUP BY quality
""")
def split_stratified_nulls(t: Tables):
    """The share is exact although most rows have no key."""
    rows = t.labels.select(F.when(F.col("doc_id") % 10 == 0, F.col("doc_id")).alias("key"), "doc_id", "quality")
    marked = labels.split_stratified(rows, "quality", "key", 0.2)
    return marked.groupBy("quality").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("is_test").alias("n_test"))


# ---- metrics --------------------------------------------------------------

_SCORED_SQL = """
s AS (SELECT quality AS label, round(n_chars / (SELECT max(n_chars) FROM documents), 3) AS score
      FROM labels JOIN documents USING (doc_id))"""


def _scored(t: Tables):
    longest = t.documents.agg(F.max("n_chars")).scalar()
    scores = t.documents.select("doc_id", F.round(F.col("n_chars") / longest, 3).alias("score"))
    return t.labels.select("doc_id", F.col("quality").alias("label")).join(scores, "doc_id")


@query(f"""
WITH {_SCORED_SQL},
c AS (SELECT count(*) FILTER (label = 1 AND score > 0.01) AS tp, count(*) FILTER (label = 0 AND score > 0.01) AS fp,
             count(*) FILTER (label = 1 AND score <= 0.01) AS fn, count(*) FILTER (label = 0 AND score <= 0.01) AS tn FROM s)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1
FROM c
""")
def eval_confusion(t: Tables):
    rows = _scored(t).withColumn("prediction", (F.col("score") > 0.01).cast("int"))
    found = evaluate.eval_confusion(rows, "label", "prediction")
    return found.withColumns({c: F.round(c, 9) for c in ("accuracy", "precision", "recall", "f1")})


@query(f"""
WITH {_SCORED_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM s),
n AS (SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg, sum(rk) FILTER (label = 1) AS rs FROM r)
SELECT n_pos, n_neg, round((rs - n_pos * (n_pos + 1) / 2) / (n_pos * n_neg), 9) AS auc FROM n
""")
def eval_auc(t: Tables):
    return evaluate.eval_auc(_scored(t), "label", "score").withColumn("auc", F.round("auc", 9))


# ---- training set and learning --------------------------------------------

_PANEL_SQL = f"""{NATION_ORDERS_SQL},
p AS (SELECT nation, year, month, round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders,
             count(DISTINCT o_custkey) AS n_customers, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_urgent
      FROM no GROUP BY 1, 2, 3)"""


def _panel(t: Tables):
    return (
        nation_orders(t)
        .groupBy(*MONTHLY_KEYS)
        .agg(
            money(F.sum("o_totalprice")).alias("revenue"),
            F.count(F.lit(1)).alias("n_orders"),
            F.countDistinct("o_custkey").alias("n_customers"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        )
    )


FEATURES = ["revenue", "n_orders", "n_customers", "n_urgent"]


def _training_set(t: Tables):
    panel = store(_panel(t), "panel")
    conditions = below(low_thresholds(panel, ["revenue", "n_customers"], 0.33, rel_err=0)) + [
        F.col("n_urgent") > F.col("n_orders") * 0.3
    ]
    return build_training_set(panel, conditions, MONTHLY_KEYS)


_SPLIT_SQL = f"""
WITH {_PANEL_SQL},
q AS (SELECT quantile_disc(revenue, 0.33) AS r33, quantile_disc(n_customers, 0.33) AS c33 FROM p),
l AS (SELECT p.*, CASE WHEN revenue < r33 OR n_customers < c33 OR n_urgent > n_orders * 0.3 THEN 0 ELSE 1 END AS label FROM p, q),
m AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', nation, year, month)))
                <= floor(0.2 * count(*) OVER (PARTITION BY label) + 0.5) AS is_test FROM l)"""


@query(f"""
{_SPLIT_SQL},
w AS (SELECT count(*) FILTER (label = 0) / nullif(count(*) FILTER (label = 1), 0) AS ratio FROM m WHERE NOT is_test)
SELECT nation, year, month, label, is_test, round(CASE WHEN label = 1 THEN ratio ELSE 1.0 END, 9) AS weight FROM m, w
""")
def training_set(t: Tables):
    return _training_set(t).select(*MONTHLY_KEYS, "label", "is_test", F.round("weight", 9).alias("weight"))


@query(f"{_SPLIT_SQL} SELECT nation, year, month, label, true AS in_range, true AS by_threshold, true AS learnt FROM m WHERE is_test")
def ml_train_score(t: Tables):
    """Fit boosted trees on the training part and score the rest; what SQL can't say is checked against what must hold."""
    rows = store(_training_set(t), "training_set")
    seen = rows.filter(~F.col("is_test"))
    model = learn.train(seen, FEATURES, maxIter=5, maxDepth=3)
    auc = evaluate.eval_auc(learn.score_with(model, seen, FEATURES), "label", "probability").first()["auc"]
    p = F.col("probability")
    return learn.score_with(model, rows.filter("is_test"), FEATURES).select(
        *MONTHLY_KEYS,
        "label",
        p.between(0, 1).alias("in_range"),
        (F.col("prediction") == (p > 0.5).cast("int")).alias("by_threshold"),
        F.lit(auc is not None and auc > 0.8).alias("learnt"),
    )


@query("""
WITH f AS (SELECT doc_id, quality, toxic, floor((row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::VARCHAR)) - 1) * 10 / count(*) OVER (PARTITION BY quality))::INT AS fold FROM labels)
SELECT *, count(*) OVER (PARTITION BY quality, fold) AS n_in_fold, count(*) OVER (PARTITION BY quality) AS n_in_class FROM f
""")
def cv_folds_stratified(t: Tables):
    """Ten exact folds of each class, with how many rows the fold and the class hold."""
    folds = store(labels.stratified_folds(t.labels, "quality", "doc_id", 10), "folds")
    counts = folds.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n_in_fold"))
    classes = folds.groupBy("quality").agg(F.count(F.lit(1)).alias("n_in_class"))
    return folds.join(counts.join(classes, "quality"), ["quality", "fold"]).select("doc_id", "quality", "toxic", "fold", "n_in_fold", "n_in_class")


@query("""
SELECT * FROM (VALUES (0, '{"maxDepth": 2, "stepSize": 0.1}', true), (1, '{"maxDepth": 3, "stepSize": 0.1}', true)) g(point, settings, is_share)
""")
def ml_grid_search(t: Tables):
    rows = store(_training_set(t), "training_set").filter(~F.col("is_test"))
    grid = {"maxDepth": [2, 3], "stepSize": [0.1]}
    search = learn.grid_search(rows, FEATURES, grid, folds=2, parallelism=2, key=MONTHLY_KEYS, maxIter=3)
    return learn.grid_results(search, t.spark).select("point", "settings", F.col("mean_auc").between(0.5, 1).alias("is_share"))


@query("""
SELECT 'run-1' AS run_id, kind, name, value, true AS loaded_as_fitted
FROM (VALUES ('metric', 'tp', NULL), ('metric', 'fp', NULL), ('metric', 'fn', NULL), ('metric', 'tn', NULL), ('metric', 'accuracy', NULL),
    ('metric', 'precision', NULL), ('metric', 'recall', NULL), ('metric', 'f1', NULL), ('param', 'maxIter', '3'), ('param', 'maxDepth', '2')) l(kind, name, value)
""")
def ml_save_load_score(t: Tables):
    """Fit, save, load, score, evaluate and log the run; the loaded model has to score as the fitted one does."""
    root = scratch_dir(t.spark)
    rows = store(_training_set(t), "training_set")
    settings, unseen = {"maxIter": 3, "maxDepth": 2}, rows.filter("is_test")
    fitted = learn.train(rows.filter(~F.col("is_test")), FEATURES, **settings)
    learn.save_model(fitted, f"{root}/model")
    scored = learn.score_with(learn.load_model(f"{root}/model"), unseen, FEATURES)
    keys = [*MONTHLY_KEYS, "probability"]
    same = scored.select(keys).exceptAll(learn.score_with(fitted, unseen, FEATURES).select(keys)).isEmpty()
    log = learn.log_run(evaluate.eval_confusion(scored, "label", "prediction"), "run-1", settings, f"{root}/runs")
    value = F.when(F.col("kind") == "param", F.col("value"))
    return log.select("run_id", "kind", "name", value.alias("value"), F.lit(same).alias("loaded_as_fitted"))


@query("""
WITH rows AS (SELECT o_orderkey, month(o_orderdate) >= 5 AND month(o_orderdate) < 9 AS label,
    row_number() OVER (PARTITION BY month(o_orderdate) >= 5 AND month(o_orderdate) < 9 ORDER BY md5(o_orderkey::VARCHAR)) AS r,
    count(*) OVER (PARTITION BY month(o_orderdate) >= 5 AND month(o_orderdate) < 9) AS n FROM orders),
test AS (SELECT * FROM rows WHERE r <= floor(0.2 * n + 0.5)),
counts AS (SELECT count(*) FILTER (label) AS tp, count(*) FILTER (NOT label) AS tn FROM test)
SELECT 'run-2' AS run_id, kind, name, value FROM (
    SELECT 'metric' AS kind, unnest(['tp', 'fp', 'fn', 'tn', 'accuracy', 'precision', 'recall', 'f1']) AS name,
        unnest([tp::DOUBLE, 0, 0, tn, 1, 1, 1, 1])::DOUBLE AS value FROM counts
    UNION ALL VALUES ('param', 'maxDepth', 3), ('param', 'maxIter', 5))
""")
def ml_logged_metrics(t: Tables):
    """A run's log with its values: the label follows from the month, so that trees of depth 3 find it and SQL knows every count."""
    month = F.month("o_orderdate")
    rows = t.orders.select("o_orderkey", month.cast("double").alias("month"), (F.col("o_custkey") % 7).alias("noise"), month.between(5, 8).cast("int").alias("label"))
    marked = store(labels.split_stratified(rows, "label", "o_orderkey", 0.2), "marked")
    settings = {"maxIter": 5, "maxDepth": 3}
    root = scratch_dir(t.spark)
    learn.save_model(learn.train(marked.filter("NOT is_test"), ["month", "noise"], weight=None, **settings), f"{root}/model")
    scored = learn.score_with(learn.load_model(f"{root}/model"), marked.filter("is_test"), ["month", "noise"])
    log = learn.log_run(evaluate.eval_confusion(scored, "label", "prediction"), "run-2", settings, f"{root}/runs")
    return log.withColumn("value", F.round(F.col("value").cast("double"), 9))


# ---- batch scoring --------------------------------------------------------

@query("""
WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT c_custkey, round(0.05 + 0.9 * (c_acctbal - lo) / (hi - lo + 1e-6), 9) AS probability FROM customer, b
""")
def score_minmax(t: Tables):
    scored = score.rescale_scores(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal")
    return scored.select("c_custkey", F.round("probability", 9).alias("probability"))


def _requests(t: Tables):
    """One request per event: a place and a date within 2024."""
    return t.events.select(
        "event_id",
        (F.col("user_id") % 25).cast("int").alias("nation"),
        F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 300).cast("int")).alias("day"),
        "value",
    )


_REQUESTS_SQL = """
rq AS (SELECT event_id, (user_id % 25)::INT AS nation, CAST(CAST(ts AS DATE) + (event_id % 300)::INT AS DATE) AS day, value FROM events),
rqm AS (SELECT *, year(day)::INT AS year, month(day)::INT AS month FROM rq)"""


def _features(t: Tables, keep):
    """The monthly panel as a stored table, as a scoring job would find it."""
    rows = nation_orders(t).filter(keep).groupBy(*MONTHLY_KEYS).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.floor("o_totalprice")).alias("revenue")
    )
    return store(rows, "features").drop("year")


@query(f"""
WITH {NATION_ORDERS_SQL}, {_REQUESTS_SQL},
f AS (SELECT nation, year, month, count(*) AS n_orders, sum(floor(o_totalprice)) AS revenue FROM no WHERE nation % 5 <> 0 GROUP BY 1, 2, 3),
g AS (SELECT nation, month, avg(n_orders) AS n_orders, avg(revenue) AS revenue FROM f GROUP BY 1, 2)
SELECT event_id, r.nation, day, r.year, r.month, round(n_orders, 6) AS n_orders, round(revenue, 4) AS revenue,
       g.nation IS NOT NULL AS found
FROM rqm r LEFT JOIN g ON r.nation = g.nation AND r.month = g.month
""")
def score_lookup(t: Tables):
    features = _features(t, F.col("nation") % 5 != 0)
    found = score.score_lookup(_requests(t).drop("value"), features, "nation", "day", ["n_orders", "revenue"])
    return found.withColumns({"n_orders": F.round("n_orders", 6), "revenue": F.round("revenue", 4)})


_FALLBACK_SQL = f"""{NATION_ORDERS_SQL}, {_REQUESTS_SQL},
f AS (SELECT nation, year, month, count(*) AS n_orders, sum(floor(o_totalprice)) AS revenue FROM no
      WHERE nation % 5 <> 0 AND (month % 2 = 0 OR (nation % 2 = 0 AND month > 8)) GROUP BY 1, 2, 3),
g AS (SELECT nation, month, avg(n_orders) AS n_orders, avg(revenue) AS revenue FROM f GROUP BY 1, 2),
md AS (SELECT nation, median(month) AS mid FROM f GROUP BY 1),
u AS (SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM g WHERE g.nation = r.nation AND g.month = r.month) THEN r.month ELSE md.mid END AS used
      FROM rqm r LEFT JOIN md ON md.nation = r.nation),
found AS (SELECT u.*, g.month AS used_month, g.n_orders, g.revenue, g.nation IS NOT NULL AS found
          FROM u LEFT JOIN g ON g.nation = u.nation AND g.month = u.used)"""


def _gappy_features(t: Tables):
    even_or_late = (F.col("month") % 2 == 0) | ((F.col("nation") % 2 == 0) & (F.col("month") > 8))
    return _features(t, (F.col("nation") % 5 != 0) & even_or_late)


@query(f"""
WITH {_FALLBACK_SQL}
SELECT event_id, nation, month, used_month, round(n_orders, 6) AS n_orders, found FROM found
""")
def score_month_fallback(t: Tables):
    found = score.score_month_fallback(_requests(t), _gappy_features(t), "nation", "day", ["n_orders", "revenue"])
    return found.select("event_id", "nation", "month", "used_month", F.round("n_orders", 6).alias("n_orders"), "found")


@query(f"""
WITH {_FALLBACK_SQL}
SELECT event_id, nation, day, CASE WHEN found THEN round(n_orders / (n_orders + 50), 9) END AS probability,
       CASE WHEN found THEN CAST(n_orders / (n_orders + 50) > 0.5 AS INT) END AS prediction
FROM found
""")
def score_batch(t: Tables):
    found = score.score_month_fallback(_requests(t), _gappy_features(t), "nation", "day", ["n_orders"])
    scored = found.withColumn("probability", F.col("n_orders") / (F.col("n_orders") + 50))
    predicted = score.predict_batch(scored, "probability")
    return predicted.select("event_id", "nation", "day", F.round("probability", 9).alias("probability"), "prediction")


_PLACES = ["Barcelona", "Illes Balears", "Valencia", "Sevilla", "Madrid", "Bilbao"]


def _city_requests(t: Tables):
    city = F.element_at(F.array(*[F.lit(p) for p in _PLACES]), (F.col("nation") % 6 + 1).cast("int"))
    return _requests(t).withColumns({"city": city, "month": F.month("day"), "p": F.col("value") / 500})


_CITY_SQL = f"""{_REQUESTS_SQL},
rc AS (SELECT *, ['Barcelona', 'Illes Balears', 'Valencia', 'Sevilla', 'Madrid', 'Bilbao'][nation % 6 + 1] AS city, value / 500 AS p FROM rqm)"""
_BIAS_SQL = """CASE
  WHEN city IN ('Barcelona', 'Illes Balears') THEN CASE WHEN month IN (6, 7, 8) THEN 0.30 WHEN month IN (4, 5, 9, 10) THEN 0.45
       WHEN month IN (12, 1, 2) THEN 0.10 ELSE 0.25 END
  WHEN city = 'Valencia' THEN CASE WHEN month IN (6, 7, 8) THEN -0.40 WHEN month IN (4, 5, 9, 10) THEN 0.40
       WHEN month IN (11, 12, 1, 2) THEN 0.10 ELSE 0.25 END
  WHEN city = 'Sevilla' THEN CASE WHEN month IN (6, 7, 8) THEN -0.85 WHEN month IN (5, 9) THEN -0.25 WHEN month IN (4, 10) THEN 0.25
       WHEN month IN (11, 12, 1, 2) THEN 0.05 ELSE 0.15 END
  WHEN city = 'Madrid' THEN CASE WHEN month IN (12, 1, 2) THEN -0.15 WHEN month IN (3, 4, 5) THEN 0.25 WHEN month IN (6, 7, 8) THEN -0.10
       ELSE 0.20 END
  ELSE 0 END::DOUBLE"""
_CUT_SQL = "CASE WHEN month IN (6, 7, 8) THEN 0.50 WHEN month IN (4, 5, 9, 10) THEN 0.42 ELSE 0.46 END"
_CITY_CUT_SQL = "CASE city WHEN 'Barcelona' THEN 0.40 WHEN 'Valencia' THEN 0.53 WHEN 'Madrid' THEN 0.34 WHEN 'Sevilla' THEN 0.40 WHEN 'Illes Balears' THEN 0.45 ELSE 0.5 END::DOUBLE"


@query(f"""
WITH {_CITY_SQL}, a AS (SELECT *, 0.55::DOUBLE * p + 0.45::DOUBLE / (1 + exp(-((p - 0.5) * 4 + {_BIAS_SQL}))) AS adjusted FROM rc)
SELECT event_id, city, month, round(adjusted, 9) AS adjusted, CAST(adjusted > {_CUT_SQL} AS INT) AS season_prediction FROM a
""")
def score_seasonal_adjust(t: Tables):
    adjusted = score.seasonal_adjust(_city_requests(t), "p", "city", "month")
    return adjusted.select("event_id", "city", "month", F.round("adjusted", 9).alias("adjusted"), "season_prediction")


_PENALTY_SQL = """greatest(least({p} - CASE WHEN {rain} > 8 THEN 0.1::DOUBLE * ({rain} - 8) / 10 ELSE 0 END
       - CASE WHEN {temp} < 10 THEN 0.05::DOUBLE * (10 - {temp}) / 10 WHEN {temp} > 30 THEN 0.1::DOUBLE * ({temp} - 30) / 10 ELSE 0 END, 1), 0)"""


@query(f"""
WITH r AS (SELECT event_id, value / 500 AS p, CASE WHEN event_id % 7 <> 0 THEN event_id % 31 END AS rain, event_id % 45 AS temp FROM events)
SELECT event_id, round({_PENALTY_SQL.format(p='p', rain='rain', temp='temp')}, 9) AS adjusted FROM r
""")
def score_climate_penalty(t: Tables):
    rows = t.events.select(
        "event_id",
        (F.col("value") / 500).alias("p"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 31).alias("rain"),
        (F.col("event_id") % 45).alias("temp"),
    )
    adjusted = score.climate_penalty(rows, "p", "rain", "temp")
    return adjusted.select("event_id", F.round("adjusted", 9).alias("adjusted"))


_VERDICT_SQL = """CASE WHEN {p} >= {cut} THEN '✅ Es un buen momento para viajar a ' ELSE '⚠️ No es un buen momento para viajar a ' END
       || city || ' (' || printf('%.1f%%', {p} * 100) || ' de probabilidad favorable)'"""


@query(f"""
WITH {_CITY_SQL}, v AS (SELECT event_id, city, floor(value * 2) / 1000 AS p FROM rc)
SELECT event_id, city, {_CITY_CUT_SQL} AS threshold, CAST(p >= {_CITY_CUT_SQL} AS INT) AS recommended,
       {_VERDICT_SQL.format(p='p', cut=_CITY_CUT_SQL)} AS verdict FROM v
""")
def score_verdict(t: Tables):
    rows = _city_requests(t).select("event_id", "city", (F.floor(F.col("value") * 2) / 1000).alias("p"))
    return score.verdict(rows, "p", "city").select("event_id", "city", "threshold", "recommended", "verdict")


@query(f"""
WITH {_FALLBACK_SQL},
a AS (SELECT *, n_orders / (n_orders + 50) AS p, CASE nation % 3 WHEN 0 THEN 0.3 WHEN 1 THEN -0.2 ELSE 0 END::DOUBLE AS bias FROM found),
b AS (SELECT *, 0.55::DOUBLE * p + 0.45::DOUBLE / (1 + exp(-((p - 0.5) * 4 + CASE WHEN month <= 6 THEN bias ELSE 0 END))) AS blended FROM a),
c AS (SELECT *, {_PENALTY_SQL.format(p='blended', rain='(n_orders / 10)', temp='(revenue % 40)')} AS adjusted FROM b),
d AS (SELECT *, CASE WHEN nation % 2 = 0 THEN 0.4 ELSE 0.5 END::DOUBLE AS threshold FROM c)
SELECT event_id, nation, day, found, CASE WHEN found THEN round(p, 9) END AS probability,
       CASE WHEN found THEN CAST(p > 0.5 AS INT) END AS prediction, CASE WHEN found THEN round(adjusted, 9) END AS adjusted,
       CASE WHEN found THEN CAST(blended > {_CUT_SQL} AS INT) END AS season_prediction, threshold,
       CASE WHEN found THEN CAST(adjusted >= threshold AS INT) END AS recommended
FROM d
""")
def recommend_batch(t: Tables):
    """Lookup with fallback, probability, seasonal and climate adjustment and verdict in one plan."""
    features = _gappy_features(t).withColumn("n_rain", F.col("n_orders") / 10)
    season = [(n, m, {0: 0.3, 1: -0.2, 2: 0.0}[n % 3]) for n in range(25) for m in range(1, 7)]
    bias = literal_dim(t.spark, season, "place int, month int, bias double")
    cuts = literal_dim(t.spark, [(n, 0.4) for n in range(0, 25, 2)], "place int, threshold double")

    def model(df):
        p = F.col("n_orders") / (F.col("n_orders") + 50)
        return df.withColumns({"probability": p, "temp": F.col("revenue") % 40})

    advised = recommend(
        _requests(t),
        features,
        "nation",
        "day",
        ["n_orders", "revenue", "n_rain"],
        model,
        rain_days="n_rain",
        mean_temp="temp",
        bias=bias,
        thresholds=cuts,
    )
    return advised.select(
        "event_id", "nation", "day", "found", F.round("probability", 9).alias("probability"), "prediction",
        F.round("adjusted", 9).alias("adjusted"), "season_prediction", "threshold", "recommended",
    )
