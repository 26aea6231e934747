"""What is kept from load to load: statistics, thresholds, clustered files and attempts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans.reload import next_requests
from stratalake.sources import clustered, loadstats
from stratalake.sources.scratch import scratch_dir
from stratalake.streaming import retries
from suite.registry import Tables, query


@query("""
WITH loads AS (SELECT l, e.* FROM events e JOIN (VALUES (0), (1), (2), (3)) x(l) ON event_id % 4 = l OR event_id % 8 = 0)
SELECT event_type, count(DISTINCT l) AS n_loads, count(*) AS n_rows, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day,
       count(DISTINCT event_id) AS n_events, count(DISTINCT user_id) AS n_users, true AS events_within, true AS users_within
FROM loads GROUP BY event_type
""")
def load_stats_sketch(t: Tables):
    """Four overlapping loads, one of them recorded twice: totals and distinct counts from stored entries, the latter within 5 % of the exact ones beside them."""
    path = f"{scratch_dir(t.spark)}/entries"
    key = F.col("event_id")
    for load in (0, 1, 2, 3, 0):
        rows = t.events.filter((key % 4 == load) | (key % 8 == 0))
        loadstats.record_load(rows, f"part{load}", path, by=["event_type"], distinct=["event_id", "user_id"], day="ts")
    totals = loadstats.load_totals(t.spark, path, ["event_type"])
    exact = t.events.groupBy("event_type").agg(F.countDistinct("event_id").alias("n_events"), F.countDistinct("user_id").alias("n_users"))
    near = lambda estimate, n: F.abs(F.col(estimate) - F.col(n)) <= 0.05 * F.col(n)
    return totals.join(exact, "event_type").select(
        "event_type",
        "n_loads",
        "n_rows",
        "first_day",
        "last_day",
        "n_events",
        "n_users",
        near("event_id_estimate", "n_events").alias("events_within"),
        near("user_id_estimate", "n_users").alias("users_within"),
    )


@query("""
SELECT column_name, prob, CASE column_name WHEN 'o_totalprice' THEN n ELSE m END AS n, true AS rank_within
FROM (VALUES ('o_totalprice', 0.33::DOUBLE), ('o_totalprice', 0.66), ('o_custkey', 0.33), ('o_custkey', 0.66)) p(column_name, prob),
     (SELECT count(*) FILTER (o_orderkey % 10 > 0) AS n, count(*) AS m FROM orders)
""")
def quantile_sketch_merged(t: Tables):
    """Thresholds from the months' stored sketches; the last month, and late rows of all months, arrive afterwards."""
    path = f"{scratch_dir(t.spark)}/sketches"
    price = F.when(F.col("o_orderkey") % 10 > 0, F.col("o_totalprice")).otherwise(F.when(F.col("o_orderkey") % 20 == 0, float("nan")))
    orders = t.orders.select("o_orderkey", price.alias("o_totalprice"), "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    newest, late = F.col("year") >= 2001, F.col("o_orderkey") % 25 == 0
    for load, rows in (("months", ~newest & ~late), ("newest", newest & ~late), ("late", late)):
        loadstats.record_load(orders.filter(rows), load, path, by=["year", "month"], numbers=["o_totalprice", "o_custkey"])
    found = loadstats.merged_quantiles(t.spark, path, [0.33, 0.66])
    each = orders.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in ("o_totalprice", "o_custkey")])).alias("e"))
    each = each.select("e.*").where("v IS NOT NULL AND NOT isnan(v)")
    upto = each.join(found, "column_name").groupBy("column_name", "prob").agg(
        F.first("n").alias("n"), F.count_if(F.expr("v < value")).alias("below"), F.count_if(F.expr("v <= value")).alias("upto")
    )
    # The rank lies between the share below the value and the share up to it.
    within = (F.col("below") / F.col("n") <= F.col("prob") + 0.01) & (F.col("upto") / F.col("n") >= F.col("prob") - 0.01)
    return upto.select("column_name", "prob", "n", within.alias("rank_within"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, 0::BIGINT AS n_disordered, true AS all_indexed, true AS most_skipped
FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-03-31'
""")
def clustered_read(t: Tables):
    """A month out of twelve files clustered by day: rows are in order within files, the index knows all rows, and most files are not opened."""
    path = f"{scratch_dir(t.spark)}/clustered"
    index = clustered.write_clustered(t.lineitem, path, ["l_shipdate", "l_orderkey"], files=12)
    low, high = (F.lit(f"1998-03-{d}").cast(t.lineitem.schema["l_shipdate"].dataType) for d in ("01", "31"))
    rows = clustered.read_clustered(t.spark, path, "l_shipdate", low, high)
    wrong = clustered.disorder(t.spark, path, "l_shipdate").agg(F.sum("n_disordered")).scalar()
    indexed = index.agg(F.sum("n_rows")).scalar() == t.lineitem.agg(F.count(F.lit(1))).scalar()
    opened = len(clustered.files_between(t.spark, path, low, high))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", wrong.alias("n_disordered"), indexed.alias("all_indexed"), F.lit(opened <= 3).alias("most_skipped"))


_RETRY_SQL = """
results AS (SELECT user_id % 997 AS key, event_id AS seq, event_id % 2 AS delivery, event_type = 'purchase' AS ok FROM events),
placed AS (
  SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER w AS failed, coalesce(bool_or(ok) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS done
  FROM results WINDOW w AS (PARTITION BY key ORDER BY delivery, seq)),
states AS (
SELECT key, least(6, max(failed) FILTER (NOT done))::INT AS attempts,
       CASE WHEN max(failed) FILTER (NOT done) >= 6 THEN 'gave up' WHEN bool_or(ok) THEN 'loaded' ELSE 'pending' END AS status
FROM placed GROUP BY key)"""


@query(f"WITH {_RETRY_SQL} SELECT * FROM states")
def retry_state(t: Tables):
    """Results of loads in two deliveries; a key is given up after six failures before its first success."""
    return _states(t)


def _states(t: Tables):
    path = scratch_dir(t.spark)
    results = t.events.select((F.col("user_id") % 997).alias("key"), F.col("event_id").alias("seq"), (F.col("event_type") == "purchase").alias("ok"))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("ok", T.BooleanType())])
    for delivery in (0, 1):
        results.filter(F.col("seq") % 2 == delivery).write.mode("append").json(f"{path}/landing")
        retries.track_attempts(t.spark, f"{path}/landing", schema, 6, f"{path}/state")
    return retries.attempt_states(t.spark, f"{path}/state")


@query(f"""
WITH {_RETRY_SQL},
requested AS (
  SELECT DISTINCT o_custkey % 160 AS place, CAST(o_orderdate AS DATE) AS asked_from, CAST(o_orderdate AS DATE) + (o_orderkey % 60)::INT AS asked_to FROM orders),
covered AS (
  SELECT DISTINCT user_id % 997 AS place, unnest(generate_series(DATE '1995-01-01' + (event_id * 7919 % 2400)::INT,
         DATE '1995-01-01' + (event_id * 7919 % 2400 + event_id % 30)::INT, INTERVAL 1 DAY))::DATE AS day FROM events),
days AS (
  SELECT *, unnest(generate_series(asked_from, asked_to, INTERVAL 1 DAY))::DATE AS day FROM requested r
  WHERE NOT EXISTS (SELECT 1 FROM states s WHERE s.key = r.place AND status = 'gave up')),
open AS (
  SELECT *, day - row_number() OVER (PARTITION BY place, asked_from, asked_to ORDER BY day)::INT AS stretch
  FROM days d WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.place = d.place AND c.day = d.day))
SELECT place, asked_from, asked_to, min(day) AS interval_start, max(day) AS interval_end FROM open GROUP BY place, asked_from, asked_to, stretch
""")
def reload_next_requests(t: Tables):
    """What to ask for next: the open days of the places that have not been given up."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    ends = [day, F.date_add(day, (key % 60).cast("int"))]
    names = ["asked_from", "asked_to", "interval_start", "interval_end"]
    requested = t.orders.select((F.col("o_custkey") % 160).alias("place"), *[c.alias(n) for n, c in zip(names, ends * 2, strict=True)])
    n = F.col("event_id")
    first = F.date_add(F.lit("1995-01-01").cast("date"), (n * 7919 % 2400).cast("int"))
    loaded = t.events.select((F.col("user_id") % 997).alias("place"), first.alias("interval_start"), F.date_add(first, (n % 30).cast("int")).alias("interval_end"))
    return next_requests(requested, loaded, _states(t), ["place"])
