"""Projection, normalisation, missing values, filters and quality reports."""

from pyspark.sql import functions as F

from stratalake.operators import clean, quality
from stratalake.operators.joins import attach_dimension
from stratalake.plans.climate import build_daily_readings
from stratalake.plans.datasets import MonthlyDataset, clean_monthly, keep_selected, report_monthly
from stratalake.plans.reports import report_extract as extract
from suite.registry import Tables, dated, query


@query("SELECT o_orderkey AS pedido, upper(o_orderpriority) AS prioridad, o_totalprice AS importe FROM orders")
def proj_rename(t: Tables):
    names = {"o_orderkey": "pedido", "o_orderpriority": "prioridad", "o_totalprice": "importe"}
    return clean.project_renamed(t.orders, names).withColumn("prioridad", F.upper("prioridad"))


@query("SELECT p_partkey, p_brand, p_size FROM part")
def proj_existing_cols(t: Tables):
    return clean.project_existing(t.part, ["p_partkey", "p_container", "p_brand", "p_size", "p_comment"])


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def normalize_values(t: Tables):
    df = t.customer.select("c_custkey", "c_mktsegment")
    return clean.normalize_values(df, "c_mktsegment", {"AUTOMOBILE": "AUTO"})


@query("""
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'basic' WHEN 'STANDARD' THEN 'basic' WHEN 'PROMO' THEN 'offer'
                  WHEN 'LARGE' THEN 'bulk' ELSE p_type END AS p_type FROM part
""")
def normalize_values_multi(t: Tables):
    mapping = {"ECONOMY": "basic", "STANDARD": "basic", "PROMO": "offer", "LARGE": "bulk"}
    return clean.normalize_values(t.part.select("p_partkey", "p_type"), "p_type", mapping)


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def normalize_columns(t: Tables):
    return clean.normalize_columns(
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        {"o_orderstatus": {"F": "finished", "O": "open"}, "o_orderpriority": {"1-URGENT": "urgent"}},
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS price
FROM lineitem
""")
def decimal_comma_cast(t: Tables):
    text = F.when(F.col("l_linenumber") == 7, "Ip").otherwise(
        F.translate(F.col("l_extendedprice").cast("string"), ".", ",")
    )
    return clean.decimal_comma_cast(t.lineitem.select("l_orderkey", "l_linenumber", text.alias("price")), ["price"])


# ---- filters --------------------------------------------------------------

@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(t: Tables):
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality <> 0")
def filter_ne_null(t: Tables):
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.filter(F.col("quality") != 0)


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_isin(t: Tables):
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_nationkey")


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH'))
""")
def filter_pairs(t: Tables):
    pairs = [("F", "1-URGENT"), ("O", "5-LOW"), ("P", "2-HIGH")]
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return clean.filter_pairs(rows, ["o_orderstatus", "o_orderpriority"], pairs)


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 5 AND 44 AND p_partkey % 3 = p_size % 3")
def filter_pairs_many(t: Tables):
    """Forty pairs, as many as a user may list by hand."""
    rows = t.part.select("p_partkey", "p_size", (F.col("p_partkey") % 3).cast("int").alias("third"))
    return clean.filter_pairs(rows, ["p_size", "third"], [(n, n % 3) for n in range(5, 45)]).select("p_partkey", "p_size")


@query("SELECT c_custkey, c_name FROM customer WHERE starts_with(c_name, 'Customer#0000001')")
def filter_prefix(t: Tables):
    return clean.filter_prefix(t.customer.select("c_custkey", "c_name"), "c_name", "Customer#0000001")


# ---- missing values -------------------------------------------------------

def _orders_with_gaps(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def _lines_with_gaps(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_linenumber") % 2 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_returnflag")).alias("l_returnflag"),
    )


@query("""
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0
""")
def drop_nulls_any(t: Tables):
    return clean.drop_nulls(_orders_with_gaps(t))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_quantity END AS l_quantity,
       CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE l_extendedprice END AS l_extendedprice,
       CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag
FROM lineitem
""")
def fill_numeric(t: Tables):
    return clean.fill_numeric(_lines_with_gaps(t), 0)


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 999.0 ELSE l_quantity END AS l_quantity,
       CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag
FROM lineitem
""")
def impute_numeric(t: Tables):
    return clean.impute_numeric(_lines_with_gaps(t), 999.0, ["l_quantity"])


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN 'Desconocido' ELSE p_brand END AS p_brand FROM part
""")
def impute_string(t: Tables):
    brand = F.when(F.col("p_partkey") % 5 == 0, "").when(F.col("p_partkey") % 3 != 0, F.col("p_brand"))
    return clean.impute_string(t.part.select("p_partkey", brand.alias("p_brand")))


# ---- quality --------------------------------------------------------------

@query("""
SELECT w.n_name, count(c.c_custkey) AS n_rows, count(c.c_custkey) > 0 AS has_data
FROM (VALUES ('NATION_1'), ('NATION_7'), ('NATION_24'), ('ATLANTIS')) w(n_name)
LEFT JOIN nation n ON n.n_name = w.n_name LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY w.n_name
""")
def coverage_check(t: Tables):
    named = attach_dimension(t.customer.select("c_custkey", "c_nationkey"), t.nation, "c_nationkey", "n_nationkey", ["n_name"])
    return quality.coverage_check(named, "n_name", ["NATION_1", "NATION_7", "NATION_24", "ATLANTIS"])


def _segment_orders(t: Tables, gap: int = 7):
    """Orders with their customer segment and a price that is missing now and then."""
    orders = dated(t.orders, "o_orderdate").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "year",
        "month",
        F.when(F.col("o_orderkey") % gap != 0, F.col("o_totalprice")).alias("o_totalprice"),
    )
    joined = attach_dimension(orders, t.customer, "o_custkey", "c_custkey", {"c_mktsegment": "segment"})
    return clean.normalize_values(joined, "segment", {"AUTOMOBILE": "AUTO"})


_REPORT_TAIL = """
SELECT {keys}, rows_before, rows_before - rows_after AS rows_dropped, rows_after, months_present,
       coalesce((ly - fy) * 12 + (lm - fm + 1), 0)::BIGINT AS months_expected,
       (coalesce((ly - fy) * 12 + (lm - fm + 1), 0) - months_present)::BIGINT AS months_missing,
       fy::INT AS first_year, fm::INT AS first_month, ly::INT AS last_year, lm::INT AS last_month,
       CASE WHEN rows_after > 0 THEN 'ok' ELSE 'no data' END AS status
FROM (
  SELECT {wkeys}, count(r.ym) AS rows_before, count(*) FILTER (r.kept) AS rows_after,
         count(DISTINCT r.ym) FILTER (r.kept) AS months_present,
         (min(r.ym) FILTER (r.kept)) // 100 AS fy, (min(r.ym) FILTER (r.kept)) % 100 AS fm,
         (max(r.ym) FILTER (r.kept)) // 100 AS ly, (max(r.ym) FILTER (r.kept)) % 100 AS lm
  FROM wanted w LEFT JOIN rows_in r ON {on} GROUP BY {wkeys}
) q
"""


@query(
    """
WITH rows_in AS (
  SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO' ELSE c_mktsegment END AS segment,
         year(o_orderdate) * 100 + month(o_orderdate) AS ym, o_orderkey % 7 <> 0 AS kept
  FROM orders JOIN customer ON o_custkey = c_custkey),
wanted(segment) AS (VALUES ('AUTO'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY'), ('SHIPPING'))
"""
    + _REPORT_TAIL.format(keys="segment", wkeys="w.segment", on="r.segment = w.segment")
)
def quality_report(t: Tables):
    before = _segment_orders(t)
    after = clean.drop_nulls(before)
    wanted = ["AUTO", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "SHIPPING"]
    return quality.quality_report(before, after, "segment", "year", "month", wanted)


@query(
    """
WITH rows_in AS (
  SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO' ELSE c_mktsegment END AS segment, o_orderpriority,
         year(o_orderdate) * 100 + month(o_orderdate) AS ym, o_orderkey % 3 <> 0 AS kept
  FROM orders JOIN customer ON o_custkey = c_custkey),
wanted(segment, o_orderpriority) AS (VALUES ('AUTO', '1-URGENT'), ('BUILDING', '5-LOW'), ('MACHINERY', '9-NONE'))
"""
    + _REPORT_TAIL.format(
        keys="segment, o_orderpriority",
        wkeys="w.segment, w.o_orderpriority",
        on="r.segment = w.segment AND r.o_orderpriority = w.o_orderpriority",
    )
)
def quality_report_pairs(t: Tables):
    """The one-scan form, keyed by pairs."""
    rows = _segment_orders(t, gap=3)
    wanted = [("AUTO", "1-URGENT"), ("BUILDING", "5-LOW"), ("MACHINERY", "9-NONE")]
    return quality.quality_report_marked(
        rows, clean.complete_row(rows), ["segment", "o_orderpriority"], "year", "month", wanted
    )


@query("""
SELECT o_orderstatus, o_orderpriority, min(year(o_orderdate) * 100 + month(o_orderdate)) // 100 AS first_year,
       min(year(o_orderdate) * 100 + month(o_orderdate)) % 100 AS first_month,
       max(year(o_orderdate) * 100 + month(o_orderdate)) // 100 AS last_year,
       max(year(o_orderdate) * 100 + month(o_orderdate)) % 100 AS last_month
FROM orders GROUP BY 1, 2
""")
def first_last_period(t: Tables):
    rows = dated(t.orders, "o_orderdate")
    found = quality.first_last_period(rows, ["o_orderstatus", "o_orderpriority"], "year", "month")
    return found.withColumns(
        {c: F.col(c).cast("bigint") for c in ("first_year", "first_month", "last_year", "last_month")}
    )


@query("""
SELECT o_orderpriority, count(DISTINCT year(o_orderdate) * 100 + month(o_orderdate)) AS n_periods FROM orders GROUP BY 1
""")
def distinct_periods(t: Tables):
    return quality.distinct_periods(dated(t.orders, "o_orderdate"), "o_orderpriority", "year", "month")


# ---- plans ----------------------------------------------------------------

_SEGMENTS = MonthlyDataset(
    "segments",
    {"segments": {"PROVINCIA": {"AUTOMOBILE": "AUTO"}}},
    not_equal={"PRIORIDAD": "5-LOW"},
    report_values=("AUTO", "BUILDING", "SHIPPING"),
    keep=("AUTO", "BUILDING"),
)


def _segment_landing(t: Tables):
    orders = dated(t.orders, "o_orderdate").select(
        F.col("o_orderkey").alias("PEDIDO"),
        F.col("o_custkey"),
        F.col("year").alias("AÑO"),
        F.col("month").alias("MES"),
        F.col("o_orderpriority").alias("PRIORIDAD"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("GASTO"),
    )
    joined = attach_dimension(orders, t.customer, "o_custkey", "c_custkey", {"c_mktsegment": "PROVINCIA"})
    return {"segments": joined.drop("o_custkey")}


@query("""
SELECT o_orderkey AS PEDIDO, year(o_orderdate)::INT AS "AÑO", month(o_orderdate)::INT AS MES, o_orderpriority AS PRIORIDAD,
       o_totalprice AS GASTO, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO' ELSE c_mktsegment END AS PROVINCIA
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderkey % 7 <> 0 AND o_orderpriority <> '5-LOW' AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
""")
def monthly_clean_select(t: Tables):
    return keep_selected(clean_monthly(_segment_landing(t), _SEGMENTS), _SEGMENTS)


@query(
    """
WITH rows_in AS (
  SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTO' ELSE c_mktsegment END AS PROVINCIA,
         year(o_orderdate) * 100 + month(o_orderdate) AS ym,
         o_orderkey % 7 <> 0 AND o_orderpriority <> '5-LOW' AS kept
  FROM orders JOIN customer ON o_custkey = c_custkey),
wanted(PROVINCIA) AS (VALUES ('AUTO'), ('BUILDING'), ('SHIPPING'))
"""
    + _REPORT_TAIL.format(keys="PROVINCIA", wkeys="w.PROVINCIA", on="r.PROVINCIA = w.PROVINCIA")
)
def monthly_clean_report(t: Tables):
    return report_monthly(_segment_landing(t), _SEGMENTS)


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS fecha, user_id AS idema, c_mktsegment AS municipio,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS precipitacion,
       CASE WHEN event_id % 4 = 0 THEN 'Desconocido' ELSE strftime(ts, '%H:%M') END AS hora
FROM events JOIN customer ON user_id = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def climate_daily_build(t: Tables):
    """Readings of chosen stations: events are the readings, customers of two segments the stations."""
    raw = t.events.select(
        F.col("ts").cast("date").alias("fecha_dt"),
        "user_id",
        F.when(F.col("event_id") % 9 == 0, "Ip").otherwise(F.translate(F.col("value").cast("string"), ".", ",")).alias("prec"),
        F.when(F.col("event_id") % 8 == 0, "").when(F.col("event_id") % 4 != 0, F.date_format("ts", "HH:mm")).alias("hora"),
    )
    chosen = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return build_daily_readings(
        raw,
        chosen,
        "user_id",
        "c_custkey",
        {"c_mktsegment": "municipio"},
        {"fecha_dt": "fecha", "user_id": "idema", "municipio": "municipio", "prec": "precipitacion", "hora": "hora"},
        ["precipitacion"],
        ["fecha", "municipio", "hora"],
    )


@query("""
SELECT o_orderkey, n_name, year(o_orderdate)::INT AS year, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_3', 'NATION_11')
""")
def report_extract(t: Tables):
    orders = attach_dimension(dated(t.orders, "o_orderdate"), t.customer, "o_custkey", "c_custkey", ["c_nationkey"])
    named = attach_dimension(orders, t.nation, "c_nationkey", "n_nationkey", ["n_name"])
    return extract(named, ["o_orderkey", "n_name", "year", "o_totalprice"], "n_name", ["NATION_3", "NATION_11"])
