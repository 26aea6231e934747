"""Reshaping, time functions, feature blocks, joins, lags and the feature panel."""

from pyspark.sql import functions as F

from stratalake.functions import clock
from stratalake.functions.nested import first_matching
from stratalake.operators import aggregate, forecast, intervals, joins, reshape
from stratalake.plans.panel import build_feature_panel
from stratalake.sources.scratch import store
from suite.registry import ORACLES, Tables, dated, money, query, rounded

# ---- set operations and reshaping -----------------------------------------

def _parties(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("key")
    )
    return customers, suppliers


@query("""
SELECT c_custkey AS key, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier
""")
def union_by_name(t: Tables):
    return reshape.union_all(_parties(t))


@query("""
SELECT c_custkey AS key, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier
""")
def union_missing_cols(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return reshape.union_all([customers, suppliers], allow_missing=True)


@query("""
WITH q AS (
  SELECT c_mktsegment AS segment, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month,
         round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT segment, year, month, revenue, n_orders FROM q
UNION ALL SELECT segment, year, month - 1, -99.0, -99 FROM q WHERE month IN (3, 6, 9, 12)
UNION ALL SELECT segment, year, month - 2, -99.0, -99 FROM q WHERE month IN (3, 6, 9, 12)
""")
def expand_quarter_to_month(t: Tables):
    rows = dated(t.orders, "o_orderdate")
    named = joins.attach_dimension(rows, t.customer, "o_custkey", "c_custkey", {"c_mktsegment": "segment"})
    quarterly = named.groupBy("segment", "year", "month").agg(
        money(F.sum("o_totalprice")).alias("revenue"), F.count(F.lit(1)).alias("n_orders")
    )
    return reshape.expand_quarter_to_month(quarterly, "month", ["revenue", "n_orders"])


@query("""
WITH o AS (SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders)
SELECT * FROM o UNION ALL SELECT o_orderkey, year, m FROM o, (VALUES (4), (5)) v(m) WHERE year = 1996 AND month = 3
""")
def copy_period(t: Tables):
    rows = dated(t.orders, "o_orderdate").select("o_orderkey", "year", "month")
    return reshape.copy_period(rows, "year", "month", (1996, 3), [4, 5])


@query("""
SELECT doc_id, length(line)::INT AS line_chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE doc_id % 10 <> 0)
UNION ALL SELECT doc_id, NULL FROM documents WHERE doc_id % 10 = 0
""")
def explode_outer_days(t: Tables):
    """Lines of whole texts; documents given a NULL or empty array stay with one NULL line."""
    lines = F.when(F.col("doc_id") % 20 == 0, F.array().cast("array<string>")).when(
        F.col("doc_id") % 10 != 0, F.split("text", "\n")
    )
    exploded = reshape.explode_keep(t.documents.select("doc_id", lines.alias("lines")), "lines", "line")
    return exploded.select("doc_id", F.length("line").alias("line_chars"))


@query("""
WITH span AS (SELECT o_orderstatus, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1),
cut AS (SELECT o_orderstatus, b, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 15 DAY)) AS DATE) AS s FROM span)
SELECT o_orderstatus, strftime(s, '%Y-%m-%dT%H:%M:%SUTC') AS start_text,
       strftime(CAST(least(s + INTERVAL 14 DAY, b) AS DATE), '%Y-%m-%dT%H:%M:%SUTC') AS end_text
FROM cut
""")
def date_intervals(t: Tables):
    spans = t.orders.groupBy("o_orderstatus").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return reshape.date_intervals(spans, "a", "b", 15).select("o_orderstatus", "start_text", "end_text")


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def preview_topn(t: Tables):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


# ---- time functions -------------------------------------------------------

@query("""
SELECT event_id, CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE round(hour(ts) + minute(ts) / 60.0, 6) END AS hours FROM events
""")
def time_to_decimal(t: Tables):
    text = (
        F.when(F.col("event_id") % 10 == 0, "Desconocido")
        .when(F.col("event_id") % 10 == 1, "7")
        .otherwise(F.date_format("ts", "HH:mm"))
    )
    return t.events.select("event_id", F.round(clock.time_to_decimal(text), 6).alias("hours"))


@query("""
WITH h AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value % 23 END AS x FROM events),
m AS (SELECT event_id, x, CAST(floor(x) * 60 + round((x - floor(x)) * 60) AS INT) AS total FROM h)
SELECT event_id, CASE WHEN x IS NOT NULL THEN printf('%02d:%02d', total // 60, total % 60) END AS clock FROM m
""")
def decimal_to_time(t: Tables):
    hours = F.when(F.col("event_id") % 10 != 0, F.col("value") % 23)
    return t.events.select("event_id", clock.decimal_to_time(hours).alias("clock"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE year(o_orderdate)::INT END AS year,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE month(o_orderdate)::INT END AS month
FROM orders
""")
def date_parts(t: Tables):
    text = F.when(F.col("o_orderkey") % 13 == 0, "sin fecha").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    days = t.orders.select("o_orderkey", clock.parse_date(text).alias("day"))
    return days.withColumns({"year": F.year("day"), "month": F.month("day")})


@query("SELECT o_orderkey, isodow(o_orderdate)::INT AS weekday FROM orders")
def date_iso_weekday(t: Tables):
    return t.orders.select("o_orderkey", clock.iso_weekday(F.col("o_orderdate")).alias("weekday"))


# ---- nested data ----------------------------------------------------------

@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN l_quantity WHEN l_linestatus = 'O' AND l_linenumber % 2 = 0 THEN l_extendedprice END AS picked
FROM lineitem
""")
def array_filter_first(t: Tables):
    second = F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") % 2 == 0), "R").otherwise("-")
    items = F.array(
        F.struct(F.col("l_returnflag").alias("code"), F.col("l_quantity").alias("value")),
        F.struct(second.alias("code"), F.col("l_extendedprice").alias("value")),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", items.alias("items"))
    return rows.select("l_orderkey", "l_linenumber", first_matching(F.col("items"), "code", "R", "value").alias("picked"))


@query("""
WITH requested AS (
  SELECT DISTINCT (o_custkey % 100)::INT AS place, CAST(o_orderdate AS DATE) AS asked_from, CAST(o_orderdate AS DATE) + (o_orderkey % 90)::INT AS asked_to FROM orders),
loaded AS (
  SELECT CASE WHEN user_id % 5 = 0 THEN 0 ELSE (user_id % 100)::INT END AS place,
         DATE '1995-01-01' + (event_id * 7919 % 2400)::INT AS a, DATE '1995-01-01' + (event_id * 7919 % 2400 + event_id % 15)::INT AS b FROM events),
covered AS (SELECT DISTINCT place, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM loaded),
days AS (SELECT *, unnest(generate_series(asked_from, asked_to, INTERVAL 1 DAY))::DATE AS day FROM requested),
open AS (
  SELECT *, day - row_number() OVER (PARTITION BY place, asked_from, asked_to ORDER BY day)::INT AS stretch
  FROM days d WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.place = d.place AND c.day = d.day))
SELECT place, asked_from, asked_to, min(day) AS interval_start, max(day) AS interval_end FROM open GROUP BY place, asked_from, asked_to, stretch
""")
def join_pending_intervals(t: Tables):
    """The days of each order's interval that no event's interval of the same place covers; a fifth of the events are of one place."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    asked = {"asked_from": day, "asked_to": F.date_add(day, (key % 90).cast("int"))}
    requested = t.orders.select(
        (F.col("o_custkey") % 100).cast("int").alias("place"),
        *[c.alias(n) for n, c in asked.items()],
        *[c.alias(n) for n, c in zip(("interval_start", "interval_end"), asked.values(), strict=True)],
    )
    user, n = F.col("user_id"), F.col("event_id")
    first = (n * 7919 % 2400).cast("int")
    loaded = t.events.select(
        F.when(user % 5 == 0, 0).otherwise(user % 100).cast("int").alias("place"),
        F.date_add(F.lit("1995-01-01").cast("date"), first).alias("interval_start"),
        F.date_add(F.lit("1995-01-01").cast("date"), first + (n % 15).cast("int")).alias("interval_end"),
    )
    return intervals.pending_intervals(requested, loaded, ["place"])


def _days_of_order():
    """0 to 3 day numbers per order."""
    n = (F.col("o_orderkey") % 4).cast("int")
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _with_bad_documents(doc):
    return F.when(F.col("o_orderkey") % 17 == 0, "[{bad").when(F.col("o_orderkey") % 19 != 0, doc)


@query("""
WITH base AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS d0,
         o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_orderkey % 4 > 0 AS good FROM orders),
days AS (
  SELECT b.*, g.d FROM base b JOIN (VALUES (1), (2), (3)) g(d) ON b.good AND g.d <= b.o_orderkey % 4
  UNION ALL SELECT b.*, NULL FROM base b WHERE NOT b.good)
SELECT CAST(o_orderkey AS VARCHAR) AS "municipioCodigo", o_orderpriority AS "nombreMunicipio",
       strftime(d0, '%Y-%m-%d') AS "fechaDescargaUTC",
       coalesce(strftime(CAST(d0 + d * INTERVAL 1 DAY AS DATE), '%Y-%m-%d'), 'Desconocido') AS "fechaPrediccion",
       CASE WHEN d IS NULL OR o_orderkey % 3 = 0 THEN -9999 ELSE d * 10 END AS "probPrecipitacion_00_24",
       -9999 AS "cotaNieveProv_00_24",
       CASE WHEN d IS NULL THEN 'Desconocido' ELSE o_orderpriority END AS "estadoCieloDescripcion_00_24",
       CASE WHEN d IS NULL THEN 'Desconocido' ELSE o_orderstatus END AS "estadoCieloCode_00_24",
       CASE WHEN d IS NULL THEN 'Desconocido' ELSE 'N' END AS "vientoDireccion_00_24",
       coalesce(d + 5, -9999) AS "vientoVelocidad_00_24", -9999 AS "rachaMaxima_00_24",
       coalesce(d + 20, -9999) AS "temperaturaMaxima", coalesce(d + 10, -9999) AS "temperaturaMinima",
       coalesce(d + 21, -9999) AS "sensTermicaMaxima", -9999 AS "sensTermicaMinima",
       -9999 AS "humedadRelativaMaxima", -9999 AS "humedadRelativaMinima",
       CASE WHEN d = 2 THEN -9999 ELSE coalesce(d, -9999) END AS "uv_max"
FROM days
""")
def json_flatten_forecast(t: Tables):
    """Forecast documents in the published layout, flattened by a declared schema."""
    return forecast.flatten_municipal_forecast(_municipal_documents(t))


def _municipal_documents(t: Tables, *more):
    """Forecast documents in the published layout, one per order, some malformed, missing or without days; ``more`` fields of each day."""

    def entry(period, **fields):
        return F.struct(*[v.alias(k) for k, v in fields.items()], period.alias("periodo"))

    def day(d):
        whole = F.lit("00-24")
        some = F.when(F.col("o_orderkey") % 3 == 0, "00-12").otherwise("00-24")
        return F.struct(
            F.array(entry(F.lit("12-24"), value=d), entry(some, value=d * 10), entry(whole, value=F.lit(None).cast("int"))).alias("probPrecipitacion"),
            F.array(entry(whole, value=F.col("o_orderstatus"), descripcion=F.col("o_orderpriority"))).alias("estadoCielo"),
            F.array(entry(whole, direccion=F.lit("N"), velocidad=d + 5)).alias("viento"),
            F.array(entry(F.lit("00-06"), value=d)).alias("rachaMax"),
            F.struct((d + 20).alias("maxima"), (d + 10).alias("minima")).alias("temperatura"),
            F.struct((d + 21).alias("maxima")).alias("sensTermica"),
            F.when(d != 2, d).alias("uvMax"),
            F.date_format(F.date_add(F.col("o_orderdate").cast("date"), d), "yyyy-MM-dd").alias("fecha"),
            *[field(d) for field in more],
        )

    days = F.struct(F.transform(_days_of_order(), day).alias("dia"))
    doc = F.to_json(F.array(F.struct(F.lit("x").alias("nombre"), days.alias("prediccion"))))
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("municipio_codigo_aemet"),
        F.col("o_orderpriority").alias("nombre_municipio_ine"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha_descarga_utc"),
        _with_bad_documents(doc).alias("raw_aemet_data_json_str"),
    )
    return raw


@query(
    ORACLES["json_flatten_forecast"].replace(
        "SELECT CAST(o_orderkey AS VARCHAR)", """SELECT CASE WHEN d IS NOT NULL THEN '{"extra":' || (d + 100) || '}' END AS unknown, CAST(o_orderkey AS VARCHAR)"""
    )
)
def json_variant_flatten(t: Tables):
    """The same documents by one parse to VARIANT; a field that no schema names is kept."""
    return forecast.flatten_municipal_variant(_municipal_documents(t, lambda d: (d + 100).alias("extra")))


@query("""
WITH base AS (
  SELECT o_orderkey, o_orderstatus, o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AS parsed FROM orders),
days AS (
  SELECT b.*, g.d FROM base b JOIN (VALUES (1), (2), (3)) g(d) ON b.parsed AND g.d <= b.o_orderkey % 4
  UNION ALL SELECT b.*, NULL FROM base b WHERE NOT (b.parsed AND b.o_orderkey % 4 > 0))
SELECT CAST(o_orderkey AS VARCHAR) AS id_playa, CASE WHEN parsed THEN o_orderstatus END AS nombre_playa,
       CASE WHEN parsed THEN 31 END AS codigo_municipio, 20240100 + d AS fecha, d AS "estadoCielo_f1",
       CASE WHEN d IS NOT NULL THEN 'sol' END AS "estadoCielo_desc1", d + 1 AS viento_f2,
       d + 30 AS "tMaxima", d + 40 AS "tempMaxima", d + 15 AS "tAgua_valor1", d + 16 AS "tempAgua",
       CASE WHEN d IS NOT NULL THEN 'calor' END AS "sTermica_desc1",
       CASE WHEN d IS NOT NULL THEN 'fresco' END AS "sensacTermica_desc1"
FROM days
""")
def json_flatten_dupcase(t: Tables):
    """Beach documents whose keys differ only in case and hold different values."""
    return forecast.flatten_beach_forecast(_beach_documents(t)).select(*_BEACH_PICKS)


@query(ORACLES["json_flatten_dupcase"])
def json_variant_dupcase(t: Tables):
    """The same documents by one parse to VARIANT."""
    return forecast.flatten_beach_variant(_beach_documents(t)).select(*_BEACH_PICKS)


_BEACH_PICKS = [
    "id_playa", "nombre_playa", "codigo_municipio", "fecha", "estadoCielo_f1", "estadoCielo_desc1", "viento_f2",
    "tMaxima", "tempMaxima", "tAgua_valor1", "tempAgua", "sTermica_desc1", "sensacTermica_desc1",
]


def _beach_documents(t: Tables):
    """Beach forecasts in the published layout, one per order, some malformed, missing or without days."""

    def day(d):
        return F.struct(
            F.struct(d.alias("f1"), F.lit("sol").alias("descripcion1")).alias("estadoCielo"),
            F.struct((d + 1).alias("f2")).alias("viento"),
            F.struct((d + 30).alias("valor1")).alias("tMaxima"),
            F.struct((d + 40).alias("valor1")).alias("tmaxima"),
            F.struct((d + 15).alias("valor1")).alias("tAgua"),
            F.struct((d + 16).alias("valor1")).alias("tagua"),
            F.struct(F.lit("calor").alias("descripcion1")).alias("sTermica"),
            F.struct(F.lit("fresco").alias("descripcion1")).alias("stermica"),
            (d + 20240100).alias("fecha"),
        )

    days = F.struct(F.transform(_days_of_order(), day).alias("dia"))
    place = F.struct(F.col("o_orderstatus").alias("nombre"), F.lit(31).alias("localidad"), days.alias("prediccion"))
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("playa_codigo_aemet"),
        F.lit("m").alias("nombre_municipio"),
        F.lit("p").alias("nombre_provincia"),
        _with_bad_documents(F.to_json(F.array(place))).alias("raw_aemet_data_json_str"),
    )
    return raw


# ---- joins ----------------------------------------------------------------

@query("""
SELECT c_custkey, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey
""")
def join_dim_left(t: Tables):
    nations = t.nation.filter("n_nationkey % 5 <> 0")
    named = joins.attach_dimension(
        t.customer.select("c_custkey", "c_nationkey"), nations, "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"]
    )
    placed = joins.attach_dimension(named, t.region, "n_regionkey", "r_regionkey", ["r_name"])
    return placed.select("c_custkey", "n_name", "r_name")


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def join_semi(t: Tables):
    members = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return joins.keep_members(t.orders.select("o_orderkey", "o_custkey"), members, "o_custkey", "c_custkey")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def join_pending_anti(t: Tables):
    return joins.pending(t.documents.select("doc_id", "source"), t.labels, ["doc_id"])


MONTHLY_KEYS = ["nation", "year", "month"]


def nation_orders(t: Tables):
    """Orders with the nation of their customer and their month."""
    orders = dated(t.orders, "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate", "year", "month"
    )
    return joins.attach_dimension(orders, t.customer, "o_custkey", "c_custkey", {"c_nationkey": "nation"})


def nation_lines(t: Tables):
    """Lines with the nation of their supplier and their shipping month."""
    lines = dated(t.lineitem, "l_shipdate").drop("l_shipdate")
    return joins.attach_dimension(lines, t.supplier, "l_suppkey", "s_suppkey", {"s_nationkey": "nation"})


NATION_ORDERS_SQL = """
no AS (SELECT orders.*, c_nationkey AS nation, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""
NATION_LINES_SQL = """
nl AS (SELECT lineitem.*, s_nationkey AS nation, year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month
       FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)"""


@query(f"""
WITH {NATION_ORDERS_SQL}, {NATION_LINES_SQL},
base AS (SELECT nation, year, month, round(sum(o_totalprice), 2) AS revenue FROM no GROUP BY 1, 2, 3),
a AS (SELECT nation, year, month, sum(l_quantity) AS shipped FROM nl GROUP BY 1, 2, 3),
b AS (SELECT nation, year, month, sum(l_quantity) AS returned FROM nl WHERE l_returnflag = 'R' GROUP BY 1, 2, 3),
c AS (SELECT nation, year, month, count(*) AS n_urgent FROM no WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2, 3),
d AS (SELECT nation, year, month, count(*) AS n_even FROM no WHERE month % 2 = 0 GROUP BY 1, 2, 3)
SELECT nation, year, month, revenue, shipped, returned, n_urgent, n_even FROM base LEFT JOIN a USING (nation, year, month)
LEFT JOIN b USING (nation, year, month) LEFT JOIN c USING (nation, year, month) LEFT JOIN d USING (nation, year, month)
""")
def join_panel_left(t: Tables):
    """Each source is read once, down to a small stored table the panel sides are cut from."""
    orders = store(
        nation_orders(t)
        .groupBy(*MONTHLY_KEYS, "o_orderpriority")
        .agg(F.sum("o_totalprice").alias("price"), F.count(F.lit(1)).alias("n")),
        "orders_by_priority",
    )
    lines = store(
        nation_lines(t).groupBy(*MONTHLY_KEYS, "l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q")),
        "lines_by_flag",
    )
    base = orders.groupBy(*MONTHLY_KEYS).agg(money(F.sum("price")).alias("revenue"))
    shipped = lines.groupBy(*MONTHLY_KEYS).agg(F.sum("q").alias("shipped"))
    # finer grain than the keys: rolled up by the join
    returned = (lines.filter("l_returnflag = 'R'"), {"returned": F.sum("q")})
    urgent = orders.filter("o_orderpriority = '1-URGENT'").select(*MONTHLY_KEYS, F.col("n").alias("n_urgent"))
    even = orders.filter("month % 2 = 0").groupBy(*MONTHLY_KEYS).agg(F.sum("n").alias("n_even"))
    return joins.panel_join(base, [shipped, returned, urgent, even], MONTHLY_KEYS)


# ---- feature blocks -------------------------------------------------------

@query(f"""
WITH {NATION_LINES_SQL}
SELECT nation, year, month, sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS spend,
       round(avg(l_linenumber * 10.0), 6) AS occupancy, round(avg(l_quantity), 6) AS mean_quantity,
       round(100 - avg(l_linenumber * 10.0), 6) AS availability_score
FROM nl GROUP BY 1, 2, 3
""")
def feat_occupancy(t: Tables):
    lines = nation_lines(t).withColumn("load", F.col("l_linenumber") * 10.0)
    block = aggregate.occupancy_block(
        lines,
        MONTHLY_KEYS,
        sums={"quantity": "l_quantity", "spend": "l_extendedprice"},
        averages={"occupancy": "load", "mean_quantity": "l_quantity"},
        occupancy="occupancy",
    )
    return rounded(block).withColumn("spend", money(F.col("spend")))


@query("""
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, floor(value)::BIGINT AS value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
SELECT event_type, day, sum(value)::BIGINT AS spend, sum(k)::BIGINT AS visits, round(avg(value), 6) AS mean_value,
       round(sum(value) / (sum(k) + 1), 6) AS spend_per_visit
FROM e GROUP BY 1, 2
""")
def feat_ratio_smoothed(t: Tables):
    rows = t.events.select(
        "event_type",
        F.col("ts").cast("date").alias("day"),
        F.floor("value").alias("value"),
        F.from_json("props", "k int").getField("k").alias("k"),
    )
    block = aggregate.leisure_block(
        rows,
        ["event_type", "day"],
        sums={"spend": "value", "visits": "k"},
        averages={"mean_value": "value"},
        ratios={"spend_per_visit": ("spend", "visits")},
    )
    return rounded(block)


@query("""
WITH g AS (
  SELECT user_id, CAST(ts AS DATE) AS day, avg(floor(value)) FILTER (event_type IN ('view', 'click')) AS good,
         avg(floor(value)) FILTER (event_type = 'signup') AS fair, avg(floor(value)) FILTER (event_type IN ('error', 'purchase')) AS poor,
         count(DISTINCT hour(ts)) AS n_entities
  FROM events GROUP BY 1, 2)
SELECT user_id, day, round(good, 6) AS good, round(fair, 6) AS fair, round(poor, 6) AS poor, n_entities,
       round((2 * good + fair) / (good + fair + poor + 1e-6), 6) AS quality_index
FROM g
""")
def feat_conditional_avg(t: Tables):
    rows = t.events.select(
        "user_id",
        F.col("ts").cast("date").alias("day"),
        "event_type",
        F.floor("value").alias("value"),
        F.hour("ts").alias("hour"),
    )
    block = aggregate.bucket_share_block(
        rows,
        ["user_id", "day"],
        label="event_type",
        value="value",
        buckets={"good": ["view", "click"], "fair": ["signup"], "poor": ["error", "purchase"]},
        weights={"good": 2, "fair": 1, "poor": 0},
        entity="hour",
    )
    return rounded(block)


@query("""
WITH p AS (SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier)
SELECT nation, round(avg(floor(balance)), 6) AS mean_balance, round(sum(balance), 2) AS total_balance FROM p GROUP BY 1
""")
def feat_perception(t: Tables):
    rows = reshape.union_all(_parties(t)).withColumn("whole", F.floor("balance"))
    block = aggregate.mixed_block(rows, ["nation"], {"mean_balance": "whole"}, {"total_balance": "balance"})
    return rounded(block).withColumn("total_balance", money(F.col("total_balance")))


def _readings(rows):
    """Daily readings made from lines; clock times fall on quarter hours, one line number has none."""
    quarter = F.lpad(((F.col("l_suppkey") % 4) * 15).cast("string"), 2, "0")

    def at(hour):
        return F.concat_ws(":", F.lpad((hour % 24).cast("string"), 2, "0"), quarter)

    return rows.withColumns(
        {
            "mean": F.col("l_quantity") / 2,
            "rain": F.col("l_linenumber") - 4,
            "low": F.col("l_quantity") - 20,
            "high": F.col("l_quantity") - 10,
            "low_time": F.when(F.col("l_linenumber") == 3, "Desconocido").otherwise(at(F.col("l_partkey"))),
            "high_time": at(F.col("l_partkey") + 9),
        }
    )


_CLIMATE_COLUMNS_SQL = """
round(avg(l_quantity / 2), 6) AS temp_media_mes, sum(l_linenumber - 4)::{rain} AS precipitacion_total_mes,
count(*) FILTER (l_linenumber > 4) AS dias_lluvia_mes, round(avg(l_quantity - 20), 6) AS temp_min_media_mes,
min(l_quantity - 20) AS temp_min_abs_mes, round(avg(l_quantity - 10), 6) AS temp_max_media_mes,
max(l_quantity - 10) AS temp_max_abs_mes, round(avg(l_quantity - 10) - avg(l_quantity - 20), 6) AS rango_termico_medio,
max(l_quantity - 10) - min(l_quantity - 20) AS rango_termico_extremo,
count(*) FILTER (l_quantity - 10 > 30) AS dias_calidos, count(*) FILTER (l_quantity - 20 < 0) AS dias_helada,
avg(CASE WHEN l_linenumber <> 3 THEN l_partkey % 24 + (l_suppkey % 4) * 15 / 60.0 END) AS low_hours,
avg((l_partkey + 9) % 24 + (l_suppkey % 4) * 15 / 60.0) AS high_hours"""


@query(f"""
WITH {NATION_LINES_SQL}, g AS (SELECT nation, year, month, {_CLIMATE_COLUMNS_SQL.format(rain='BIGINT')} FROM nl GROUP BY 1, 2, 3),
m AS (SELECT *, CAST(floor(low_hours) * 60 + round((low_hours - floor(low_hours)) * 60) AS INT) AS lo,
             CAST(floor(high_hours) * 60 + round((high_hours - floor(high_hours)) * 60) AS INT) AS hi FROM g)
SELECT * EXCLUDE (low_hours, high_hours, lo, hi),
       CASE WHEN lo IS NOT NULL THEN printf('%02d:%02d', lo // 60, lo % 60) END AS hora_temp_min_media,
       CASE WHEN hi IS NOT NULL THEN printf('%02d:%02d', hi // 60, hi % 60) END AS hora_temp_max_media
FROM m
""")
def feat_climate_month(t: Tables):
    block = aggregate.climate_block(
        _readings(nation_lines(t)), MONTHLY_KEYS, "mean", "rain", "low", "high", "low_time", "high_time"
    )
    return rounded(block)


# ---- lags -----------------------------------------------------------------

_LAG_SQL = f"""
WITH {NATION_ORDERS_SQL},
p AS (SELECT nation, year, month, round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders FROM no GROUP BY 1, 2, 3)
SELECT p.*, lag(revenue) OVER w AS revenue_lag1, lag(n_orders) OVER w AS n_orders_lag1 FROM p
WINDOW w AS (PARTITION BY nation ORDER BY {{order}})
"""


def nation_panel(t: Tables):
    return (
        nation_orders(t)
        .groupBy(*MONTHLY_KEYS)
        .agg(money(F.sum("o_totalprice")).alias("revenue"), F.count(F.lit(1)).alias("n_orders"))
    )


@query(_LAG_SQL.format(order="year, month"))
def lag_features(t: Tables):
    return joins.lag_features(nation_panel(t), ["nation"], ["year", "month"], ["revenue", "n_orders"])


@query(_LAG_SQL.format(order="month DESC, year"))
def lag_features_desc(t: Tables):
    """Month number downwards whatever the year, with the year as tie-breaker."""
    return joins.lag_features(
        nation_panel(t), ["nation"], ["month"], ["revenue", "n_orders"], descending=True, ties=["year"]
    )


# ---- the feature panel ----------------------------------------------------

def _panel_inputs(t: Tables):
    """The five published inputs, read off all orders and lines; provinces are the nations of customer and supplier."""

    def named(df):
        return joins.attach_dimension(df, t.nation, "nation", "n_nationkey", {"n_name": "PROVINCIA"})

    def monthly(df, **columns):
        return named(df).select(
            "PROVINCIA", F.col("year").alias("AÑO"), F.col("month").alias("MES"), *[c.alias(n) for n, c in columns.items()]
        )

    orders = nation_orders(t)
    lines = nation_lines(t)
    # whole numbers, so sums and averages do not depend on the order of addition
    price, spend, quantity = F.floor("o_totalprice"), F.floor("l_extendedprice"), F.col("l_quantity")
    perception = monthly(
        orders,
        INIDICE_PERCEPCION_TURISTICA_GLOBAL=price,
        INDICE_SATISFACCION_PRODUCTOS_TURISTICOS=F.col("o_custkey") % 100,
        INDICE_PERCEPCION_SEGURIDAD=F.dayofmonth("o_orderdate"),
        INDICE_PERCEPCION_CLIMATICA=F.col("o_orderkey") % 10,
    )
    air_label = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Buena")
        .when(F.col("o_orderpriority") == "2-HIGH", "Razonablemente buena")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Regular")
        .otherwise("Desfavorable")
    )
    air = monthly(
        orders, CALIDAD_AIRE=air_label, PORCENTAJE_CALIDAD_AIRE=price % 100, ESTACION=F.col("o_custkey")
    )
    leisure = monthly(
        lines,
        PRODUCTO=F.col("l_returnflag"),
        CATEGORIA=F.col("l_linestatus"),
        ENTRADAS=quantity,
        VISITAS_PAGINAS=F.col("l_partkey") % 50,
        GASTO_TOTAL=spend,
        PRECIO_MEDIO_ENTRADA=F.floor(spend / quantity),
        TRANSACCIONES=F.col("l_linenumber"),
    )
    apartments = monthly(
        lines,
        VIAJEROS=quantity,
        PERNOCTACIONES=quantity * 2,
        ESTANCIA_MEDIA=F.col("l_linenumber"),
        GRADO_OCUPA_PLAZAS=quantity,
        GRADO_OCUPA_APART=quantity / 2,
        GRADO_OCUPA_APART_FIN_SEMANA=quantity / 4,
        APARTAMENTOS_ESTIMADOS=F.col("l_linenumber"),
        PLAZAS_ESTIMADAS=F.col("l_linenumber") * 2,
        PERSONAL_EMPLEADO=F.col("l_partkey") % 7,
    )
    climate = monthly(
        _readings(lines),
        temperaturaMedia=F.col("mean"),
        precipitacion=F.col("rain"),
        temperaturaMinima=F.col("low"),
        temperaturaMaxima=F.col("high"),
        horaTemperaturaMinima=F.col("low_time"),
        horaTemperaturaMaxima=F.col("high_time"),
    )
    return perception, leisure, air, apartments, climate


_PANEL_SQL = f"""
WITH {NATION_ORDERS_SQL}, {NATION_LINES_SQL},
per AS (
  SELECT nation, year, month, avg(floor(o_totalprice)) AS indice_percepcion_turistica_global,
         avg(o_custkey % 100) AS indice_satisfaccion_productos_turisticos, avg(day(o_orderdate)) AS indice_percepcion_seguridad,
         sum(o_orderkey % 10)::BIGINT AS indice_percepcion_climatica
  FROM no GROUP BY 1, 2, 3),
air AS (
  SELECT nation, year, month, avg(floor(o_totalprice) % 100) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS aire_pct_buena,
         avg(floor(o_totalprice) % 100) FILTER (o_orderpriority = '3-MEDIUM') AS aire_pct_aceptable,
         avg(floor(o_totalprice) % 100) FILTER (o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) AS aire_pct_mala
  FROM no GROUP BY 1, 2, 3),
apt AS (
  SELECT nation, year, month, sum(l_quantity) AS apt_viajeros, sum(l_quantity * 2) AS apt_pernoctaciones,
         avg(l_linenumber) AS apt_estancia_media, sum(l_linenumber)::BIGINT AS apt_estimados,
         sum(l_linenumber * 2)::BIGINT AS plazas_estimadas, sum(l_partkey % 7)::BIGINT AS apt_personal_empleado,
         100 - avg(l_quantity) AS apt_availability_score
  FROM nl GROUP BY 1, 2, 3),
cli AS (SELECT nation, year, month, {_CLIMATE_COLUMNS_SQL.format(rain='BIGINT')} FROM nl GROUP BY 1, 2, 3),
fun AS (
  SELECT nation, year, month {{detail}}, sum(l_quantity) AS ocio_total_entradas, sum(floor(l_extendedprice))::BIGINT AS ocio_gasto_total,
         avg(floor(floor(l_extendedprice) / l_quantity)) AS ocio_precio_medio_entrada
  FROM nl GROUP BY ALL),
wide AS (
  SELECT * FROM per LEFT JOIN air USING (nation, year, month) LEFT JOIN apt USING (nation, year, month)
  LEFT JOIN cli USING (nation, year, month) {{fun_before}}),
lagged AS (
  SELECT *, lag(aire_pct_buena) OVER w AS aire_pct_buena_lag1, lag(apt_availability_score) OVER w AS apt_availability_score_lag1,
         lag(temp_min_media_mes) OVER w AS temp_min_media_mes_lag1, lag(temp_max_media_mes) OVER w AS temp_max_media_mes_lag1,
         lag(dias_lluvia_mes) OVER w AS dias_lluvia_mes_lag1
  FROM wide WINDOW w AS (PARTITION BY nation ORDER BY {{order}}))
SELECT n_name AS "PROVINCIA", year AS "AÑO", month AS "MES", apt_viajeros, apt_pernoctaciones,
       round(apt_estancia_media, 6) AS apt_estancia_media, apt_estimados, plazas_estimadas, apt_personal_empleado,
       round(apt_availability_score_lag1, 6) AS apt_availability_score_lag1, ocio_total_entradas,
       ocio_gasto_total, round(ocio_precio_medio_entrada, 6) AS ocio_precio_medio_entrada,
       round(aire_pct_buena_lag1, 6) AS aire_pct_buena_lag1, round(aire_pct_aceptable, 6) AS aire_pct_aceptable,
       round(aire_pct_mala, 6) AS aire_pct_mala, temp_media_mes, temp_min_media_mes_lag1, temp_max_media_mes_lag1,
       precipitacion_total_mes, dias_lluvia_mes_lag1, dias_calidos, dias_helada,
       round(indice_percepcion_turistica_global, 6) AS indice_percepcion_turistica_global,
       round(indice_percepcion_seguridad, 6) AS indice_percepcion_seguridad,
       round(indice_satisfaccion_productos_turisticos, 6) AS indice_satisfaccion_productos_turisticos,
       indice_percepcion_climatica, round(aire_pct_buena, 6) AS aire_pct_buena,
       round(apt_availability_score, 6) AS apt_availability_score, temp_min_media_mes, temp_max_media_mes, dias_lluvia_mes
FROM lagged {{fun_after}} LEFT JOIN nation ON nation = n_nationkey
"""


@query(
    _PANEL_SQL.format(
        detail="", fun_before="", fun_after="LEFT JOIN fun USING (nation, year, month)", order="year, month"
    )
)
def feature_panel(t: Tables):
    return rounded(build_feature_panel(*_panel_inputs(t)))


@query(
    _PANEL_SQL.format(
        detail=", l_returnflag, l_linestatus",
        fun_before="LEFT JOIN fun USING (nation, year, month)",
        fun_after="",
        order="month DESC, year, l_returnflag, l_linestatus",
    )
)
def feature_panel_fanout(t: Tables):
    """The panel with repeated rows per leisure detail and lags by month number."""
    return rounded(build_feature_panel(*_panel_inputs(t), keep_fanout=True, lag_by_month_number=True))
