"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.nested import document, parse_json
from stratalake.functions.text import row_id
from stratalake.operators import clean
from stratalake.plans.reload import reload_pending
from stratalake.sources import batches, readers, writers, xlsx
from stratalake.sources.literal import literal_dim
from stratalake.sources.scratch import scratch_dir
from stratalake.streaming.incremental import append_sink, ingest_new_files
from suite.registry import Tables, dated, money, query


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def src_table_scan(t: Tables):
    db = t.work_db()
    t.spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.scan_{_key(t)} USING parquet LOCATION '{t.folder}/lineitem.parquet'")
    table = readers.read_table(t.spark, f"scan_{_key(t)}", db)
    return table.filter(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_quantity")


def _key(t: Tables) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in t.folder)


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def src_csv_locale(t: Tables):
    path = f"{scratch_dir(t.spark)}/customer"
    text = F.translate(F.col("c_acctbal").cast("string"), ".", ",").alias("c_acctbal")
    t.customer.select("c_custkey", "c_name", text, "c_mktsegment").write.csv(
        path, sep=";", header=True, encoding="ISO-8859-1"
    )
    return readers.read_delimited(
        t.spark, path, "c_custkey bigint, c_name string, c_acctbal string, c_mktsegment string", ["c_acctbal"]
    )


@query("""
SELECT o_orderkey AS key, o_totalprice AS price, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day,
       CAST(CAST(o_orderdate AS DATE) + (o_orderkey % 86400) * INTERVAL 1 SECOND AS VARCHAR) AS moment,
       CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 2 = 0 END AS even, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey / 4 END AS quarter,
       CASE WHEN o_orderkey % 3 > 0 THEN ' <' || o_orderpriority || '>' || chr(9) || '& _x0041_ é ' END AS note, o_orderstatus AS _sheet
FROM orders
""")
def src_xlsx_parse(t: Tables):
    """All orders written to workbooks inside the tasks, one sheet for each status, and read back with types from their cells."""
    path = f"{scratch_dir(t.spark)}/workbooks"
    key = F.col("o_orderkey")
    rows = t.orders.select(
        key.alias("key"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.timestamp_add("SECOND", (key % 86400).cast("int"), F.col("o_orderdate").cast("date").cast("timestamp_ntz")).alias("moment"),
        F.when(key % 7 > 0, key % 2 == 0).alias("even"),
        F.when(key % 5 > 0, F.col("o_custkey") / 4).alias("quarter"),
        F.when(key % 3 > 0, F.concat(F.lit(" <"), "o_orderpriority", F.lit(">\t& _x0041_ é "))).alias("note"),
        "o_orderstatus",
    )
    xlsx.write_xlsx(rows, path, sheetBy="o_orderstatus", rowsPerFile=20_000)
    read = xlsx.read_xlsx(t.spark, path, sheets="*")
    return read.withColumn("moment", F.date_format("moment", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT page_id, url, length(html)::INT AS n_chars, md5(html) AS digest FROM pages")
def src_binary_parse(t: Tables):
    path = f"{scratch_dir(t.spark)}/pages"
    t.pages.select("page_id", "url", "html").write.option("maxRecordsPerFile", 500).json(path)
    rows = readers.read_binary_records(
        t.spark, path, readers.json_line_records, "page_id bigint, url string, html string", glob="*.json"
    )
    return rows.select("page_id", "url", F.length("html").alias("n_chars"), F.md5("html").alias("digest"))


@query("""
SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 50 <> 0
UNION ALL SELECT event_id, user_id, 'copy', value FROM events WHERE event_id % 50 > 40
""")
def src_json_envelope(t: Tables):
    """Envelopes of no, one or two rows, so none grows with the data."""
    path = f"{scratch_dir(t.spark)}/envelopes"

    def row(kind):
        fields = {"event_id": "event_id", "user_id": "user_id", "value": "value"}
        return F.struct(*[F.col(c).cast("string").alias(n) for n, c in fields.items()], kind.alias("event_type"))

    one, two = F.array(row(F.col("event_type"))), F.array(row(F.col("event_type")), row(F.lit("copy")))
    slot = F.col("event_id") % 50
    data = F.when(slot > 40, two).when(slot > 0, one).otherwise(F.slice(one, 1, 0))
    t.events.select(document(F.struct(F.col("ts").alias("fecha")).alias("metadata"), data.alias("data"))).write.text(path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "user_id", "event_type", "value")])
    rows = readers.read_envelope(t.spark, path, text, multi_line=False)
    return rows.select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", F.col("value").cast("double")
    )


@query("""
SELECT d.meaning, count(*) AS n_orders
FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) d(code, meaning) ON o_orderstatus = d.code
GROUP BY d.meaning
""")
def src_literal_dim(t: Tables):
    dim = literal_dim(t.spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "code string, meaning string")
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.join(dim, F.col("o_orderstatus") == F.col("code")).select("meaning", "n_orders")


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority,
       CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'done' ELSE 'open' END AS load_tag
FROM orders
""")
def src_multi_union(t: Tables):
    """Four loads, one of them empty and one without a column, under two tags."""
    full = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    loads = [
        ("done", full.filter("o_orderstatus = 'F'").drop("o_orderstatus")),
        ("done", full.filter("o_orderstatus = 'P'").drop("o_orderstatus")),
        ("open", full.filter("o_orderstatus = 'O'").drop("o_orderstatus", "o_orderpriority")),
        ("none", full.filter("o_orderstatus = 'X'").drop("o_orderstatus")),
    ]
    return readers.union_tagged(loads, "load_tag")


@query("""
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS k
FROM events
""")
def json_from_string(t: Tables):
    text = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    return t.events.select("event_id", parse_json(text, "k int").getField("k").alias("k"))


@query("SELECT event_id, event_type, value FROM events")
def json_roundtrip(t: Tables):
    docs = t.events.select(document("event_id", "event_type", "value").alias("doc"))
    return docs.select(parse_json(F.col("doc"), "event_id bigint, event_type string, value double").alias("r")).select(
        "r.*"
    )


@query("SELECT event_id, event_type, value FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def src_log_dropmalformed(t: Tables):
    path = f"{scratch_dir(t.spark)}/log"
    head, value = F.concat_ws(",", "event_id", "event_type"), F.col("value").cast("string")
    line = (
        F.when(F.col("event_id") % 7 == 0, F.concat_ws(",", head, F.lit("oops")))
        .when(F.col("event_id") % 11 == 0, head)
        .otherwise(F.concat_ws(",", head, value))
    )
    t.events.select(line).write.text(path)
    return readers.read_log(t.spark, path, "event_id bigint, event_type string, value double", header=False)


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_ids FROM orders")
def row_id_hash(t: Tables):
    ids = t.orders.select(row_id("o_orderkey").alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"))


# ---- sinks ----------------------------------------------------------------

@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sink_overwrite_readback(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    writers.overwrite_table(rows.filter("o_orderkey % 2 = 0"), t.work_db(), "orders_replaced")
    return writers.overwrite_table(rows, t.work_db(), "orders_replaced")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sink_append_readback(t: Tables):
    rows, db = t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.work_db()
    t.spark.sql(f"DROP TABLE IF EXISTS {db}.orders_appended")
    writers.append_table(rows.filter("o_orderkey % 2 = 0"), db, "orders_appended")
    odd = rows.filter("o_orderkey % 2 <> 0").select("o_totalprice", "o_custkey", "o_orderkey")
    return writers.append_table(odd, db, "orders_appended")


@query("""
WITH target AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 3 <> 0),
source AS (SELECT c_custkey, c_nationkey, round(c_acctbal + 100, 2) AS c_acctbal FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey,
       coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal
FROM target t FULL JOIN source s ON t.c_custkey = s.c_custkey
""")
def upsert_merge(t: Tables):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    source = rows.filter("c_custkey % 2 = 0").withColumn("c_acctbal", money(F.col("c_acctbal") + 100))
    return writers.upsert_merge(rows.filter("c_custkey % 3 <> 0"), source, ["c_custkey"])


@query("""
WITH lines AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
target AS (SELECT * FROM lines WHERE l_orderkey % 3 <> 0),
source AS (SELECT l_orderkey, l_linenumber, qty + 1000 AS qty FROM lines WHERE l_linenumber % 2 = 0)
SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
       coalesce(s.qty, t.qty) AS qty
FROM target t FULL JOIN source s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
""")
def upsert_merge_composite(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("qty"))
    source = lines.filter("l_linenumber % 2 = 0").withColumn("qty", F.col("qty") + 1000)
    return writers.upsert_merge(lines.filter("l_orderkey % 3 <> 0"), source, ["l_orderkey", "l_linenumber"])


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN round(c_acctbal + 100, 2) ELSE c_acctbal END AS c_acctbal
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0
""")
def upsert_table(t: Tables):
    """The same merge into a stored table that is read, rewritten and renamed."""
    rows, db = t.customer.select("c_custkey", "c_acctbal"), t.work_db()
    writers.overwrite_table(rows.filter("c_custkey % 3 <> 0"), db, "customer_merged")
    source = rows.filter("c_custkey % 2 = 0").withColumn("c_acctbal", money(F.col("c_acctbal") + 100))
    return writers.upsert_table(source, db, "customer_merged", ["c_custkey"])


@query("SELECT 'orders_located' AS leaf, count(*) AS n_rows FROM orders")
def table_location(t: Tables):
    """Where a written table lies (its last path element), with the rows read back from that place."""
    db = t.work_db()
    writers.overwrite_table(t.orders.select("o_orderkey", "o_orderdate"), db, "orders_located")
    location = writers.table_location(t.spark, db, "orders_located").select("location").scalar()
    place = writers.table_location(t.spark, db, "orders_located").first()["location"]
    rows = readers.read_parquet(t.spark, place).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(F.element_at(F.split(location, "/"), -1).alias("leaf"), "n_rows")


@query("""
SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS n_orders,
       round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1, 2
""")
def sink_partitioned(t: Tables):
    rows = dated(t.orders, "o_orderdate").select("o_orderkey", "o_totalprice", "year", "month")
    stored = writers.write_partitioned(rows, f"{scratch_dir(t.spark)}/orders_by_month")
    return stored.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_orders"), money(F.sum("o_totalprice")).alias("revenue")
    )


@query("""
SELECT count(*) AS n_records, count(DISTINCT user_id) AS n_entities,
       CAST(min(ts) AS DATE) AS first_date, CAST(max(ts) AS DATE) AS last_date
FROM events
""")
def batch_metadata(t: Tables):
    batch = t.events.select("event_id", "user_id", "ts", "value")
    return writers.write_batch(batch, f"{scratch_dir(t.spark)}/batch", "user_id", "ts")


@query("""
WITH lines AS (SELECT l_returnflag, l_discount, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END AS qty FROM lineitem)
SELECT CASE WHEN qty > 10 THEN 'good' ELSE 'bad' END AS side, l_returnflag, count(*) AS n_rows, sum(qty) AS sum_qty
FROM lines GROUP BY 1, 2
""")
def reject_split(t: Tables):
    """Rejected lines go to a log that is read back."""
    lines = t.lineitem.select("l_returnflag", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("qty"))
    good, bad = clean.reject_split(lines, F.col("qty") > 10)
    path = f"{scratch_dir(t.spark)}/rejects"
    writers.log_rejects(bad, path)
    logged = readers.read_rejects(t.spark, path, "l_returnflag string, qty double")
    sides = good.withColumn("side", F.lit("good")).unionByName(logged.withColumn("side", F.lit("bad")))
    return sides.groupBy("side", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("sum_qty")
    )


@query("""SELECT count(*) AS "rows", 'stratalake_suite.orders_loaded' AS "table" FROM orders""")
def load_summary(t: Tables):
    return writers.load_summary(t.orders.select("o_orderkey", "o_totalprice"), t.work_db(), "orders_loaded")


@query("SELECT event_id, CAST(ts AS DATE) AS day, event_type, value FROM events", name="reload_pending")
def reload_pending_batches(t: Tables):
    """Odd days are loaded, every day was requested; reloading adds the even days, and twice adds nothing more."""
    rows = t.events.select("event_id", F.col("ts").cast("date").alias("day"), "event_type", "value")
    db, requested = t.work_db(), rows.select("day").distinct()
    writers.overwrite_table(rows.filter(F.dayofmonth("day") % 2 == 1), db, "events_reloaded")
    reload_pending(requested, rows, ["day"], db, "events_reloaded")
    return reload_pending(requested, rows, ["day"], db, "events_reloaded")


@query("SELECT event_id, event_type, value FROM events")
def stream_ingest_files(t: Tables):
    """Files arrive in two deliveries; each run of the stream loads the new ones once."""
    root = scratch_dir(t.spark)
    rows = t.events.select("event_id", "event_type", "value")
    for part in (0, 1):
        rows.filter(F.col("event_id") % 2 == part).write.mode("append").json(f"{root}/landing")
        ingest_new_files(t.spark, f"{root}/landing", rows.schema, append_sink(f"{root}/table"), f"{root}/progress")
    return t.spark.read.schema(rows.schema).parquet(f"{root}/table").select(*rows.columns)


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice
FROM orders
""")
def sink_append_mismatch(t: Tables):
    """The second load has a column more and one less; the new one is added, neither is lost."""
    db = t.work_db()
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    writers.overwrite_table(rows.filter("o_orderkey % 2 = 0").drop("o_orderpriority"), db, "orders_mixed")
    return writers.append_table(rows.filter("o_orderkey % 2 = 1").drop("o_totalprice"), db, "orders_mixed", add_columns=True).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )


@query("SELECT c_custkey, c_name, round(c_acctbal * 1000, 1) AS c_acctbal, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def src_csv_reordered(t: Tables):
    """Files whose columns come in different orders, one kind without a column, with points between thousands."""
    path = f"{scratch_dir(t.spark)}/customer"
    text = F.translate(F.format_number(F.col("c_acctbal") * 1000, 1), ",.", ".,").alias("c_acctbal")
    rows = t.customer.select("c_custkey", "c_name", text, "c_mktsegment")
    for part, names in enumerate((["c_name", "c_acctbal", "c_custkey"], ["c_mktsegment", "c_custkey", "c_name", "c_acctbal"], rows.columns)):
        rows.filter(F.col("c_custkey") % 3 == part).select(names).write.mode("append").csv(path, sep=";", header=True, encoding="ISO-8859-1")
    return readers.read_delimited(
        t.spark, path, "c_custkey bigint, c_name string, c_acctbal string, c_mktsegment string", ["c_acctbal"]
    )


@query("""
SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'broken' ELSE 'row' END AS kind, count(*) AS n, CAST(sum(CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE s_suppkey END) AS BIGINT) AS keys
FROM supplier GROUP BY 1
""")
def src_json_envelope_multiline(t: Tables):
    """One document a file over several lines, a fifth of them cut off; those are counted in the reject frame."""
    path = f"{scratch_dir(t.spark)}/envelopes"
    row = F.concat(F.lit('{"metadata": {},\n "data": [\n  {"key": "'), F.col("s_suppkey").cast("string"))
    whole = F.concat(row, F.lit('"}\n ]\n}'))
    lines = F.when(F.col("s_suppkey") % 5 == 0, row).otherwise(whole).alias("value")
    # As many files as rows: by all cores at once, and each task moves its own into place instead of the driver.
    files = t.supplier.select(lines).repartition(4 * t.spark.sparkContext.defaultParallelism)
    files.write.options(maxRecordsPerFile=1, **{"mapreduce.fileoutputcommitter.algorithm.version": 2}).text(path)
    schema = T.StructType([T.StructField("key", T.StringType())])
    rows, broken = readers.read_envelope_rejects(t.spark, path, schema)
    rows = rows.select(F.lit("row").alias("kind"), F.col("key").cast("long").alias("k"))
    return rows.union(broken.select(F.lit("broken"), F.lit(0).cast("long"))).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys")
    )


@query("SELECT doc_id, text, lang FROM documents")
def reject_roundtrip(t: Tables):
    """Rejected texts with line breaks, quotes and separators come back as they were."""
    path = f"{scratch_dir(t.spark)}/rejects"
    writers.log_rejects(t.documents.select("doc_id", "text", "lang"), path)
    return readers.read_rejects(t.spark, path, "doc_id bigint, text string, lang string")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 10 = 0 THEN 1999 ELSE year(o_orderdate) END::INT AS year
FROM orders
""")
def upsert_table_partitioned(t: Tables):
    """Updated rows move to another partition; the table keeps its partitions."""
    db = t.work_db()
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    writers.overwrite_table(rows, db, "orders_by_year", partition_by=["year"])
    moved = rows.filter("o_orderkey % 10 = 0").select("o_orderkey", F.lit(0.0).alias("o_totalprice"), F.lit(1999).alias("year"))
    writers.upsert_table(moved, db, "orders_by_year", ["o_orderkey"])
    if writers.partition_columns(t.spark, f"{db}.orders_by_year") != ["year"]:
        raise ValueError("the table lost its partitions")
    return t.spark.table(f"{db}.orders_by_year")


@query("""
SELECT *, floor((row_number() OVER (PARTITION BY year ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) / 5000)::INT AS batch, 0 AS added_by_rerun
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, year(l_shipdate)::INT AS year FROM lineitem)
""")
def exact_batches(t: Tables):
    """Batches of exactly 5,000 rows of each year, loaded twice; the second time adds no batch."""
    path = f"{scratch_dir(t.spark)}/batches"
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.select(*order, F.year("l_shipdate").alias("year"))
    batches.load_batches(rows, ["year"], order, 5000, path)
    again = batches.load_batches(rows.repartition(7), ["year"], order, 5000, path)
    return batches.read_batches(t.spark, path).withColumn("added_by_rerun", again.agg(F.count(F.lit(1)).cast("int")).scalar())
