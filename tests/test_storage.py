import io
import json
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from stratalake.plans.datasets import MONTHLY_DATASETS, load_landing, read_landing
from stratalake.plans.reload import reload_pending
from stratalake.sources import readers, writers
from stratalake.sources.literal import literal_dim
from stratalake.sources.scratch import discard, scratch_dir, store
from stratalake.sources.spreadsheet import sheet_rows
from stratalake.streaming.incremental import append_sink, ingest_new_files, upsert_sink


@pytest.fixture
def db(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark)}'")
    return name


def _frame(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def test_upsert_replaces_matches_and_adds_the_rest(spark, rows):
    target = _frame(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = _frame(spark, [(2, "B"), (3, "C"), (None, "N")])
    merged = writers.upsert_merge(target, source, ["k"])
    assert rows(merged) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=repr)


def test_upsert_is_idempotent(spark, rows):
    target, source = _frame(spark, [(1, "a")]), _frame(spark, [(1, "b"), (2, "c")])
    once = writers.upsert_merge(target, source, ["k"])
    assert rows(writers.upsert_merge(once, source, ["k"])) == rows(once)


def test_upsert_duplicate_source_key(spark, rows):
    target = _frame(spark, [(1, "a")])
    with pytest.raises(Exception, match="several source rows"):
        writers.upsert_merge(target, _frame(spark, [(1, "x"), (1, "y")]), ["k"]).collect()
    added = writers.upsert_merge(target, _frame(spark, [(2, "x"), (2, "y")]), ["k"])
    assert rows(added) == [(1, "a"), (2, "x"), (2, "y")]


def test_upsert_table_creates_then_merges(spark, rows, db):
    writers.upsert_table(_frame(spark, [(1, "a"), (2, "b")]), db, "t", ["k"])
    stored = writers.upsert_table(_frame(spark, [(2, "B"), (3, "c")]), db, "t", ["k"])
    assert rows(stored) == [(1, "a"), (2, "B"), (3, "c")]
    again = writers.upsert_table(_frame(spark, [(3, "C")]), db, "t", ["k"])
    assert rows(again) == [(1, "a"), (2, "B"), (3, "C")]
    assert {t.name for t in spark.catalog.listTables(db)} == {"t"}


@pytest.mark.parametrize("stopped_with", [["t__next", "t__old"], ["t__old"]])
def test_upsert_table_completes_a_stopped_swap(spark, rows, db, stopped_with):
    for name in stopped_with:
        writers.overwrite_table(_frame(spark, [(1, name)]), db, name)
    stored = writers.upsert_table(_frame(spark, [(2, "b")]), db, "t", ["k"])
    assert rows(stored) == [(1, stopped_with[0]), (2, "b")]


def test_append_matches_columns_by_name(spark, rows, db):
    writers.append_table(_frame(spark, [(1, "a")]), db, "t")
    stored = writers.append_table(_frame(spark, [(2, "b")]).select("v", "k"), db, "t")
    assert rows(stored) == [(1, "a"), (2, "b")]


def test_overwrite_replaces_schema(spark, db):
    writers.overwrite_table(_frame(spark, [(1, "a")]), db, "t")
    assert writers.overwrite_table(spark.createDataFrame([(1.5,)], "x double"), db, "t").columns == ["x"]


def test_partitioned_write_prunes(spark):
    df = spark.createDataFrame([("2024-01-31", 1), ("2024-02-01", 2), ("bad", 3)], "fecha string, v int")
    stored = writers.write_partitioned(
        writers.with_year_month(df, "fecha", "yyyy-MM-dd"), f"{scratch_dir(spark)}/p"
    )
    assert stored.filter("month = 2").select("v").first()["v"] == 2
    assert stored.filter("year IS NULL").select("v").first()["v"] == 3
    plan = stored.filter("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_reload_adds_missing_batches_once(spark, rows, db):
    batches = _frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    writers.append_table(batches.filter("k = 1"), db, "t")
    requested = _frame(spark, [(1, ""), (2, "")])
    for _ in range(2):
        stored = reload_pending(requested, batches, ["k"], db, "t")
    assert rows(stored) == [(1, "a"), (2, "b")]


def test_reload_into_a_missing_table(spark, rows, db):
    stored = reload_pending(_frame(spark, [(1, "")]), _frame(spark, [(1, "a"), (2, "b")]), ["k"], db, "t")
    assert rows(stored) == [(1, "a")]


def test_log_round_trip_and_malformed_lines(spark, rows, tmp_path):
    (tmp_path / "log.csv").write_text("start,end,n\n2024-01-01,2024-01-15,3\nonly-one\n2024-02-01,2024-02-02,x\n")
    log = readers.read_log(spark, str(tmp_path), "start string, end string, n int")
    assert rows(log) == [("2024-01-01", "2024-01-15", 3)]
    assert log.select("start").count() == 1 and log.count() == 1


def test_delimited_reads_latin1_and_decimal_comma(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("AÑO;PROVINCIA;GASTO\n2024;Málaga;1,5\n2024;Cádiz;\n".encode("latin-1"))
    df = readers.read_delimited(spark, str(tmp_path), "`AÑO` int, PROVINCIA string, GASTO string", ["GASTO"])
    assert [tuple(r) for r in df.collect()] == [(2024, "Málaga", 1.5), (2024, "Cádiz", None)]


def test_envelope_multi_line(spark, rows, tmp_path):
    doc = {"metadata": {"n": 2}, "data": [{"fecha": "2024-01-01", "tmed": "1,5"}, {"fecha": "2024-01-02"}]}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=2))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("fecha", T.StringType()), T.StructField("tmed", T.StringType())])
    assert rows(readers.read_envelope(spark, str(tmp_path), schema)) == [("2024-01-01", "1,5"), ("2024-01-02", None)]


def _workbook(table):
    def cell(column, row, value):
        ref = f"{chr(65 + column)}{row}"
        if value is None:
            return ""
        if isinstance(value, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
        return f'<c r="{ref}"><v>{value}</v></c>'

    lines = "".join(
        f'<row r="{i}">' + "".join(cell(j, i, v) for j, v in enumerate(values)) + "</row>"
        for i, values in enumerate(table, 1)
    )
    space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{space}"><sheetData>{lines}</sheetData></worksheet>')
    return buffer.getvalue()


def test_spreadsheets_are_parsed_in_tasks(spark, rows, tmp_path):
    table = [["AÑO", "MES", "PROVINCIA", "VIAJEROS"], [2024, 1, "Madrid", 10.5], [2024, 2, "Sevilla", None]]
    assert list(sheet_rows(_workbook(table)))[1] == {"AÑO": 2024, "MES": 2, "PROVINCIA": "Sevilla", "VIAJEROS": None}
    for i in range(3):
        (tmp_path / f"f{i}.xlsx").write_bytes(_workbook(table))
    spec = MONTHLY_DATASETS["campings_ocupacion"]
    df = read_landing(spark, spec, str(tmp_path), "`AÑO` int, MES int, PROVINCIA string, VIAJEROS double")
    assert rows(df.distinct()) == [(2024, 1, "Madrid", 10.5), (2024, 2, "Sevilla", None)]
    assert df.count() == 6


def test_workbook_as_spreadsheet_programs_write_it():
    """Sheet order and place from the workbook, dates by style, errors, phonetic text, rich text and cells without reference."""
    space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cells = (
        '<row><c t="s"><v>0</v></c><c t="s"><v>1</v></c><c t="inlineStr"><is><r><t>TO</t></r><r><t>TAL</t></r></is></c><c t="str"><v>AT</v></c></row>'
        '<row><c s="1"><v>45306</v></c><c t="s"><v>2</v></c><c t="e"><v>#N/A</v></c><c s="2"><v>45306.5</v></c></row>'
        '<row r="3"><c r="B3" t="b"><v>1</v></c><c r="C3"><v>1.5</v></c><c s="3"><v>2</v></c></row>'
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{space}"><sheetData/></worksheet>')
        book.writestr("xl/worksheets/data.xml", f'<worksheet xmlns="{space}"><sheetData>{cells}</sheetData></worksheet>')
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{space}" xmlns:r="{links}"><sheets><sheet name="x" sheetId="7" r:id="rId9"/><sheet name="y" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="p"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId9" Target="/xl/worksheets/data.xml"/></Relationships>',
        )
        book.writestr(
            "xl/sharedStrings.xml", f'<sst xmlns="{space}"><si><t>DAY</t></si><si><t>NAME</t></si><si><t>X</t><rPh sb="0" eb="1"><t>yomi</t></rPh></si></sst>'
        )
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{space}"><numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy hh:mm"/><numFmt numFmtId="171" formatCode="0.0&quot; days&quot;"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>',
        )
    import datetime

    assert list(sheet_rows(buffer.getvalue())) == [
        {"DAY": datetime.date(2024, 1, 15), "NAME": "X", "TOTAL": None, "AT": datetime.datetime(2024, 1, 15, 12)},
        {"DAY": None, "NAME": True, "TOTAL": 1.5, "AT": 2},
    ]


def test_tagged_union_and_empty_loads(spark, rows, db):
    full, empty = _frame(spark, [(1, "a")]), _frame(spark, []).withColumn("extra", F.lit(1))
    assert readers.union_tagged({"x": full, "y": empty}, "tag").columns == ["k", "v", "tag", "extra"]
    stored = load_landing([("x", full), ("x", full), ("y", empty)], "tag", db, "t")
    assert rows(stored) == [(1, "a", "x"), (1, "a", "x")]
    with pytest.raises(ValueError):
        load_landing([("y", empty)], "tag", db, "t2")


def test_tag_by_file(spark, rows, tmp_path):
    for name in ("madrid", "sevilla"):
        (tmp_path / f"{name}.csv").write_text("v\n1\n")
    df = spark.read.csv(str(tmp_path), header=True, schema="v int")
    assert rows(readers.tag_by_file(df, r"([a-z]+)\.csv", "city"), "city") == [("madrid",), ("sevilla",)]


def test_batch_metadata_is_written_beside_the_rows(spark):
    df = spark.createDataFrame([("s1", "2024-01-01"), ("s1", "2024-01-09"), ("s2", "2024-01-03")], "s string, d string")
    path = f"{scratch_dir(spark)}/b"
    meta = writers.write_batch(df, path, "s", "d").first()
    assert (meta["n_records"], meta["n_entities"], str(meta["first_date"]), str(meta["last_date"])) == (
        3, 2, "2024-01-01", "2024-01-09",
    )
    assert spark.read.json(f"{path}/data").count() == 3


def test_literal_dimension_is_a_sized_relation(spark):
    dim = literal_dim(spark, [(1, "a"), (2, None)], "k int, v string")
    assert "LocalRelation" in dim._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        literal_dim(spark, [(1,)] * 100_001, "k int")


def test_store_keeps_rows_and_types(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, None)], "k int, v string")
    assert rows(store(df)) == rows(df) and store(df).schema == df.schema


def test_stream_loads_each_file_once(spark, rows, tmp_path, db):
    landing, schema = tmp_path / "in", _frame(spark, []).schema
    landing.mkdir()
    (landing / "1.json").write_text('{"k": 1, "v": "a"}\n{"k": 2, "v": "b"}\n')
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):
        ingest_new_files(spark, str(landing), schema, append_sink(out), progress)
    (landing / "2.json").write_text('{"k": 2, "v": "B"}\n')
    ingest_new_files(spark, str(landing), schema, append_sink(out), progress)
    assert rows(spark.read.parquet(out), "k", "v") == [(1, "a"), (2, "B"), (2, "b")]
    ingest_new_files(spark, str(landing), schema, upsert_sink(db, "t", ["k"]), str(tmp_path / "p2"), max_files_per_batch=1)
    assert rows(spark.table(f"{db}.t")) in ([(1, "a"), (2, "B")], [(1, "a"), (2, "b")])


class _Session:
    """Stands in for a session without a shared folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_rules(spark):
    assert scratch_dir(_Session("yarn", "s3a://bucket/shared/")).startswith("s3a://bucket/shared/stratalake/")
    assert scratch_dir(_Session("local[2]")) != scratch_dir(_Session("local[2]"))
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("spark://host:7077"))
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_append_refuses_or_adds_unknown_columns(spark, rows, db):
    writers.overwrite_table(_frame(spark, [(1, "a")]), db, "t")
    wider = _frame(spark, [(2, "b")]).withColumn("extra", F.lit(5))
    with pytest.raises(ValueError, match="extra"):
        writers.append_table(wider, db, "t")
    stored = writers.append_table(wider, db, "t", add_columns=True)
    assert rows(stored) == [(1, "a", None), (2, "b", 5)]


def test_failed_overwrite_leaves_the_old_table(spark, rows, db):
    writers.overwrite_table(_frame(spark, [(1, "a")]), db, "t")
    broken = _frame(spark, [(2, "b")]).withColumn("v", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        writers.overwrite_table(broken, db, "t")
    assert rows(spark.table(f"{db}.t")) == [(1, "a")]


def test_upsert_rewrites_touched_partitions_only(spark, rows, db):
    frame = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021), (3, "c", 2022), (4, "d", None)], "k int, v string, year int")
    writers.overwrite_table(frame, db, "t", partition_by=["year"])
    files = {r["p"]: r["f"] for r in spark.table(f"{db}.t").select("year", F.col("_metadata.file_path").alias("f")).withColumnRenamed("year", "p").collect()}
    source = spark.createDataFrame([(2, "moved", 2022), (5, "new", 2023)], "k int, v string, year int")
    stored = writers.upsert_table(source, db, "t", ["k"])
    assert rows(stored, "k", "v", "year") == sorted([(1, "a", 2020), (2, "moved", 2022), (3, "c", 2022), (4, "d", None), (5, "new", 2023)], key=repr)
    assert writers.partition_columns(spark, f"{db}.t") == ["year"]
    after = {r["p"]: r["f"] for r in stored.select(F.col("year").alias("p"), F.col("_metadata.file_path").alias("f")).collect()}
    assert after[2020] == files[2020] and after[None] == files[None]


def test_upsert_reads_the_target_once(spark):
    target = spark.range(100).selectExpr("id AS k", "id AS v")
    plan = writers.upsert_merge(target, spark.range(50, 120).selectExpr("id AS k", "0L AS v"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 100") == 1


def test_columns_are_bound_by_name(spark, rows, tmp_path):
    (tmp_path / "x.csv").write_bytes("a;b\n1;1.234,5\n".encode("latin-1"))
    (tmp_path / "y.csv").write_bytes("b;a\n2,5;2\n".encode("latin-1"))
    (tmp_path / "z.csv").write_bytes("a\n3\n".encode("latin-1"))
    df = readers.read_delimited(spark, str(tmp_path), "a int, b string", ["b"])
    assert rows(df) == [(1, 1234.5), (2, 2.5), (3, None)]
    with pytest.raises(ValueError, match="not in the schema"):
        readers.read_delimited(spark, str(tmp_path), "a int", [])


def test_a_broken_envelope_fails_or_is_told(spark, rows, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.json").write_text(json.dumps({"data": [{"k": "1"}, {"k": "2"}]}, indent=1))
    (tmp_path / "b.json").write_text('{"data": [\n{"k": "3"},')
    schema = T.StructType([T.StructField("k", T.StringType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_envelope(spark, str(tmp_path), schema).collect()
    good, bad = readers.read_envelope_rejects(spark, str(tmp_path), schema)
    assert rows(good) == [("1",), ("2",)]
    assert [(r["file_path"].endswith("b.json"), '"3"' in r["text"]) for r in bad.collect()] == [(True, True)]


def test_rejects_come_back_whole(spark, rows, tmp_path):
    values = [(1, 'line\nbreak, "quoted"'), (2, None), (3, "k,v")]
    writers.log_rejects(spark.createDataFrame(values, "k int, v string"), str(tmp_path / "log"))
    assert rows(readers.read_rejects(spark, str(tmp_path / "log"), "k int, v string")) == sorted(values, key=repr)


def test_a_line_like_the_header_is_kept(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,y\nk,v\n")
    assert rows(readers.read_log(spark, str(tmp_path), "k string, v string")) == [("k", "v"), ("x", "y")]


def test_stored_tables_can_be_discarded(spark):
    kept, gone = store(spark.range(3)), store(spark.range(3))
    discard(gone)
    assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(gone.scratch_path)


def test_single_documents_are_written_by_many_tasks(spark, rows, tmp_path, monkeypatch):
    from suite import storage
    from suite.registry import QUERIES

    spark.range(1, 41).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(storage, "scratch_dir", lambda spark: str(tmp_path))
    assert rows(QUERIES["src_json_envelope_multiline"](spark, str(tmp_path))) == [("broken", 8, 0), ("row", 32, 820 - 180)]
    files = [p.name for p in (tmp_path / "envelopes").glob("part-*")]
    assert len(files) == 40 and len({name.split("-")[1] for name in files}) > 4
