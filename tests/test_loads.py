"""Workbooks, exact batches, pending intervals, VARIANT documents, stored statistics, clustered files and attempts."""

import datetime
import io
import json
import os
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import clean, forecast, intervals
from stratalake.plans.reload import next_requests
from stratalake.sources import batches, clustered, loadstats, spreadsheet, xlsx
from stratalake.sources.scratch import store
from stratalake.streaming import retries

DAY = datetime.date
MOMENT = datetime.datetime

# ---- workbooks ------------------------------------------------------------

ODD = ["", " lead and trail ", "a\nb\tc", "\x00\x07\x1f", "_x0041_ and _x12", "a\r\nb", "<&>\"'", "é 😀 ￾", "x" * 5000]


def test_workbook_round_trip():
    table = [(i, t, i / 3, i % 2 == 0, DAY(2024, 1, 1 + i), MOMENT(1999, 12, 31, 23, 59, i, 250_000), None) for i, t in enumerate(ODD)]
    file = io.BytesIO()
    spreadsheet.write_workbook(file, ["k", "t", "f", "b", "d", "m", "nothing"], {"One": table, "Two & <three>": table[:2]})
    assert spreadsheet.sheet_names(file) == ["One", "Two & <three>"]
    got = [tuple(cells.get(i) for i in range(7)) for _, cells in spreadsheet.cell_rows(file, "One")]
    assert got == table
    assert len(list(spreadsheet.cell_rows(file, "Two & <three>"))) == 2
    with pytest.raises(ValueError, match="no sheet"):
        list(spreadsheet.cell_rows(file, "Three"))
    for name in ("", "a/b", "x" * 32):
        with pytest.raises(ValueError, match="name"):
            spreadsheet.write_workbook(io.BytesIO(), ["a"], {name: []})


def test_xlsx_source_infers_and_reads_all_sheets(spark, rows, tmp_path):
    schema = "k long, t string, f double, b boolean, d date, m timestamp_ntz, nothing string, s string"
    data = [(i, t or None, i / 3 + 0.1, None if i == 3 else i % 2 == 0, DAY(2024, 1, 1 + i), MOMENT(1999, 12, 31, 23, 59, i, 250_000), None, f"s{i % 2}") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "books")
    xlsx.write_xlsx(df.repartition(3), path, sheetBy="s", rowsPerFile=2)
    read = xlsx.read_xlsx(spark, path, sheets="*")
    assert [(f.name, f.dataType.simpleString()) for f in read.schema][:2] == [("k", "bigint"), ("t", "string")]
    assert dict(read.dtypes)["m"] == "timestamp_ntz" and dict(read.dtypes)["d"] == "date" and dict(read.dtypes)["b"] == "boolean"
    assert rows(read.select(*df.columns[:-1], "_sheet")) == rows(df)
    assert read.rdd.getNumPartitions() >= 5
    assert not [f for f in os.listdir(path) if f.startswith("_temporary")]
    xlsx.write_xlsx(df.limit(1), path, mode="overwrite")
    assert xlsx.read_xlsx(spark, path).count() == 1
    xlsx.write_xlsx(df.limit(1), path)
    assert xlsx.read_xlsx(spark, path, "k long").count() == 2


def test_xlsx_columns_are_bound_by_name_and_kind(spark, rows, tmp_path):
    with open(tmp_path / "a.xlsx", "wb") as file:
        spreadsheet.write_workbook(file, ["v", "k"], {"x": [(1, 10), ("two", 20), (3.5, 30)]})
    with open(tmp_path / "b.xlsx", "wb") as file:
        spreadsheet.write_workbook(file, ["k", "w"], {"x": [(40, "w")], "y": [(50, "z")]})
    (tmp_path / "c.txt").write_text("no workbook")
    os.makedirs(tmp_path / "_old")
    (tmp_path / "_old" / "d.xlsx").write_text("no workbook either")
    path = str(tmp_path)
    got = xlsx.read_xlsx(spark, path, "k long, v string, _sheet string")
    assert rows(got) == sorted([(10, "1", "x"), (20, "two", "x"), (30, "3.5", "x"), (40, None, "x")], key=repr)
    with pytest.raises(Exception, match="row 3, column v"):
        xlsx.read_xlsx(spark, path, "k long, v double").collect()
    lenient = xlsx.read_xlsx(spark, path, "k long, v decimal(5,1)", mode="PERMISSIVE")
    assert rows(lenient) == sorted([(10, Decimal("1.0")), (20, None), (30, Decimal("3.5")), (40, None)], key=repr)
    assert rows(xlsx.read_xlsx(spark, f"{path}/b.xlsx", "k long, w string", sheets="y, x")) == [(40, "w"), (50, "z")]
    assert xlsx.read_xlsx(spark, f"file://{path}/b.xlsx", sheets="*").columns == ["k", "w", "_sheet"]
    with pytest.raises(Exception, match="nowhere"):
        xlsx.read_xlsx(spark, f"{path}/nowhere")


def test_xlsx_of_no_rows_and_bad_options(spark, tmp_path):
    with open(tmp_path / "a.xlsx", "wb") as file:
        spreadsheet.write_workbook(file, ["v", "k"], {})
    empty = xlsx.read_xlsx(spark, str(tmp_path))
    assert empty.columns == ["v", "k"] and empty.count() == 0
    df = spark.createDataFrame([(1,)], "k int")
    xlsx.write_xlsx(df.limit(0), str(tmp_path / "none"))
    for options in ({"sheetBy": "missing"}, {"rowsPerFile": 0}):
        with pytest.raises(Exception):
            xlsx.write_xlsx(df, str(tmp_path / "bad"), **options)


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [(True, "string", "true"), (3.0, "int", 3), ("7", "long", 7), (MOMENT(2024, 1, 2, 3), "date", DAY(2024, 1, 2)), (DAY(2024, 1, 2), "timestamp_ntz", MOMENT(2024, 1, 2)), ("2024-01-02", "date", DAY(2024, 1, 2)), (2, "double", 2.0)],
)
def test_cells_take_the_column_kind(spark, value, kind, expected):
    assert xlsx.cell_value(value, T._parse_datatype_string(kind)) == expected


@pytest.mark.parametrize(("value", "kind"), [(3.5, "int"), (True, "int"), ("x", "double"), (1, "boolean"), (1, "date"), ("x", "decimal(5,1)")])
def test_cells_of_another_kind_are_refused(spark, value, kind):
    with pytest.raises(ValueError):
        xlsx.cell_value(value, T._parse_datatype_string(kind))


# ---- batches --------------------------------------------------------------

@pytest.mark.parametrize("ranges", [None, 2, 9])
def test_dense_numbers_do_not_depend_on_ranges(spark, ranges):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(40), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, o int, v int")
    got = batches.dense_numbers(df.repartition(5), ["g"], ["o"], "n", ranges).collect()
    assert sorted((r["g"] or "", r["o"], r["v"]) for r in got) == sorted((g or "", o, v) for g, o, v in data)
    for group in ("a", "b", None):
        own = sorted((r["n"], r["o"]) for r in got if r["g"] == group)
        assert [n for n, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)


def _loaded(spark, path):
    return sorted((r["g"] or "", r["v"], r["batch"]) for r in batches.read_batches(spark, path).collect())


def test_batches_are_written_once(spark, tmp_path):
    path = str(tmp_path / "out")
    data = [("a" if i % 3 else None, i) for i in range(100)]
    df = spark.createDataFrame(data, "g string, v int")
    expected = sorted((g, v, n // 7) for g in ("a", "") for n, v in enumerate(sorted(v for h, v in data if (h or "") == g)))
    first = batches.load_batches(df, ["g"], ["v"], 7, path)
    assert sorted(r["n_rows"] for r in first.collect()) == sorted([7] * 9 + [3] + [7] * 4 + [6])
    assert _loaded(spark, path) == expected
    assert batches.load_batches(df.repartition(3), ["g"], ["v"], 7, path).count() == 0
    assert _loaded(spark, path) == expected
    # Rows added at the end of a group change its last batch and add new ones.
    more = data + [("a", 100 + i) for i in range(10)]
    fresh = batches.load_batches(spark.createDataFrame(more, "g string, v int"), ["g"], ["v"], 7, path)
    assert sorted((r["g"], r["batch"], r["n_rows"]) for r in fresh.collect()) == [("a", 9, 7), ("a", 10, 6)]
    assert Counter(v for _, v, _ in _loaded(spark, path)) == Counter(v for _, v in more)


def test_a_load_that_stopped_before_its_ledger_is_repeated(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", i) for i in range(20)], "g string, v int")
    batches.load_batches(df, ["g"], ["v"], 8, path)
    for folder, _, files in os.walk(f"{path}/ledger"):
        for f in files:
            os.remove(f"{folder}/{f}")
    os.rmdir(f"{path}/ledger")
    assert batches.load_batches(df, ["g"], ["v"], 8, path).count() == 3
    assert [v for _, v, _ in _loaded(spark, path)] == list(range(20))
    with pytest.raises(ValueError):
        batches.number_batches(df, ["g"], ["v"], 0)


# ---- intervals ------------------------------------------------------------

def plain_pending(requested, loaded):
    days = lambda a, b: {a + datetime.timedelta(i) for i in range((b - a).days + 1)} if a and b and a <= b else set()
    covered = defaultdict(set)
    for key, a, b in loaded:
        covered[key] |= days(a, b)
    out = []
    for key, note, a, b in set(requested):
        left = sorted(days(a, b) - (covered[key] if key is not None else set()))
        while left:
            n = 1
            while n < len(left) and left[n] == left[0] + datetime.timedelta(n):
                n += 1
            out.append((key, note, left[0], left[n - 1]))
            left = left[n:]
    return sorted(out, key=repr)


def test_pending_intervals_are_those_of_all_days(spark, rows):
    rng = random.Random(11)
    start = DAY(1969, 11, 1)  # buckets on both sides of 1970
    span = lambda most: (lambda a: (a, a + datetime.timedelta(rng.randrange(-2, most))))(start + datetime.timedelta(rng.randrange(300)))
    requested = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice("xy"), *span(200)) for _ in range(120)]
    requested += requested[:5] + [(1, "n", None, start), (1, "n", start, None), (9, "one", start, start)]
    loaded = [(rng.choice([1, 1, 2, None]), *span(12)) for _ in range(60)] + [(1, None, start), (2, start, None)]
    a = spark.createDataFrame(requested, "k int, note string, interval_start date, interval_end date")
    b = spark.createDataFrame(loaded, "k int, interval_start date, interval_end date")
    assert rows(intervals.pending_intervals(a, b, ["k"])) == plain_pending(requested, loaded)
    assert rows(intervals.pending_intervals(a, b.limit(0), ["k"])) == plain_pending(requested, [])
    assert rows(intervals.pending_intervals(a.limit(0), b, ["k"])) == []


def test_a_hot_key_is_one_row_per_bucket_and_can_be_split(spark, tmp_path):
    """Many loads of one key meet as one number per bucket; the requests' side of the join is shuffled for it, not grouped."""
    start = DAY(2020, 1, 1)
    loaded = spark.range(20_000).select(F.lit(1).alias("k"), F.date_add(F.lit(start), (F.col("id") % 500).cast("int")).alias("interval_start"))
    loaded = loaded.withColumn("interval_end", F.col("interval_start"))
    masks = intervals.interval_masks(loaded, "interval_start", "interval_end").groupBy("k", "_bucket").agg(F.bit_or("_mask").alias("m"), F.count(F.lit(1)).alias("n"))
    assert masks.count() <= 10
    requested = spark.range(5000).select(F.lit(1).alias("k"), F.col("id"), F.lit(start).alias("interval_start"), F.lit(start + datetime.timedelta(509)).alias("interval_end"))
    got = intervals.pending_intervals(requested, loaded, ["k"])
    assert got.groupBy("interval_start", "interval_end").count().collect() == [(start + datetime.timedelta(500), start + datetime.timedelta(509), 5000)]


def test_given_up_keys_are_not_asked_for_again(spark, rows):
    day = lambda n: DAY(2024, 1, n)
    requested = spark.createDataFrame([(1, day(1), day(9)), (2, day(1), day(9)), (3, day(1), day(2)), (None, day(1), day(2))], "k int, interval_start date, interval_end date")
    loaded = spark.createDataFrame([(1, day(3), day(4)), (3, day(1), day(5))], "k int, interval_start date, interval_end date")
    attempts = spark.createDataFrame([(1, 1, "pending"), (2, 3, "gave up"), (3, 0, "loaded")], "key int, attempts int, status string")
    got = next_requests(requested, loaded, attempts, ["k"])
    assert rows(got) == sorted([(1, day(1), day(2)), (1, day(5), day(9)), (None, day(1), day(2))], key=repr)


# ---- documents of varying layout ------------------------------------------

def test_variant_documents(spark, rows):
    day = {"probPrecipitacion": [{"value": 5, "periodo": "00-24"}], "temperatura": {"maxima": 9}, "fecha": "2024-01-01", "new": {"a": [1]}}
    docs = [json.dumps([{"prediccion": {"dia": [day, {"fecha": "2024-01-02", "temperatura": "warm"}]}}]), "[{bad", None, "[]", '[{"prediccion": {"dia": []}}]', '{"other": 1}']
    raw = spark.createDataFrame([(str(i), "n", "d", t) for i, t in enumerate(docs)], "municipio_codigo_aemet string, nombre_municipio_ine string, fecha_descarga_utc string, raw_aemet_data_json_str string")
    got = forecast.flatten_municipal_variant(raw, impute=False)
    wanted = ["municipioCodigo", "fechaPrediccion", "probPrecipitacion_00_24", "temperaturaMaxima", "unknown"]
    assert rows(got, *wanted) == sorted(
        [("0", "2024-01-01", 5, 9, '{"new":{"a":[1]}}'), ("0", "2024-01-02", None, None, None), *[(str(i), None, None, None, None) for i in range(1, 6)]], key=repr
    )
    same = forecast.flatten_municipal_forecast(raw.filter("municipio_codigo_aemet != '0'"))
    assert rows(forecast.flatten_municipal_variant(raw.filter("municipio_codigo_aemet != '0'")).drop("unknown")) == rows(same)
    layout = forecast.observed_layout(raw.filter("municipio_codigo_aemet = '0'"), "raw_aemet_data_json_str").first()["layout"]
    assert "new: OBJECT<a: ARRAY<BIGINT>>" in layout


def test_variant_paths_tell_the_case_of_keys_apart(spark, rows):
    day = {"tMaxima": {"valor1": 30}, "tmaxima": {"valor1": 40}, "tAgua": {"valor1": "warm"}, "fecha": 20240101, "New": 1, "new": 2}
    docs = [json.dumps([{"nombre": "p", "localidad": 7, "prediccion": {"dia": [day]}}]), json.dumps([{"nombre": "q", "prediccion": {}}]), "{", None]
    raw = spark.createDataFrame([(str(i), "m", "v", t) for i, t in enumerate(docs)], "playa_codigo_aemet string, nombre_municipio string, nombre_provincia string, raw_aemet_data_json_str string")
    got = forecast.flatten_beach_variant(raw)
    wanted = ["id_playa", "nombre_playa", "codigo_municipio", "fecha", "tMaxima", "tempMaxima", "tAgua_valor1", "unknown"]
    assert rows(got, *wanted) == sorted(
        [("0", "p", 7, 20240101, 30, 40, None, '{"New":1,"new":2}'), ("1", "q", *[None] * 6), *[(str(i), *[None] * 7) for i in (2, 3)]], key=repr
    )


# ---- statistics of loads --------------------------------------------------

def test_distinct_sketches_merge_over_loads(spark, tmp_path):
    path = str(tmp_path)
    for load, (a, b) in {"x": (0, 20_000), "y": (10_000, 30_000), "z": (0, 0)}.items():
        loadstats.record_load(spark.range(a, b).withColumn("d", F.lit("2024-01-05")), load, path, distinct=["id"], day="d")
    for _ in range(2):
        total = loadstats.load_totals(spark, path).first()
        assert (total["n_loads"], total["n_rows"], str(total["first_day"])) == (3, 40_000, "2024-01-05")
        assert abs(total["id_estimate"] - 30_000) < 0.05 * 30_000
        loadstats.record_load(spark.range(10_000, 30_000).withColumn("d", F.lit("2024-01-05")), "y", path, distinct=["id"], day="d")


def test_thresholds_follow_late_months_without_reading_the_others(spark, tmp_path):
    path, rng = str(tmp_path), random.Random(5)
    values = {m: [rng.gauss(m, 3) for _ in range(3000)] for m in (1, 2, 3)}
    frame = lambda m, xs: spark.createDataFrame([(m, x) for x in xs] + [(m, None), (m, float("nan"))], "month int, x double")
    for m in (1, 2):
        loadstats.record_load(frame(m, values[m]), f"m{m}", path, by=["month"], numbers=["x"])

    def check(every):
        every = sorted(every)
        for row in loadstats.merged_quantiles(spark, path, [0.33, 0.66]).collect():
            assert row["n"] == len(every)
            assert abs(sum(x <= row["value"] for x in every) / len(every) - row["prob"]) < 0.012

    check(values[1] + values[2])
    loadstats.record_load(frame(3, values[3]), "m3", path, by=["month"], numbers=["x"])
    loadstats.record_load(frame(1, [100.0] * 900), "late1", path, by=["month"], numbers=["x"])
    check(values[1] + values[2] + values[3] + [100.0] * 900)
    per_month = {r["month"]: r["n"] for r in loadstats.merged_quantiles(spark, path, [0.5], by=["month"]).collect()}
    assert per_month == {1: 3900, 2: 3000, 3: 3000}
    nothing = str(tmp_path / "nothing")
    loadstats.record_load(frame(1, []), "l", nothing, numbers=["x"])
    assert loadstats.merged_quantiles(spark, nothing, [0.5]).count() == 0


# ---- clustered files ------------------------------------------------------

def test_clustered_files_are_in_order_and_skipped(spark, rows, tmp_path):
    data = [(random.Random(i).randrange(1000) if i % 50 else None, i) for i in range(3000)]
    df = spark.createDataFrame(data, "d int, v int").repartition(7)
    path = str(tmp_path)
    index = clustered.write_clustered(df, path, ["d", "v"], rows_per_file=300)
    assert sum(r["n_rows"] for r in index.collect()) == 3000 and 8 <= index.count() <= 11
    assert clustered.disorder(spark, path, "d").agg(F.sum("n_disordered")).first()[0] == 0
    got = clustered.read_clustered(spark, path, "d", 200, 260)
    assert rows(got) == sorted([(d, v) for d, v in data if d is not None and 200 <= d <= 260], key=repr)
    assert len(clustered.files_between(spark, path, 200, 260)) <= 3
    assert len(got.inputFiles()) <= 3
    assert rows(clustered.read_clustered(spark, path, "d", 5000, 6000)) == [] and clustered.files_between(spark, path, 5000, 6000) == []


# ---- attempts -------------------------------------------------------------

RESULTS = T.StructType([T.StructField("key", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("ok", T.BooleanType())])


def plain_attempts(deliveries, limit):
    state = {}
    for rows in deliveries:
        for key, _, ok in sorted((r for r in rows if r[2] is not None), key=lambda r: r[1]):
            attempts, status = state.get(key, (0, "pending"))
            if status == "pending":
                attempts += not ok
                state[key] = (attempts, "loaded" if ok else "gave up" if attempts >= limit else "pending")
    return sorted(((k, *v) for k, v in state.items()), key=repr)


def test_attempts_over_deliveries_and_after_a_stopped_run(spark, rows, tmp_path, monkeypatch):
    rng = random.Random(2)
    deliveries = [[(rng.randrange(40) if i % 30 else None, i, rng.choice([True, False, False, False, None])) for i in range(300)] for _ in range(3)]
    deliveries[1] += [(77, i, False) for i in range(2000)]  # a hot key
    landing, path = tmp_path / "landing", str(tmp_path / "state")
    os.makedirs(landing)
    for n, results in enumerate(deliveries):
        (landing / f"{n}.json").write_text("\n".join(json.dumps({"key": k, "seq": s, "ok": ok}) for k, s, ok in results))
        if n == 1:

            def fails(folder):
                def write(batch, batch_id):
                    batch.collect()  # the state has moved on
                    raise RuntimeError("stopped")

                return write

            with monkeypatch.context() as m:
                m.setattr(retries, "append_sink", fails)
                with pytest.raises(Exception, match="stopped"):
                    retries.track_attempts(spark, str(landing), RESULTS, 3, path)
        retries.track_attempts(spark, str(landing), RESULTS, 3, path)
        assert rows(retries.attempt_states(spark, path)) == plain_attempts(deliveries[: n + 1], 3)
    retries.track_attempts(spark, str(landing), RESULTS, 3, path)
    assert rows(retries.attempt_states(spark, path)) == plain_attempts(deliveries, 3)


# ---- imputation -----------------------------------------------------------

def test_every_numeric_type_is_imputed(spark):
    df = spark.createDataFrame([(None,) * 7], "a byte, b short, c int, d long, e float, f double, g decimal(9,2)").withColumn("t", F.lit("x"))
    assert [float(v) for v in clean.impute_numeric(df, -9).first()[:7]] == [-9.0] * 7
    with pytest.warns(UserWarning, match="t"):
        clean.impute_numeric(df, 1, ["a", "t"])
    for bad in (True, "1", None):
        with pytest.raises(TypeError):
            clean.impute_numeric(df, bad)


def test_a_load_deals_its_rows_out_once(spark, tmp_path, monkeypatch):
    """Rows are stored once on the way to their batches, are numbered and written where they lie, and leave nothing behind."""
    stored = []

    def kept(df, name):
        stored.append((name, store(df, name)))
        return stored[-1][1]

    monkeypatch.setattr(batches, "store", kept)
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = batches.dense_numbers(df, ["g"], ["v"], "n", 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan
    stored.clear()
    assert batches.load_batches(df, ["g"], ["v"], 100, str(tmp_path / "out")).count() == 51
    assert [name for name, _ in stored] == ["ranges", "offsets", "fresh"]
    assert [os.path.exists(t.scratch_path.removeprefix("file:")) for _, t in stored] == [False, False, True]
