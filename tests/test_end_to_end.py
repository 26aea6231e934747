"""Landing files to trusted tables, feature panel, model and recommendations."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from stratalake.plans import climate, forecasts, panel
from stratalake.plans.datasets import MONTHLY_DATASETS, run_monthly
from stratalake.plans.recommend import model_probability, recommend_batch
from stratalake.plans.training import bad_month_conditions, train_and_log
from stratalake.sources.scratch import scratch_dir

PLACES = ["Madrid", "Barcelona", "Sevilla", "Valencia/València"]
PERIODS = [(y, m) for y in (2021, 2022) for m in range(1, 13)]


@pytest.fixture(scope="module")
def dbs(spark):
    names = {k: f"{k}_{uuid.uuid4().hex[:6]}" for k in ("landing", "trusted", "exploitation")}
    for name in names.values():
        spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark)}'")
    return names


def _save(spark, db, table, schema, rows):
    spark.createDataFrame(rows, schema).write.saveAsTable(f"{db}.{table}")


@pytest.fixture(scope="module")
def trusted(spark, dbs, tmp_path_factory):
    """Every input of the panel, cleaned from generated landing tables and files."""
    rng, landing = random.Random(1), dbs["landing"]
    keyed = "`AÑO` int, MES int, PROVINCIA string, "

    def rows(make):
        return [(y, m, p, *make()) for y, m in PERIODS for p in PLACES]

    _save(spark, landing, "percepcion_turista",
          keyed + "INIDICE_PERCEPCION_TURISTICA_GLOBAL double, INDICE_SATISFACCION_PRODUCTOS_TURISTICOS double, INDICE_PERCEPCION_SEGURIDAD double, INDICE_PERCEPCION_CLIMATICA double",
          rows(lambda: [float(rng.randint(50, 90)) for _ in range(4)]))
    _save(spark, landing, "actividades_Ocio",
          keyed + "PRODUCTO string, CATEGORIA string, ENTRADAS double, VISITAS_PAGINAS double, GASTO_TOTAL double, PRECIO_MEDIO_ENTRADA double, TRANSACCIONES double",
          [r for r in rows(lambda: ["x", "c", 1.0, 2.0, 30.0, 4.0, 5.0])] + [r for r in rows(lambda: ["y", "c", 2.0, 2.0, 30.0, 8.0, 5.0])])
    _save(spark, landing, "calidad_aire", keyed + "CALIDAD_AIRE string, PORCENTAJE_CALIDAD_AIRE double, ESTACION string",
          [r for kind in ("Buena", "Regular", "Desfavorable") for r in rows(lambda: [kind, float(rng.randint(1, 99)), "s"])])
    _save(spark, landing, "apartamentos_ocupacion",
          keyed + "VIAJEROS double, PERNOCTACIONES double, ESTANCIA_MEDIA double, GRADO_OCUPA_PLAZAS double, GRADO_OCUPA_APART double, GRADO_OCUPA_APART_FIN_SEMANA double, APARTAMENTOS_ESTIMADOS double, PLAZAS_ESTIMADAS double, PERSONAL_EMPLEADO double",
          rows(lambda: [float(rng.randint(1, 99)) for _ in range(9)]))
    for name in ("percepcion_turista", "actividades_Ocio", "calidad_aire", "apartamentos_ocupacion"):
        run_monthly(spark, MONTHLY_DATASETS[name], dbs["landing"], dbs["trusted"])

    folder = tmp_path_factory.mktemp("climate")
    for i, (station, _, _, _, _, _, _) in enumerate(climate.STATIONS):
        data = [{"fecha": f"{y}-{m:02d}-{d:02d}", "indicativo": station, "tmed": f"{rng.randint(5, 30)},5", "prec": "Ip" if d == 1 else "0,2",
                 "tmin": f"{rng.randint(-3, 15)},0", "tmax": f"{rng.randint(15, 40)},0", "horatmin": "06:15", "horatmax": "Varias"}
                for y, m in PERIODS for d in (1, 11, 21)]
        (folder / f"{i}.json").write_text(json.dumps({"metadata": {"n": len(data)}, "data": data}))
    climate.load_daily_climate(spark, str(folder), dbs["landing"])
    climate.run_daily_climate(spark, dbs["landing"], dbs["trusted"])
    return dbs["trusted"]


def test_climate_tables(spark, dbs, trusted):
    landed = spark.table(f"{dbs['landing']}.{climate.LANDING_TABLE}")
    assert landed.count() == 14 * 24 * 3
    assert landed.filter("year = 2022 AND month = 5").count() == 14 * 3
    stored = spark.table(f"{trusted}.{climate.TRUSTED_TABLE}")
    assert len(stored.columns) == 28 and stored.filter("precipitacion IS NULL").count() == 14 * 24


@pytest.fixture(scope="module")
def stored_panel(spark, dbs, trusted, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("export"))
    stored = panel.run_feature_panel(spark, trusted, dbs["exploitation"], export_path=path)
    assert spark.read.parquet(path).count() == stored.count()
    return stored


def test_panel_grain_and_columns(spark, trusted, stored_panel):
    assert len(stored_panel.columns) == 32
    assert stored_panel.count() == len(PERIODS) * len(PLACES)
    assert stored_panel.filter("PROVINCIA = 'Valencia'").count() == 24
    first = stored_panel.filter("PROVINCIA = 'Madrid' AND `AÑO` = 2021 AND MES = 1").first()
    assert first["aire_pct_buena_lag1"] is None
    pair = stored_panel.filter("PROVINCIA = 'Madrid' AND ((`AÑO` = 2021 AND MES = 12) OR (`AÑO` = 2022 AND MES = 1))")
    december, january = pair.orderBy("AÑO").collect()
    assert january["aire_pct_buena_lag1"] == december["aire_pct_buena"]
    inputs = {name: spark.table(f"{trusted}.{table}") for name, table in panel.INPUT_TABLES.items()}
    fanned = panel.build_feature_panel(**inputs, keep_fanout=True, lag_by_month_number=True)
    assert fanned.count() == 2 * len(PERIODS) * len(PLACES)


def test_train_and_recommend(spark, stored_panel):
    path = scratch_dir(spark)
    conditions = bad_month_conditions(stored_panel, rel_err=0)
    model, metrics = train_and_log(
        stored_panel, panel.FEATURES, conditions, panel.KEYS, "r1", path, grid={"maxDepth": [1, 2]}, folds=2, maxIter=2
    )
    row = metrics.first()
    assert row["tp"] + row["fp"] + row["fn"] + row["tn"] in (19, 20)
    log = spark.read.parquet(f"{path}/runs")
    assert {"accuracy", "auc", "f1", "maxDepth", "maxIter"} <= {r["name"] for r in log.collect()}

    requests = spark.createDataFrame(
        [("Madrid", "2023-04-02"), ("Valencia", "2023-07-02"), ("Lugo", "2023-07-02")], "PROVINCIA string, fecha string"
    ).withColumn("fecha", F.to_date("fecha"))
    advice = recommend_batch(
        requests, stored_panel, "PROVINCIA", "fecha", panel.FEATURES, model_probability(model, panel.FEATURES), feature_month="MES"
    )
    got = {r["PROVINCIA"]: r for r in advice.collect()}
    assert got["Lugo"]["verdict"] is None and got["Lugo"]["probability"] is None
    for place in ("Madrid", "Valencia"):
        assert 0 <= got[place]["probability"] <= 1 and place in got[place]["verdict"]


def test_forecast_tables(spark, dbs):
    doc = json.dumps([{"prediccion": {"dia": [{"fecha": "2024-01-01", "uvMax": 2}, {"fecha": "2024-01-02"}]}}])
    docs = spark.createDataFrame([("28079", doc), ("99999", doc)], "municipio_codigo_aemet string, documento string")
    fixed = F.lit("2024-01-01 10:00:00").cast("timestamp")
    landed = forecasts.load_municipal(docs, dbs["landing"], loaded_at=fixed)
    assert landed.count() == 1 and landed.first()["fecha_descarga_utc"] == "2024-01-01T10:00:00.000000"
    again = forecasts.landing_documents(docs, forecasts.municipalities(spark), "municipio_codigo_aemet", "documento", fixed)
    assert again.first()["id"] == landed.first()["id"]
    stored = forecasts.run_municipal(spark, dbs["landing"], dbs["trusted"])
    assert [(r["nombreMunicipio"], r["uv_max"]) for r in stored.orderBy("fechaPrediccion").collect()] == [("Madrid", 2), ("Madrid", -9999)]

    beach = json.dumps([{"nombre": "B", "localidad": 8019, "prediccion": {"dia": [{"fecha": 20240101, "tMaxima": {"valor1": 9}}]}}])
    forecasts.load_beaches(spark.createDataFrame([("0801905", beach)], "playa_codigo_aemet string, documento string"), dbs["landing"])
    row = forecasts.run_beaches(spark, dbs["landing"], dbs["trusted"]).first()
    assert (row["tMaxima"], row["nombre_municipio"], row["codigo_municipio"]) == (9, "Barcelona", 8019)
