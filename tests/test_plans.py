import json

from pyspark.sql import functions as F

from stratalake.operators import forecast
from stratalake.plans import climate, datasets, panel
from stratalake.sources.scratch import scratch_dir


def test_sixteen_monthly_datasets():
    assert len(datasets.MONTHLY_DATASETS) == 16
    assert datasets.MONTHLY_DATASETS["calidad_aire"].target_table == "calidad_aire_selected"


def test_every_monthly_dataset_cleans_and_reports(spark):
    """One generic landing frame holds every column the configurations name."""
    columns = {
        "AÑO": "int", "MES": "int", "PROVINCIA": "string", "PROVINCIA_ORIGEN": "string", "PROVINCIA_DESTINO": "string",
        "MUNICIPIO": "string", "MUNICIPIO_ORIGEN": "string", "CIUDAD": "string", "AUT_PORTUARIA": "string",
        "LUGAR_RESIDENCIA": "string", "VIAJEROS": "double", "IMD_VEHICULO_TOTAL": "double", "TASA_DELITOS": "double",
        "TASA_DELITOS_ESPAÑA": "double",
    }
    schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    base = (2020, 3, "Valencia/València", "Lugo", "Valencia/València", "València", "València", "Madrid", "VALENCIA", "Italia", 5.0, 3.0, 1.5, 2.5)
    gap = base[:-1] + (None,)
    zero = base[:9] + ("Total", 0.0, 0.0, 1.0, 1.0)
    raw = spark.createDataFrame([base, gap, zero], schema)
    for spec in datasets.MONTHLY_DATASETS.values():
        tables = {name: raw for name in spec.sources}
        cleaned = datasets.clean_monthly(tables, spec)
        kept = datasets.keep_selected(cleaned, spec)
        report = datasets.report_monthly(tables, spec)
        assert kept.count() <= cleaned.count()
        assert report.filter("rows_before - rows_dropped <> rows_after").count() == 0
        if spec.report_values:
            assert report.count() == len(spec.report_values)


def test_security_rates_are_spread_and_apartments_repeated(spark, rows):
    crime = spark.createDataFrame([(2020, 3, "Madrid", 1.5, 2.5), (2020, 6, "Lugo", 1.0, 1.0), (2020, 9, "Madrid", None, 1.0)],
                                  "`AÑO` int, MES int, PROVINCIA string, TASA_DELITOS double, `TASA_DELITOS_ESPAÑA` double")
    spec = datasets.MONTHLY_DATASETS["seguridad_provincia"]
    kept = datasets.keep_selected(datasets.clean_monthly({"seguridad_provincia": crime}, spec), spec)
    assert rows(kept, "MES", "TASA_DELITOS") == sorted([(1, -99.0), (2, -99.0), (3, 1.5)], key=repr)

    flats = spark.createDataFrame([(2020, 3, "Islas Baleares", None), (2021, 3, "Madrid", 2.0)],
                                  "`AÑO` int, MES int, PROVINCIA string, VIAJEROS double")
    spec = datasets.MONTHLY_DATASETS["apartamentos_ocupacion"]
    kept = datasets.keep_selected(datasets.clean_monthly({"apartamentos_ocupacion": flats}, spec), spec)
    assert rows(kept, "AÑO", "MES", "PROVINCIA", "VIAJEROS") == [
        (2020, 3, "Illes Balears", 0.0), (2020, 4, "Illes Balears", 0.0), (2020, 5, "Illes Balears", 0.0), (2021, 3, "Madrid", 2.0),
    ]


def test_each_source_has_its_own_recoding(spark, rows):
    frame = spark.createDataFrame([(2020, 1, "Palma"), (2020, 1, "València")], "`AÑO` int, MES int, MUNICIPIO_ORIGEN string")
    spec = datasets.MONTHLY_DATASETS["turismo_Emisor"]
    tables = {"turismo_Emisor": frame, "turismo_Emisor_Balears": frame}
    kept = datasets.keep_selected(datasets.clean_monthly(tables, spec), spec)
    assert rows(kept, "MUNICIPIO_ORIGEN") == [("Palma de Mallorca",), ("Valencia",)]


def test_run_monthly_between_tables(spark, rows):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landing LOCATION '{scratch_dir(spark)}'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS trusted LOCATION '{scratch_dir(spark)}'")
    spark.createDataFrame([(2020, 1, "Madrid", 0.0), (2020, 2, "Madrid", 3.0)], "`AÑO` int, MES int, PROVINCIA string, VIAJEROS double").write.saveAsTable("landing.campings_ocupacion")
    stored, report = datasets.run_monthly(spark, datasets.MONTHLY_DATASETS["campings_ocupacion"])
    assert rows(stored, "MES") == [(2,)]
    assert rows(report.filter("PROVINCIA = 'Madrid'"), "rows_before", "rows_after", "status") == [(2, 1, "ok")]


def test_daily_climate(spark):
    fields = dict.fromkeys(climate.RAW_FIELDS, "")
    known = {**fields, "fecha": "2024-01-02", "indicativo": "3195", "nombre": "RETIRO", "tmed": "1,5", "prec": "Ip", "horatmin": "09:30", "provincia": "MADRID"}
    other = {**fields, "fecha": "2024-01-02", "indicativo": "XXXX"}
    broken = {**fields, "indicativo": None}
    raw = spark.createDataFrame([tuple(r[f] for f in climate.RAW_FIELDS) for r in (known, other, broken)], climate.RAW_SCHEMA)
    built = climate.build_daily_climate(climate.landing_rows(raw))
    assert built.columns == list(climate.TRUSTED_NAMES.values())
    (row,) = built.collect()
    assert row["fecha"] == "2024-01-02" and row["provincia"] == "Madrid" and row["temperaturaMedia"] == 1.5
    assert row["precipitacion"] is None and row["horaTemperaturaMinima"] == "09:30" and row["horaRacha"] == "Desconocido"
    assert (row["AÑO"], row["MES"]) == (2024, 1)
    (filled,) = climate.build_daily_climate(climate.landing_rows(raw), measure_value=-9999).collect()
    assert filled["precipitacion"] == -9999.0


def test_municipal_forecast_edges(spark):
    day = {"fecha": "2024-01-01T00:00:00", "uvMax": 3, "temperatura": {"maxima": 20, "minima": 10},
           "probPrecipitacion": [{"value": 1, "periodo": "00-12"}, {"value": 7, "periodo": "00-24"}, {"value": 9, "periodo": "00-24"}],
           "estadoCielo": [{"value": "11", "periodo": "00-24", "descripcion": "Despejado"}], "viento": []}
    docs = [json.dumps([{"prediccion": {"dia": [day, {"fecha": "2"}]}}]), "[{", None, json.dumps([{"prediccion": {"dia": []}}]), "[]"]
    raw = spark.createDataFrame([("c", "n", "d", doc) for doc in docs],
                                "municipio_codigo_aemet string, nombre_municipio_ine string, fecha_descarga_utc string, raw_aemet_data_json_str string")
    plain = forecast.flatten_municipal_forecast(raw, impute=False).collect()
    assert len(plain) == 6
    assert plain[0]["probPrecipitacion_00_24"] == 7 and plain[0]["estadoCieloDescripcion_00_24"] == "Despejado"
    assert plain[0]["vientoDireccion_00_24"] is None and plain[0]["temperaturaMaxima"] == 20
    assert plain[1]["fechaPrediccion"] == "2" and all(r["fechaPrediccion"] is None for r in plain[2:])
    filled = forecast.flatten_municipal_forecast(raw).collect()
    assert len(filled[0]) == 18 and filled[0]["vientoVelocidad_00_24"] == -9999 and filled[2]["fechaPrediccion"] == "Desconocido"


def test_beach_forecast_keeps_both_spellings(spark):
    day = '{"fecha": 20240101, "tMaxima": {"valor1": 1}, "tmaxima": {"valor1": 2}, "tAgua": {"valor1": 3}, "tagua": {"valor1": 4}, "uvMax": {"valor1": 5}}'
    doc = f'[{{"nombre": "La Playa", "localidad": 8019, "prediccion": {{"dia": [{day}]}}}}]'
    raw = spark.createDataFrame([("1", "m", "p", doc), ("2", "m", "p", "no")],
                                "playa_codigo_aemet string, nombre_municipio string, nombre_provincia string, raw_aemet_data_json_str string")
    first, second = forecast.flatten_beach_forecast(raw).orderBy("id_playa").collect()
    assert len(first) == 27
    assert (first["tMaxima"], first["tempMaxima"], first["tAgua_valor1"], first["tempAgua"], first["uvMax"]) == (1, 2, 3, 4, 5)
    assert second["nombre_playa"] is None and second["nombre_municipio"] == "m"


def test_air_index_is_null_when_a_bucket_is_empty(spark):
    df = spark.createDataFrame([("Madrid", 2020, 1, "Buena", 60.0, "s1"), ("Madrid", 2020, 1, "Regular", 30.0, "s2"), ("Madrid", 2020, 1, "Muy desfavorable", 10.0, "s2"),
                                ("Sevilla", 2020, 1, "Buena", 60.0, "s1")],
                               "PROVINCIA string, `AÑO` int, MES int, CALIDAD_AIRE string, PORCENTAJE_CALIDAD_AIRE double, ESTACION string")
    got = {r["PROVINCIA"]: r for r in panel.air_quality_features(df).collect()}
    assert abs(got["Madrid"]["aire_quality_index"] - 150 / (100 + 1e-6)) < 1e-12
    assert got["Madrid"]["aire_num_estaciones"] == 2 and got["Sevilla"]["aire_quality_index"] is None


def test_climate_block_skips_texts_that_are_no_times(spark):
    df = spark.createDataFrame([("Madrid", 2020, 1, 5.0, 0.0, -1.0, 31.0, "06:00", "Desconocido"), ("Madrid", 2020, 1, 7.0, 2.0, 3.0, 29.0, "07:30", "Desconocido")],
                               "provincia string, `AÑO` int, MES int, temperaturaMedia double, precipitacion double, temperaturaMinima double, temperaturaMaxima double, horaTemperaturaMinima string, horaTemperaturaMaxima string")
    row = panel.climate_features(df).first()
    assert (row["dias_lluvia_mes"], row["dias_calidos"], row["dias_helada"]) == (1, 1, 1)
    assert row["rango_termico_extremo"] == 32.0 and row["hora_temp_min_media"] == "06:45" and row["hora_temp_max_media"] is None


def test_no_column_is_lost_from_the_panel():
    assert len(panel.FEATURES) == 24 and len(panel.LAGGED) == 5


def test_explode_documents_parses_once(spark):
    raw = spark.createDataFrame([("[]",)], "raw_aemet_data_json_str string").withColumns(
        {c: F.lit("x") for c in ("playa_codigo_aemet", "nombre_municipio", "nombre_provincia")}
    )
    plan = forecast.flatten_beach_forecast(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
