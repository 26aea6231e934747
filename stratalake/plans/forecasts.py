"""Forecast documents from landing to trusted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.clock import load_stamp
from stratalake.functions.text import row_id
from stratalake.operators.forecast import flatten_beach_forecast, flatten_municipal_forecast
from stratalake.sources.literal import literal_dim
from stratalake.sources.writers import append_table, overwrite_table

# ---- fixed values ---------------------------------------------------------

MUNICIPALITIES = [
    ("28079", "Madrid"),
    ("08019", "Barcelona"),
    ("41091", "Sevilla"),
    ("07040", "Palma de Mallorca"),
    ("03031", "Benidorm"),
    ("46250", "Valencia"),
]
MUNICIPALITY_SCHEMA = "municipio_codigo_aemet string, nombre_municipio_ine string"
# id_playa, nombre_playa, id_provincia, nombre_provincia, id_municipio, nombre_municipio
BEACHES = [
    ("0303102", "Llevant / Playa de Levante", "03", "Alacant/Alicante", "03031", "Benidorm"),
    ("0303104", "Ponent / Playa de Poniente", "03", "Alacant/Alicante", "03031", "Benidorm"),
    ("0704001", "Cala Major", "07", "Illes Balears", "07040", "Palma de Mallorca"),
    ("0704007", "Playa de Palma", "07", "Illes Balears", "07040", "Palma de Mallorca"),
    ("0801903", "Del Bogatell", "08", "Barcelona", "08019", "Barcelona"),
    ("0801905", "La Barceloneta", "08", "Barcelona", "08019", "Barcelona"),
    ("4625001", "Playa de Levante / Malvarrosa", "46", "València/Valencia", "46250", "Valencia"),
    ("4625004", "La Devesa", "46", "València/Valencia", "46250", "Valencia"),
]
BEACH_SCHEMA = (
    "playa_codigo_aemet string, nombre_playa string, id_provincia string, nombre_provincia string, "
    "id_municipio string, nombre_municipio string"
)
MUNICIPAL_LANDING, MUNICIPAL_TRUSTED = "aemet_prediccion_diaria", "prediccion_clima_diario"
BEACH_LANDING, BEACH_TRUSTED = "aemet_prediccion_playa", "prediccion_playa"


def municipalities(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, MUNICIPALITIES, MUNICIPALITY_SCHEMA)


def beaches(spark: SparkSession) -> DataFrame:
    return literal_dim(spark, BEACHES, BEACH_SCHEMA)


def landing_documents(
    documents: DataFrame, places: DataFrame, key: str, text: str, loaded_at: Column | None = None, version: float = 1.0
) -> DataFrame:
    """Downloaded documents with their place, load time and a repeatable row id; the text is kept as it is.

    Documents of places that are not listed are dropped. Pass a fixed ``loaded_at`` where runs must repeat.
    """
    rows = documents.select(key, F.col(text).alias("raw_aemet_data_json_str")).join(places, key)
    return rows.withColumns({"fecha_descarga_utc": load_stamp(loaded_at), "version": F.lit(version)}).withColumn(
        "id", row_id(key, "fecha_descarga_utc", "raw_aemet_data_json_str")
    )


def load_municipal(documents: DataFrame, db: str = "landing", **options) -> DataFrame:
    """Append municipal documents (``municipio_codigo_aemet``, ``documento``) to the landing table."""
    places = municipalities(documents.sparkSession)
    return append_table(landing_documents(documents, places, "municipio_codigo_aemet", "documento", **options), db, MUNICIPAL_LANDING)


def load_beaches(documents: DataFrame, db: str = "landing", **options) -> DataFrame:
    """Append beach documents (``playa_codigo_aemet``, ``documento``) to the landing table."""
    places = beaches(documents.sparkSession).select("playa_codigo_aemet", "nombre_municipio", "nombre_provincia")
    return append_table(landing_documents(documents, places, "playa_codigo_aemet", "documento", **options), db, BEACH_LANDING)


def run_municipal(spark: SparkSession, src_db: str = "landing", tgt_db: str = "trusted") -> DataFrame:
    return overwrite_table(flatten_municipal_forecast(spark.table(f"{src_db}.{MUNICIPAL_LANDING}")), tgt_db, MUNICIPAL_TRUSTED)


def run_beaches(spark: SparkSession, src_db: str = "landing", tgt_db: str = "trusted") -> DataFrame:
    return overwrite_table(flatten_beach_forecast(spark.table(f"{src_db}.{BEACH_LANDING}")), tgt_db, BEACH_TRUSTED)
