"""Daily climate readings from landing to trusted form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.clock import parse_date
from stratalake.operators.clean import decimal_comma_cast, impute_numeric, impute_string, project_renamed
from stratalake.operators.joins import attach_dimension
from stratalake.sources.literal import literal_dim
from stratalake.sources.readers import read_envelope
from stratalake.sources.writers import append_table, overwrite_table

# ---- fixed values ---------------------------------------------------------

STATIONS = [
    ("8036Y", "Benidorm", "Benidorm", "Alacant/Alicante", 70, "383306N", "000800W"),
    ("0201D", "Barcelona", "Barcelona", "Barcelona", 6, "412326N", "021200E"),
    ("0201X", "Barcelona, Museo Marítimo", "Barcelona", "Barcelona", 5, "412230N", "021026E"),
    ("B228", "Palma de Mallorca, Puerto", "Palma de Mallorca", "Illes Balears", 3, "393312N", "023731E"),
    ("B236C", "Palma de Mallorca, Universidad", "Palma de Mallorca", "Illes Balears", 95, "393832N", "023837E"),
    ("B278", "Palma de Mallorca, Aeropuerto", "Palma de Mallorca", "Illes Balears", 8, "393339N", "024412E"),
    ("3126Y", "Madrid, El Goloso", "Madrid", "Madrid", 740, "403341N", "034243W"),
    ("3129", "Madrid Aeropuerto", "Madrid", "Madrid", 609, "402800N", "033320W"),
    ("3194U", "Madrid, Ciudad Universitaria", "Madrid", "Madrid", 664, "402706N", "034327W"),
    ("3195", "Madrid, Retiro", "Madrid", "Madrid", 667, "402443N", "034041W"),
    ("5783", "Sevilla Aeropuerto", "Sevilla", "Sevilla", 34, "372500N", "055245W"),
    ("5790Y", "Sevilla, Tablada", "Sevilla", "Sevilla", 9, "372151N", "060021W"),
    ("8416Y", "Valencia", "Valencia", "Comunitat Valenciana", 11, "392850N", "002159W"),
    ("8416X", "Valencia, UPV", "València", "Comunitat Valenciana", 6, "392847N", "002013W"),
]
SHORT_STATIONS = ["8036Y", "0201D", "0201X", "B278", "3129", "5790Y", "8416Y"]
STATION_SCHEMA = "id string, nombre string, municipio string, provincia string, altura int, latitud string, longitud string"

RAW_FIELDS = [
    "fecha", "indicativo", "nombre", "provincia", "altitud", "tmed", "prec", "tmin", "horatmin", "tmax", "horatmax",
    "dir", "velmedia", "racha", "horaracha", "sol", "presMax", "horaPresMax", "presMin", "horaPresMin",
    "hrMedia", "hrMax", "horaHrMax", "hrMin", "horaHrMin",
]
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

# landing name -> trusted name
TRUSTED_NAMES = {
    "fecha_dt": "fecha",
    "indicativo": "idema",
    "nombre": "nombreEstacion",
    "municipio": "municipio",
    "provincia": "provincia",
    "altitud": "altitud",
    "tmed": "temperaturaMedia",
    "prec": "precipitacion",
    "tmin": "temperaturaMinima",
    "horatmin": "horaTemperaturaMinima",
    "tmax": "temperaturaMaxima",
    "horatmax": "horaTemperaturaMaxima",
    "dir": "direccionViento",
    "velmedia": "velocidadMediaViento",
    "racha": "racha",
    "horaracha": "horaRacha",
    "sol": "radiacionSolar",
    "presMax": "presionMaxima",
    "horaPresMax": "horaPresionMaxima",
    "presMin": "presionMinima",
    "horaPresMin": "horaPresionMinima",
    "hrMedia": "humedadRelativaMedia",
    "hrMax": "humedadRelativaMaxima",
    "horaHrMax": "horaHumedadRelativaMaxima",
    "hrMin": "humedadRelativaMinima",
    "horaHrMin": "horaHumedadRelativaMinima",
    "year": "AÑO",
    "month": "MES",
}
MEASURES = [
    "temperaturaMedia", "precipitacion", "temperaturaMinima", "temperaturaMaxima", "direccionViento",
    "velocidadMediaViento", "racha", "radiacionSolar", "presionMaxima", "presionMinima",
    "humedadRelativaMedia", "humedadRelativaMaxima", "humedadRelativaMinima",
]
TEXTS = [
    "fecha", "idema", "nombreEstacion", "municipio", "provincia", "horaTemperaturaMinima",
    "horaTemperaturaMaxima", "horaRacha", "horaPresionMaxima", "horaPresionMinima",
    "horaHumedadRelativaMaxima", "horaHumedadRelativaMinima",
]


def stations(spark, ids: Sequence[str] | None = None) -> DataFrame:
    """The station dimension, or the part of it with the given ids."""
    rows = [s for s in STATIONS if ids is None or s[0] in ids]
    return literal_dim(spark, rows, STATION_SCHEMA)


def build_daily_readings(
    raw: DataFrame,
    dimension: DataFrame,
    raw_key: str,
    dimension_key: str,
    dimension_columns: Mapping[str, str] | Sequence[str],
    names: Mapping[str, str],
    measures: Sequence[str],
    texts: Sequence[str],
    text_value: str = "Desconocido",
    measure_value: float | None = None,
) -> DataFrame:
    """Readings of the listed entities, renamed, with numeric text parsed and missing text filled.

    Unknown numbers stay NULL unless ``measure_value`` is given; a sentinel would
    spoil later averages.
    """
    chosen = attach_dimension(raw, dimension, raw_key, dimension_key, dimension_columns, how="inner")
    numeric = decimal_comma_cast(project_renamed(chosen, names), measures)
    if measure_value is not None:
        numeric = impute_numeric(numeric, measure_value, list(measures))
    return impute_string(numeric, text_value, texts)


def build_daily_climate(raw: DataFrame, station_dim: DataFrame | None = None, **options) -> DataFrame:
    """Trusted daily climate from landing rows that carry ``fecha_dt``, ``year`` and ``month``."""
    station_dim = stations(raw.sparkSession) if station_dim is None else station_dim
    return build_daily_readings(
        raw.drop("provincia"),
        station_dim,
        "indicativo",
        "id",
        ["municipio", "provincia"],
        TRUSTED_NAMES,
        MEASURES,
        TEXTS,
        **options,
    )


# ---- landing and trusted tables -------------------------------------------

LANDING_TABLE, TRUSTED_TABLE = "aemet_clima_diario", "aemet_clima_diario_trusted"


def landing_rows(raw: DataFrame) -> DataFrame:
    """Well-formed raw rows with their date parts."""
    day = parse_date(F.col("fecha"))
    return raw.filter(F.col("indicativo").isNotNull()).withColumns(
        {"fecha_dt": day, "year": F.year(day), "month": F.month(day)}
    )


def load_daily_climate(spark: SparkSession, paths, db: str = "landing", table: str = LANDING_TABLE) -> DataFrame:
    """Append downloaded envelope files to the landing table, partitioned by year and month."""
    rows = landing_rows(read_envelope(spark, paths, RAW_SCHEMA))
    return append_table(rows, db, table, partition_by=("year", "month"))


def run_daily_climate(spark: SparkSession, src_db: str = "landing", tgt_db: str = "trusted", **options) -> DataFrame:
    """Build the trusted daily climate from the landing table and store it."""
    built = build_daily_climate(spark.table(f"{src_db}.{LANDING_TABLE}"), **options)
    return overwrite_table(built, tgt_db, TRUSTED_TABLE)
