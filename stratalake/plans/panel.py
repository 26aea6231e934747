"""The monthly feature panel per province."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.aggregate import (
    bucket_share_block,
    climate_block,
    leisure_block,
    mixed_block,
    occupancy_block,
)
from stratalake.operators.joins import lag_features, panel_join
from stratalake.plans.datasets import MONTH, PROVINCE, YEAR
from stratalake.sources.writers import overwrite_table

# ---- fixed values ---------------------------------------------------------

KEYS = [PROVINCE, YEAR, MONTH]
LEISURE_DETAIL = ["PRODUCTO", "CATEGORIA"]
AIR_BUCKETS = {
    "aire_pct_buena": ["Buena", "Razonablemente buena"],
    "aire_pct_aceptable": ["Regular"],
    "aire_pct_mala": ["Desfavorable", "Muy desfavorable", "Extremadamente desfavorable"],
}
AIR_WEIGHTS = {"aire_pct_buena": 2, "aire_pct_aceptable": 1, "aire_pct_mala": 0}
LAGGED = [
    "aire_pct_buena",
    "apt_availability_score",
    "temp_min_media_mes",
    "temp_max_media_mes",
    "dias_lluvia_mes",
]
FEATURES = [
    "apt_viajeros", "apt_pernoctaciones", "apt_estancia_media", "apt_estimados", "plazas_estimadas",
    "apt_personal_empleado", "apt_availability_score_lag1",
    "ocio_total_entradas", "ocio_gasto_total", "ocio_precio_medio_entrada",
    "aire_pct_buena_lag1", "aire_pct_aceptable", "aire_pct_mala",
    "temp_media_mes", "temp_min_media_mes_lag1", "temp_max_media_mes_lag1", "precipitacion_total_mes",
    "dias_lluvia_mes_lag1", "dias_calidos", "dias_helada",
    "indice_percepcion_turistica_global", "indice_percepcion_seguridad",
    "indice_satisfaccion_productos_turisticos", "indice_percepcion_climatica",
]


# output column -> input column
APARTMENT_SUMS = {
    "apt_viajeros": "VIAJEROS",
    "apt_pernoctaciones": "PERNOCTACIONES",
    "apt_estimados": "APARTAMENTOS_ESTIMADOS",
    "plazas_estimadas": "PLAZAS_ESTIMADAS",
    "apt_personal_empleado": "PERSONAL_EMPLEADO",
}
APARTMENT_AVERAGES = {
    "apt_estancia_media": "ESTANCIA_MEDIA",
    "avg_ocupa_plazas": "GRADO_OCUPA_PLAZAS",
    "avg_ocupa_apart": "GRADO_OCUPA_APART",
    "avg_ocupa_apart_weekend": "GRADO_OCUPA_APART_FIN_SEMANA",
}
LEISURE_SUMS = {
    "ocio_total_entradas": "ENTRADAS",
    "ocio_total_visitas_paginas": "VISITAS_PAGINAS",
    "ocio_gasto_total": "GASTO_TOTAL",
    "ocio_total_transacciones": "TRANSACCIONES",
}
LEISURE_AVERAGES = {"ocio_precio_medio_entrada": "PRECIO_MEDIO_ENTRADA"}
LEISURE_RATIOS = {
    "ocio_engagement_score": ("ocio_total_visitas_paginas", "ocio_total_transacciones"),
    "ocio_gasto_medio_por_entrada": ("ocio_gasto_total", "ocio_total_entradas"),
}
PERCEPTION_AVERAGES = {
    "indice_percepcion_turistica_global": "INIDICE_PERCEPCION_TURISTICA_GLOBAL",
    "indice_satisfaccion_productos_turisticos": "INDICE_SATISFACCION_PRODUCTOS_TURISTICOS",
    "indice_percepcion_seguridad": "INDICE_PERCEPCION_SEGURIDAD",
}
PERCEPTION_SUMS = {"indice_percepcion_climatica": "INDICE_PERCEPCION_CLIMATICA"}
# panel input -> trusted table
INPUT_TABLES = {
    "perception": "percepcion_turista_selected",
    "leisure": "actividades_Ocio_selected",
    "air": "calidad_aire_selected",
    "apartments": "apartamentos_ocupacion_selected",
    "climate": "aemet_clima_diario_trusted",
}
PANEL_TABLE = "tourism_features"


# ---- blocks ---------------------------------------------------------------

def apartment_features(df: DataFrame) -> DataFrame:
    return occupancy_block(
        df, KEYS, APARTMENT_SUMS, APARTMENT_AVERAGES, occupancy="avg_ocupa_plazas", score="apt_availability_score"
    )


def leisure_features(df: DataFrame, detail: bool = False) -> DataFrame:
    """Leisure block at the panel grain, or with ``detail`` per product and category as well."""
    return leisure_block(df, KEYS + (LEISURE_DETAIL if detail else []), LEISURE_SUMS, LEISURE_AVERAGES, LEISURE_RATIOS)


def air_quality_features(df: DataFrame) -> DataFrame:
    return bucket_share_block(
        df,
        KEYS,
        label="CALIDAD_AIRE",
        value="PORCENTAJE_CALIDAD_AIRE",
        buckets=AIR_BUCKETS,
        weights=AIR_WEIGHTS,
        entity="ESTACION",
        n_entities="aire_num_estaciones",
        index="aire_quality_index",
    )


def perception_features(df: DataFrame) -> DataFrame:
    """Three averaged indices; the climate index is summed. The first input name is spelled as published."""
    return mixed_block(df, KEYS, PERCEPTION_AVERAGES, PERCEPTION_SUMS)


def climate_features(df: DataFrame) -> DataFrame:
    return climate_block(
        df.withColumnRenamed("provincia", PROVINCE),
        KEYS,
        mean="temperaturaMedia",
        rain="precipitacion",
        low="temperaturaMinima",
        high="temperaturaMaxima",
        low_time="horaTemperaturaMinima",
        high_time="horaTemperaturaMaxima",
    )


def build_feature_panel(
    perception: DataFrame,
    leisure: DataFrame,
    air: DataFrame,
    apartments: DataFrame,
    climate: DataFrame,
    keep_fanout: bool = False,
    lag_by_month_number: bool = False,
) -> DataFrame:
    """Wide monthly panel: five blocks, four left joins, five lags.

    By default there is one row per province and month, and a lag is the
    previous period. ``keep_fanout`` repeats rows per leisure product and
    category. ``lag_by_month_number`` orders by month number downwards whatever
    the year, with fixed tie-breakers.
    """
    keyed = panel_join(
        perception_features(perception),
        [air_quality_features(air), apartment_features(apartments), climate_features(climate)],
        KEYS,
    )
    fun = leisure_features(leisure, detail=keep_fanout)
    if lag_by_month_number:
        ties = [YEAR, *(LEISURE_DETAIL if keep_fanout else [])]
        panel = lag_features(panel_join(keyed, [fun], KEYS), [PROVINCE], [MONTH], LAGGED, descending=True, ties=ties)
    else:
        panel = panel_join(lag_features(keyed, [PROVINCE], [YEAR, MONTH], LAGGED), [fun], KEYS)
    return panel.select(*FEATURES, *LAGGED, *KEYS)


def run_feature_panel(
    spark: SparkSession, src_db: str = "trusted", tgt_db: str = "exploitation", export_path: str | None = None, **options
) -> DataFrame:
    """Build the panel from the trusted tables and store it, as files at ``export_path`` too if given."""
    inputs = {name: spark.table(f"{src_db}.{table}") for name, table in INPUT_TABLES.items()}
    stored = overwrite_table(build_feature_panel(**inputs, **options), tgt_db, PANEL_TABLE)
    if export_path:
        stored.write.mode("overwrite").parquet(export_path)
    return stored
