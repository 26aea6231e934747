"""Flattening of nested forecast documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.nested import first_matching, parse_json, parse_json_renamed
from stratalake.operators.clean import impute_numeric, impute_string


def explode_documents(
    df: DataFrame, text: str, schema: str, items_path: str, out: str = "day", unique_schema: str | None = None
) -> DataFrame:
    """Parse a JSON array column and give one row per element of an array inside its first entry.

    The first entry is kept as ``doc``. A row whose document is malformed, empty
    or without elements stays once, with NULL in ``out``.
    """
    parsed = (
        parse_json(F.col(text), schema)
        if unique_schema is None
        else parse_json_renamed(F.col(text), schema, unique_schema)
    )
    return df.withColumn("doc", F.get(parsed, F.lit(0))).withColumn(out, F.explode_outer(f"doc.{items_path}"))


# ---- municipal forecast ---------------------------------------------------

# The part of the document layout that is read, and the whole-day
# period code. The parser skips fields a schema does not name.
WHOLE_DAY = "00-24"
_RANGE = "struct<maxima:int,minima:int>"
MUNICIPAL_SCHEMA = f"""array<struct<prediccion:struct<dia:array<struct<
probPrecipitacion:array<struct<value:int,periodo:string>>,
cotaNieveProv:array<struct<value:int,periodo:string>>,
estadoCielo:array<struct<value:string,periodo:string,descripcion:string>>,
viento:array<struct<direccion:string,velocidad:int,periodo:string>>,
rachaMax:array<struct<value:int,periodo:string>>,
temperatura:{_RANGE},sensTermica:{_RANGE},humedadRelativa:{_RANGE},
uvMax:int,fecha:string>>>>>"""
# output column -> (array, field) picked for the whole-day period
PERIOD_PICKS = {
    "probPrecipitacion_00_24": ("probPrecipitacion", "value"),
    "cotaNieveProv_00_24": ("cotaNieveProv", "value"),
    "estadoCieloDescripcion_00_24": ("estadoCielo", "descripcion"),
    "estadoCieloCode_00_24": ("estadoCielo", "value"),
    "vientoDireccion_00_24": ("viento", "direccion"),
    "vientoVelocidad_00_24": ("viento", "velocidad"),
    "rachaMaxima_00_24": ("rachaMax", "value"),
}
RANGE_PICKS = {"temperatura": "temperatura", "sensTermica": "sensTermica", "humedadRelativa": "humedadRelativa"}


def period_columns(day: str, picks: Mapping[str, tuple[str, str]], period: str = WHOLE_DAY) -> list[Column]:
    """One column per pick: the named field of the first array entry of that period."""
    return [
        first_matching(F.col(f"{day}.{array}"), "periodo", period, field).alias(out)
        for out, (array, field) in picks.items()
    ]


def _municipal_rows(days: DataFrame, *more: Column) -> DataFrame:
    bounds = [
        F.col(f"day.{source}.{end}").alias(f"{out}{end.capitalize()}")
        for out, source in RANGE_PICKS.items()
        for end in ("maxima", "minima")
    ]
    return days.select(
        F.col("municipio_codigo_aemet").alias("municipioCodigo"),
        F.col("nombre_municipio_ine").alias("nombreMunicipio"),
        F.col("fecha_descarga_utc").alias("fechaDescargaUTC"),
        F.col("day.fecha").alias("fechaPrediccion"),
        *period_columns("day", PERIOD_PICKS),
        *bounds,
        F.col("day.uvMax").alias("uv_max"),
        *more,
    )


def flatten_municipal_forecast(
    df: DataFrame, impute: bool = True, number: int = -9999, text: str = "Desconocido"
) -> DataFrame:
    """One row per municipality, download and forecast day, with whole-day values.

    Missing numbers and texts take the given constants unless ``impute`` is off.
    """
    flat = _municipal_rows(explode_documents(df, "raw_aemet_data_json_str", MUNICIPAL_SCHEMA, "prediccion.dia"))
    return impute_string(impute_numeric(flat, number), text) if impute else flat


def explode_variant(df: DataFrame, text: str, items_path: str, out: str = "day", doc: str = "doc") -> DataFrame:
    """Parse a JSON column to VARIANT (``doc``) and give one row per element of the array at ``items_path``, as a VARIANT ``out``.

    The document is parsed once, whatever is taken from it afterwards, and its layout may differ from row to row; names are matched case by case. A row
    whose document is malformed, missing or without elements stays once, with NULL in ``out``.
    """
    parsed = df.withColumn(doc, F.try_parse_json(text))
    parsed = parsed.withColumn("_items", F.try_variant_get(doc, items_path, "variant"))
    each = df.sparkSession.tvf.variant_explode_outer(F.col("_items").outer())
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (out, doc)]
    return parsed.lateralJoin(each).select(*kept, doc, F.col("value").alias(out))


def variant_fields(value: str, fields: T.StructType) -> Column:
    """The named fields of a VARIANT as a struct of their types; one that is missing or of another kind is NULL."""
    typed = [F.try_variant_get(value, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]
    return F.when(F.col(value).isNotNull(), F.struct(*typed))


def unknown_fields(value: str, names: Sequence[str]) -> Column:
    """The fields of a VARIANT object besides those named, as JSON; NULL without such."""
    every = F.try_variant_get(value, "$", "map<string,variant>")
    rest = F.map_filter(every, lambda name, _: ~name.isin(list(names)))
    return F.when(F.size(F.map_keys(rest)) > 0, F.to_json(rest))


def observed_layout(df: DataFrame, text: str) -> DataFrame:
    """One row with the layout that all documents of a JSON column fit together, as a schema in SQL."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(text)).alias("layout"))


def flatten_municipal_variant(df: DataFrame, impute: bool = True, number: int = -9999, text: str = "Desconocido") -> DataFrame:
    """What :func:`flatten_municipal_forecast` gives, by way of VARIANT, and ``unknown``: the day's further fields as JSON, NULL without such."""
    fields = T._parse_datatype_string(MUNICIPAL_SCHEMA).elementType["prediccion"].dataType["dia"].dataType.elementType
    days = explode_variant(df, "raw_aemet_data_json_str", "$[0].prediccion.dia")
    days = days.withColumns({"day": variant_fields("day", fields), "unknown": unknown_fields("day", fields.names)})
    flat = _municipal_rows(days, F.col("unknown"))
    if not impute:
        return flat
    texts = [c for c, kind in flat.dtypes if kind == "string" and c != "unknown"]
    return impute_string(impute_numeric(flat, number), text, texts)


# ---- beach forecast -------------------------------------------------------

# The part of the document layout that is read, whose keys partly
# differ in case only, and the same layout under names that stay apart without a
# case-sensitive session.
_SKY = "struct<f1:int,descripcion1:string,f2:int,descripcion2:string>"
_VALUE = "struct<valor1:int>"
_FEEL = "struct<valor1:int,descripcion1:string>"
_BEACH_LAYOUT = "array<struct<nombre:string,localidad:int,prediccion:struct<dia:array<struct<{days}>>>>>"
_BEACH_DAY = [
    ("estadoCielo", "estadoCielo", _SKY),
    ("viento", "viento", _SKY),
    ("oleaje", "oleaje", _SKY),
    ("tMaxima", "tMaxima", _VALUE),
    ("sTermica", "sTermica", _FEEL),
    ("tAgua", "tAgua", _VALUE),
    ("uvMax", "uvMax", _VALUE),
    ("fecha", "fecha", "int"),
    ("tagua", "tempAgua", _VALUE),
    ("tmaxima", "tempMaxima", _VALUE),
    ("stermica", "sensacTermica", _FEEL),
]
BEACH_SCHEMA = _BEACH_LAYOUT.format(days=",".join(f"{key}:{kind}" for key, _, kind in _BEACH_DAY))
BEACH_UNIQUE_SCHEMA = _BEACH_LAYOUT.format(days=",".join(f"{name}:{kind}" for _, name, kind in _BEACH_DAY))


def _beach_rows(days: DataFrame, name: Column, town: Column, *more: Column) -> DataFrame:
    half_days = [
        F.col(f"day.{item}.{field}").alias(f"{item}_{short}")
        for item in ("estadoCielo", "viento", "oleaje")
        for field, short in (("f1", "f1"), ("descripcion1", "desc1"), ("f2", "f2"), ("descripcion2", "desc2"))
    ]
    return days.select(
        F.col("playa_codigo_aemet").alias("id_playa"),
        name.alias("nombre_playa"),
        "nombre_municipio",
        "nombre_provincia",
        town.alias("codigo_municipio"),
        F.col("day.fecha").alias("fecha"),
        *half_days,
        F.col("day.tMaxima.valor1").alias("tMaxima"),
        F.col("day.sTermica.valor1").alias("sTermica_valor1"),
        F.col("day.sTermica.descripcion1").alias("sTermica_desc1"),
        F.col("day.tAgua.valor1").alias("tAgua_valor1"),
        F.col("day.uvMax.valor1").alias("uvMax"),
        F.col("day.tempAgua.valor1").alias("tempAgua"),
        F.col("day.tempMaxima.valor1").alias("tempMaxima"),
        F.col("day.sensacTermica.valor1").alias("sensacTermica_valor1"),
        F.col("day.sensacTermica.descripcion1").alias("sensacTermica_desc1"),
        *more,
    )


def flatten_beach_forecast(df: DataFrame) -> DataFrame:
    """One row per beach, download and forecast day, both spellings of the doubled keys included."""
    days = explode_documents(
        df, "raw_aemet_data_json_str", BEACH_SCHEMA, "prediccion.dia", unique_schema=BEACH_UNIQUE_SCHEMA
    )
    return _beach_rows(days, F.col("doc.nombre"), F.col("doc.localidad"))


def flatten_beach_variant(df: DataFrame) -> DataFrame:
    """What :func:`flatten_beach_forecast` gives, by way of VARIANT, whose paths tell the doubled keys apart, and ``unknown``: the day's further fields as JSON."""
    days = explode_variant(df, "raw_aemet_data_json_str", "$[0].prediccion.dia")
    typed = [F.try_variant_get("day", f"$.{key}", kind).alias(name) for key, name, kind in _BEACH_DAY]
    unknown = unknown_fields("day", [key for key, _, _ in _BEACH_DAY])
    days = days.withColumns({"day": F.when(F.col("day").isNotNull(), F.struct(*typed)), "unknown": unknown})
    return _beach_rows(days, F.try_variant_get("doc", "$[0].nombre", "string"), F.try_variant_get("doc", "$[0].localidad", "int"), F.col("unknown"))
