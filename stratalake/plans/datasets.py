"""Monthly datasets as configuration: how each is cleaned, normalised, kept and reported."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.clean import complete_row, fill_numeric, filter_pairs, normalize_columns
from stratalake.operators.quality import quality_report, quality_report_marked
from stratalake.operators.reshape import copy_period, expand_quarter_to_month, union_all
from stratalake.sources.readers import read_delimited, union_tagged
from stratalake.sources.writers import overwrite_table
from stratalake.sources.xlsx import read_xlsx

# ---- fixed values ---------------------------------------------------------

YEAR, MONTH, PROVINCE = "AÑO", "MES", "PROVINCIA"
PROVINCES = ["Madrid", "Barcelona", "Sevilla", "Illes Balears", "Valencia"]
PORT_PROVINCES = ["Barcelona", "Sevilla", "Illes Balears", "Valencia"]
MUNICIPALITIES = ["Madrid", "Barcelona", "Sevilla", "Palma de Mallorca", "Valencia"]
PROVINCE_MUNICIPALITY = [
    ("Barcelona", "Barcelona"),
    ("Valencia", "Valencia"),
    ("Sevilla", "Sevilla"),
    ("Illes Balears", "Palma de Mallorca"),
]
VALENCIA_PROVINCE = {"Valencia/València": "Valencia"}
VALENCIA_TOWN = {"València": "Valencia"}
PALMA_TOWN = {"Palma": "Palma de Mallorca"}
BALEARES_PROVINCE = {"Islas Baleares": "Illes Balears"}
PORTS = {"BARCELONA": "Barcelona", "VALENCIA": "Valencia", "SEVILLA": "Sevilla", "BALEARES": "Illes Balears"}
AIRPORT_CITIES = {
    "JT Barcelona-El Prat": "Barcelona",
    "Girona-Costa Brava": "Barcelona",
    "AS Madrid-Barajas": "Madrid",
    "Sevilla": "Sevilla",
    "Jerez de la Frontera": "Sevilla",
    "P. Mallorca": "Palma de Mallorca",
    "Valencia": "Valencia",
}


@dataclass(frozen=True)
class MonthlyDataset:
    """One dataset. ``sources`` maps each landing table to its own value recodings."""

    name: str
    sources: Mapping[str, Mapping[str, Mapping]]
    file_format: str = "csv"
    drop_incomplete: bool = True
    fill_zero: bool = False
    not_equal: Mapping[str, object] = field(default_factory=dict)
    report_keys: Sequence[str] = (PROVINCE,)
    report_values: Sequence | None = tuple(PROVINCES)
    keep: Sequence | None = tuple(PROVINCES)
    expand: Callable[[DataFrame], DataFrame] | None = None
    sort_by: Sequence[str] = ()
    target: str = ""

    @property
    def target_table(self) -> str:
        return self.target or f"{self.name}_selected"


def _spread_crime_rates(df: DataFrame) -> DataFrame:
    return expand_quarter_to_month(df, MONTH, ["TASA_DELITOS", "TASA_DELITOS_ESPAÑA"], sentinel=-99)


def _repeat_march_2020(df: DataFrame) -> DataFrame:
    return copy_period(df, YEAR, MONTH, (2020, 3), [4, 5])


def _by_province(name: str, recoding: Mapping = VALENCIA_PROVINCE, **options) -> MonthlyDataset:
    return MonthlyDataset(name, {name: {PROVINCE: recoding}}, **options)


def _by_destination(name: str) -> MonthlyDataset:
    both = {"PROVINCIA_ORIGEN": VALENCIA_PROVINCE, "PROVINCIA_DESTINO": VALENCIA_PROVINCE}
    return MonthlyDataset(name, {name: both}, report_keys=("PROVINCIA_DESTINO",))


MONTHLY_DATASETS = {
    d.name: d
    for d in [
        _by_destination("turismo_Provincia"),
        _by_province("actividades_Ocio", file_format="xlsx"),
        MonthlyDataset(
            "aena_destinos",
            {"aena_destinos": {}},
            file_format="xlsx",
            report_keys=("CIUDAD",),
            report_values=None,
            keep=None,
        ),
        _by_province("satisfacion_hotelera"),
        MonthlyDataset(
            "puertos_turismo",
            {"puertos_turismo": {"AUT_PORTUARIA": PORTS}},
            file_format="xlsx",
            report_keys=("AUT_PORTUARIA",),
            report_values=tuple(PORT_PROVINCES),
            keep=None,
        ),
        _by_province("trafico_semana", not_equal={"IMD_VEHICULO_TOTAL": 0}),
        _by_destination("gastos_Turismo"),
        _by_province("calidad_aire", file_format="xlsx"),
        MonthlyDataset(
            "apartamentosTuristicos_ocupacion",
            {
                "apartamentosTuristicos_ocupacion": {
                    PROVINCE: VALENCIA_PROVINCE,
                    "MUNICIPIO": VALENCIA_TOWN | PALMA_TOWN,
                }
            },
            report_keys=(PROVINCE, "MUNICIPIO"),
            report_values=tuple(PROVINCE_MUNICIPALITY),
            keep=tuple(PROVINCE_MUNICIPALITY),
        ),
        _by_province("seguridad_provincia", file_format="xlsx", expand=_spread_crime_rates, sort_by=(YEAR, MONTH)),
        _by_province("percepcion_turista"),
        MonthlyDataset(
            "turismo_Emisor",
            {
                "turismo_Emisor": {"MUNICIPIO_ORIGEN": VALENCIA_TOWN},
                "turismo_Emisor_Balears": {"MUNICIPIO_ORIGEN": PALMA_TOWN},
            },
            report_keys=("MUNICIPIO_ORIGEN",),
            report_values=tuple(MUNICIPALITIES),
            keep=tuple(MUNICIPALITIES),
        ),
        _by_province("hotel_precio"),
        _by_province(
            "apartamentos_ocupacion",
            BALEARES_PROVINCE,
            file_format="xlsx",
            drop_incomplete=False,
            fill_zero=True,
            expand=_repeat_march_2020,
        ),
        _by_province(
            "hotel_ocupacion",
            BALEARES_PROVINCE,
            file_format="xlsx",
            drop_incomplete=False,
            fill_zero=True,
            not_equal={"LUGAR_RESIDENCIA": "Total"},
        ),
        _by_province(
            "campings_ocupacion",
            BALEARES_PROVINCE,
            file_format="xlsx",
            drop_incomplete=False,
            not_equal={"VIAJEROS": 0},
        ),
    ]
}


# ---- cleaning -------------------------------------------------------------

def kept_rows(df: DataFrame, spec: MonthlyDataset) -> Column:
    """Which raw rows survive cleaning. ``!=`` also drops NULL, and is tested before zero-filling."""
    test = complete_row(df) if spec.drop_incomplete else F.lit(True)
    for column, value in spec.not_equal.items():
        test = test & (F.col(column) != F.lit(value))
    return test


def _with_keys(values: Sequence) -> list[tuple]:
    return [v if isinstance(v, tuple) else (v,) for v in values]


def normalized_sources(raw: Mapping[str, DataFrame], spec: MonthlyDataset) -> DataFrame:
    """All landing tables of a dataset, recoded each by its own rules and united."""
    return union_all([normalize_columns(raw[table], recoding) for table, recoding in spec.sources.items()])


def clean_monthly(raw: Mapping[str, DataFrame], spec: MonthlyDataset) -> DataFrame:
    """Cleaned rows of every place: drop, fill, normalise, expand periods."""
    united = normalized_sources(raw, spec)
    cleaned = united.filter(kept_rows(united, spec))
    if spec.fill_zero:
        cleaned = fill_numeric(cleaned, 0)
    return spec.expand(cleaned) if spec.expand else cleaned


def keep_selected(cleaned: DataFrame, spec: MonthlyDataset) -> DataFrame:
    """Only the places the dataset is published for."""
    return cleaned if spec.keep is None else filter_pairs(cleaned, spec.report_keys, _with_keys(spec.keep))


def report_monthly(raw: Mapping[str, DataFrame], spec: MonthlyDataset) -> DataFrame:
    """Quality report per place. Period expansion adds rows, so ``rows_dropped`` may be negative there."""
    united = normalized_sources(raw, spec)
    if spec.expand is None:
        return quality_report_marked(united, kept_rows(united, spec), spec.report_keys, YEAR, MONTH, spec.report_values)
    return quality_report(united, clean_monthly(raw, spec), spec.report_keys, YEAR, MONTH, spec.report_values)


def run_monthly(
    spark: SparkSession,
    spec: MonthlyDataset,
    src_db: str = "landing",
    tgt_db: str = "trusted",
) -> tuple[DataFrame, DataFrame]:
    """Clean a dataset from landing to trusted tables; returns (stored rows, report)."""
    raw = {table: spark.table(f"{src_db}.{table}") for table in spec.sources}
    rows = keep_selected(clean_monthly(raw, spec), spec)
    if spec.sort_by:
        # sorted files let readers skip by min/max; a global order would cost a range shuffle
        rows = rows.sortWithinPartitions(*spec.sort_by)
    stored = overwrite_table(rows, tgt_db, spec.target_table)
    return stored, report_monthly(raw, spec)


def read_landing(spark: SparkSession, spec: MonthlyDataset, paths, schema, decimal_comma_columns=()) -> DataFrame:
    """Files of a dataset in the format it is published in."""
    if spec.file_format == "xlsx":
        return union_all([read_xlsx(spark, path, schema) for path in ([paths] if isinstance(paths, str) else paths)])
    return read_delimited(spark, paths, schema, decimal_comma_columns)


def load_landing(frames: Sequence[tuple[str, DataFrame]], tag: str, db: str, table: str) -> DataFrame:
    """Union several tagged loads into one landing table; raises when all of them are empty."""
    return overwrite_table(union_tagged(frames, tag, skip_empty=True), db, table)
