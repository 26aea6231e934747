"""The published monthly datasets and the daily climate, each rule over a whole table in its published configuration."""

from pyspark.sql import functions as F

from stratalake.plans import climate
from stratalake.plans.datasets import (
    MONTHLY_DATASETS,
    PORT_PROVINCES,
    PROVINCE_MUNICIPALITY,
    PROVINCES,
    clean_monthly,
    keep_selected,
    report_monthly,
)
from suite.cleaning import _REPORT_TAIL
from suite.registry import Tables, query

# Place names as they are published, with those that a rule recodes or leaves out.
PLACES = ["Madrid", "Barcelona", "Valencia/València", "Sevilla", "Illes Balears", "Murcia", "Islas Baleares", "Valencia"]
TOWNS = ["Barcelona", "València", "Sevilla", "Palma", "Palma de Mallorca", "Madrid", "Gijón"]
PORT_NAMES = ["BARCELONA", "VALENCIA", "SEVILLA", "BALEARES", "VIGO"]


def _pick(values, key):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def _pick_sql(values, key: str, recoding: dict | None = None) -> str:
    recoded = [(recoding or {}).get(v, v) for v in values]
    return "[" + ", ".join(f"'{v}'" for v in recoded) + f"][({key} % {len(values)} + 1)::INT]"


def _landing(t: Tables, years: int = 0, **columns):
    """Orders as a landing table: their key, period and the given columns."""
    day = F.col("o_orderdate")
    period = {"AÑO": (F.year(day) + years).cast("int"), "MES": F.month(day)}
    return t.orders.select(F.col("o_orderkey").alias("PEDIDO"), *[c.alias(n) for n, c in (period | columns).items()])


def _landing_sql(years: int = 0, **columns: str) -> str:
    more = "".join(f', {sql} AS "{n}"' for n, sql in columns.items())
    return f'SELECT o_orderkey AS "PEDIDO", (year(o_orderdate) + {years})::INT AS "AÑO", month(o_orderdate)::INT AS "MES"{more} FROM orders'


def _listed(values) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in v) + ")" if isinstance(v, tuple) else f"'{v}'" for v in values)


def _published(t: Tables, name: str, *raw):
    """What is kept of a dataset, its landing tables given in the order of its sources."""
    spec = MONTHLY_DATASETS[name]
    return keep_selected(clean_monthly(dict(zip(spec.sources, raw, strict=True)), spec), spec)




def _price():
    return F.col("o_totalprice")


def _key():
    return F.col("o_orderkey")


VALENCIA = {"Valencia/València": "Valencia"}
BALEARES = {"Islas Baleares": "Illes Balears"}


@query(f"""
SELECT * FROM ({_landing_sql(PROVINCIA=_pick_sql(PLACES, "o_custkey", VALENCIA),
                             MUNICIPIO=_pick_sql(TOWNS, "o_orderkey", {"València": "Valencia", "Palma": "Palma de Mallorca"}),
                             VIAJEROS="CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END")})
WHERE "VIAJEROS" IS NOT NULL AND ("PROVINCIA", "MUNICIPIO") IN ({_listed(PROVINCE_MUNICIPALITY)})
""")
def monthly_pair_keys(t: Tables):
    """Kept by pairs of province and town, each recoded by its own rule."""
    raw = _landing(t, PROVINCIA=_pick(PLACES, "o_custkey"), MUNICIPIO=_pick(TOWNS, "o_orderkey"), VIAJEROS=F.when(_key() % 9 > 0, _price()))
    return _published(t, "apartamentosTuristicos_ocupacion", raw)


@query(f"""
SELECT * FROM ({_landing_sql(MUNICIPIO_ORIGEN=_pick_sql(TOWNS, "o_custkey", {"València": "Valencia"}), TURISTAS="o_totalprice")} WHERE o_orderkey % 2 = 0
    UNION ALL {_landing_sql(MUNICIPIO_ORIGEN=_pick_sql(TOWNS, "o_custkey", {"Palma": "Palma de Mallorca"}), TURISTAS="CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END")}
    WHERE o_orderkey % 2 = 1)
WHERE "TURISTAS" IS NOT NULL AND "MUNICIPIO_ORIGEN" IN ('Madrid', 'Barcelona', 'Sevilla', 'Palma de Mallorca', 'Valencia')
""")
def monthly_two_sources(t: Tables):
    """Two landing tables, recoded each by its own rule and united."""
    even = Tables(t.spark, t.folder)
    odd = Tables(t.spark, t.folder)
    even.orders, odd.orders = t.orders.filter(_key() % 2 == 0), t.orders.filter(_key() % 2 == 1)
    town = _pick(TOWNS, "o_custkey")
    return _published(
        t,
        "turismo_Emisor",
        _landing(even, MUNICIPIO_ORIGEN=town, TURISTAS=_price()),
        _landing(odd, MUNICIPIO_ORIGEN=town, TURISTAS=F.when(_key() % 5 > 0, _price())),
    )


@query(f"""
SELECT "PEDIDO", "AÑO", "MES", "PROVINCIA", "LUGAR_RESIDENCIA", coalesce("VIAJEROS", 0) AS "VIAJEROS", coalesce("PERNOCTACIONES", 0) AS "PERNOCTACIONES"
FROM ({_landing_sql(PROVINCIA=_pick_sql(PLACES, "o_custkey", BALEARES), LUGAR_RESIDENCIA="CASE o_orderkey % 4 WHEN 0 THEN 'Total' WHEN 1 THEN 'España' WHEN 2 THEN 'Francia' END",
                    VIAJEROS="CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END", PERNOCTACIONES="CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END")})
WHERE "LUGAR_RESIDENCIA" <> 'Total' AND "PROVINCIA" IN ({_listed(PROVINCES)})
""")
def monthly_zero_fill(t: Tables):
    """Missing numbers are 0 and stay; totals, and rows without place of residence, go."""
    home = F.when(_key() % 4 == 0, "Total").when(_key() % 4 == 1, "España").when(_key() % 4 == 2, "Francia")
    raw = _landing(
        t,
        PROVINCIA=_pick(PLACES, "o_custkey"),
        LUGAR_RESIDENCIA=home,
        VIAJEROS=F.when(_key() % 3 > 0, _price()),
        PERNOCTACIONES=F.when(_key() % 5 > 0, F.col("o_custkey")),
    )
    return _published(t, "hotel_ocupacion", raw)


@query(f"""
SELECT * FROM ({_landing_sql(PROVINCIA=_pick_sql(PLACES, "o_custkey", VALENCIA), IMD_VEHICULO_TOTAL="CASE WHEN o_orderkey % 6 > 1 THEN o_custkey WHEN o_orderkey % 6 = 1 THEN 0 END",
                             DIA="CASE WHEN o_orderkey % 11 > 0 THEN o_orderpriority END")})
WHERE "IMD_VEHICULO_TOTAL" <> 0 AND "DIA" IS NOT NULL AND "PROVINCIA" IN ({_listed(PROVINCES)})
""")
def monthly_not_equal(t: Tables):
    """Counts of 0 go, and so does every incomplete row."""
    raw = _landing(
        t,
        PROVINCIA=_pick(PLACES, "o_custkey"),
        IMD_VEHICULO_TOTAL=F.when(_key() % 6 > 1, F.col("o_custkey")).when(_key() % 6 == 1, 0),
        DIA=F.when(_key() % 11 > 0, F.col("o_orderpriority")),
    )
    return _published(t, "trafico_semana", raw)


@query(f"""
SELECT * FROM ({_landing_sql(PROVINCIA=_pick_sql(PLACES, "o_custkey", BALEARES), VIAJEROS="CASE WHEN o_orderkey % 4 > 1 THEN o_custkey WHEN o_orderkey % 4 = 1 THEN 0 END",
                             PERNOCTACIONES="CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END")})
WHERE "VIAJEROS" <> 0 AND "PROVINCIA" IN ({_listed(PROVINCES)})
""")
def monthly_incomplete_kept(t: Tables):
    """Other missing values stay missing where only a count of 0 is a reason to drop a row."""
    viajeros = F.when(_key() % 4 > 1, F.col("o_custkey")).when(_key() % 4 == 1, 0)
    raw = _landing(t, PROVINCIA=_pick(PLACES, "o_custkey"), VIAJEROS=viajeros, PERNOCTACIONES=F.when(_key() % 5 > 0, _price()))
    return _published(t, "campings_ocupacion", raw)


_CRIME_SQL = _landing_sql(
    PROVINCIA=_pick_sql(PLACES, "o_custkey", VALENCIA), TASA_DELITOS="CASE WHEN o_orderkey % 8 > 0 THEN o_totalprice END", TASA_DELITOS_ESPAÑA="o_totalprice * 2"
)
_SPREAD_SQL = f"""
crime AS (SELECT * FROM ({_CRIME_SQL}) WHERE "TASA_DELITOS" IS NOT NULL),
spread AS (
  SELECT * FROM crime UNION ALL
  SELECT "PEDIDO", "AÑO", ("MES" - back)::INT, "PROVINCIA", -99, -99 FROM crime, (VALUES (1), (2)) b(back) WHERE "MES" % 3 = 0)"""


def _crime(t: Tables):
    return _landing(t, PROVINCIA=_pick(PLACES, "o_custkey"), TASA_DELITOS=F.when(_key() % 8 > 0, _price()), TASA_DELITOS_ESPAÑA=_price() * 2)


@query(f'WITH {_SPREAD_SQL} SELECT * FROM spread WHERE "PROVINCIA" IN ({_listed(PROVINCES)})')
def monthly_expansion(t: Tables):
    """Quarters are spread over their months, with a sentinel for what is not known."""
    return _published(t, "seguridad_provincia", _crime(t))


@query(f"""
WITH {_SPREAD_SQL},
wanted("PROVINCIA") AS (VALUES {", ".join(f"('{p}')" for p in PROVINCES)}),
a AS (SELECT "PROVINCIA", count(*) AS n, count(DISTINCT "AÑO" * 100 + "MES") AS months, min("AÑO" * 100 + "MES") AS f, max("AÑO" * 100 + "MES") AS l FROM spread GROUP BY 1),
b AS (SELECT "PROVINCIA", count(*) AS n FROM ({_CRIME_SQL}) GROUP BY 1)
SELECT "PROVINCIA", b.n AS rows_before, b.n - a.n AS rows_dropped, a.n AS rows_after, months AS months_present,
       ((l // 100 - f // 100) * 12 + l % 100 - f % 100 + 1)::BIGINT AS months_expected, ((l // 100 - f // 100) * 12 + l % 100 - f % 100 + 1 - months)::BIGINT AS months_missing,
       (f // 100)::INT AS first_year, (f % 100)::INT AS first_month, (l // 100)::INT AS last_year, (l % 100)::INT AS last_month, 'ok' AS status
FROM wanted JOIN a USING ("PROVINCIA") JOIN b USING ("PROVINCIA")
""")
def monthly_expansion_report(t: Tables):
    """Rows that the expansion adds count as negatively dropped."""
    return report_monthly({"seguridad_provincia": _crime(t)}, MONTHLY_DATASETS["seguridad_provincia"])


@query(f"""
WITH filled AS (
  SELECT "PEDIDO", "AÑO", "MES", "PROVINCIA", coalesce("VIAJEROS", 0) AS "VIAJEROS"
  FROM ({_landing_sql(20, PROVINCIA=_pick_sql(PLACES, "o_custkey", BALEARES), VIAJEROS="CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END")})
  WHERE "PROVINCIA" IN ({_listed(PROVINCES)}))
SELECT * FROM filled UNION ALL
SELECT "PEDIDO", "AÑO", m AS "MES", "PROVINCIA", "VIAJEROS" FROM filled, (VALUES (4), (5)) g(m) WHERE "AÑO" = 2020 AND "MES" = 3
""")
def monthly_repeated_period(t: Tables):
    """March of one year stands for April and May as well; the orders' years are moved to reach it."""
    raw = _landing(t, 20, PROVINCIA=_pick(PLACES, "o_custkey"), VIAJEROS=F.when(_key() % 3 > 0, _price()))
    return _published(t, "apartamentos_ocupacion", raw)


_PORT_RECODING = {"BARCELONA": "Barcelona", "VALENCIA": "Valencia", "SEVILLA": "Sevilla", "BALEARES": "Illes Balears"}


@query(f"""
SELECT * FROM ({_landing_sql(AUT_PORTUARIA=_pick_sql(PORT_NAMES, "o_custkey", _PORT_RECODING), PASAJEROS="CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END")})
WHERE "PASAJEROS" IS NOT NULL
""")
def monthly_port_recoding(t: Tables):
    """Ports take the names of provinces; all ports stay."""
    return _published(t, "puertos_turismo", _ports(t))


def _ports(t: Tables):
    return _landing(t, AUT_PORTUARIA=_pick(PORT_NAMES, "o_custkey"), PASAJEROS=F.when(_key() % 7 > 0, _price()))


@query(
    f"""
WITH rows_in AS (
  SELECT {_pick_sql(PORT_NAMES, "o_custkey", _PORT_RECODING)} AS "AUT_PORTUARIA", year(o_orderdate) * 100 + month(o_orderdate) AS ym, o_orderkey % 7 > 0 AS kept FROM orders),
wanted("AUT_PORTUARIA") AS (VALUES {", ".join(f"('{p}')" for p in PORT_PROVINCES)})
"""
    + _REPORT_TAIL.format(keys='"AUT_PORTUARIA"', wkeys='w."AUT_PORTUARIA"', on='r."AUT_PORTUARIA" = w."AUT_PORTUARIA"')
)
def monthly_port_report(t: Tables):
    """The report of four ports only."""
    return report_monthly({"puertos_turismo": _ports(t)}, MONTHLY_DATASETS["puertos_turismo"])


@query(f"""
SELECT * FROM ({_landing_sql(PROVINCIA_ORIGEN=_pick_sql(PLACES, "o_orderkey", VALENCIA), PROVINCIA_DESTINO=_pick_sql(PLACES, "o_custkey", VALENCIA), TURISTAS="o_totalprice")})
WHERE "PROVINCIA_DESTINO" IN ({_listed(PROVINCES)})
""")
def monthly_origin_and_destination(t: Tables):
    """Both ends are recoded, and the destination decides."""
    raw = _landing(t, PROVINCIA_ORIGEN=_pick(PLACES, "o_orderkey"), PROVINCIA_DESTINO=_pick(PLACES, "o_custkey"), TURISTAS=_price())
    return _published(t, "turismo_Provincia", raw)


@query(
    f"""
WITH rows_in AS (
  SELECT {_pick_sql(TOWNS, "o_custkey")} AS "CIUDAD", year(o_orderdate) * 100 + month(o_orderdate) AS ym, o_orderkey % 4 > 0 AS kept FROM orders),
wanted AS (SELECT DISTINCT "CIUDAD" FROM rows_in)
"""
    + _REPORT_TAIL.format(keys='"CIUDAD"', wkeys='w."CIUDAD"', on='r."CIUDAD" = w."CIUDAD"')
)
def monthly_open_report(t: Tables):
    """A dataset without list of places reports every one it has."""
    raw = _landing(t, CIUDAD=_pick(TOWNS, "o_custkey"), PASAJEROS=F.when(_key() % 4 > 0, _price()))
    return report_monthly({"aena_destinos": raw}, MONTHLY_DATASETS["aena_destinos"])


# ---- daily climate --------------------------------------------------------

#: Stations of the short list and others that are left out.
IDS = [*climate.SHORT_STATIONS, "3195", "9999Z", "8416X"]
_NUMBERS = ["altitud", "tmed", "prec", "tmin", "tmax", "dir", "velmedia", "racha", "sol", "presMax", "presMin", "hrMedia", "hrMax", "hrMin"]
_CLOCKS = ["horatmin", "horatmax", "horaracha", "horaPresMax", "horaPresMin", "horaHrMax", "horaHrMin"]


def _climate_sql() -> str:
    names = climate.TRUSTED_NAMES
    stations = ", ".join(f"('{s[0]}', '{s[2]}', '{s[3]}')" for s in climate.STATIONS if s[0] in climate.SHORT_STATIONS)
    out = [f"strftime(ts, '%Y-%m-%d') AS {names['fecha_dt']}", "id AS idema", "CASE WHEN event_id % 13 = 0 THEN 'Desconocido' ELSE event_type END AS \"nombreEstacion\"", "municipio", "provincia"]
    out += ["year(ts)::INT AS \"AÑO\"", "month(ts)::INT AS \"MES\""]
    for i, n in enumerate(_NUMBERS):
        value = f"round(value + {i}, 2)"
        missing = f"event_id % {i + 5} = 0"
        out.append(f'CASE WHEN {missing} THEN NULL ELSE {f"round(({value}) * 100)::BIGINT::VARCHAR" if n == "altitud" else value} END AS "{names[n]}"')
    for i, n in enumerate(_CLOCKS):
        out.append(f"CASE WHEN event_id % {i + 4} = 0 THEN 'Desconocido' ELSE strftime(ts, '%H:%M') END AS \"{names[n]}\"")
    return f"""
    WITH stations(id, municipio, provincia) AS (VALUES {stations}),
    readings AS (SELECT *, {_pick_sql(IDS, "user_id")} AS station FROM events WHERE event_id % 17 > 0)
    SELECT {", ".join(out)} FROM readings JOIN stations ON station = id
    """


@query(_climate_sql())
def climate_daily_published(t: Tables):
    """All 28 published columns for the short list of stations: decimal commas, codes that are no numbers, empty and missing text, rows without station."""
    n = F.col("event_id")
    comma = lambda c: F.translate(F.format_string("%.2f", c), ".", ",")
    raw = {"fecha": F.date_format("ts", "yyyy-MM-dd"), "indicativo": F.when(n % 17 > 0, _pick(IDS, "user_id"))}
    raw |= {"nombre": F.when(n % 13 == 0, "").otherwise(F.col("event_type")), "provincia": F.lit("as landed")}
    for i, name in enumerate(_NUMBERS):
        text = F.round((F.col("value") + i) * 100).cast("long").cast("string") if name == "altitud" else comma(F.col("value") + i)
        raw[name] = F.when(n % (i + 5) != 0, text) if name == "altitud" else F.when(n % (i + 5) == 0, F.when(n % 2 == 0, "Ip")).otherwise(text)
    for i, name in enumerate(_CLOCKS):
        raw[name] = F.when(n % (i + 4) == 0, F.when(n % 3 == 0, "")).otherwise(F.date_format("ts", "HH:mm"))
    landed = climate.landing_rows(t.events.select(*[raw[f].alias(f) for f in climate.RAW_FIELDS]))
    built = climate.build_daily_climate(landed, climate.stations(t.spark, climate.SHORT_STATIONS))
    return built.withColumns({c: F.round(c, 2) for c in climate.MEASURES})
