"""The whole hotspot chain on a raw feed that is derived from the events."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.quality import STATE_CODES
from emberlake.operators.shaping import union_by_name
from emberlake.plans.dashboard import Filters, chart_counts, hotspot_star, overview
from emberlake.plans.dimensions import date_rows
from emberlake.plans.fact import build_fact, refresh_fact
from emberlake.plans.hotspots import clean_hotspots, load_hotspots
from emberlake.queries import Query, table
from emberlake.queries.cleaning import normal_sql
from emberlake.queries.dates import date_rows_sql, days_sql
from emberlake.queries.geo import POINT_HEADER, double_hex_sql
from emberlake.queries.stars import rounded
from emberlake.session import scratch_folder
from emberlake.sinks.tables import overwrite_table
from emberlake.sources.tables import read_table

# What each event type stands for: satellite, municipality, state, biome.
PLACES = {
    "click": ("Aqua_M-T", "São Félix do Xingu", "Pará", "Amazônia"),
    "view": ("Aqua_M-T", "Corumbá", "Mato Grosso do Sul", "Pantanal"),
    "error": ("Terra", "Ilha", "Atlântida", "Oceano"),
    "purchase": ("Aqua_M-T", "Niquelândia", "Goiás", "Cerrado"),
}
ELSEWHERE = ("Terra", "São Paulo", "São Paulo", "Mata Atlântica")


def _place(part: int) -> Column:
    kind = F.col("event_type")
    chain = None
    for name, place in PLACES.items():
        chain = F.when(kind == name, place[part]) if chain is None else chain.when(kind == name, place[part])
    return chain.otherwise(ELSEWHERE[part])


def raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a raw row of text, and every row a second time."""
    text = {
        "lat": F.col("value") - 100,
        "lon": F.col("user_id") * 3.0 - 200,
        "data_hora_gmt": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "satelite": _place(0),
        "municipio": _place(1),
        "estado": _place(2),
        "bioma": _place(3),
        "numero_dias_sem_chuva": F.col("user_id") - 30,
        "precipitacao": F.col("value") - 50,
        "risco_fogo": F.col("user_id") / 120,
        "frp": F.col("value"),
    }
    rows = table(spark, folder, "events").select(*[c.cast("string").alias(n) for n, c in text.items()])
    return union_by_name(rows, rows)


def trusted(spark: SparkSession, folder: str) -> DataFrame:
    return clean_hotspots(raw_feed(spark, folder))


def clean_feed(spark: SparkSession, folder: str) -> DataFrame:
    # Zone-free like the source column.
    return trusted(spark, folder).withColumn("data_hora_gmt", F.col("data_hora_gmt").cast("timestamp_ntz"))


def _stored_trusted(spark: SparkSession, folder: str) -> DataFrame:
    """The trusted table, written as a load writes it and read back."""
    path = scratch_folder(spark, "trusted")
    load_hotspots(trusted(spark, folder), path)
    return read_table(spark, path)


def _dimensions(spark: SparkSession, folder: str, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dates of the events but the last day, municipalities and biomes that hold readings, by trusted name."""
    day = F.to_date("ts")
    bounds = table(spark, folder, "events").agg(F.min(day).alias("first"), F.date_sub(F.max(day), 1).alias("last"))
    towns = rows.select("municipio", "sigla_estado").distinct().select(
        (F.length("municipio") * 100 + F.ascii("municipio")).alias("id_municipio"),
        F.col("municipio").alias("des_nome"),
        F.col("sigla_estado").alias("des_sigla"),
    )
    biomes = rows.filter("bioma <> 'OCEANO'").select("bioma").distinct()
    biomes = biomes.select(
        (F.length("bioma") * 100 + F.ascii("bioma")).alias("id_bioma"), F.col("bioma").alias("des_nome")
    )
    return date_rows(bounds, "first", "last"), towns, biomes


def _fact_and_dimensions(spark: SparkSession, folder: str) -> list[DataFrame]:
    rows = _stored_trusted(spark, folder)
    dimensions = _dimensions(spark, folder, rows)
    return [build_fact(rows, *dimensions), *dimensions]


def hotspot_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _fact_and_dimensions(spark, folder)[0].withColumn("geom_foco", F.lower(F.hex("geom_foco")))


def fact_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """The stored fact after a first build without the last day and a refresh with it."""
    path = {n: scratch_folder(spark, n) for n in ("trusted", "days", "towns", "biomes", "fact")}
    rows = trusted(spark, folder)
    first, last = rows.agg(F.min("dt_data"), F.max("dt_data")).first()
    of_last = F.col("dt_data") == last
    load_hotspots(rows.where(~of_last), path["trusted"])
    _, towns, biomes = _dimensions(spark, folder, rows)
    overwrite_table(towns, path["towns"])
    overwrite_table(biomes, path["biomes"])
    refresh_fact(spark, *path.values(), first)
    load_hotspots(rows.where(of_last), path["trusted"])
    refresh_fact(spark, *path.values(), first)
    return read_table(spark, path["fact"]).withColumn("geom_foco", F.lower(F.hex("geom_foco")))


def _star(spark: SparkSession, folder: str) -> DataFrame:
    filters = Filters("AQUA_M-T", datetime.date(2024, 1, 5), datetime.date(2024, 1, 31))
    return hotspot_star(*_fact_and_dimensions(spark, folder), filters)


def hotspot_overview(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(overview(_star(spark, folder)), "media_dias_sem_chuva", "media_precipitacao")


def hotspot_charts(spark: SparkSession, folder: str) -> DataFrame:
    return chart_counts(_star(spark, folder))


def _place_sql(part: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN '{place[part]}'" for name, place in PLACES.items())
    return f"CASE event_type {cases} ELSE '{ELSEWHERE[part]}' END"


_CODES_SQL = "CASE estado " + " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in STATE_CODES.items()) + " END"
_KEY_SQL = ", ".join(
    [
        "CAST(lat AS VARCHAR)",
        "CAST(lon AS VARCHAR)",
        "strftime(data_hora_gmt, '%Y-%m-%d %H:%M:%S')",
        "satelite",
        "municipio",
        "estado",
        "bioma",
        "CAST(dias AS VARCHAR)",
        "CAST(precipitacao AS VARCHAR)",
        "CAST(risco_fogo AS VARCHAR)",
        "CAST(frp AS VARCHAR)",
    ]
)
_READING_SQL = f"""
    SELECT value - 100 AS lat, user_id * 3.0::DOUBLE - 200 AS lon, date_trunc('second', ts) AS data_hora_gmt,
           {_place_sql(0)} AS satelite, {_place_sql(1)} AS municipio, {_place_sql(2)} AS estado, {_place_sql(3)} AS bioma,
           CAST(CASE WHEN user_id >= 30 THEN user_id - 30 END AS DOUBLE) AS dias,
           CASE WHEN value - 50 >= 0 THEN value - 50 END AS precipitacao,
           CASE WHEN user_id / 120 <= 1 THEN user_id / 120 END AS risco_fogo, value AS frp
    FROM events
"""
_NORMAL_SQL = f"""
    SELECT DISTINCT upper(md5(concat_ws('_', {_KEY_SQL}))) AS id, lat, lon, data_hora_gmt,
           {normal_sql("satelite")} AS satelite, {normal_sql("municipio")} AS municipio, {normal_sql("estado")} AS estado,
           {normal_sql("bioma")} AS bioma, CAST(dias AS INTEGER) AS numero_dias_sem_chuva, precipitacao, risco_fogo, frp
    FROM ({_READING_SQL})
"""
TRUSTED_SQL = f"""
    SELECT *, CASE WHEN risco_fogo <= 0.15 THEN 'MINIMO' WHEN risco_fogo <= 0.4 THEN 'BAIXO'
              WHEN risco_fogo <= 0.7 THEN 'MEDIO' WHEN risco_fogo <= 0.95 THEN 'ALTO'
              WHEN risco_fogo <= 1 THEN 'CRITICO' ELSE 'INVALIDO' END AS fire_risk_category,
           lat BETWEEN -90 AND 90 AS valid_lat, lon BETWEEN -180 AND 180 AS valid_lon,
           lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AS valid_coordinates,
           {_CODES_SQL} AS sigla_estado, CAST(data_hora_gmt AS DATE) AS dt_data,
           CAST(year(data_hora_gmt) AS INTEGER) AS year, CAST(month(data_hora_gmt) AS INTEGER) AS month
    FROM ({_NORMAL_SQL})
"""
_AREA_ID = "CAST(length({0}) * 100 + ascii({0}) AS INTEGER)"
_DAYS_SQL = date_rows_sql(days_sql("SELECT min(ts)::DATE FROM events", "SELECT max(ts)::DATE - 1 FROM events"))
_ALL_DAYS_SQL = date_rows_sql(days_sql("SELECT min(ts)::DATE FROM events", "SELECT max(ts)::DATE FROM events"))
_FACT_SQL = f"""
    WITH trusted AS ({TRUSTED_SQL}),
    dm_data AS ({_DAYS_SQL}),
    dm_municipio AS (
        SELECT DISTINCT {_AREA_ID.format("municipio")} AS id_municipio, municipio AS nome, sigla_estado AS sigla FROM trusted
    ),
    dm_bioma AS (
        SELECT DISTINCT {_AREA_ID.format("bioma")} AS id_bioma, bioma AS nome FROM trusted WHERE bioma <> 'OCEANO'
    ),
    ft AS (
        SELECT id AS id_queimada, id_data, id_municipio, id_bioma, satelite AS des_satelite,
               numero_dias_sem_chuva AS qtd_dias_sem_chuva, precipitacao AS vl_precipitacao, risco_fogo AS vl_risco_fogo,
               frp AS vl_frp, lon, lat, t.year, t.month
        FROM trusted t
        LEFT JOIN dm_bioma b ON t.bioma = b.nome
        LEFT JOIN dm_municipio m ON t.sigla_estado = m.sigla AND t.municipio = m.nome
        LEFT JOIN dm_data d ON t.dt_data = d.dt_data
        WHERE valid_coordinates IS TRUE
    )
"""
_STAR_SQL = f"""
    {_FACT_SQL},
    star AS (
        SELECT ft.*, m.nome AS municipio_nome, m.sigla AS estado_sigla, b.nome AS bioma_nome, d.dt_data
        FROM ft JOIN dm_data d USING (id_data) JOIN dm_municipio m USING (id_municipio) JOIN dm_bioma b USING (id_bioma)
        WHERE des_satelite = 'AQUA_M-T' AND d.dt_data BETWEEN DATE '2024-01-05' AND DATE '2024-01-31'
    )
"""


def _chart_sql(chart: str, key: str) -> str:
    return (
        f"SELECT '{chart}' AS chart, CAST({key} AS VARCHAR) AS key, count(id_queimada) AS n, "
        f"count(id_queimada) / sum(count(id_queimada)) OVER () AS share FROM star GROUP BY {key}"
    )


QUERIES = {
    "clean_hotspots": Query(clean_feed, TRUSTED_SQL),
    "hotspot_fact": Query(
        hotspot_fact,
        f"{_FACT_SQL} SELECT * EXCLUDE (lon, lat), "
        f"'{POINT_HEADER}' || {double_hex_sql('lon')} || {double_hex_sql('lat')} AS geom_foco FROM ft",
    ),
    "fact_refreshed": Query(
        fact_refreshed,
        f"{_FACT_SQL.replace(_DAYS_SQL, _ALL_DAYS_SQL)} SELECT * EXCLUDE (lon, lat), "
        f"'{POINT_HEADER}' || {double_hex_sql('lon')} || {double_hex_sql('lat')} AS geom_foco FROM ft",
    ),
    "hotspot_overview": Query(
        hotspot_overview,
        f"{_STAR_SQL} SELECT count(*) AS total_focos, count(DISTINCT id_municipio) AS total_municipios, "
        "count(DISTINCT id_bioma) AS total_biomas, round(avg(qtd_dias_sem_chuva), 6) AS media_dias_sem_chuva, "
        "round(avg(vl_precipitacao), 6) AS media_precipitacao FROM star",
    ),
    "hotspot_charts": Query(
        hotspot_charts,
        f"{_STAR_SQL} "
        + " UNION ALL ".join(
            [_chart_sql("bioma", "bioma_nome"), _chart_sql("data", "dt_data"), _chart_sql("estado", "estado_sigla")]
        ),
    ),
}
