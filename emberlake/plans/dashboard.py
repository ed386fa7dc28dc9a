"""The dashboard's questions as DataFrames: filtered star, headline figures, charts, map points."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.functions.geometry import MAP_SRID, geometry_label, point_wkt, point_xy
from emberlake.operators.lookup import Dimension, star_join
from emberlake.operators.measures import count_by, count_charts, headline, options, pairs, with_share

# Fixed value: the choice that stands for no filter.
ALL = "Todos"


@dataclass(frozen=True)
class Filters:
    """Choices of a dashboard user. Names match every area that has them, a state narrows that down."""

    satellite: str
    first_day: datetime.date
    last_day: datetime.date
    biome: str = ALL
    state: str = ALL
    municipality: str = ALL


def chosen(column: Column, choice: str | None) -> Column | None:
    """Equality with a choice, or None where the choice is no filter."""
    return None if choice in (None, ALL) else column == choice


def all_of(*conditions: Column | None) -> Column | None:
    """Conjunction of the conditions that are there; None if none is."""
    present = [c for c in conditions if c is not None]
    if not present:
        return None
    both = present[0]
    for c in present[1:]:
        both = both & c
    return both


def month_range(year: Column, month: Column, first: datetime.date, last: datetime.date) -> Column:
    """Months of a date range as a condition on partition columns alone."""
    after = (year > first.year) | ((year == first.year) & (month >= first.month))
    before = (year < last.year) | ((year == last.year) & (month <= last.month))
    return after & before


def hotspot_star(
    fact: DataFrame, dates: DataFrame, municipalities: DataFrame, biomes: DataFrame, filters: Filters
) -> DataFrame:
    """Fact rows with day and area names under the filters.

    Inner joins: hotspots without a date, municipality or biome drop out of
    every figure. If the fact has year and month partitions, the date range
    prunes them.
    """
    of_satellite = F.col("des_satelite") == filters.satellite
    months = None
    if {"year", "month"} <= set(fact.columns):
        months = month_range(F.col("year"), F.col("month"), filters.first_day, filters.last_day)
    joined = star_join(
        fact,
        [
            Dimension(
                dates,
                {"id_data": "id_data"},
                {"dt_data": "dt_data"},
                F.col("dt_data").between(F.lit(filters.first_day), F.lit(filters.last_day)),
            ),
            Dimension(
                municipalities,
                {"id_municipio": "id_municipio"},
                {"municipio_nome": "des_nome", "estado_sigla": "des_sigla"},
                all_of(chosen(F.col("des_sigla"), filters.state), chosen(F.col("des_nome"), filters.municipality)),
            ),
            Dimension(
                biomes,
                {"id_bioma": "id_bioma"},
                {"bioma_nome": "des_nome"},
                chosen(F.col("des_nome"), filters.biome),
            ),
        ],
        where=all_of(of_satellite, months),
    )
    return joined.select(
        "id_queimada",
        "qtd_dias_sem_chuva",
        "vl_precipitacao",
        "vl_risco_fogo",
        "vl_frp",
        "id_municipio",
        "id_bioma",
        "des_satelite",
        "municipio_nome",
        "estado_sigla",
        "bioma_nome",
        "dt_data",
        "geom_foco",
    )


def filter_options(fact: DataFrame, municipalities: DataFrame, biomes: DataFrame) -> dict[str, DataFrame]:
    """The four choice lists."""
    return {
        "biomas": options(biomes, ["id_bioma", "des_nome"], "des_nome"),
        "estados": options(municipalities, ["des_sigla"], "des_sigla"),
        "municipios": options(municipalities, ["id_municipio", "des_nome"], "des_nome"),
        "satelites": options(fact, ["des_satelite"], "des_satelite"),
    }


def overview(star: DataFrame) -> DataFrame:
    """The headline row: hotspots, municipalities and biomes hit, mean dry days and mean rain."""
    return headline(
        star,
        {"total_municipios": "id_municipio", "total_biomas": "id_bioma"},
        {"media_dias_sem_chuva": "qtd_dias_sem_chuva", "media_precipitacao": "vl_precipitacao"},
        total="total_focos",
    )


def map_points(star: DataFrame) -> DataFrame:
    """Points of the map: id, latitude, longitude, municipality."""
    xy = point_xy("geom_foco")
    points = star.select("id_queimada", xy.alias("__xy"), "municipio_nome")
    return points.select(
        "id_queimada",
        F.col("__xy.y").alias("latitude", metadata=geometry_label(MAP_SRID)),
        F.col("__xy.x").alias("longitude", metadata=geometry_label(MAP_SRID)),
        "municipio_nome",
    )


def with_wkt(star: DataFrame) -> DataFrame:
    """The star with its point as WKT text in place of binary."""
    located = star.withColumn("__xy", point_xy("geom_foco"))
    return located.withColumn("geom_foco", point_wkt(F.col("__xy.x"), F.col("__xy.y"))).drop("__xy")


def charts(star: DataFrame) -> dict[str, DataFrame]:
    """The four charts, each as its own query."""
    return {
        "bioma": count_by(star, "bioma_nome", "id_queimada", "total"),
        "data": count_by(star, "dt_data", "id_queimada", "total"),
        "estado": with_share(count_by(star, "estado_sigla", "id_queimada", "total"), "total"),
        "dispersao": pairs(star, "vl_precipitacao", "vl_risco_fogo"),
    }


def chart_counts(star: DataFrame) -> DataFrame:
    """The three count charts in long form from one pass over the star."""
    keys = {"bioma": F.col("bioma_nome"), "data": F.col("dt_data"), "estado": F.col("estado_sigla")}
    return count_charts(star, keys, "id_queimada")
