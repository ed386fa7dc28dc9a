"""The fact table: trusted hotspots with the ids of date, municipality and biome."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.geometry import SRID, geometry_label, point
from emberlake.operators.lookup import Dimension, star_join
from emberlake.plans.dimensions import FIRST_DAY, extend_date_dimension
from emberlake.schemas import FACT_MEASURES, HOTSPOT_PARTITIONS
from emberlake.sinks.tables import overwrite_table, replace_folders
from emberlake.sources.tables import Version, current_version, read_folders, read_table, read_version

FACT_IDS = ["id_data", "id_municipio", "id_bioma"]


def build_fact(
    trusted: DataFrame, dates: DataFrame, municipalities: DataFrame, biomes: DataFrame, unique: bool = True
) -> DataFrame:
    """Fact rows; hotspots without a matching date, municipality or biome keep a null id.

    Rows need valid coordinates. Areas are matched by normalised name, not by
    geometry, and dimension polygons never enter the joins. ``unique=True``
    raises if a dimension key would multiply hotspots; ``False`` lets it. The
    partition columns of the trusted table are kept after the fact columns.
    """
    joined = star_join(
        trusted,
        [
            Dimension(biomes, {"bioma": "des_nome"}, {"id_bioma": "id_bioma"}),
            Dimension(
                municipalities,
                {"sigla_estado": "des_sigla", "municipio": "des_nome"},
                {"id_municipio": "id_municipio"},
            ),
            Dimension(dates, {"dt_data": "dt_data"}, {"id_data": "id_data"}),
        ],
        how="left",
        where=F.col("valid_coordinates").eqNullSafe(True),
        unique=unique,
    )
    measures = {new: F.col(old).alias(new) for new, old in FACT_MEASURES.items()}
    geometry = point(F.col("lon"), F.col("lat"), SRID).alias("geom_foco", metadata=geometry_label(SRID))
    partitions = [c for c in HOTSPOT_PARTITIONS if c in trusted.columns]
    return joined.select(
        measures.pop("id_queimada"), *FACT_IDS, *measures.values(), geometry, *partitions
    )


def refresh_fact(
    spark: SparkSession,
    trusted_path: str,
    dates_path: str,
    municipalities_path: str,
    biomes_path: str,
    fact_path: str,
    first_day=FIRST_DAY,
) -> None:
    """Bring the date dimension up to the latest hotspot, then the fact table up to its sources.

    The fact is partitioned like the trusted table, so that a date range in a
    query prunes files, and sorted by satellite within files. Its version names
    the folders it was built from: only months whose trusted folders or days
    have changed since are built anew, and all of them if an area dimension
    has changed, days have gone or the fact was written by other means.
    """
    trusted_path, dates_path, fact_path = (p.rstrip("/") for p in (trusted_path, dates_path, fact_path))
    now = current_version(spark, trusted_path)
    before = current_version(spark, fact_path)
    built_from = before.sources if before else {}
    stale = None
    if now and _partitioned(now) and _partitioned(before):
        stale = {f.rpartition("/")[0] for f in set(now.folders) ^ set(built_from.get("trusted", ()))}
    trusted = read_table(spark, trusted_path) if now is None else read_folders(spark, trusted_path, now, now.folders)
    recent = _of_months(spark, trusted_path, now, stale) if stale else trusted
    extend_date_dimension(spark, dates_path, recent.agg(F.max("dt_data").alias("last")), first_day)
    areas = [read_version(spark, p) for p in (municipalities_path, biomes_path)]
    days, days_version = read_version(spark, dates_path)
    sources = _sources(trusted=now, days=days_version, municipalities=areas[0][1], biomes=areas[1][1])
    known = sources and all(built_from.get(n) == sources[n] for n in ("municipalities", "biomes"))
    if stale is None or not known or not set(built_from["days"]) <= set(sources["days"]):
        fact = build_fact(trusted, days, areas[0][0], areas[1][0])
        overwrite_table(fact, fact_path, HOTSPOT_PARTITIONS, ["des_satelite"], sources)
        return
    added = sorted(set(sources["days"]) - set(built_from["days"]))
    if added:
        # Days that the dimension lacked when older months were built.
        fresh = read_folders(spark, dates_path, days_version, added)
        months = fresh.select(F.year("dt_data").alias("y"), F.month("dt_data").alias("m")).distinct().collect()
        present = {f.rpartition("/")[0] for f in now.folders}
        stale |= present & {"/".join(f"{c}={v}" for c, v in zip(HOTSPOT_PARTITIONS, month)) for month in months}
    if stale or added:
        fact = build_fact(_of_months(spark, trusted_path, now, stale), days, areas[0][0], areas[1][0])
        replace_folders(fact, fact_path, before, stale, ["des_satelite"], sources)


def _partitioned(version: Version | None) -> bool:
    return version is not None and version.partition_by == tuple(HOTSPOT_PARTITIONS)


def _of_months(spark: SparkSession, path: str, version: Version, months: Collection[str]) -> DataFrame:
    return read_folders(spark, path, version, [f for f in version.folders if f.rpartition("/")[0] in months])


def _sources(**versions: Version | None) -> dict[str, list[str]]:
    """Folders of the tables by name; nothing if one of them has no versions."""
    return {} if None in versions.values() else {name: sorted(v.folders) for name, v in versions.items()}
