"""Geometry: events as points, with user id as longitude and value as latitude."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.geometry import MAP_SRID, SRID, point, point_wkt, point_xy, set_srid, srid_of, wkt_x, wkt_y
from emberlake.plans.dashboard import map_points
from emberlake.queries import Query, table


def _lon_lat() -> tuple[Column, Column]:
    return (F.col("user_id") - 75.5).alias("lon"), (F.col("value") / 4 - 60).alias("lat")


_LON_LAT_SQL = "SELECT event_id, event_type, user_id - 75.5::DOUBLE AS lon, value / 4 - 60 AS lat FROM events"


def _located(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "event_type", *_lon_lat())


def point_texts(spark: SparkSession, folder: str) -> DataFrame:
    """WKT of points; the latitude is a value as stored, so both engines print the same digits."""
    events = table(spark, folder, "events")
    return events.select("event_id", point_wkt(F.col("user_id") - 75.5, F.col("value")).alias("wkt"))


def point_parse(spark: SparkSession, folder: str) -> DataFrame:
    texts = point_texts(spark, folder)
    return texts.select("event_id", wkt_x(F.col("wkt")).alias("x"), wkt_y(F.col("wkt")).alias("y"))


def point_ewkb(spark: SparkSession, folder: str) -> DataFrame:
    rows = _located(spark, folder)
    return rows.select("event_id", F.lower(F.hex(point(F.col("lon"), F.col("lat")))).alias("ewkb"))


def srid_relabel(spark: SparkSession, folder: str) -> DataFrame:
    """Points under another SRID: the header changes, the coordinates do not."""
    rows = _located(spark, folder).withColumn("geom", point(F.col("lon"), F.col("lat")))
    moved = rows.select("event_id", srid_of(F.col("geom")).alias("was"), set_srid(F.col("geom"), MAP_SRID).alias("geom"))
    return moved.select("event_id", "was", srid_of(F.col("geom")).alias("now"), point_xy("geom").alias("xy")).select(
        "event_id", "was", "now", "xy.x", "xy.y"
    )


def points_on_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = _located(spark, folder)
    return map_points(
        rows.select(
            F.col("event_id").alias("id_queimada"),
            point(F.col("lon"), F.col("lat")).alias("geom_foco"),
            F.col("event_type").alias("municipio_nome"),
        )
    )


def double_hex_sql(value: str) -> str:
    """Little-endian hex of a normal double, from its C hexadecimal text."""
    text = f"printf('%a', abs({value}))"
    digits = f"rpad(regexp_extract({text}, '^0x1\\.?([0-9a-f]*)p', 1), 13, '0')"
    exponent = f"(CAST(regexp_extract({text}, 'p([+-][0-9]+)$', 1) AS INTEGER) + 1023 + CASE WHEN {value} < 0 THEN 2048 ELSE 0 END)"
    big = f"(lower(lpad(hex({exponent}), 3, '0')) || {digits})"
    big = f"CASE WHEN {value} = 0 THEN repeat('0', 16) ELSE {big} END"
    return "(" + " || ".join(f"substr({big}, {i}, 2)" for i in range(15, 0, -2)) + ")"


POINT_HEADER = struct.pack("<BII", 1, 0x20000001, SRID).hex()
_WKT_NUMBER = "regexp_replace(CAST({0} AS VARCHAR), '\\.0$', '')"

QUERIES = {
    "point_wkt": Query(
        point_texts,
        f"SELECT event_id, concat('POINT(', {_WKT_NUMBER.format('lon')}, ' ', {_WKT_NUMBER.format('value')}, ')') AS wkt "
        "FROM (SELECT event_id, user_id - 75.5::DOUBLE AS lon, value FROM events)",
    ),
    "point_parse": Query(point_parse, "SELECT event_id, user_id - 75.5::DOUBLE AS x, value AS y FROM events"),
    "point_ewkb": Query(
        point_ewkb,
        f"SELECT event_id, '{POINT_HEADER}' || {double_hex_sql('lon')} || {double_hex_sql('lat')} AS ewkb FROM ({_LON_LAT_SQL})",
    ),
    "srid_relabel": Query(
        srid_relabel,
        f"SELECT event_id, {SRID}::INTEGER AS was, {MAP_SRID}::INTEGER AS now, lon AS x, lat AS y FROM ({_LON_LAT_SQL})",
    ),
    "map_points": Query(
        points_on_map,
        "SELECT event_id AS id_queimada, lat AS latitude, lon AS longitude, event_type AS municipio_nome "
        f"FROM ({_LON_LAT_SQL})",
    ),
}
