"""Cleaning operators: types, ranges, keys, bands, flags, codes, union and dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.keys import surrogate_key
from emberlake.functions.quality import band, code_of, coordinate_flags, null_outside
from emberlake.functions.text import ACCENTED, UNACCENTED
from emberlake.functions.times import event_day_columns
from emberlake.operators.shaping import (
    conform,
    distinct_rows,
    normalize_frame,
    nulled_cells,
    typed,
    union_by_name,
)
from emberlake.queries import Query, table

SEGMENT_CODES = {"BUILDING": "BU", "HOUSEHOLD": "HO", "MACHINERY": "MA"}


def normal_sql(text: str) -> str:
    """Spark upper-cases sharp s to SS, the SQL engine to a capital sharp s."""
    return f"upper(replace(translate({text}, '{ACCENTED}', '{UNACCENTED}'), 'ß', 'ss'))"


def normalize_strings(spark: SparkSession, folder: str) -> DataFrame:
    rows = normalize_frame(table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars"))
    return rows.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


_KEYED = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "discount", "l_returnflag", "l_shipdate"]


def _keyed_lines(spark: SparkSession, folder: str, null_token: str | None) -> DataFrame:
    rows = table(spark, folder, "lineitem").withColumn("discount", null_outside(F.col("l_discount"), high=0.05))
    return rows.select("l_orderkey", "l_linenumber", surrogate_key([F.col(c) for c in _KEYED], null_token).alias("id"))


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _keyed_lines(spark, folder, None)


def surrogate_keys_null_token(spark: SparkSession, folder: str) -> DataFrame:
    return _keyed_lines(spark, folder, "?")


def null_out_of_range(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey",
        null_outside(F.col("c_acctbal"), low=0).alias("not_negative"),
        null_outside(F.col("c_acctbal"), low=0, high=5000).alias("in_range"),
    )


def risk_bands(spark: SparkSession, folder: str) -> DataFrame:
    risk = null_outside(F.col("l_discount") * 12, low=0.1)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", band(risk).alias("category"))


def validate_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    lat, lon = null_outside(F.col("value") - 100, high=300), F.col("user_id") * 3 - 180
    flags = coordinate_flags(lat, lon)
    return table(spark, folder, "events").select("event_id", *[c.alias(n) for n, c in flags.items()])


def code_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", code_of(F.col("c_mktsegment"), SEGMENT_CODES).alias("code"))


def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = event_day_columns(F.col("o_orderdate"))
    return table(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a feed of text cells, some of which do not fit their type; two time layouts."""
    kind = F.col("event_type")
    layout = (
        F.when(kind == "click", F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
        .when(kind == "error", F.lit("no time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        layout.alias("moment"),
        F.when(kind == "view", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("user_id") < 100, F.col("user_id").cast("string")).otherwise(kind).alias("user_id"),
    )


_EVENT_TYPES = {"event_id": "long", "moment": "timestamp", "value": "double", "user_id": "int"}
_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss")


def typed_cells(spark: SparkSession, folder: str) -> DataFrame:
    rows = typed(raw_events(spark, folder), _EVENT_TYPES, _LAYOUTS)
    # Zone-free like the source column.
    return rows.withColumn("moment", F.col("moment").cast("timestamp_ntz"))


def nulled_cell_counts(spark: SparkSession, folder: str) -> DataFrame:
    return nulled_cells(raw_events(spark, folder), _EVENT_TYPES, _LAYOUTS)


def whole_row_dedup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    return distinct_rows(union_by_name(events, events))


def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as three feeds by status, one under other column names and one given twice."""
    orders = table(spark, folder, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    daily = conform(orders.filter("o_orderstatus = 'F'"), columns)
    monthly = conform(orders.filter("o_orderstatus = 'O'"), columns)
    renamed = {"o_orderkey": "key", "o_orderdate": "day"}
    yearly = orders.filter("o_orderstatus = 'P'").withColumnsRenamed(renamed)
    yearly = conform(yearly, columns, {new: old for old, new in renamed.items()})
    return distinct_rows(union_by_name(daily, monthly, yearly, daily))


_DISCOUNT = "CASE WHEN l_discount <= 0.05 THEN l_discount END"
_TEXTS = [f"CAST({c} AS VARCHAR)" for c in _KEYED]


def _key_sql(parts: list[str]) -> str:
    return (
        f"SELECT l_orderkey, l_linenumber, upper(md5(concat_ws('_', {', '.join(parts)}))) AS id "
        f"FROM (SELECT *, {_DISCOUNT} AS discount FROM lineitem)"
    )


QUERIES = {
    "normalize_strings": Query(
        normalize_strings,
        f"SELECT doc_id, md5({normal_sql('text')}) AS text_md5, {normal_sql('lang')} AS lang, "
        f"{normal_sql('source')} AS source, n_chars FROM documents",
    ),
    "surrogate_key": Query(surrogate_keys, _key_sql(_TEXTS)),
    "surrogate_key_null_token": Query(surrogate_keys_null_token, _key_sql([f"coalesce({t}, '?')" for t in _TEXTS])),
    "null_out_of_range": Query(
        null_out_of_range,
        "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS not_negative, "
        "CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END AS in_range FROM customer",
    ),
    "risk_bands": Query(
        risk_bands,
        "SELECT l_orderkey, l_linenumber, CASE WHEN risk <= 0.15 THEN 'MINIMO' WHEN risk <= 0.4 THEN 'BAIXO' "
        "WHEN risk <= 0.7 THEN 'MEDIO' WHEN risk <= 0.95 THEN 'ALTO' WHEN risk <= 1 THEN 'CRITICO' "
        "ELSE 'INVALIDO' END AS category FROM (SELECT l_orderkey, l_linenumber, "
        "CASE WHEN l_discount * 12 >= 0.1 THEN l_discount * 12 END AS risk FROM lineitem)",
    ),
    "validate_coordinates": Query(
        validate_coordinates,
        "SELECT event_id, coalesce(lat BETWEEN -90 AND 90, false) AS valid_lat, "
        "coalesce(lon BETWEEN -180 AND 180, false) AS valid_lon, "
        "coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false) AS valid_coordinates FROM (SELECT event_id, "
        "CASE WHEN value - 100 <= 300 THEN value - 100 END AS lat, user_id * 3 - 180 AS lon FROM events)",
    ),
    "code_lookup": Query(
        code_lookup,
        "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'BU' WHEN 'HOUSEHOLD' THEN 'HO' "
        "WHEN 'MACHINERY' THEN 'MA' END AS code FROM customer",
    ),
    "date_parts": Query(
        date_parts,
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt_data, CAST(year(o_orderdate) AS INTEGER) AS year, "
        "CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
    ),
    "typed_cells": Query(
        typed_cells,
        "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS moment, "
        "CASE WHEN event_type <> 'view' THEN value END AS value, "
        "CAST(CASE WHEN user_id < 100 THEN user_id END AS INTEGER) AS user_id FROM events",
    ),
    "nulled_cell_counts": Query(
        nulled_cell_counts,
        "SELECT CAST(0 AS BIGINT) AS event_id, count(*) FILTER (event_type = 'error') AS moment, "
        "count(*) FILTER (event_type = 'view') AS value, count(*) FILTER (user_id >= 100) AS user_id FROM events",
    ),
    "whole_row_dedup": Query(
        whole_row_dedup, "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events"
    ),
    "union_sources": Query(
        union_sources, "SELECT DISTINCT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders"
    ),
}
