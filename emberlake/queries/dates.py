"""The date dimension over the days of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.plans.dimensions import date_rows, extend_date_dimension, missing_date_rows
from emberlake.queries import Query, table
from emberlake.session import scratch_folder
from emberlake.sources.tables import read_table


def date_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Days from the first to the last order."""
    day = F.to_date("o_orderdate")
    bounds = table(spark, folder, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return date_rows(bounds, "first", "last")


def date_dimension_extend(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension of the orders carried on to the last shipment."""
    existing = date_dimension(spark, folder)
    until = table(spark, folder, "lineitem").agg(F.to_date(F.max("l_shipdate")).alias("last"))
    return existing.unionByName(missing_date_rows(existing, until, "last"))


def date_dimension_first(spark: SparkSession, folder: str) -> DataFrame:
    """A new dimension from its fixed first day to the last shipment."""
    until = table(spark, folder, "lineitem").agg(F.to_date(F.max("l_shipdate")).alias("last"))
    return missing_date_rows(None, until, "last")


def date_dimension_stored(spark: SparkSession, folder: str) -> DataFrame:
    """A stored dimension, created, carried on to the last shipment, and then asked for no new day."""
    path = scratch_folder(spark, "dates")
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    last_order = orders.agg(F.to_date(F.max("o_orderdate")).alias("last"))
    last_shipment = lines.agg(F.to_date(F.max("l_shipdate")).alias("last"))
    for until in (last_order, last_shipment, last_order):
        extend_date_dimension(spark, path, until)
    return read_table(spark, path)


_MASK = "4294967295::HUGEINT"


def _rotl(x: str, bits: int) -> str:
    return f"((({x} << {bits}) & {_MASK}) | ({x} >> {32 - bits}))"


def date_rows_sql(days: str) -> str:
    """Dimension rows of the ``day`` column of a query, with Murmur3 in integer arithmetic."""
    return f"""
        WITH days AS ({days}),
        k0 AS (SELECT day, (date_diff('day', DATE '1970-01-01', day)::HUGEINT) & {_MASK} AS k FROM days),
        k1 AS (SELECT day, (k * 3432918353::HUGEINT) & {_MASK} AS k FROM k0),
        k2 AS (SELECT day, ({_rotl('k', 15)} * 461845907::HUGEINT) & {_MASK} AS k FROM k1),
        h0 AS (SELECT day, xor(42::HUGEINT, k) AS h FROM k2),
        h1 AS (SELECT day, ({_rotl('h', 13)} * 5 + 3864292196::HUGEINT) & {_MASK} AS h FROM h0),
        h2 AS (SELECT day, xor(h, 4::HUGEINT) AS h FROM h1),
        h3 AS (SELECT day, (xor(h, h >> 16) * 2246822507::HUGEINT) & {_MASK} AS h FROM h2),
        h4 AS (SELECT day, (xor(h, h >> 13) * 3266489909::HUGEINT) & {_MASK} AS h FROM h3),
        h5 AS (SELECT day, xor(h, h >> 16) AS h FROM h4)
        SELECT CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS id_data,
               CAST(day(day) AS INTEGER) AS qtd_dia, CAST(month(day) AS INTEGER) AS qtd_mes,
               CAST(year(day) AS INTEGER) AS qtd_ano, day AS dt_data
        FROM h5
    """


def days_sql(first: str, last: str) -> str:
    return f"SELECT CAST(unnest(generate_series(({first})::TIMESTAMP, ({last})::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day"


_FIRST_ORDER = "SELECT CAST(min(o_orderdate) AS DATE) FROM orders"
_LAST_ORDER = "SELECT CAST(max(o_orderdate) AS DATE) FROM orders"
_LAST_SHIPMENT = "SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem"

QUERIES = {
    "date_dimension": Query(date_dimension, date_rows_sql(days_sql(_FIRST_ORDER, _LAST_ORDER))),
    "date_dimension_extend": Query(date_dimension_extend, date_rows_sql(days_sql(_FIRST_ORDER, _LAST_SHIPMENT))),
    "date_dimension_stored": Query(
        date_dimension_stored,
        date_rows_sql(
            days_sql("SELECT DATE '2000-01-01'", "SELECT greatest(CAST(max(o_orderdate) AS DATE), (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)) FROM orders")
        ),
    ),
    "date_dimension_first": Query(date_dimension_first, date_rows_sql(days_sql("SELECT DATE '2000-01-01'", _LAST_SHIPMENT))),
}
