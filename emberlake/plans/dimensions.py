"""Area layers, area dimensions and the date dimension."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.geometry import SRID
from emberlake.functions.keys import date_key
from emberlake.functions.times import days_between
from emberlake.operators.shaping import alias_columns, distinct_rows, is_geometry, normalize_frame
from emberlake.sinks.tables import append_missing
from emberlake.sources.tables import read_table, table_exists

# Fixed value: first day of the date dimension.
FIRST_DAY = datetime.date(2000, 1, 1)


def clean_layer(layer: DataFrame, columns: Mapping[str, tuple[str, str]], srid: int = SRID) -> DataFrame:
    """Select, cast and rename layer attributes, drop repeated rows, normalise by type."""

    def cell(new: str, old: str, kind: str) -> Column:
        kept = layer.schema[old].metadata if is_geometry(layer.schema[old]) else None
        return F.col(old).try_cast(kind).alias(new, metadata=kept) if kept else F.col(old).try_cast(kind).alias(new)

    return normalize_frame(distinct_rows(layer.select(*[cell(n, *source) for n, source in columns.items()])), srid)


def build_dimension(trusted: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Trusted rows under the dimension's column names."""
    return alias_columns(trusted, names)


def date_rows(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Date dimension rows for every day between two columns of a one-row frame."""
    day = F.col("dt_data")
    return bounds.select(days_between(F.col(first), F.col(last)).alias("dt_data")).select(
        date_key(day).alias("id_data"),
        F.dayofmonth(day).alias("qtd_dia"),
        F.month(day).alias("qtd_mes"),
        F.year(day).alias("qtd_ano"),
        day,
    )


def missing_date_rows(existing: DataFrame | None, until: DataFrame, last: str, first_day=FIRST_DAY) -> DataFrame:
    """Rows for the days after the latest one in ``existing``, up to column ``last`` of a one-row frame.

    With no or an empty dimension they start at ``first_day``. Nothing is
    collected: both ends of the range are found inside the same query.
    """
    start = F.lit(first_day).cast("date")
    if existing is None:
        return date_rows(until.select(start.alias("first"), F.col(last).alias("last")), "first", "last")
    known = existing.agg(F.max("dt_data").alias("known"))
    # Both frames are one aggregate row.
    bounds = until.select(F.col(last).alias("last")).withColumn("known", known.scalar())
    return date_rows(bounds.withColumn("first", F.coalesce(F.date_add("known", 1), start)), "first", "last")


def extend_date_dimension(
    spark: SparkSession, path: str, as_of: datetime.date | DataFrame, first_day: datetime.date = FIRST_DAY
) -> None:
    """Add the missing days up to ``as_of``, a date or a one-row frame holding one."""
    if not isinstance(as_of, DataFrame):
        as_of = spark.range(1).select(F.lit(as_of).cast("date").alias("last"))
    existing = read_table(spark, path) if table_exists(spark, path) else None
    append_missing(missing_date_rows(existing, as_of, as_of.columns[0], first_day), path, ["id_data"])
