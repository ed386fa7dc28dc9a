"""The high-water mark: the latest event time loaded so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.times import day_number, mark_text, parse_timestamp
from emberlake.sources.tables import table_exists

FIELD = "last_date"


def read_mark(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """Mark as text and as yyyyMMdd number; None before the first load."""
    if not table_exists(spark, path):
        return None
    marks = spark.read.schema(f"{FIELD} string").json(path, multiLine=True)
    moment = parse_timestamp(F.col(FIELD))
    row = marks.filter(moment.isNotNull()).select(FIELD, day_number(moment)).orderBy(F.desc(FIELD)).first()
    return (row[0], row[1]) if row else None


def latest(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest event time as mark text."""
    return df.agg(mark_text(F.max(column)).alias(FIELD))


def store_mark(spark: SparkSession, text: str, path: str) -> None:
    """Replace the mark by a text already computed."""
    write_mark(spark.createDataFrame([(text,)], f"{FIELD} string"), path)


def write_mark(mark: DataFrame, path: str) -> None:
    """Replace the mark. If this is interrupted the next load takes every file again, which merging makes harmless."""
    mark.select(FIELD).coalesce(1).write.mode("overwrite").json(path)
