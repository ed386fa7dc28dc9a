"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A query over the tables of a folder, and equivalent SQL where SQL can say it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def registry() -> dict[str, Query]:
    """All queries by name."""
    from emberlake.queries import areas, cleaning, dates, feeds, geo, hotspots, stars, stored

    found: dict[str, Query] = {}
    for module in (stars, cleaning, dates, stored, feeds, geo, areas, hotspots):
        found.update(module.QUERIES)
    return found
