"""Figures over a filtered star: headline row, group counts, shares, option lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_value(df: DataFrame, column: str) -> DataFrame:
    """One row with the largest value of ``column``."""
    return df.agg(F.max(column).alias(column))


def headline(df: DataFrame, distinct: Mapping[str, str], means: Mapping[str, str], total: str = "total") -> DataFrame:
    """One row: row count, distinct counts (nulls excluded) and means (nulls skipped).

    Rows are first grouped by the counted columns with partial sums, so several
    distinct counts need one pass; the usual plan would copy each row once per
    distinct column before the shuffle.
    """
    keys = list(dict.fromkeys(distinct.values()))
    sums = []
    for i, column in enumerate(means.values()):
        sums += [F.sum(column).alias(f"__sum{i}"), F.count(column).alias(f"__n{i}")]
    grouped = df.groupBy(*keys).agg(F.count("*").alias("__rows"), *sums)
    figures = [F.coalesce(F.sum("__rows"), F.lit(0).cast("long")).alias(total)]
    figures += [F.count_distinct(column).alias(name) for name, column in distinct.items()]
    for i, name in enumerate(means):
        n = F.sum(f"__n{i}")
        figures.append(F.when(n > 0, F.sum(f"__sum{i}") / n).cast("double").alias(name))
    return grouped.agg(*figures)


def count_by(df: DataFrame, key: str | Column, counted: str, name: str, alias: str = "key") -> DataFrame:
    """Count of non-null ``counted`` per non-null key, in key order."""
    label = F.col(key).alias(key) if isinstance(key, str) else key.alias(alias)
    keyed = df.select(label, F.col(counted).alias("__counted"))
    group = keyed.columns[0]
    counts = keyed.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count("__counted").alias(name))
    return counts.orderBy(group)


def with_share(counts: DataFrame, count: str, share: str = "share") -> DataFrame:
    """Adds each count's part of the total, a scalar subquery over the same counts; null if the total is zero."""
    whole = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.try_divide(F.col(count), whole))


def count_charts(df: DataFrame, keys: Mapping[str, Column], counted: str) -> DataFrame:
    """Counts per key for several charts in one pass over ``df``.

    Long form (chart, key, n, share). Raw rows are first collapsed to one row
    per combination of keys; only those are regrouped per chart.
    """
    names = list(keys)
    cells = df.select(*[c.cast("string").alias(n) for n, c in keys.items()], F.col(counted).alias("__counted"))
    cells = cells.groupBy(*names).agg(F.count("__counted").alias("__n"))
    entries = F.array(*[F.struct(F.lit(n).alias("chart"), F.col(n).alias("key")) for n in names])
    long = cells.select(F.inline(entries), "__n").filter(F.col("key").isNotNull())
    counts = long.groupBy("chart", "key").agg(F.sum("__n").alias("n"))
    wholes = counts.groupBy("chart").agg(F.sum("n").alias("__whole"))
    # One row per chart, and there are as many charts as entries in ``keys``.
    shared = counts.join(F.broadcast(wholes), "chart").withColumn("share", F.try_divide("n", "__whole"))
    return shared.drop("__whole").orderBy("chart", "key")


def options(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Distinct values of ``columns`` in order of ``label``."""
    rest = [c for c in columns if c != label]
    return df.select(*columns).distinct().orderBy(label, *rest)


def pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """The (x, y) points of a scatter chart: rows that have both values."""
    return df.select(x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
