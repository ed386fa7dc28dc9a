"""Projection, union, dedup and type-driven normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.functions import geometry, text, times


def conform(df: DataFrame, columns: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Rename to the canonical layout and keep its columns only, in order."""
    return df.withColumnsRenamed(dict(rename or {})).select(*columns)


def alias_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project ``names`` (new name to old name) without changing values."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def typed(df: DataFrame, types: Mapping[str, str], time_formats: Sequence[str] = (times.EVENT_TIME_FORMAT,)) -> DataFrame:
    """Cast columns by name; a cell that does not fit its type becomes null."""

    def cast(name: str, kind: str) -> Column:
        if kind == "timestamp" and isinstance(df.schema[name].dataType, T.StringType):
            return times.parse_timestamp(F.col(name), time_formats)
        return F.col(name).try_cast(kind)

    return df.select(*[cast(name, kind).alias(name) for name, kind in types.items()])


def nulled_cells(
    df: DataFrame, types: Mapping[str, str], time_formats: Sequence[str] = (times.EVENT_TIME_FORMAT,)
) -> DataFrame:
    """One row with, per column, how many non-null cells ``typed`` turns into null."""
    marked = df.select(*[F.col(n).alias(f"raw_{n}") for n in types], *[F.col(n) for n in types])
    pairs = typed(marked, {**{f"raw_{n}": "string" for n in types}, **types}, time_formats)
    lost = [F.count_if(F.col(f"raw_{n}").isNotNull() & F.col(n).isNull()).alias(n) for n in types]
    return pairs.agg(*lost)


def union_by_name(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Bag union matched on column names."""
    for other in rest:
        first = first.unionByName(other)
    return first


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup; copies collapse within each input task before the shuffle."""
    return df.dropDuplicates()


def is_geometry(field: T.StructField) -> bool:
    """Whether column metadata marks the binary column as geometry."""
    return isinstance(field.dataType, T.BinaryType) and field.metadata.get("geometry") == "ewkb"


def normalize_frame(df: DataFrame, srid: int = geometry.SRID) -> DataFrame:
    """Transform every column by its type in one projection.

    Strings are folded and upper-cased (keys in text form too), geometry goes
    to ``srid``; timestamps and everything else pass unchanged.
    """
    columns = []
    for field in df.schema.fields:
        name = field.name
        if isinstance(field.dataType, T.StringType):
            columns.append(text.normalize_string(F.col(name)).alias(name))
        elif is_geometry(field):
            moved = geometry.transform(F.col(name), field.metadata.get("srid") or srid, srid)
            columns.append(moved.alias(name, metadata=geometry.geometry_label(srid)))
        else:
            columns.append(F.col(name))
    return df.select(*columns)
