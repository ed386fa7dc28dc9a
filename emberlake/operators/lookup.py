"""Joins from a large table to dimensions, with a measured choice of strategy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if its measured in-memory size is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024

# File estimates are compressed sizes: beyond this many times the limit a
# side is not even measured.
_ESTIMATE_FACTOR = 4

# Sizes of whole dimensions by frame, then by columns and keys. A frame keeps the files it was planned with, so its sizes
# hold as long as it does; a frame read anew is measured anew.
_MEASURED: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()

# Per-row cost of a hashed relation (row header, pointers, hash slot).
_ROW_OVERHEAD = 64


class DuplicateKeyError(ValueError):
    """A key that must be unique is not."""


@dataclass(frozen=True)
class Size:
    """Row count and in-memory size of a frame, and most rows that share one key."""

    rows: int
    bytes: int
    copies: int


def _row_bytes(df: DataFrame) -> Column | None:
    """Bytes of one row, or None if a column type has no simple size."""
    total: Column = F.lit(_ROW_OVERHEAD + 8 * len(df.schema.fields))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return None
    return total.cast("long")


def _too_large_to_measure(df: DataFrame, limit: int) -> bool:
    """Whether the optimiser's own size estimate already rules a broadcast out."""
    try:
        estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except AttributeError:  # no JVM handle on a remote session
        return False
    return estimate > _ESTIMATE_FACTOR * limit


def _size_row(df: DataFrame, keys: Sequence[str], number: int) -> DataFrame | None:
    """One row (number, rows, bytes, copies), or None if rows have no simple size."""
    per_row = _row_bytes(df)
    if per_row is None:
        return None
    if keys:
        complete = F.lit(True)
        for k in keys:
            complete = complete & F.col(k).isNotNull()
        df = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(per_row).alias("b"))
        figures = F.sum("n"), F.sum("b"), F.max(F.when(complete, F.col("n")))
    else:
        figures = F.count("*"), F.sum(per_row), F.lit(None).cast("long")
    named = [F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in zip(("rows", "bytes", "copies"), figures)]
    return df.agg(*named).select(F.lit(number).alias("number"), "*")


def measure_all(sides: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[Size | None]:
    """Sizes of several frames in one job of one row each; with keys, also the most rows per non-null key."""
    rows = [r for r in (_size_row(df, keys, i) for i, (df, keys) in enumerate(sides)) if r is not None]
    found = {r.number: Size(r.rows, r.bytes, r.copies) for r in reduce(DataFrame.union, rows).collect()} if rows else {}
    return [found.get(i) for i in range(len(sides))]


def measure(df: DataFrame, keys: Sequence[str] = ()) -> Size | None:
    """Size of one frame."""
    return measure_all([(df, keys)])[0]


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise unless every non-null key of ``df`` occurs once."""
    narrow = df.select(*keys).dropna(subset=list(keys))
    worst = narrow.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if worst:
        raise DuplicateKeyError(f"{what}: key {tuple(keys)} is not unique, e.g. {tuple(worst[0][k] for k in keys)}")


def _hinted(df: DataFrame, size: Size | None, limit: int) -> DataFrame:
    return F.broadcast(df) if size is not None and size.bytes <= limit else df


def sized(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if its measured size allows; else left to a shuffled join."""
    return df if _too_large_to_measure(df, limit) else _hinted(df, measure(df), limit)


@dataclass(frozen=True)
class Dimension:
    """One side of a star join.

    ``on`` pairs columns of the large table with key columns of ``frame``;
    ``take`` names the output columns (new name to dimension column);
    ``where`` filters the dimension before it is measured and joined.
    """

    frame: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str] = field(default_factory=dict)
    where: Column | None = None


def _keys(dim: Dimension) -> list[str]:
    return [f"__key{i}" for i in range(len(dim.on))]


def _side(dim: Dimension) -> DataFrame:
    """The dimension filtered and pruned to its keys and the columns taken."""
    frame = dim.frame if dim.where is None else dim.frame.filter(dim.where)
    keys = [F.col(column).alias(key) for key, column in zip(_keys(dim), dim.on.values())]
    return frame.select(*keys, *[F.col(old).alias(new) for new, old in dim.take.items()])


def _columns(dim: Dimension) -> tuple[str, ...]:
    """What the size of a side without its filter depends on."""
    return tuple(sorted([*dim.on.values(), *dim.take.values()]))


def _recalled(dim: Dimension, unique: bool) -> Size | None:
    """The size of the dimension without its filter, if it was measured; with the copies of its keys if ``unique``."""
    known = _MEASURED.get(dim.frame, {}).get(_columns(dim), {})
    return known.get(tuple(dim.on.values())) if unique else next(iter(known.values()), None)


def _suffices(size: Size | None, unique: bool, limit: int) -> bool:
    """Whether the figures of a whole dimension settle those of any part of it."""
    return size is not None and size.bytes <= limit and not (unique and size.copies > 1)


def _sizes(dims: Sequence[Dimension], sides: Sequence[DataFrame], unique: bool, limit: int) -> dict[int, Size | None]:
    """Sizes of the sides that are worth measuring, by place.

    A dimension is measured without its filter once and the figures are kept with its frame: a small one with unique
    keys stays so under any filter. Only where they do not settle the matter is the filtered side measured.
    """
    asked = [i for i, side in enumerate(sides) if unique or not _too_large_to_measure(side, limit)]
    sizes = {i: _recalled(dims[i], unique) for i in asked}
    wholes = {i: _side(Dimension(dims[i].frame, dims[i].on, dims[i].take)) for i in asked if sizes[i] is None}
    wholes = {i: whole for i, whole in wholes.items() if dims[i].where is None or not _too_large_to_measure(whole, limit)}
    for i, size in zip(wholes, measure_all([(w, _keys(dims[i]) if unique else ()) for i, w in wholes.items()])):
        sizes[i] = size
        if size is not None:
            known = _MEASURED.setdefault(dims[i].frame, {}).setdefault(_columns(dims[i]), {})
            known[tuple(dims[i].on.values()) if unique else ()] = size
    parts = [i for i in asked if dims[i].where is not None and not _suffices(sizes[i], unique, limit)]
    sizes.update(zip(parts, measure_all([(sides[i], _keys(dims[i]) if unique else ()) for i in parts])))
    return sizes


def star_join(
    facts: DataFrame,
    dims: Sequence[Dimension],
    how: str = "inner",
    where: Column | None = None,
    unique: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``facts`` filtered by ``where`` and equi-joined to each dimension in turn.

    Dimensions are measured together in one small job, and not again when
    the same frames are joined later. Each that is proven small is broadcast;
    for any other both sides shuffle on the key and adaptive execution splits
    the hot ones. ``unique=True`` also raises if a
    dimension key would multiply rows, in the same job.
    """
    sides = [_side(d) for d in dims]
    sizes = _sizes(dims, sides, unique, limit)
    joined = facts if where is None else facts.filter(where)
    for i, (dim, side) in enumerate(zip(dims, sides)):
        size, keys = sizes.get(i), _keys(dim)
        if unique and size is None:
            require_unique(side, keys, "dimension")
        elif unique and size.copies > 1:
            raise DuplicateKeyError(f"dimension key {tuple(dim.on.values())} occurs up to {size.copies} times")
        side = _hinted(side, size, limit)
        match = [joined[column] == side[key] for column, key in zip(dim.on, keys)]
        joined = joined.join(side, match, how).drop(*keys)
    return joined


def lookup_join(
    facts: DataFrame, dim: Dimension, how: str = "left", unique: bool = False, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``facts`` equi-joined to one dimension."""
    return star_join(facts, [dim], how, None, unique, limit)


def unmatched_counts(joined: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per dimension id with the number of left-joined rows that found no partner.

    One pass over the joined rows counts all dimensions; no anti join per dimension.
    """
    counts = joined.agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in ids])
    entries = F.array(
        *[F.struct(F.lit(c).alias("dimension"), (F.col("total") - F.col(c)).alias("unmatched")) for c in ids]
    )
    return counts.select(F.inline(entries))
