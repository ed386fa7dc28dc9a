"""Merge (upsert) of two frames by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from emberlake.operators.lookup import BROADCAST_BYTES, sized


def missing_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``; only key columns of ``target`` are read.

    The keys that both hold are found first, with the smaller side's keys broadcast if their measured size allows, so
    that the target's keys need not be shuffled; the anti join then meets only those.
    """
    known = target.select(*keys).join(sized(source.select(*keys), limit), list(keys), "left_semi")
    return source.join(sized(known, limit), list(keys), "left_anti")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """``target`` with matched rows replaced by, and unmatched ones taken from, ``source``.

    Keys of ``source`` must be unique. A null key matches nothing, so such
    source rows are always added.
    """
    kept = target.join(sized(source.select(*keys), limit), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))
