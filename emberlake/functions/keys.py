"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(columns: Sequence[Column], null_token: str | None = None) -> Column:
    """Upper-case md5 over the ``_``-joined text of ``columns``.

    Nulls are skipped by default, so (null, 1) and (1, null) share a key; a
    ``null_token`` keeps them apart at the price of different keys.
    """
    texts = [c.cast("string") for c in columns]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.upper(F.md5(F.concat_ws("_", *texts)))


def date_key(day: Column) -> Column:
    """Murmur3 of the day number (seed 42): a bijection on dates, may be negative."""
    return F.hash(day.cast("date"))
