"""Daily ingest: files newer than the high-water mark, and the mark after them."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberlake.functions.times import mark_text, parse_timestamp
from emberlake.schemas import RAW_HOTSPOT
from emberlake.sources.files import list_files, read_csv, require_dated
from emberlake.sources.marks import FIELD, read_mark, store_mark


# How long the report of a finished job may take to arrive.
REPORT_SECONDS = 20


def new_rows(
    spark: SparkSession,
    folder: str | Sequence[str],
    mark_path: str,
    columns: Sequence[str] = tuple(RAW_HOTSPOT),
    inclusive: bool = False,
    undated: str = "raise",
) -> DataFrame:
    """Raw rows of the files whose day is after the mark; all files before the first load.

    Files whose name carries no day raise, on the first load too; ``undated="load"`` takes them every time.
    """
    if undated not in ("raise", "load"):
        raise ValueError(f'undated must be "raise" or "load", not {undated}')
    if undated == "raise":
        require_dated(list_files(spark, folder, suffix=""), "name")
    mark = read_mark(spark, mark_path)
    newer_than = mark[1] if mark else None
    return read_csv(spark, folder, columns, newer_than=newer_than, inclusive=inclusive, undated=undated == "load")


def next_mark(rows: DataFrame, time_column: str, previous: str | None) -> DataFrame:
    """One row: the larger of the previous mark and the latest event time in ``rows``."""
    latest = mark_text(F.max(parse_timestamp(F.col(time_column))))
    return rows.agg(F.greatest(latest, F.lit(previous).cast("string")).alias(FIELD))


def ingest(
    spark: SparkSession,
    folder: str | Sequence[str],
    mark_path: str,
    load: Callable[[DataFrame], None],
    columns: Sequence[str] = tuple(RAW_HOTSPOT),
    time_column: str = "data_hora_gmt",
    inclusive: bool = False,
    undated: str = "raise",
) -> None:
    """Load new rows with ``load``, then advance the mark.

    The mark moves only after the load has been written, so an interrupted run
    repeats its files. It is the latest event time, as text of whole seconds,
    observed while the load's first job passes over the rows, so the files are
    parsed once. A first job that stops early leaves a lower mark, and files
    are repeated; a load that runs no job on the rows costs a pass of their own.
    """
    mark = read_mark(spark, mark_path)
    rows = new_rows(spark, folder, mark_path, columns, inclusive, undated)
    seen = Observation()
    load(rows.observe(seen, mark_text(F.max(parse_timestamp(F.col(time_column)))).alias(FIELD)))
    previous = mark[0] if mark else None
    found = _observed(seen)
    latest = found[FIELD] if found is not None else next_mark(rows, time_column, None).first()[0]
    advanced = max((m for m in (latest, previous) if m is not None), default=None)
    if advanced is not None:
        store_mark(spark, advanced, mark_path)


def _observed(seen: Observation) -> dict | None:
    """What was observed; None if no job has passed over the frame. The report arrives shortly after its job."""
    found: list[dict] = []
    waiting = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
    waiting.start()
    waiting.join(REPORT_SECONDS)
    return found[0] if found else None
