"""Time and date expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of event times in feeds and in the high-water mark.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Text that begins with year, month and day.
FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T]|\s*$)"


def parse_timestamp(text: Column, formats: Sequence[str] = (EVENT_TIME_FORMAT,)) -> Column:
    """First layout that fits, then any text that begins with a full date; else null (bad cells must not stop a load).

    A lone time or year is no event time: the cast would take them for today or for a year's first day.
    """
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tries, F.when(text.cast("string").rlike(FULL_DATE), text.try_cast("timestamp")))


def mark_text(moment: Column) -> Column:
    """Timestamp as high-water mark text."""
    return F.date_format(moment, EVENT_TIME_FORMAT)


def day_number(moment: Column) -> Column:
    """Date or timestamp as yyyyMMdd number."""
    return F.date_format(moment, "yyyyMMdd").cast("int")


def event_day_columns(moment: Column) -> dict[str, Column]:
    """Day, year and month columns of an event time."""
    return {"dt_data": F.to_date(moment), "year": F.year(moment), "month": F.month(moment)}


def days_between(first: Column, last: Column) -> Column:
    """One row per day, both ends included; no row if ``last`` is before ``first`` or either is null."""
    step = F.expr("interval 1 day")
    return F.explode(F.when(first <= last, F.sequence(first, last, step)))
