"""Raw hotspot feeds to the trusted table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.functions.keys import surrogate_key
from emberlake.functions.quality import band, code_of, coordinate_flags, null_outside
from emberlake.functions.times import EVENT_TIME_FORMAT, event_day_columns
from emberlake.operators.shaping import distinct_rows, normalize_frame, typed, union_by_name
from emberlake.schemas import HOTSPOT_KEY, HOTSPOT_PARTITIONS, RAW_HOTSPOT, READING_RANGES, YEARLY_NAMES
from emberlake.session import require_utc
from emberlake.sinks.tables import append_missing, upsert_table
from emberlake.sources.files import read_csv


def read_feeds(
    spark: SparkSession, daily: str, monthly: str | None = None, yearly: str | None = None
) -> DataFrame:
    """Raw rows of the given granularities in one layout; copies are left for the cleaning step."""
    frames = [read_csv(spark, daily, list(RAW_HOTSPOT))]
    if monthly:
        frames.append(read_csv(spark, monthly, list(RAW_HOTSPOT)))
    if yearly:
        frames.append(read_csv(spark, yearly, list(RAW_HOTSPOT), rename=YEARLY_NAMES))
    return union_by_name(*frames)


def typed_readings(
    raw: DataFrame,
    types: Mapping[str, str] = RAW_HOTSPOT,
    ranges: Mapping[str, tuple[float | None, float | None]] = READING_RANGES,
    time_formats: Sequence[str] = (EVENT_TIME_FORMAT,),
) -> DataFrame:
    """Raw cells in their types, readings outside their range as null."""
    rows = typed(raw, types, time_formats)
    return rows.withColumns({c: null_outside(F.col(c), low, high) for c, (low, high) in ranges.items()})


def keyed_distinct(rows: DataFrame, null_token: str | None = None, key: str = "id") -> DataFrame:
    """Distinct rows with the key over all their columns in front.

    The same rows as a dedup of keyed rows gives, but the key is computed after
    the shuffle: its digits do not compress and would be a third of what is
    moved. Rows of equal values have equal keys, except that grouping takes
    minus zero for zero while their texts differ; so the signs of zeros are
    carried through the dedup as bits.
    """
    doubles = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)]
    bits = {c: 1 << i for i, c in enumerate(doubles)}
    signs = F.lit(0)
    for c, bit in bits.items():
        minus_zero = (F.col(c) == 0) & F.col(c).cast("string").startswith("-")
        signs = signs + F.when(minus_zero, F.lit(bit)).otherwise(F.lit(0))
    distinct = distinct_rows(rows.withColumn("__signs", signs))

    def keyed(c: str) -> Column:
        value = F.col(c)
        return F.when(F.col("__signs").bitwiseAND(bits[c]) != 0, -value).otherwise(value) if c in bits else value

    return distinct.select(surrogate_key([keyed(c) for c in rows.columns], null_token).alias(key), *rows.columns)


def clean_hotspots(
    raw: DataFrame,
    null_token: str | None = None,
    time_formats: Sequence[str] = (EVENT_TIME_FORMAT,),
    types: Mapping[str, str] = RAW_HOTSPOT,
) -> DataFrame:
    """Raw rows as trusted rows: typed, deduplicated, keyed, normalised, validated.

    One shuffle, for the dedup; the rest is projections. The key is a hash of
    text: ``types`` are fixed before hashing and the session zone must be UTC, or
    the same reading would get another key. Dry days are hashed as double by
    default; give ``int`` to keep the keys of feeds that hold whole numbers.
    """
    require_utc(raw.sparkSession)
    rows = keyed_distinct(typed_readings(raw, types, time_formats=time_formats), null_token)
    rows = rows.withColumn("numero_dias_sem_chuva", F.col("numero_dias_sem_chuva").try_cast("int"))
    return normalize_frame(rows).withColumns(
        {
            "fire_risk_category": band(F.col("risco_fogo")),
            **coordinate_flags(F.col("lat"), F.col("lon")),
            "sigla_estado": code_of(F.col("estado")),
            **event_day_columns(F.col("data_hora_gmt")),
        }
    )


def load_hotspots(trusted: DataFrame, path: str, whole_rows_keyed: bool = False) -> None:
    """First load writes the table by year and month, later ones merge on the key.

    A key covers all readings, so a matched row normally equals its source and
    a corrected reading comes in as a new row. If keys were made with a null
    token (``whole_rows_keyed=True``) this holds without exception and new rows
    are appended without rewriting a partition. Without one, two rows that
    differ only in which of two neighbouring readings is null have one key:
    that raises, on the first load as on later ones, and a null token mends it.
    """
    if whole_rows_keyed:
        append_missing(trusted, path, HOTSPOT_KEY, HOTSPOT_PARTITIONS)
    else:
        upsert_table(trusted, path, HOTSPOT_KEY, HOTSPOT_PARTITIONS, keys_fix_partition=True)
