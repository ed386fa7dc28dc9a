"""The daily ingest as a file stream.

The stream's checkpoint remembers which files were read. It stands in for the
high-water mark, so files that arrive late for a loaded day are not lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from emberlake.schemas import RAW_HOTSPOT


def stream_csv(
    spark: SparkSession, folder: str, columns: Sequence[str] = tuple(RAW_HOTSPOT), files_per_batch: int | None = None
) -> DataFrame:
    """Rows of unseen CSV files as text; ``columns`` must be the files' header, in order."""
    reader = spark.readStream.option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(folder)


def append_available(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append all rows available now to a raw table, each file once, and stop.

    A restarted run goes on where the last complete batch ended. The table is
    raw: cleaning and merging read it as a batch.
    """
    writer = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
