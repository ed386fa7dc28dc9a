"""Writes to lake tables: overwrite, partitioned overwrite, append of new keys, upsert.

Every write adds folders that no version names yet and then one small file that makes them the table's (see
``emberlake.sources.tables``). So a run that dies changes nothing, readers see one version or the next, and the driver's
work grows with the partitions written, not with files. One writer at a time; a second one that commits first raises.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Collection, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from emberlake.operators.lookup import require_unique, sized
from emberlake.operators.merge import merge_rows, missing_rows
from emberlake.session import materialised
from emberlake.sources.tables import (
    VERSION_COLUMN,
    VERSIONS,
    Version,
    current_version,
    file_system,
    paths_like,
    read_folders,
    read_table,
    table_exists,
    version_file,
    version_numbers,
    version_of,
)

# Versions before the current one whose folders stay, for readers under way.
KEPT_VERSIONS = 2
# Folders that merges and appends may leave in one partition before the next merge joins them.
CROWDED = 8


class ConcurrentWriteError(RuntimeError):
    """Another writer committed to the table first."""


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value for writing.

    A rebalance, not a plain repartition: adaptive execution splits a value
    that holds much of the data over many tasks and joins small ones, so
    neither one huge task nor thousands of tiny files arise.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    sources: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Replace all rows of a table, which ``df`` may read.

    ``sort_by`` orders rows within each file so that scans filtering on those
    columns skip row groups. A run that dies leaves the old rows; a reader
    under way goes on reading them. ``sources`` is kept with the version.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    before = current_version(spark, path)
    folders = _write(df, path, partition_by, sort_by)
    number = before.number + 1 if before else 0
    _commit(spark, path, Version(number, df.schema, tuple(partition_by), tuple(folders), sources or {}))


def replace_folders(
    df: DataFrame, path: str, version: Version, stale: Collection[str], sort_by: Sequence[str], sources: Mapping[str, Sequence[str]]
) -> None:
    """Replace the partitions ``stale`` (such as ``year=2024/month=1``) of a version by the rows of ``df``.

    ``df`` holds no rows of other partitions, and a stale one that it has no rows of is gone. Folders of the others are
    neither read nor written.
    """
    path = path.rstrip("/")
    written = _write(df, path, version.partition_by, sort_by)
    kept = [f for f in version.folders if f.rpartition("/")[0] not in stale]
    _commit(df.sparkSession, path, Version(version.number + 1, df.schema, version.partition_by, (*kept, *written), sources))


def _partition_text(names: Sequence[str]) -> Column:
    """Partition values as one text, nulls apart from every value."""
    return F.concat_ws("\1", *[F.coalesce(F.col(n).cast("string"), F.lit("\2")) for n in names])


def _only_partitions(df: DataFrame, names: Sequence[str], values: Sequence[Row]) -> DataFrame:
    """``df`` limited to listed partitions, by one set lookup that reads partition columns only and so prunes."""
    texts = ["\1".join("\2" if row[f"__{n}"] is None else row[f"__{n}"] for n in names) for row in values]
    return df.filter(_partition_text(names).isin(texts) if texts else F.lit(False))


def _partitions(df: DataFrame, names: Sequence[str]) -> list[Row]:
    """Distinct partition values of ``df`` as text; the driver plans a scan with as many folder names."""
    return df.select(*[F.col(n).cast("string").alias(f"__{n}") for n in names]).distinct().collect()


def _versioned(spark: SparkSession, path: str, partition_by: Sequence[str]) -> Version:
    """The table's version; a folder that another writer filled, or one of other partitions, is first rewritten."""
    version = current_version(spark, path)
    if version is None or version.partition_by != tuple(partition_by):
        overwrite_table(read_table(spark, path), path, partition_by)
        version = current_version(spark, path)
    return version


def _typed_as(source: DataFrame, version: Version) -> DataFrame:
    """The source's rows under the table's columns and types."""
    types = {f.name: f.dataType for f in version.schema.fields}
    return source.select(*[F.col(n) if source.schema[n].dataType == t else F.col(n).cast(t).alias(n) for n, t in types.items()])


def append_missing(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Add the rows whose key the table lacks and leave all others alone.

    Reads only key columns of the partitions that ``source`` touches and
    rewrites nothing. Equal keys must imply equal partition values. Duplicate
    source keys raise, on the first load too. Repeating an interrupted call
    adds what was missing; without new keys nothing is written.
    """
    path, spark = path.rstrip("/"), source.sparkSession
    with materialised(source, "append") as fresh:
        require_unique(fresh, keys, "source")
        if not table_exists(spark, path):
            overwrite_table(fresh, path, partition_by)
            return
        version = _versioned(spark, path, partition_by)
        target = read_folders(spark, path, version, version.folders)
        if partition_by:
            target = _only_partitions(target, partition_by, _partitions(fresh, partition_by))
        with materialised(missing_rows(_typed_as(fresh, version), target, keys), "append-new") as rows:
            if rows.isEmpty():
                return
            folders = _write(rows, path, partition_by)
        _commit(spark, path, Version(version.number + 1, version.schema, version.partition_by, (*version.folders, *folders)))


def upsert_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    keys_fix_partition: bool = False,
) -> None:
    """Merge ``source`` into a table: matched rows are replaced, unmatched ones added.

    A table that does not exist yet is created from ``source`` as it is. Source
    rows that the table holds as they are, found by hashes of their columns,
    are put aside first; without any other row nothing is written. Folders that
    hold keys of the others are rewritten; new keys get folders of their own,
    and partitions without changes are left alone. Comparing reads the whole
    table; ``keys_fix_partition=True`` limits it to the source's partitions
    where a key can occur in one partition only. Duplicate source keys raise,
    on the first load too. A null key matches nothing, so such rows are always
    added. A run that dies changes nothing.
    """
    path, spark = path.rstrip("/"), source.sparkSession
    with materialised(source, "upsert") as fresh:
        require_unique(fresh, keys, "source")
        if not table_exists(spark, path):
            overwrite_table(fresh, path, partition_by)
            return
        version = _versioned(spark, path, partition_by)
        target = read_folders(spark, path, version, version.folders)
        if partition_by and keys_fix_partition:
            target = _only_partitions(target, partition_by, _partitions(fresh, partition_by))
        with materialised(_changed(_typed_as(fresh, version), target, keys), "upsert-changed") as changed:
            if changed.isEmpty():
                return
            hit = {*_folders_with(target, changed, keys, path, version), *_crowded(version)}
            kept = read_folders(spark, path, version, sorted(hit))
            folders = _write(merge_rows(kept, changed, keys) if hit else changed, path, partition_by)
        rest = [f for f in version.folders if f not in hit]
        _commit(spark, path, Version(version.number + 1, version.schema, version.partition_by, (*rest, *folders)))


def _changed(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that the target lacks or holds with other values; rows are compared by key and hash."""
    others = [c for c in source.columns if c not in keys]
    digest = F.xxhash64(*others) if others else F.lit(0).cast("long")
    hashed = source.withColumn("__hash", digest)
    return missing_rows(hashed, target.withColumn("__hash", digest), [*keys, "__hash"]).select(*source.columns)


def _folders_with(target: DataFrame, rows: DataFrame, keys: Sequence[str], path: str, version: Version) -> list[str]:
    """The version's folders in which keys of ``rows`` occur; as many names as there are folders reach the driver."""
    if not version.folders:
        return []
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1).alias("folder")
    held = target.select(*keys, folder).join(sized(rows.select(*keys)), list(keys), "left_semi")
    depth = len(version.partition_by) + 1
    names = {"/".join(unquote(r.folder).split("/")[-depth:]) for r in held.select("folder").distinct().collect()}
    return [f for f in version.folders if f in names]


def _crowded(version: Version) -> list[str]:
    """Folders of partitions that have many."""
    count = Counter(f.rpartition("/")[0] for f in version.folders)
    return [f for f in version.folders if count[f.rpartition("/")[0]] >= CROWDED]


def _write(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> list[str]:
    """Write rows to folders of a fresh name; the folders, below ``path``."""
    name = uuid.uuid4().hex[:16]
    own = f"{VERSION_COLUMN}={name}"
    rows = laid_out(df, partition_by)
    if not partition_by:
        if sort_by:
            rows = rows.sortWithinPartitions(*sort_by)
        rows.write.parquet(f"{path}/{own}")
        return [own]
    label = F.lit(name)
    if sort_by:
        # The writer wants rows by all folder columns. A constant would leave the order, and the writer sort again.
        label = F.concat(label, F.substring(F.monotonically_increasing_id().cast("string"), 1, 0))
    rows = rows.withColumn(VERSION_COLUMN, label)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, VERSION_COLUMN, *sort_by)
    rows.write.mode("append").partitionBy(*partition_by, VERSION_COLUMN).parquet(path)
    found = paths_like(df.sparkSession, f"{path}/{'*/' * len(partition_by)}{own}")
    return sorted("/".join(p.split("/")[-len(partition_by) - 1 :]) for p in found)


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    """Make a version the table by one rename, then remove what no kept version names."""
    fs, target = file_system(spark, version_file(path, version.number))
    if fs.exists(target):
        raise ConcurrentWriteError(f"version {version.number} of {path} has been written by another run")
    _, draft = file_system(spark, f"{path}/{VERSIONS}/.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(bytearray(version.to_json().encode()))
    stream.close()
    if not fs.rename(draft, target):
        raise ConcurrentWriteError(f"version {version.number} of {path} could not be put in place")
    clean_versions(spark, path)


def clean_versions(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Remove folders that neither the current version nor the ``keep`` ones before it name.

    Those of writes that died are among them. Readers of still older versions fail. Files that another writer put there
    before the first version go too.
    """
    numbers = version_numbers(spark, path)
    versions = [version_of(spark, path, n) for n in numbers[-keep - 1 :]]
    if not versions:
        return
    named = {f for v in versions for f in v.folders}
    for depth in {len(v.partition_by) for v in versions}:
        for found in paths_like(spark, f"{path}/{'*/' * depth}{VERSION_COLUMN}=*"):
            if "/".join(found.split("/")[-depth - 1 :]) not in named:
                _remove(spark, found)
    if numbers[0] == 0 and len(numbers) == 1:
        _remove_foreign(spark, path, len(versions[0].partition_by))
    for number in numbers[: -keep - 1]:
        _remove(spark, version_file(path, number))


def _remove_foreign(spark: SparkSession, path: str, depth: int) -> None:
    """Remove data files that lie beside the folders of the first version."""
    for level in range(depth + 1):
        for found in paths_like(spark, f"{path}/{'*/' * level}*.{{parquet,json,csv}}"):
            if f"/{VERSIONS}/" not in found and f"{VERSION_COLUMN}=" not in found:
                _remove(spark, found)


def _remove(spark: SparkSession, path: str) -> None:
    fs, handle = file_system(spark, path)
    fs.delete(handle, True)
