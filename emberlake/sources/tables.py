"""Lake tables and SQL over them.

A table that the library writes has versions. Each write puts its files into folders of their own,
``year=2024/month=1/__version=x``, below the partitions it touches, and then adds one small file to ``_versions`` that
lists the folders of the whole table, its schema and its partition columns. The file of the highest number is the
table; a reader looks it up once and reads those folders, whatever is written meanwhile.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMAT = "parquet"
VERSIONS = "_versions"
VERSION_COLUMN = "__version"


@dataclass(frozen=True)
class Version:
    """What a table consists of: folders below its path, each with the files of one write to one partition.

    ``sources`` holds, by name, the folders of the tables that a derived table was built from; empty if not told.
    """

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    folders: tuple[str, ...]
    sources: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def to_json(self) -> str:
        whole = {"schema": self.schema.jsonValue(), "partition_by": self.partition_by, "folders": self.folders}
        whole["sources"] = {name: sorted(folders) for name, folders in self.sources.items()}
        return json.dumps(whole)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of ``path``, and the path as its object."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    fs, handle = file_system(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(handle) or ()]


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are still kept, in order."""
    names = (p.rpartition("/")[2] for p in paths_like(spark, f"{path}/{VERSIONS}/*.json"))
    return sorted(int(n.partition(".")[0]) for n in names)


def version_file(path: str, number: int) -> str:
    return f"{path}/{VERSIONS}/{number:012d}.json"


def version_of(spark: SparkSession, path: str, number: int) -> Version:
    fs, handle = file_system(spark, version_file(path, number))
    stream = fs.open(handle)
    try:
        whole = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    schema = T.StructType.fromJson(whole["schema"])
    return Version(number, schema, tuple(whole["partition_by"]), tuple(whole["folders"]), whole.get("sources", {}))


def current_version(spark: SparkSession, path: str) -> Version | None:
    """The table's version now; None for a folder that another writer filled."""
    numbers = version_numbers(spark, path)
    return version_of(spark, path, numbers[-1]) if numbers else None


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written to ``path``; decides between full and incremental load."""
    fs, handle = file_system(spark, path)
    if not fs.exists(handle):
        return False
    if version_numbers(spark, path):
        return True
    # Folders of a first write that died belong to no version.
    names = [s.getPath().getName() for s in fs.listStatus(handle)]
    return any(not n.startswith(("_", ".")) for n in names)


def read_folders(spark: SparkSession, path: str, version: Version, folders: Iterable[str]) -> DataFrame:
    """Rows of some of a version's folders, partition columns last."""
    names = [f.name for f in version.schema.fields if f.name not in version.partition_by] + list(version.partition_by)
    paths = [f"{path}/{f}" for f in folders]
    if not paths:
        return spark.createDataFrame([], version.schema).select(*names)
    schema = T.StructType([*version.schema.fields, T.StructField(VERSION_COLUMN, T.StringType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*names)


def read_table(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """A lake table as DataFrame, in the version it has now; folders of other writers are read as they are."""
    path = path.rstrip("/")
    version = current_version(spark, path) if fmt == FORMAT else None
    return spark.read.format(fmt).load(path) if version is None else read_folders(spark, path, version, version.folders)


def read_version(spark: SparkSession, path: str) -> tuple[DataFrame, Version | None]:
    """A lake table and the version that was read; None for folders of other writers."""
    path = path.rstrip("/")
    version = current_version(spark, path)
    found = spark.read.format(FORMAT).load(path) if version is None else read_folders(spark, path, version, version.folders)
    return found, version


def query(spark: SparkSession, tables: Mapping[str, DataFrame], text: str, **args) -> DataFrame:
    """SQL over frames, named in braces (``FROM {orders}``); values are bound as ``:name`` parameters, never pasted in.

    The frames are views of this call only, so no view of the session is replaced.
    """
    return spark.sql(text, args=args, **tables)
