"""Vector layers: .shp, .shx and .dbf files that share a base name.

Record boundaries come from the index file. The scan is a data source whose tasks read ranges of bytes of their own;
for stores that only Spark reaches, the binary reader gives whole files and the JVM cuts them into records.
"""

from __future__ import annotations

import math
import re
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from emberlake.functions.geometry import SRID, geometry_label
from emberlake.functions.projection import TransverseMercator, projection_of

# The shape decoder runs in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PARTS = ("shp", "shx", "dbf")
_FIELD_SIZE = 32
# Bytes of shapes and rows for a task, of one read within it, and index records that the plan looks at together.
RANGE_BYTES, _READ_BYTES, _INDEX_RECORDS = 64 << 20, 8 << 20, 1 << 20
# Bytes that opening a layer's files counts for where small layers share a task.
OPEN_BYTES = 1 << 20
# Bytes of a point's shape, and the layout of such records from the first shape on, each with the next one's header.
_POINT_BYTES = 20
_POINTS = np.dtype([("kind", "<i4"), ("xy", "<f8", 2), ("next", "V8")])
# Definitions of geographic systems whose coordinates are those of SRID 4674 or 4326.
GEOGRAPHIC = r'(?is)^\s*GEOG(?:CS|CRS)\s*\[\s*"[^"]*(?:SIRGAS[ _]*2000|WGS[ _]*(?:19)?84)'


def _unsigned(blob: Column, position: int | Column, size: int, little: bool) -> Column:
    """Unsigned integer of ``size`` bytes at a 1-based position."""
    order = range(size - 1, -1, -1) if little else range(size)
    digits = F.concat(*[F.hex(F.substring(blob, F.lit(position) + i, F.lit(1))) for i in order])
    return F.conv(digits, 16, 10).cast("int")


def layer_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and content of the layer files below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(folder).select("path", "content")
    return files.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*_PARTS))


def _by_layer(files: DataFrame) -> dict[str, DataFrame]:
    layer = F.regexp_replace("path", r"\.[^./]+$", "")
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return {
        part: files.filter(kind == part).select(layer.alias("layer"), F.col("content").alias(part)) for part in _PARTS
    }


def _layout(raw: bytes) -> list[tuple[str, str, int, int, int]]:
    """(name, type, offset, length, decimals) of the attributes a table header describes."""
    fields, offset = [], 1
    for start in range(0, len(raw) - _FIELD_SIZE + 1, _FIELD_SIZE):
        if raw[start] == 0x0D:
            break
        name, kind, size, decimals = struct.unpack_from("<11sc4xBB", raw, start)
        fields.append((name.split(b"\0")[0].decode("ascii"), kind.decode("ascii"), offset, size, decimals))
        offset += size
    return fields


def _attribute_layout(dbf: DataFrame) -> list[tuple[str, str, int, int, int]]:
    """(name, type, offset, length, decimals) of the attributes, read from the table headers alone."""
    length = _unsigned(F.col("dbf"), 9, 2, True)
    headers = dbf.select(F.substring("dbf", F.lit(33), length - 33).alias("header")).distinct().limit(2).collect()
    if len(headers) != 1:
        raise ValueError("the layers below one folder must exist and have the same attributes")
    return _layout(bytes(headers[0].header))


def _attribute(record: Column, kind: str, offset: int, size: int, decimals: int, encoding: str) -> Column:
    text = F.trim(F.replace(F.decode(F.substring(record, offset + 1, size), encoding), F.lit("\0"), F.lit("")))
    text = F.nullif(text, F.lit(""))
    if kind in "NF":
        if decimals or size > 18 or kind == "F":
            return text.try_cast("double")
        return text.try_cast("long")
    if kind == "D":
        return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    if kind == "L":
        return F.when(F.upper(text).isin("T", "Y"), True).when(F.upper(text).isin("F", "N"), False)
    return text


def _ring_area(ring: np.ndarray) -> float:
    """Twice the signed area; outer rings run clockwise and come out negative."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1]))


class EdgeIndex:
    """The edges of closed rings in horizontal bands, for finding the rings around a point."""

    def __init__(self, rings: list[np.ndarray]) -> None:
        edges = np.concatenate([np.column_stack([r[:-1], r[1:]]) for r in rings]) if rings else np.empty((0, 4))
        owner = np.repeat(np.arange(len(rings)), [max(len(r) - 1, 0) for r in rings])
        low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
        self.rings, self.bottom = len(rings), float(low.min()) if len(edges) else 0.0
        # Bands as high as a usual edge hold each edge about twice.
        span = float(high.max()) - self.bottom if len(edges) else 0.0
        mean = float((high - low).mean()) if len(edges) else 0.0
        self.height = max(mean, span / max(len(edges), 1)) or 1.0
        first = ((low - self.bottom) / self.height).astype(np.int64)
        bands = ((high - self.bottom) / self.height).astype(np.int64) - first + 1
        at = np.repeat(np.arange(len(edges)), bands)
        band = np.arange(len(at)) - np.repeat(np.cumsum(bands) - bands, bands) + first[at]
        order = np.argsort(band, kind="stable")
        self.edges, self.owner, self.band = edges[at[order]], owner[at[order]], band[order]

    def around(self, x: float, y: float) -> np.ndarray:
        """Numbers of the rings that contain the point, by the even-odd rule."""
        band = math.floor((y - self.bottom) / self.height)
        part = slice(*np.searchsorted(self.band, [band, band + 1]))
        x0, y0, x1, y1 = self.edges[part].T
        crosses = (y0 > y) != (y1 > y)
        rise = np.where(crosses, y1 - y0, 1.0)
        right = crosses & (x < (x1 - x0) * (y - y0) / rise + x0)
        return np.flatnonzero(np.bincount(self.owner[part][right], minlength=self.rings) % 2)


def _polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings grouped to polygons: each hole goes to the smallest outer ring around it."""
    areas = np.array([_ring_area(r) for r in rings])
    outer = np.flatnonzero(areas < 0) if (areas < 0).any() else np.arange(len(rings))
    groups = {i: [rings[i]] for i in outer.tolist()}
    holes = sorted(set(range(len(rings))) - set(groups))
    index = EdgeIndex([rings[i] for i in outer]) if holes else None
    for i in holes:
        around = outer[index.around(*rings[i][0])]
        if len(around):
            groups[int(around[np.abs(areas[around]).argmin()])].append(rings[i])
        else:
            groups[i] = [rings[i]]
    return list(groups.values())


def _head(code: int, srid: int | None = None) -> bytes:
    if srid is None:
        return struct.pack("<BI", 1, code)
    return struct.pack("<BII", 1, code | 0x20000000, srid)


def _body(line: np.ndarray) -> bytes:
    return struct.pack("<I", len(line)) + line.tobytes()


def _collect(single: int, multi: int, bodies: list[bytes], srid: int) -> bytes:
    """One body as a single geometry, several as a multi geometry."""
    if len(bodies) == 1:
        return _head(single, srid) + bodies[0]
    return _head(multi, srid) + struct.pack("<I", len(bodies)) + b"".join(_head(single) + b for b in bodies)


def _ewkb(shape: bytes, srid: int, system: TransverseMercator | None = None) -> bytes | None:
    """EWKB of one shape record: point, multipoint, line or polygon; z and m values are left out.

    Coordinates of a projected ``system`` become longitudes and latitudes, all of a record at once.
    """
    (kind,) = struct.unpack_from("<i", shape)
    flat = kind % 10
    if kind == 0:
        return None
    if flat not in (1, 3, 5, 8):
        raise ValueError(f"shape type {kind} is not supported")
    starts, at, count = [0], 4, 1
    if flat == 8:
        (count,), at = struct.unpack_from("<i", shape, 36), 40
    elif flat != 1:
        parts, count = struct.unpack_from("<ii", shape, 36)
        starts, at = list(struct.unpack_from(f"<{parts}i", shape, 44)), 44 + 4 * parts
    points = np.frombuffer(shape, dtype="<f8", count=2 * count, offset=at).reshape(-1, 2)
    if system is not None:
        points = system.to_geographic(points)
    if flat == 1:
        return _head(1, srid) + points.tobytes()
    if flat == 8:
        return _head(4, srid) + struct.pack("<I", count) + b"".join(_head(1) + p.tobytes() for p in points)
    lines = [points[a:b] for a, b in zip(starts, [*starts[1:], count])]
    if flat == 3:
        return _collect(2, 5, [_body(line) for line in lines], srid)
    polygons = _polygons(lines)
    return _collect(3, 6, [struct.pack("<I", len(p)) + b"".join(_body(r) for r in p) for p in polygons], srid)


def _point_ewkb(shapes: bytes, count: int, srid: int, system: TransverseMercator | None) -> np.ndarray | None:
    """EWKB of records of ``_POINT_BYTES`` that follow each other, as rows of bytes; None unless all are plain points."""
    records = np.frombuffer(shapes + bytes(8), _POINTS, count)
    if (records["kind"] != 1).any():
        return None
    points = records["xy"] if system is None else system.to_geographic(records["xy"])
    head = np.frombuffer(_head(1, srid), np.uint8)
    body = np.ascontiguousarray(points, "<f8").view(np.uint8).reshape(count, 16)
    return np.hstack([np.broadcast_to(head, (count, len(head))), body])


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary array."""
    count, size = rows.shape
    offsets = np.arange(count + 1, dtype="<i4") * size
    return pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def decode_layers(files: DataFrame, srid: int = SRID, encoding: str = "UTF-8") -> DataFrame:
    """Attributes and ``geometry`` of every record in the given layer files (path, content)."""
    parts = _by_layer(files)
    layout = _attribute_layout(parts["dbf"])
    whole = parts["shx"].join(parts["shp"], "layer").join(parts["dbf"], "layer")
    shx, shp, dbf = F.col("shx"), F.col("shp"), F.col("dbf")
    count = ((F.octet_length(shx) - 100) / 8).cast("int")
    table_start, table_step = _unsigned(dbf, 9, 2, True), _unsigned(dbf, 11, 2, True)

    def record(i: Column) -> Column:
        shape_at = _unsigned(shx, F.lit(101) + i * 8, 4, False) * 2 + 9
        shape_size = _unsigned(shx, F.lit(105) + i * 8, 4, False) * 2
        return F.struct(
            F.substring(shp, shape_at, shape_size).alias("shape"),
            F.substring(dbf, table_start + i * table_step + 1, table_step).alias("attributes"),
        )

    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    records = whole.select(F.inline(F.transform(numbers, record)))
    # 0x2A marks a deleted table row.
    records = records.filter(F.substring("attributes", 1, 1) != F.lit(b"*"))

    @F.pandas_udf("binary")
    def shape_to_ewkb(shapes: pd.Series) -> pd.Series:
        return shapes.map(lambda s: _ewkb(s, srid))

    attributes = [_attribute(F.col("attributes"), k, o, n, d, encoding).alias(name) for name, k, o, n, d in layout]
    geometry = shape_to_ewkb("shape").alias("geometry", metadata=geometry_label(srid))
    # A layer arrives as one row; spread its records before decoding them.
    return records.repartition(F.xxhash64("shape")).select(*attributes, geometry)


def _side_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Path and text of the small files with this suffix."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}")
    return reader.load(folder).select("path", F.trim(F.col("content").cast("string")).alias("text"))


def require_shared_coordinates(spark: SparkSession, folder: str) -> None:
    """Raise if a layer's .prj file names a system whose coordinates differ from those of the known SRIDs."""
    other = _side_files(spark, folder, "prj").filter(~F.col("text").rlike(GEOGRAPHIC)).limit(5).collect()
    if other:
        raise ValueError(f"no transformation for the coordinates of {', '.join(r.path for r in other)}: {other[0].text[:80]}")


def _files_below(store: fs.FileSystem, root: str) -> Iterator[list[fs.FileInfo]]:
    """The files below a folder, listed one folder at a time."""
    folders = [root]
    while folders:
        found = store.get_file_info(fs.FileSelector(folders.pop()))
        folders += [i.path for i in found if i.type == fs.FileType.Directory]
        yield [i for i in found if i.is_file]


def _declared(store: fs.FileSystem, root: str) -> set[str]:
    """Distinct texts of the .cpg files below a folder; names that begin with . or _ are left out, as Spark does."""
    texts = set()
    for info in (i for files in _files_below(store, root) for i in files):
        if info.path.endswith(".cpg") and not re.search(r"/[._]", info.path[len(root.rstrip("/")) :]):
            with store.open_input_file(info.path) as text:
                texts.add(text.read().decode("utf-8", "replace").strip(" "))
    return texts


def declared_encoding(spark: SparkSession, folder: str) -> str:
    """What the layers' .cpg files say, which must be the same for all; UTF-8 without any."""
    try:
        names = sorted(_declared(*open_store(folder)))
    except (OSError, pa.ArrowException):
        names = [r.text for r in _side_files(spark, folder, "cpg").select("text").distinct().limit(2).collect()]
    if len(names) > 1:
        raise ValueError(f"the layers below {folder} have several encodings: {', '.join(names)}")
    return re.sub(r"^ISO[ _-]*8859[ _-]*1$", "ISO-8859-1", names[0].strip().upper()) if names else "UTF-8"


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path, with its name there: local or mounted folders, s3, gs and hdfs."""
    if "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


@dataclass(frozen=True)
class LayerFile:
    """One layer's files and what their headers say."""

    files: dict[str, str]
    records: int
    table_start: int
    table_step: int
    fields: bytes
    system: TransverseMercator | None


def each_layer(store: fs.FileSystem, root: str) -> Iterator[LayerFile]:
    """The layers below a folder, one after the other; only their headers and side files are read."""
    for infos in _files_below(store, root):
        found: dict[str, dict[str, str]] = {}
        for info in infos:
            base, _, suffix = info.path.rpartition(".")
            if suffix.lower() in (*_PARTS, "prj"):
                found.setdefault(base, {})[suffix.lower()] = info.path
        for base, files in sorted(found.items()):
            if not all(p in files for p in _PARTS):
                continue
            with store.open_input_file(files["dbf"]) as table, store.open_input_file(files["shx"]) as index:
                start, step = struct.unpack("<HH", table.read_at(4, 8))
                fields, records = table.read_at(start - 33, 32), (index.size() - 100) // 8
            system = None
            if "prj" in files:
                with store.open_input_file(files["prj"]) as text:
                    try:
                        system = projection_of(text.read().decode("utf-8", "replace"))
                    except ValueError as problem:
                        raise ValueError(f"{files['prj']}: {problem}") from None
            yield LayerFile(files, records, start, step, fields, system)


def layers_below(store: fs.FileSystem, root: str) -> list[LayerFile]:
    """All layers below a folder."""
    return list(each_layer(store, root))


@dataclass
class LayerRange:
    """Consecutive records of a layer, with their bytes of shapes and rows."""

    layer: LayerFile
    first: int
    count: int
    size: int


@dataclass
class LayerRanges(InputPartition):
    """What a task reads: a range of a large layer, or several small layers."""

    ranges: list[LayerRange]

    @property
    def count(self) -> int:
        return sum(r.count for r in self.ranges)


def _ranges(store: fs.FileSystem, layer: LayerFile, size: int) -> Iterator[LayerRange]:
    """Records of a layer in ranges of about ``size`` bytes, by the lengths in the index; larger records alone."""
    with store.open_input_file(layer.files["shx"]) as index:
        for base in range(0, layer.records, _INDEX_RECORDS):
            count = min(_INDEX_RECORDS, layer.records - base)
            lengths = np.frombuffer(index.read_at(8 * count, 100 + 8 * base), ">i4").reshape(-1, 2)[:, 1].astype(np.int64)
            ends = np.cumsum(lengths * 2 + 8 + layer.table_step)
            at = 0
            while at < count:
                before = int(ends[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
                yield LayerRange(layer, base + at, stop - at, int(ends[stop - 1]) - before)
                at = stop


def _shared(ranges: list[LayerRange], size: int, tasks: int) -> list[LayerRanges]:
    """Neighbouring ranges put together up to ``size`` bytes, but not into fewer than ``tasks`` where there are as many."""
    room = min(size, max(OPEN_BYTES, sum(r.size + OPEN_BYTES for r in ranges) // tasks))
    packed, taken = [], room
    for r in ranges:
        taken += r.size + OPEN_BYTES
        if taken > room:
            packed.append(LayerRanges([]))
            taken = r.size + OPEN_BYTES
        packed[-1].ranges.append(r)
    return packed


class LayerReader(DataSourceReader):
    """Reads byte ranges of layer files; every task opens them for itself."""

    def __init__(self, options: dict) -> None:
        self.path, self.srid = options["path"], int(options.get("srid", SRID))
        self.size, self.tasks = int(options.get("rangebytes", RANGE_BYTES)), int(options.get("tasks", 1))

    def partitions(self) -> list[LayerRanges]:
        store, root = open_store(self.path)
        return _shared([r for layer in each_layer(store, root) for r in _ranges(store, layer, self.size)], self.size, self.tasks)

    def read(self, part: LayerRanges | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark asks for where there is no range
            return
        store, _ = open_store(self.path)
        for one in part.ranges:
            yield from self._records(store, one)

    def _records(self, store: fs.FileSystem, part: LayerRange) -> Iterator[pa.RecordBatch]:
        layer, step = part.layer, part.layer.table_step
        with (
            store.open_input_file(layer.files["shx"]) as index,
            store.open_input_file(layer.files["shp"]) as shapes,
            store.open_input_file(layer.files["dbf"]) as table,
        ):
            words = np.frombuffer(index.read_at(8 * part.count, 100 + 8 * part.first), ">u4").reshape(-1, 2).astype(np.int64)
            starts, lengths = words[:, 0] * 2 + 8, words[:, 1] * 2
            at = 0
            while at < part.count:
                # Neighbours in the index that are neighbours in the file are read at once, some megabytes at a time.
                gaps = starts[at + 1 :] != starts[at:-1] + lengths[at:-1] + 8
                stop = at + 1 + (int(gaps.argmax()) if gaps.any() else part.count - at - 1)
                stop = max(at + 1, min(stop, int(np.searchsorted(starts[:stop], starts[at] + _READ_BYTES))))
                data = shapes.read_at(int(starts[stop - 1] + lengths[stop - 1] - starts[at]), int(starts[at]))
                rows = table.read_at((stop - at) * step, layer.table_start + (part.first + at) * step)
                if len(rows) < (stop - at) * step:
                    raise ValueError(f"{layer.files['dbf']} has fewer rows than {layer.files['shx']}")
                table_rows = np.frombuffer(rows, np.uint8).reshape(stop - at, step)
                kept = table_rows[:, 0] != 0x2A  # marks a deleted row
                points = None
                if (lengths[at:stop] == _POINT_BYTES).all():
                    points = _point_ewkb(data, stop - at, self.srid, layer.system)
                if points is not None:
                    geometries = _binary(points[kept])
                else:
                    begins = (starts[at:stop] - starts[at]).tolist()
                    own = [(begins[i], int(lengths[at + i])) for i in np.flatnonzero(kept)]
                    geometries = pa.array([_ewkb(data[b : b + n], self.srid, layer.system) for b, n in own], pa.binary())
                yield pa.RecordBatch.from_arrays([_binary(table_rows[kept]), geometries], ["attributes", "geometry"])
                at = stop


class LayerSource(DataSource):
    """Vector layers as a data source: rows of the attribute table and geometries as EWKB."""

    @classmethod
    def name(cls) -> str:
        return "layer"

    def schema(self) -> str:
        return "attributes binary, geometry binary"

    def reader(self, schema) -> LayerReader:
        return LayerReader(dict(self.options))


def scan_layers(spark: SparkSession, folder: str, srid: int = SRID, encoding: str = "UTF-8", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Attributes and ``geometry`` of every record of the layers below a folder, read in ranges of bytes.

    Ranges come from the index files, so no task holds a layer, and files may have any size that the format can address.
    Coordinates of projected systems (transverse Mercator on SIRGAS 2000 or WGS 84) become longitudes and latitudes;
    others raise. The folder must be one that Arrow reaches from the executors.
    """
    store, root = open_store(folder)
    layouts = {layer.fields for layer in each_layer(store, root)}
    if len(layouts) != 1:
        raise ValueError("the layers below one folder must exist and have the same attributes")
    spark.dataSource.register(LayerSource)
    tasks = str(spark.sparkContext.defaultParallelism)
    rows = spark.read.format("layer").options(path=folder, srid=str(srid), rangebytes=str(range_bytes), tasks=tasks).load()
    attributes = [_attribute(F.col("attributes"), k, o, n, d, encoding).alias(name) for name, k, o, n, d in _layout(layouts.pop())]
    return rows.select(*attributes, F.col("geometry").alias("geometry", metadata=geometry_label(srid)))


def read_layer(spark: SparkSession, folder: str, srid: int = SRID, encoding: str | None = None) -> DataFrame:
    """All layers below a folder as attribute columns plus ``geometry`` (EWKB).

    Side files count: .cpg gives the encoding unless one is given, and .prj files name projected systems, which are
    transformed. Layers without .prj are taken to be in coordinates of the SRIDs 4674 and 4326. Where only Spark reaches
    the folder, whole files are read instead of ranges, up to 2 GB each, and projected systems raise.
    """
    encoding = encoding or declared_encoding(spark, folder)
    try:
        open_store(folder)
    except (OSError, pa.ArrowException):
        require_shared_coordinates(spark, folder)
        return decode_layers(layer_files(spark, folder), srid, encoding)
    return scan_layers(spark, folder, srid, encoding)
