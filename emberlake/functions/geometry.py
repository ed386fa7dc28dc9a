"""Geometry as EWKB in binary columns.

Points are encoded and decoded a whole Arrow batch at a time; headers are read
and rewritten with binary expressions inside the JVM.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The functions below run in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# SRID of the published geometry, and the SRID that maps are labelled with.
SRID = 4674
MAP_SRID = 4326

# SRIDs between which coordinates do not change: the registered shift between
# the two datums is zero on every axis.
SAME_COORDINATES = {SRID, MAP_SRID}

_POINT = np.dtype([("order", "u1"), ("type", "<u4"), ("srid", "<u4"), ("x", "<f8"), ("y", "<f8")])
_POINT_TYPE = 1
_SRID_FLAG = 0x20000000


def point(lon: Column, lat: Column, srid: int = SRID) -> Column:
    """EWKB point with x = ``lon`` and y = ``lat``; null if either is null."""

    @F.arrow_udf("binary")
    def encode(x: pa.Array, y: pa.Array) -> pa.Array:
        rows = np.zeros(len(x), dtype=_POINT)
        rows["order"], rows["type"], rows["srid"] = 1, _POINT_TYPE | _SRID_FLAG, srid
        rows["x"] = x.fill_null(0.0).to_numpy(zero_copy_only=False)
        rows["y"] = y.fill_null(0.0).to_numpy(zero_copy_only=False)
        valid = x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(valid * _POINT.itemsize))).astype("<i4")
        present = None if valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        data = rows[valid].tobytes()
        return pa.Array.from_buffers(pa.binary(), len(x), [present, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])

    return encode(lon.cast("double"), lat.cast("double"))


def _read_points(geometry: pa.Array) -> pa.Array:
    """Coordinates of points in any mix of layouts: both byte orders, with or without SRID, z and m left out.

    Rows of one layout are gathered from the batch's buffer together.
    """
    valid = geometry.is_valid().to_numpy(zero_copy_only=False)
    x, y = np.zeros(len(geometry)), np.zeros(len(geometry))
    if valid.any():
        _, offsets, data = geometry.buffers()
        wide = np.dtype("<i8" if pa.types.is_large_binary(geometry.type) else "<i4")
        edges = np.frombuffer(offsets, wide, len(geometry) + 1, wide.itemsize * geometry.offset).astype(np.int64)
        rows, starts = np.flatnonzero(valid), edges[:-1][valid]
        sizes, content = edges[1:][valid] - starts, np.frombuffer(data, np.uint8)
        if (sizes < 21).any():
            raise ValueError("not a point geometry")
        head = content[starts[:, None] + np.arange(5)]
        little = head[:, 0] == 1
        kind = np.where(little, head[:, 1:].copy().view("<u4")[:, 0], head[:, 1:].copy().view(">u4")[:, 0])
        labelled = (kind & _SRID_FLAG) != 0
        if ((kind & 0xFF) != _POINT_TYPE).any() or (sizes < np.where(labelled, 25, 21)).any():
            raise ValueError("not a point geometry")
        for order, kind_of_number in ((True, "<f8"), (False, ">f8")):
            own = little == order
            begin = starts[own] + np.where(labelled[own], 9, 5)
            pairs = content[begin[:, None] + np.arange(16)].view(kind_of_number)
            x[rows[own]], y[rows[own]] = pairs[:, 0], pairs[:, 1]
    return pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"], mask=pa.array(~valid))


def point_xy(geometry: Column | str) -> Column:
    """Coordinates of an EWKB or WKB point, as a struct of x and y."""

    @F.arrow_udf("struct<x: double, y: double>")
    def decode(points: pa.Array) -> pa.Array:
        return _read_points(points)

    return decode(geometry)


# The byte of a geometry's type that holds its z, m and SRID flags, without and with an SRID.
_FLAG_BYTES = {0x00: 0x20, 0x40: 0x60, 0x80: 0xA0, 0xC0: 0xE0}


def _little_endian(geometry: Column) -> Column:
    return F.substring(geometry, 1, 1) == F.lit(b"\x01")


def _flags(geometry: Column) -> Column:
    return F.when(_little_endian(geometry), F.substring(geometry, 5, 1)).otherwise(F.substring(geometry, 2, 1))


def _has_srid(geometry: Column) -> Column:
    return _flags(geometry).isin([bytes([with_srid]) for with_srid in _FLAG_BYTES.values()])


def set_srid(geometry: Column, srid: int = SRID) -> Column:
    """Same geometry with ``srid`` in its EWKB header, replacing one that is there."""
    flags = _flags(geometry)
    flagged = flags
    for without, with_srid in _FLAG_BYTES.items():
        flagged = F.when(flags == F.lit(bytes([without])), F.lit(bytes([with_srid]))).otherwise(flagged)
    header = F.when(
        _little_endian(geometry), F.concat(F.substring(geometry, 1, 4), flagged, F.lit(struct.pack("<I", srid)))
    ).otherwise(
        F.concat(F.substring(geometry, 1, 1), flagged, F.substring(geometry, 3, 3), F.lit(struct.pack(">I", srid)))
    )
    start = F.when(_has_srid(geometry), F.lit(10)).otherwise(F.lit(6))
    rewritten = F.concat(header, F.substring(geometry, start, F.octet_length(geometry)))
    # Most rows are points that carry the SRID already.
    ready = F.lit(struct.pack("<BII", 1, _POINT_TYPE | _SRID_FLAG, srid))
    return F.when(F.substring(geometry, 1, 9) == ready, geometry).otherwise(rewritten)


def srid_of(geometry: Column) -> Column:
    """SRID in the header; 0 if it has none."""
    header = F.hex(F.substring(geometry, 1, 9))
    # Byte order, flags and SRID digits, the digits in big-endian order.
    ordered = F.regexp_replace(header, "^01.{6}(..)(..)(..)(..)(..)$", "01$1$5$4$3$2")
    ordered = F.regexp_replace(ordered, "^00(..).{6}(.{8})$", "00$1$2")
    digits = F.regexp_extract(ordered, "^..[26AE].(.{8})$", 1)
    return F.when(geometry.isNotNull(), F.coalesce(F.conv(F.nullif(digits, F.lit("")), 16, 10).cast("int"), F.lit(0)))


def transform(geometry: Column, source: int, target: int = SRID) -> Column:
    """Geometry in ``target`` coordinates; only pairs that share coordinates are supported."""
    if source != target and not {source, target} <= SAME_COORDINATES:
        raise ValueError(f"no transformation from SRID {source} to {target}")
    return set_srid(geometry, target)


def _number_text(value: Column) -> Column:
    """Plain decimal text without trailing zeros, 15 decimals at most."""
    number = value.cast("double")
    plain = F.when(F.abs(number) >= 0.001, number.try_cast("decimal(33,15)").cast("string")).otherwise(
        F.format_string("%.15f", number)
    )
    # The scale is fixed, so the text always has a decimal part to trim; minus zero loses its sign.
    trimmed = F.regexp_replace(plain, r"^-(?=0\.0*$)|\.?0+$", "")
    return F.when(number.isNotNull() & ~F.isnan(number), trimmed)


def point_wkt(lon: Column, lat: Column) -> Column:
    """Point as WKT; null if either coordinate is null."""
    return F.concat(F.lit("POINT("), _number_text(lon), F.lit(" "), _number_text(lat), F.lit(")"))


_WKT_POINT = r"(?i)^\s*POINT\s*\(\s*([^\s()]+)\s+([^\s()]+)\s*\)\s*$"


def wkt_x(text: Column) -> Column:
    """x of a WKT point; null if the text is none."""
    return F.regexp_extract(text, _WKT_POINT, 1).try_cast("double")


def wkt_y(text: Column) -> Column:
    """y of a WKT point; null if the text is none."""
    return F.regexp_extract(text, _WKT_POINT, 2).try_cast("double")


def geometry_label(srid: int) -> dict:
    """Column metadata that marks a binary column as geometry; labels coordinates, changes none."""
    return {"geometry": "ewkb", "srid": srid}
