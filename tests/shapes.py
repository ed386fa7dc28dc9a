"""Writes small shapefiles for tests."""

import struct


def _shape(kind, parts):
    """Shape record of a polygon (5) or line (3)."""
    points = [p for part in parts for p in part]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    starts, at = [], 0
    for part in parts:
        starts.append(at)
        at += len(part)
    return (
        struct.pack("<i4dii", kind, min(xs), min(ys), max(xs), max(ys), len(parts), len(points))
        + struct.pack(f"<{len(parts)}i", *starts)
        + b"".join(struct.pack("<dd", *p) for p in points)
    )


def polygon(*rings):
    return _shape(5, rings)


def line(*parts):
    return _shape(3, parts)


def point(x, y):
    return struct.pack("<idd", 1, x, y)


def multipoint(*points):
    return struct.pack("<i4di", 8, 0, 0, 0, 0, len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


NULL_SHAPE = struct.pack("<i", 0)


def write_layer(folder, name, fields, rows, deleted=()):
    """``fields``: (name, type, size, decimals); ``rows``: (shape bytes, attribute texts)."""
    folder.mkdir(parents=True, exist_ok=True)
    shp, shx, offset = b"", b"", 50
    for i, (shape, _) in enumerate(rows):
        shp += struct.pack(">ii", i + 1, len(shape) // 2) + shape
        shx += struct.pack(">ii", offset, len(shape) // 2)
        offset += 4 + len(shape) // 2
    head = lambda size: struct.pack(">i20xi", 9994, size) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8)
    (folder / f"{name}.shp").write_bytes(head(50 + len(shp) // 2) + shp)
    (folder / f"{name}.shx").write_bytes(head(50 + len(shx) // 2) + shx)
    width = 1 + sum(f[2] for f in fields)
    dbf = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(fields), width)
    for field, kind, size, decimals in fields:
        dbf += struct.pack("<11sc4xBB14x", field.encode(), kind.encode(), size, decimals)
    dbf += b"\r"
    for i, (_, values) in enumerate(rows):
        dbf += b"*" if i in deleted else b" "
        for (_, kind, size, _), value in zip(fields, values):
            raw = value.encode("utf-8")
            dbf += raw.rjust(size) if kind in "NF" else raw.ljust(size)
    (folder / f"{name}.dbf").write_bytes(dbf + b"\x1a")
    (folder / f"{name}.prj").write_text('GEOGCS["GCS_SIRGAS_2000",DATUM["D_SIRGAS_2000"]]')
