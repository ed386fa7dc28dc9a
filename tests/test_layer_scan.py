"""Byte-range scans of layers, ring grouping by an edge index, and projected coordinates."""

import contextlib
import math
import os
import random
import resource
import struct
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from shapes import point, polygon, write_layer

from emberlake.functions.projection import TransverseMercator, projection_of
from emberlake.queries.areas import GEOGRAPHIC, zone_system
from emberlake.sources import layers
from emberlake.sources.layers import LayerReader, layers_below, open_store, read_layer, scan_layers

FIELDS = [("ID", "N", 6, 0), ("NAME", "C", 12, 0)]
SQUARE = [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)]


def moved(ring, dx, dy, size=1.0):
    return [(x * size + dx, y * size + dy) for x, y in ring]


def ids(df):
    return sorted(r.ID for r in df.select("ID").collect())


@pytest.mark.parametrize("range_bytes", [1, 500, 1 << 20])
def test_ranges_hold_every_record_once(spark, tmp_path, range_bytes):
    rows = [(polygon(moved(SQUARE, i, 0)), [str(i), f"n{i}"]) for i in range(40)]
    write_layer(tmp_path, "a", FIELDS, rows, deleted={7})
    write_layer(tmp_path / "sub", "b", FIELDS, [(point(1, 2), [str(100 + i), "p"]) for i in range(30)])
    found = scan_layers(spark, str(tmp_path), range_bytes=range_bytes)
    assert ids(found) == sorted({*range(40), *range(100, 130)} - {7})
    reader = LayerReader({"path": str(tmp_path), "rangebytes": str(range_bytes)})
    assert len(reader.partitions()) in {1: [70], 500: range(10, 40), 1 << 20: [2]}[range_bytes]
    assert sum(p.count for p in reader.partitions()) == 70
    assert found.rdd.getNumPartitions() == len(reader.partitions())


def test_a_task_reads_its_own_ranges(tmp_path, monkeypatch):
    write_layer(tmp_path, "a", FIELDS, [(polygon(moved(SQUARE, i, 0)), [str(i), "x"]) for i in range(1000)])
    read = []

    class Counting:
        def __init__(self, real):
            self.real = real

        def read_at(self, size, at):
            read.append(size)
            return self.real.read_at(size, at)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.real.close()

    reader = LayerReader({"path": str(tmp_path), "rangebytes": "10000"})
    parts = reader.partitions()
    store, _ = open_store(str(tmp_path))

    class Store:
        def open_input_file(self, path):
            return Counting(store.open_input_file(path))

    monkeypatch.setattr(layers, "open_store", lambda path: (Store(), path))
    rows = [sum(b.num_rows for b in reader.read(p)) for p in parts]
    assert sum(rows) == 1000 and len(parts) > 10
    files = sum((tmp_path / f"a.{s}").stat().st_size for s in ("shp", "shx", "dbf"))
    assert sum(read) <= files


def test_records_in_any_place_of_the_file(spark, tmp_path):
    """The index says where a record is: out of order, with gaps, beyond 2 GB."""
    shapes = [point(float(i), -float(i)) for i in range(4)]
    write_layer(tmp_path, "a", FIELDS, [(s, [str(i), "x"]) for i, s in enumerate(shapes)])
    places = [400, 100, 3_000_000_000, 3_000_000_400]
    with open(tmp_path / "a.shp", "r+b") as shp, open(tmp_path / "a.shx", "r+b") as shx:
        shp.truncate(100)
        for i, (at, shape) in enumerate(zip(places, shapes)):
            shp.seek(at)  # the file is sparse
            shp.write(struct.pack(">ii", i + 1, len(shape) // 2) + shape)
            shx.seek(100 + 8 * i)
            shx.write(struct.pack(">II", at // 2, len(shape) // 2))
    got = {r.ID: bytes(r.geometry) for r in read_layer(spark, str(tmp_path)).collect()}
    assert got == {i: struct.pack("<BIIdd", 1, 0x20000001, 4674, float(i), -float(i)) for i in range(4)}


def test_layers_without_records_or_parts(spark, tmp_path):
    write_layer(tmp_path, "a", FIELDS, [])
    (tmp_path / "lonely.shp").write_bytes(b"")
    assert read_layer(spark, str(tmp_path)).count() == 0
    store, root = open_store(f"file:{tmp_path}")
    assert len(layers_below(store, root)) == 1


def plain_groups(rings):
    """Rings to polygons by a test of every hole against every outer ring."""

    def inside(ring, x, y):
        hit = False
        for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                hit = not hit
        return hit

    def area(ring):
        return sum((a[0] - ring[0][0]) * (b[1] - ring[0][1]) - (b[0] - ring[0][0]) * (a[1] - ring[0][1]) for a, b in zip(ring, ring[1:]))

    outer = [i for i, r in enumerate(rings) if area(r) < 0] or list(range(len(rings)))
    groups = {i: [i] for i in outer}
    for i in sorted(set(range(len(rings))) - set(outer)):
        around = [o for o in outer if inside(rings[o], *rings[i][0])]
        groups.setdefault(min(around, key=lambda o: abs(area(rings[o]))) if around else i, []).append(i)
    return sorted(groups.values())


def test_holes_go_to_the_smallest_ring_around_them():
    rng = random.Random(6)
    for _ in range(60):
        rings = []
        for k in range(rng.randrange(1, 25)):
            x, y, r = rng.uniform(0, 40), rng.uniform(0, 40), rng.choice([0.5, 2, 9])
            turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randrange(3, 9)))
            ring = [(x + r * math.cos(t), y + r * math.sin(t)) for t in turns]
            ring = ring if rng.random() < 0.5 else ring[::-1]
            rings.append([*ring, ring[0]])
        arrays = [np.array(r) for r in rings]
        got = layers._polygons(arrays)
        named = sorted(sorted(next(i for i, a in enumerate(arrays) if a is r) for r in group) for group in got)
        assert named == sorted(sorted(g) for g in plain_groups(rings))


def test_many_holes_look_at_few_edges():
    outer = [moved(SQUARE, 20 * i, 20 * j) for i in range(30) for j in range(30)]
    index = layers.EdgeIndex([np.array(r, float) for r in outer])
    assert index.around(20 * 7 + 5, 20 * 4 + 5).tolist() == [7 * 30 + 4]
    assert index.around(20 * 7 + 15, 20 * 4 + 5).tolist() == [] and index.around(5, -99).tolist() == []
    assert len(index.edges) < 4 * 4 * len(outer)


ZONE = projection_of(zone_system(23))


def meridian_arc(phi, a=6378137.0, f=1 / 298.257222101, steps=20000):
    """Length of the meridian by Simpson's rule."""
    e2, h = f * (2 - f), phi / steps
    g = lambda p: a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
    return h / 3 * (g(0) + g(phi) + 4 * sum(g(h * k) for k in range(1, steps, 2)) + 2 * sum(g(h * k) for k in range(2, steps, 2)))


@pytest.mark.parametrize("lat", [-60.0, -15.6, -0.001, 0.0, 33.3])
def test_the_central_meridian_has_true_lengths(lat):
    y = 10_000_000 + 0.9996 * meridian_arc(math.radians(lat))
    lon, found = ZONE.to_geographic(np.array([[500_000.0, y]]))[0]
    assert lon == -45 and found == pytest.approx(lat, abs=1e-10)


def test_a_sphere_has_a_closed_form():
    sphere = TransverseMercator(6_371_000.0, 0.0, 10.0, 0.0, 1.0, 0.0, 0.0)
    for lon, lat in [(12.0, 40.0), (-20.0, -70.0), (10.0, 0.0), (50.0, 5.0)]:
        d, phi = math.radians(lon - 10), math.radians(lat)
        x = 6_371_000 * math.atanh(math.cos(phi) * math.sin(d))
        y = 6_371_000 * math.atan2(math.tan(phi), math.cos(d))
        assert sphere.to_geographic(np.array([[x, y]]))[0] == pytest.approx([lon, lat], abs=1e-9)


def test_units_and_origins_are_honoured():
    text = zone_system(23).replace('UNIT["Meter",1.0]]', 'UNIT["Foot_US",0.3048006096012192]]')
    in_feet = projection_of(text)
    shift = ZONE.to_geographic(np.array([[612_345.6, 8_765_432.1]]))[0]
    scaled = TransverseMercator(*[getattr(in_feet, n) for n in in_feet.__dataclass_fields__])
    assert scaled.unit == 0.3048006096012192 and scaled.false_easting == 500000.0
    feet = np.array([[500_000 + 112_345.6 / scaled.unit, 10_000_000 - 1_234_567.9 / scaled.unit]])
    assert scaled.to_geographic(feet)[0] == pytest.approx(shift, abs=1e-11)
    lifted = TransverseMercator(6378137.0, 298.257222101, -45.0, -10.0, 0.9996, 500_000.0, 0.0)
    base = 0.9996 * meridian_arc(math.radians(-10.0))
    assert lifted.to_geographic(np.array([[500_000.0, -base]]))[0] == pytest.approx([-45, 0], abs=1e-9)


def test_projected_layers_become_geographic(spark, tmp_path):
    x, y = 500_000.0, 10_000_000 + 0.9996 * meridian_arc(math.radians(-15.0))
    write_layer(tmp_path, "a", FIELDS, [(polygon(moved(SQUARE, x, y, 100.0)), ["1", "x"])])
    (tmp_path / "a.prj").write_text(zone_system(23))
    shape = bytes(read_layer(spark, str(tmp_path)).first().geometry)
    points = np.frombuffer(shape, "<f8", 10, len(shape) - 80).reshape(-1, 2)
    assert points[0] == pytest.approx([-45, -15], abs=1e-9)
    assert points[2][0] == pytest.approx(-45 + 1000 / (111_320 * math.cos(math.radians(15))), abs=1e-4)


@pytest.mark.parametrize(
    "text",
    [
        'PROJCS["x",GEOGCS["GCS_Corrego_Alegre"],PROJECTION["Transverse_Mercator"],UNIT["Meter",1.0]]',
        zone_system(23).replace("Transverse_Mercator", "Polyconic"),
        zone_system(23).replace("Scale_Factor", "Other"),
        "",
    ],
)
def test_other_systems_raise(spark, tmp_path, text):
    write_layer(tmp_path, "a", FIELDS, [(point(1, 2), ["1", "x"])])
    (tmp_path / "a.prj").write_text(text)
    with pytest.raises(ValueError, match="a.prj"):
        read_layer(spark, str(tmp_path))


def test_geographic_systems_need_no_change():
    assert projection_of(GEOGRAPHIC) is None and projection_of('GEOGCS["WGS 84",DATUM["WGS_1984"]]') is None


def test_layer_writer_holds_no_records(tmp_path):
    """Records go to temporary files: the writer's memory does not grow with them, and the files read back whole."""
    import tracemalloc

    from emberlake.queries.areas import LayerWriter, layer_bytes

    square = [np.array([[0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [1.0, 0.0], [0.0, 0.0]])]
    writer = LayerWriter()
    tracemalloc.start()
    for i in range(20000):
        writer.add([str(i), "x", "PA", "1.0"], square)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 1 << 20
    files = dict(writer.files("prj"))
    assert {s: b"".join(c) for s, c in files.items()} == layer_bytes([([str(i), "x", "PA", "1.0"], square) for i in range(20000)], "prj")


def test_written_layers_read_back_whole(spark, tmp_path):
    from pyspark.sql import functions as F

    from emberlake.queries.areas import write_layers

    rows = spark.range(3000).select(
        F.lit(0).alias("zone"),
        F.array(F.col("id").cast("string"), F.lit("n"), F.lit("PA"), F.lit("1.0")).alias("cells"),
        F.array(F.array(F.struct(F.col("id").cast("double").alias("x"), F.lit(2.0).alias("y")))).alias("rings"),
    )
    write_layers(rows, str(tmp_path))
    got = read_layer(spark, str(tmp_path)).select(F.col("CD_MUN").cast("long").alias("id")).collect()
    assert sorted(r.id for r in got) == list(range(3000))


def zoned_points(spark, zones, rows):
    from pyspark.sql import functions as F

    return spark.range(rows, numPartitions=4).select(
        (F.col("id") % zones + 1).cast("int").alias("zone"),
        F.array(F.col("id").cast("string"), F.lit("n"), F.lit("PA"), F.lit("1.0")).alias("cells"),
        F.array(F.array(F.struct(F.lit(500_000.0).alias("x"), F.lit(9_000_000.0).alias("y")))).alias("rings"),
    )


def python_processes(spark):
    """The processes that fork Python workers, and the workers there are."""

    def ask(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"pid": [os.getppid()]})

    daemons = {r.pid for r in spark.range(8, numPartitions=4).mapInArrow(ask, "pid long").collect()}
    return [*daemons, *(int(p) for d in daemons for p in Path(f"/proc/{d}/task/{d}/children").read_text().split())]


def test_many_zones_need_few_open_files(spark, tmp_path):
    """A task writes its zones one after the other, and a zone is not split over all tasks."""
    from pyspark.sql import functions as F

    from emberlake.queries.areas import write_layers

    limits = dict.fromkeys(python_processes(spark), resource.getrlimit(resource.RLIMIT_NOFILE))
    try:
        for pid, (_, most) in limits.items():
            with contextlib.suppress(ProcessLookupError):
                resource.prlimit(pid, resource.RLIMIT_NOFILE, (100, most))
        write_layers(zoned_points(spark, 400, 3000), str(tmp_path))
    finally:
        for pid in {*limits, *python_processes(spark)}:
            with contextlib.suppress(ProcessLookupError):
                resource.prlimit(pid, resource.RLIMIT_NOFILE, next(iter(limits.values())))
    assert 400 <= len(list(tmp_path.rglob("*.shp"))) <= 400 + 4
    got = read_layer(spark, str(tmp_path)).select(F.col("CD_MUN").cast("long").alias("id"), "geometry").collect()
    assert sorted(r.id for r in got) == list(range(3000))
    for r in got:  # the middle of each zone
        lon, lat = struct.unpack("<dd", bytes(r.geometry)[-16:])
        assert lon == 6 * (r.id % 400 + 1) - 183 and lat == pytest.approx(-9.0459, abs=1e-3)


def test_small_layers_share_tasks(spark, tmp_path):
    """Layers are put together as long as enough tasks are left."""
    for i in range(300):
        write_layer(tmp_path / f"{i % 3}", f"l{i}", FIELDS, [(point(i, -i), [str(i), "x"])])
    few = LayerReader({"path": str(tmp_path)}).partitions()
    assert len(few) <= 6 and sum(p.count for p in few) == 300
    assert 50 <= len(LayerReader({"path": str(tmp_path), "tasks": "50"}).partitions()) <= 60
    assert len(LayerReader({"path": str(tmp_path), "tasks": "1000"}).partitions()) == 300
    assert ids(scan_layers(spark, str(tmp_path))) == list(range(300))


def test_points_are_written_as_one_by_one():
    """Whole batches, and parts of them, give the files that single records give."""
    from emberlake.queries.areas import LayerWriter, layer_bytes

    names = ["a", "Conceição do Araguaia", "", "x" * 30, "é" * 20, "a\0b", None]
    rows = [([str(i), names[i % 7], "PA", f"{i / 7:.4f}"], [np.array([[i + 0.5, -i]])]) for i in range(50)]
    column = pa.array([[[{"x": x, "y": y} for x, y in ring.tolist()] for ring in rings] for _, rings in rows])
    batch = pa.RecordBatch.from_arrays([pa.array([cells for cells, _ in rows]), column], ["cells", "rings"])
    writer = LayerWriter()
    for start, count in [(0, 20), (20, 1), (21, 29)]:
        writer.add_rows(batch.slice(start, count))
    assert {s: b"".join(c) for s, c in writer.files("prj")} == layer_bytes(rows, "prj")


@pytest.mark.parametrize("system", [None, ZONE])
def test_points_are_read_as_one_by_one(tmp_path, system):
    shapes = [point(500_000.0 + 9 * i, 9_000_000.0 - 7 * i) for i in range(40)]
    for name, all_shapes in (("plain", shapes), ("mixed", [*shapes, struct.pack("<i", 0), struct.pack("<i", 0) + bytes(16)])):
        folder = tmp_path / name
        write_layer(folder, "a", FIELDS, [(s, [str(i), "x"]) for i, s in enumerate(all_shapes)], deleted={3})
        if system:
            (folder / "a.prj").write_text(zone_system(23))
        reader = LayerReader({"path": str(folder)})
        got = [g.as_py() for p in reader.partitions() for b in reader.read(p) for g in b.column("geometry")]
        wanted = [layers._ewkb(s, 4674, system) for i, s in enumerate(all_shapes) if i != 3]
        assert [g and (g[:9], pytest.approx(struct.unpack("<dd", g[9:]), abs=1e-12)) for g in wanted] == [g and (g[:9], struct.unpack("<dd", g[9:])) for g in got]


def test_encodings_are_found_in_every_folder(spark, tmp_path):
    write_layer(tmp_path / "x" / "y", "a", FIELDS, [(point(1, 2), ["1", "n"])])
    (tmp_path / "x" / "y" / "a.cpg").write_text("ISO 88591")
    (tmp_path / "x" / "._a.cpg").write_bytes(b"\0\5\x16\7")
    assert layers.declared_encoding(spark, str(tmp_path)) == "ISO-8859-1"
    assert layers.declared_encoding(spark, f"file:{tmp_path}") == "ISO-8859-1"
