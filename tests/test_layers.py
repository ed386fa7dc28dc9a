import struct

import pytest
from shapes import NULL_SHAPE, line, multipoint, point, polygon, write_layer

from emberlake.plans.dimensions import build_dimension, clean_layer
from emberlake.schemas import BIOME_DIMENSION, BIOME_LAYER, MUNICIPALITY_DIMENSION, MUNICIPALITY_LAYER
from emberlake.sinks.tables import overwrite_table
from emberlake.sources.layers import read_layer
from emberlake.sources.tables import read_table

SQUARE = [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)]
HOLE = [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]
FAR = [(20, 0), (20, 5), (25, 5), (25, 0), (20, 0)]
FAR_HOLE = [(21, 1), (22, 1), (22, 2), (21, 2), (21, 1)]

BIOME_FIELDS = [("ID1", "N", 4, 0), ("COD_BIOMA", "C", 10, 0), ("NOM_BIOMA", "C", 20, 0)]
TOWN_FIELDS = [("CD_MUN", "C", 7, 0), ("NM_MUN", "C", 30, 0), ("SIGLA_UF", "C", 2, 0), ("AREA_KM2", "N", 12, 3)]


def body(rings):
    return struct.pack("<I", len(rings)) + b"".join(
        struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r) for r in rings
    )


def ewkb(code, payload):
    return struct.pack("<BII", 1, code | 0x20000000, 4674) + payload


def test_attributes_and_geometries(spark, tmp_path):
    fields = [*BIOME_FIELDS, ("KM", "N", 8, 2), ("DAY", "D", 8, 0), ("OK", "L", 1, 0)]
    rest = ["1.50", "20240102", "T"]
    rows = [
        (polygon(SQUARE, HOLE), ["1", "AM", "Amazônia", *rest]),
        (polygon(SQUARE, FAR, FAR_HOLE, HOLE), ["2", "CE", "Cerrado", "", "", "F"]),
        (NULL_SHAPE, ["3", "", "Pampa", "x", "bad", "?"]),
        (polygon(FAR), ["4", "XX", "deleted", *rest]),
        (point(-56.1, -15.6), ["5", "P", "ponto", *rest]),
        (line([(0, 0), (1, 1)]), ["6", "L", "linha", *rest]),
        (line([(0, 0), (1, 1)], [(2, 2), (3, 3)]), ["7", "M", "linhas", *rest]),
        (multipoint((1, 2), (3, 4)), ["8", "Q", "pontos", *rest]),
    ]
    write_layer(tmp_path / "layer", "biomas", fields, rows, deleted={3})
    got = {r.ID1: r for r in read_layer(spark, str(tmp_path / "layer")).collect()}
    assert sorted(got) == [1, 2, 3, 5, 6, 7, 8]
    assert (got[1].COD_BIOMA, got[1].NOM_BIOMA, got[1].KM, str(got[1].DAY), got[1].OK) == ("AM", "Amazônia", 1.5, "2024-01-02", True)
    assert (got[2].KM, got[2].DAY, got[2].OK) == (None, None, False)
    assert (got[3].COD_BIOMA, got[3].KM, got[3].DAY, got[3].OK, got[3].geometry) == (None, None, None, None, None)
    assert bytes(got[1].geometry) == ewkb(3, body([SQUARE, HOLE]))
    parts = [struct.pack("<BI", 1, 3) + body(p) for p in ([SQUARE, HOLE], [FAR, FAR_HOLE])]
    assert bytes(got[2].geometry) == ewkb(6, struct.pack("<I", 2) + b"".join(parts))
    assert bytes(got[5].geometry).hex() == "010100002042120000cdcccccccc0c4cc03333333333332fc0"
    assert bytes(got[6].geometry) == ewkb(2, body([[(0, 0), (1, 1)]])[4:])
    lines = [struct.pack("<BI", 1, 2) + body([p])[4:] for p in ([(0, 0), (1, 1)], [(2, 2), (3, 3)])]
    assert bytes(got[7].geometry) == ewkb(5, struct.pack("<I", 2) + b"".join(lines))
    points = [struct.pack("<BIdd", 1, 1, *p) for p in ((1, 2), (3, 4))]
    assert bytes(got[8].geometry) == ewkb(4, struct.pack("<I", 2) + b"".join(points))


def test_several_layers_and_dimensions(spark, tmp_path):
    write_layer(
        tmp_path / "towns",
        "north",
        TOWN_FIELDS,
        [(polygon(SQUARE), ["1500107", "Belém", "PA", "1059.466"]), (polygon(SQUARE), ["1500107", "Belém", "PA", "1059.466"])],
    )
    write_layer(tmp_path / "towns" / "sub", "south", TOWN_FIELDS, [(polygon(FAR), ["4300109", "Agudo", "RS", "534.6"])])
    trusted = clean_layer(read_layer(spark, str(tmp_path / "towns")), MUNICIPALITY_LAYER)
    overwrite_table(trusted, str(tmp_path / "trusted"))
    dimension = build_dimension(read_table(spark, str(tmp_path / "trusted")), MUNICIPALITY_DIMENSION)
    assert dimension.columns == list(MUNICIPALITY_DIMENSION)
    got = sorted(tuple(r) for r in dimension.drop("geom_municipio").collect())
    assert got == [(1500107, "BELEM", "PA", 1059.466), (4300109, "AGUDO", "RS", 534.6)]
    # Geometry keeps its label through the stored table.
    assert dimension.schema["geom_municipio"].metadata == {"geometry": "ewkb", "srid": 4674}


def test_biome_dimension(spark, tmp_path):
    write_layer(tmp_path / "b", "b", BIOME_FIELDS, [(polygon(SQUARE), ["1", "AM", "Amazônia"])])
    dimension = build_dimension(clean_layer(read_layer(spark, str(tmp_path / "b")), BIOME_LAYER), BIOME_DIMENSION)
    assert tuple(dimension.drop("geom_bioma").first()) == (1, "AM", "AMAZONIA")


def test_layer_in_other_coordinates(spark, tmp_path):
    write_layer(tmp_path / "b", "b", BIOME_FIELDS, [(polygon(SQUARE), ["1", "AM", "Amazônia"])])
    moved = clean_layer(read_layer(spark, str(tmp_path / "b"), srid=4326), BIOME_LAYER)
    assert bytes(moved.first().geom) == ewkb(3, body([SQUARE]))
    with pytest.raises(ValueError):
        clean_layer(read_layer(spark, str(tmp_path / "b"), srid=31983), BIOME_LAYER)


def test_layers_with_different_attributes_are_refused(spark, tmp_path):
    write_layer(tmp_path / "x", "a", BIOME_FIELDS, [(polygon(SQUARE), ["1", "AM", "Amazônia"])])
    write_layer(tmp_path / "x", "b", TOWN_FIELDS, [(polygon(FAR), ["4300109", "Agudo", "RS", "534.6"])])
    with pytest.raises(ValueError):
        read_layer(spark, str(tmp_path / "x"))
    with pytest.raises(ValueError):
        (tmp_path / "empty").mkdir()
        (tmp_path / "empty" / "x.txt").write_text("")
        read_layer(spark, str(tmp_path / "empty"))


def test_side_files_are_honoured(spark, tmp_path):
    write_layer(tmp_path, "a", BIOME_FIELDS, [(point(1, 2), ["1", "A", "Amazonia"])])
    dbf = (tmp_path / "a.dbf").read_bytes().replace(b"Amazonia", "Amaz\xf4nia".encode("latin-1"))
    (tmp_path / "a.dbf").write_bytes(dbf)
    (tmp_path / "a.cpg").write_text("ISO 88591\n")
    assert read_layer(spark, str(tmp_path)).first().NOM_BIOMA == "Amaz\xf4nia"
    (tmp_path / "a.prj").write_text('PROJCS["SIRGAS_2000_UTM_Zone_23S",GEOGCS["GCS_SIRGAS_2000"]]')
    with pytest.raises(ValueError, match="a.prj"):
        read_layer(spark, str(tmp_path))
    (tmp_path / "a.prj").write_text('GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]')
    write_layer(tmp_path, "b", BIOME_FIELDS, [(point(1, 2), ["1", "A", "x"])])
    (tmp_path / "b.cpg").write_text("UTF-8")
    with pytest.raises(ValueError, match="encodings"):
        read_layer(spark, str(tmp_path))
