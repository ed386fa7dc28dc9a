import datetime
import hashlib
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberlake.functions import geometry, keys, quality, text, times


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("r")).collect()]


def test_normalize_string(spark):
    values = ["São Félix do Xingu", "GOIÁS", "pingüim Ñandú Çá", None, ""]
    assert column(spark, values, "string", text.normalize_string) == [
        "SAO FELIX DO XINGU",
        "GOIAS",
        "PINGUIM NANDU CA",
        None,
        "",
    ]
    assert len(text.ACCENTED) == len(text.UNACCENTED) == 48


def test_leading_day(spark):
    values = ["x/br_1/focos_br_20240103.csv", "20240105x", "focos_br_2024.csv", None]
    assert column(spark, values, "string", lambda c: text.leading_day(c, "br_")) == [20240103, 20240105, None, None]


def test_surrogate_key_skips_nulls_unless_told(spark):
    df = spark.createDataFrame([("a", None, 0.5), ("a", 0.5, None)], "s string, x double, y double")
    columns = [F.col(c) for c in "sxy"]
    plain = [r[0] for r in df.select(keys.surrogate_key(columns)).collect()]
    assert plain[0] == plain[1] == hashlib.md5(b"a_0.5").hexdigest().upper()
    apart = [r[0] for r in df.select(keys.surrogate_key(columns, "?")).collect()]
    assert apart[0] != apart[1]


def test_surrogate_key_text_of_numbers_and_times(spark):
    df = spark.createDataFrame([(3.0, 1.0e7, datetime.datetime(2024, 1, 2, 23, 59, 59))], "a double, b double, t timestamp")
    got = df.select(keys.surrogate_key([F.col("a"), F.col("b"), F.col("t")])).first()[0]
    assert got == hashlib.md5(b"3.0_1.0E7_2024-01-02 23:59:59").hexdigest().upper()


def test_date_key(spark):
    days = [datetime.date(2000, 1, 1), datetime.date(2024, 1, 1)]
    assert column(spark, days, "date", keys.date_key) == [-272594282, -456589419]


def test_null_outside(spark):
    values = [-999.0, -0.1, 0.0, 1.0, 1.01, None, float("nan")]
    assert column(spark, values, "double", lambda c: quality.null_outside(c, 0, 1)) == [None, None, 0.0, 1.0, None, None, None]
    assert column(spark, [-1.0, 5.0], "double", lambda c: quality.null_outside(c, low=0)) == [None, 5.0]


def test_bands_at_their_limits(spark):
    values = [0.0, 0.15, 0.16, 0.4, 0.41, 0.7, 0.71, 0.95, 0.96, 1.0, 1.01, None]
    assert column(spark, values, "double", quality.band) == (
        ["MINIMO"] * 2 + ["BAIXO"] * 2 + ["MEDIO"] * 2 + ["ALTO"] * 2 + ["CRITICO"] * 2 + ["INVALIDO"] * 2
    )


def test_coordinate_flags(spark):
    rows = [(-90.0, -180.0), (90.0, 180.0), (90.01, 0.0), (0.0, -180.01), (None, 0.0), (0.0, None)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    flags = quality.coordinate_flags(F.col("lat"), F.col("lon"))
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert got == [
        (True, True, True),
        (True, True, True),
        (False, True, False),
        (True, False, False),
        (False, True, False),
        (True, False, False),
    ]


def test_code_of(spark):
    assert column(spark, ["PARA", "RORAIMA", "ATLANTIS", None], "string", quality.code_of) == ["PA", "RR", None, None]
    assert len(quality.STATE_CODES) == len(set(quality.STATE_CODES.values())) == 27


def test_parse_timestamp(spark):
    values = ["2024-01-02 23:59:59", "2024/01/02 10:00:00", "soon", None, ""]
    got = column(spark, values, "string", lambda c: times.parse_timestamp(c, ["yyyy/MM/dd HH:mm:ss"]))
    assert got == [datetime.datetime(2024, 1, 2, 23, 59, 59), datetime.datetime(2024, 1, 2, 10), None, None, None]


def test_days_between(spark):
    df = spark.sql("SELECT DATE'2024-02-28' a, DATE'2024-03-01' b")
    assert [r[0].day for r in df.select(times.days_between(F.col("a"), F.col("b"))).collect()] == [28, 29, 1]
    assert df.select(times.days_between(F.col("b"), F.col("a"))).count() == 0
    assert df.select(times.days_between(F.col("a"), F.lit(None).cast("date"))).count() == 0


def test_mark_text_and_day_number(spark):
    moment = [datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)]
    assert column(spark, moment, "timestamp", times.mark_text) == ["2024-01-02 03:04:05"]
    assert column(spark, moment, "timestamp", times.day_number) == [20240102]


def test_point_known_bytes(spark):
    df = spark.createDataFrame([(-56.1, -15.6), (None, 1.0), (1.0, None)], "lon double, lat double")
    got = [r[0] for r in df.select(geometry.point(F.col("lon"), F.col("lat"))).collect()]
    assert bytes(got[0]).hex() == "010100002042120000cdcccccccc0c4cc03333333333332fc0"
    assert got[1:] == [None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.floats(-180, 180, allow_subnormal=True)),
            st.one_of(st.none(), st.floats(-90, 90, allow_subnormal=True)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_point_round_trip(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, lon double, lat double").coalesce(2)
    xy = df.withColumn("g", geometry.point(F.col("lon"), F.col("lat"))).withColumn("xy", geometry.point_xy("g"))
    for lon, lat, blob, got in xy.orderBy("i").select("lon", "lat", "g", "xy").collect():
        if lon is None or lat is None:
            assert blob is None and got is None
        else:
            assert bytes(blob) == struct.pack("<BIIdd", 1, 0x20000001, 4674, lon, lat)
            assert (got.x, got.y) == (lon, lat)


def test_srid_headers(spark):
    little = struct.pack("<BIdd", 1, 1, 2.5, -3.5)
    big = struct.pack(">BIdd", 0, 1, 2.5, -3.5)
    tagged = struct.pack("<BIIdd", 1, 0x20000001, 4326, 2.5, -3.5)
    big_tagged = struct.pack(">BIIdd", 0, 0x20000001, 4326, 2.5, -3.5)
    blobs = [little, big, tagged, big_tagged, None]
    assert column(spark, blobs, "binary", geometry.srid_of) == [0, 0, 4326, 4326, None]
    out = column(spark, blobs, "binary", geometry.set_srid)
    assert [bytes(b) for b in out[:4]] == [
        struct.pack("<BIIdd", 1, 0x20000001, 4674, 2.5, -3.5),
        struct.pack(">BIIdd", 0, 0x20000001, 4674, 2.5, -3.5),
        struct.pack("<BIIdd", 1, 0x20000001, 4674, 2.5, -3.5),
        struct.pack(">BIIdd", 0, 0x20000001, 4674, 2.5, -3.5),
    ]
    assert out[4] is None
    assert [tuple(p) for p in column(spark, blobs[:4], "binary", geometry.point_xy)] == [(2.5, -3.5)] * 4


def test_transform_refuses_unknown_pairs():
    with pytest.raises(ValueError):
        geometry.transform(None, 31983, 4674)


def test_wkt(spark):
    rows = [(-10.0, 0.0), (0.1234567, -0.0), (1e-5, -1e-7), (100.5, 90.0), (None, 1.0), (180.0, 1e-20)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, lon double, lat double").orderBy("i")
    got = [r[0] for r in df.select(geometry.point_wkt(F.col("lon"), F.col("lat"))).collect()]
    assert got == [
        "POINT(-10 0)",
        "POINT(0.1234567 0)",
        "POINT(0.00001 -0.0000001)",
        "POINT(100.5 90)",
        None,
        "POINT(180 0)",
    ]


def test_wkt_parse(spark):
    texts = ["POINT(-56.1 -15.6)", "point ( 1e2  3 )", "LINESTRING(0 0, 1 1)", None, ""]
    assert column(spark, texts, "string", geometry.wkt_x) == [-56.1, 100.0, None, None, None]
    assert column(spark, texts, "string", geometry.wkt_y) == [-15.6, 3.0, None, None, None]


def test_points_of_mixed_layouts():
    """Both byte orders, with and without SRID and z, in arrays with offsets of either width."""
    rng = np.random.default_rng(1)
    blobs, expected = [], []
    for i in range(500):
        x, y = rng.normal(size=2)
        sign, code, tail = ("<", ">")[i % 2], 1 | (0x20000000 if i % 3 else 0) | (0x80000000 if i % 5 == 0 else 0), ()
        blob = struct.pack(sign + "BI", 1 if sign == "<" else 0, code) + (struct.pack(sign + "I", 4326) if i % 3 else b"")
        tail = (7.0,) if i % 5 == 0 else ()
        blobs.append(None if i % 11 == 0 else blob + struct.pack(f"{sign}{2 + len(tail)}d", x, y, *tail))
        expected.append(None if i % 11 == 0 else {"x": x, "y": y})
    for kind in (pa.binary(), pa.large_binary()):
        whole = pa.array(blobs, kind)
        assert geometry._read_points(whole).to_pylist() == expected
        assert geometry._read_points(whole.slice(37, 200)).to_pylist() == expected[37:237]
    assert geometry._read_points(pa.array([None], pa.binary())).to_pylist() == [None]
    for bad in (b"\x01", struct.pack("<BIdd", 1, 3, 0, 0), struct.pack("<BIdd", 1, 0x20000001, 0, 0)):
        with pytest.raises(ValueError, match="not a point"):
            geometry._read_points(pa.array([bad], pa.binary()))
