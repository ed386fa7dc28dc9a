from collections import Counter

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from emberlake.functions.geometry import geometry_label, point, srid_of
from emberlake.operators import lookup
from emberlake.operators.lookup import (
    Dimension,
    DuplicateKeyError,
    lookup_join,
    measure,
    require_unique,
    sized,
    star_join,
    unmatched_counts,
)
from emberlake.operators.measures import count_by, count_charts, headline, options, pairs, with_share
from emberlake.operators.merge import merge_rows, missing_rows
from emberlake.operators.shaping import conform, normalize_frame, nulled_cells, typed, union_by_name


def test_typed_and_nulled_cells(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01"), ("y", "2.5", "no"), (None, None, None)], "a string, b string, c string")
    kinds = {"a": "int", "b": "double", "c": "timestamp"}
    assert [r.a for r in typed(df, kinds).collect()] == [1, None, None]
    assert tuple(nulled_cells(df, kinds).first()) == (1, 1, 1)


def test_conform_union(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    two = spark.createDataFrame([(9, 4, 3)], "extra int, bb int, a int")
    both = union_by_name(conform(one, ["a", "b"]), conform(two, ["a", "b"], {"bb": "b"}))
    assert rows_of(both) == [(1, 2), (3, 4)]


def test_normalize_frame_by_type(spark):
    df = spark.createDataFrame([("é", 1, 2.0, 3.0)], "s string, n int, lon double, lat double")
    df = df.withColumn("t", F.lit("2024-01-01 00:00:00.5").cast("timestamp"))
    label = geometry_label(4326)
    df = df.withColumn("g", point(F.col("lon"), F.col("lat"), 4326)).withColumn("g", F.col("g").alias("g", metadata=label))
    out = normalize_frame(df.withColumn("raw", F.lit(b"\x01")))
    row = out.select("s", "n", srid_of(F.col("g")).alias("srid"), "t", "raw").first()
    assert (row.s, row.n, row.srid, row.t.microsecond, bytes(row.raw)) == ("E", 1, 4674, 500000, b"\x01")
    assert out.schema["g"].metadata["srid"] == 4674


def test_lookup_join_small_side_is_broadcast_large_side_is_not(spark):
    facts = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(5).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    spec = Dimension(dim, {"k": "key"}, {"name": "name"})
    small = lookup_join(facts, spec, "left")
    assert "BroadcastHashJoin" in plan_of(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_join(facts, spec, "left", limit=10)
        assert "Broadcast" not in plan_of(large)
        assert rows_of(small) == rows_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small.filter("name IS NULL").count() == sum(1 for i in range(1000) if i % 7 >= 5)


def test_measure_grows_with_the_side(spark):
    small = spark.range(10).select(F.lit("x" * 10).alias("s"))
    large = spark.range(10).select(F.lit("x" * 1000).alias("s"))
    assert measure(small).rows == 10
    assert measure(large).bytes - measure(small).bytes == 9900
    assert measure(spark.range(3).select(F.array("id").alias("a"))) is None
    assert "ResolvedHint" not in sized(large, 1)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in sized(large)._jdf.queryExecution().analyzed().toString()


def test_duplicate_dimension_keys(spark):
    facts = spark.createDataFrame([("a",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "key string, v int")
    spec = Dimension(dim, {"k": "key"}, {"v": "v"})
    with pytest.raises(DuplicateKeyError):
        lookup_join(facts, spec, unique=True)
    assert lookup_join(facts, spec).count() == 3
    # Null keys match nothing, so repeated ones are no duplicates.
    fine = Dimension(dim.filter("v <> 2"), {"k": "key"}, {"v": "v"})
    assert rows_of(lookup_join(facts, fine, unique=True)) == [("a", 1), (None, None)]
    with pytest.raises(DuplicateKeyError):
        require_unique(dim, ["key"], "dim")
    require_unique(dim.filter("v > 2"), ["key"], "dim")


def test_dimensions_are_measured_once(spark, monkeypatch):
    dim = spark.sql("SELECT * FROM VALUES (1L, 'a', 'x'), (2L, 'b', 'x'), (3L, 'b', 'y') AS t(id, name, grp)")
    facts = spark.sql("SELECT * FROM VALUES (1L, 'a'), (2L, 'b'), (2L, 'b'), (9L, 'z') AS t(fk, label)")
    seen, plain = [], lookup.measure_all
    monkeypatch.setattr(lookup, "measure_all", lambda sides: seen.append(len(sides)) or plain(sides))

    def joined(where=None, on=None, unique=False, frame=dim, limit=lookup.BROADCAST_BYTES):
        seen.clear()
        on = on or {"fk": "id"}
        take = {"id2": "id"} if "label" in on else {"name": "name"}
        found = star_join(facts, [Dimension(frame, on, take, where)], "inner", unique=unique, limit=limit)
        return found.count(), sum(seen), plan_of(found)

    assert joined()[:2] == (3, 1)
    # Another filter, or the same columns joined the other way round, needs no job.
    assert joined(F.col("name") == "b")[:2] == (2, 0)
    assert "BroadcastHashJoin" in joined(F.col("name") == "a")[2]
    assert joined(on={"label": "name"})[:2] == (5, 0)
    # Uniqueness is another question: asked once, and of the filtered side if the whole fails.
    assert joined(unique=True)[:2] == (3, 1)
    assert joined(unique=True)[:2] == (3, 0)
    assert joined(F.col("grp") == "x", {"label": "name"}, unique=True)[:2] == (3, 2)
    with pytest.raises(DuplicateKeyError):
        joined(on={"label": "name"}, unique=True)
    # A part may be small where the whole is not; a frame made anew is measured anew.
    few = lookup.measure(dim.select("id", "name").limit(1)).bytes
    found = joined(F.col("name") == "a", limit=few)
    assert found[:2] == (1, 1) and "BroadcastHashJoin" in found[2]
    assert joined(frame=dim.select("*"))[1] == 1


def test_star_join_with_hot_key_without_broadcast(spark):
    """A key that holds a third of all rows, another third null, must give the same rows."""
    facts = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 100).alias("k")
    )
    dim = spark.range(100).filter("id <> 5").select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = star_join(facts, [Dimension(dim, {"k": "key"}, {"v": "v"})], "left", limit=0)
        got = Counter((r.k, r.v) for r in joined.collect())
    finally:
        for key in conf:
            spark.conf.unset(key)
    expected = Counter()
    for i in range(30000):
        k = 7 if i % 3 == 0 else i % 100 if i % 3 == 1 else None
        expected[(k, None if k is None or k == 5 else 2 * k)] += 1
    assert got == expected


def test_unmatched_counts(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, 3)], "a int, b int")
    assert rows_of(unmatched_counts(df, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_merge_rows(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    source = spark.createDataFrame([("new", 2), ("new", 3), ("new", None)], "v string, k int")
    got = Counter(tuple(r) for r in merge_rows(target, source, ["k"]).collect())
    assert got == Counter([(1, "old"), (None, "old"), (2, "new"), (3, "new"), (None, "new")])
    assert merge_rows(target, source, ["k"], limit=0).count() == 5
    assert sorted(r.k for r in missing_rows(source, target, ["k"]).dropna().collect()) == [3]


def test_headline(spark):
    df = spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, None, 2.0), (None, 2, 4, None)], "m int, b int, d int, r double")
    row = headline(df, {"ms": "m", "bs": "b"}, {"md": "d", "mr": "r"}).first()
    assert tuple(row) == (3, 1, 2, 3.0, 1.5)
    empty = headline(df.filter("b > 9"), {"ms": "m", "bs": "b"}, {"md": "d", "mr": "r"}).first()
    assert tuple(empty) == (0, 0, 0, None, None)


def test_counts_shares_and_charts(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 2, "x"), (None, 3, "x")], "g string, id int, h string")
    counts = count_by(df, "g", "id", "n")
    assert [tuple(r) for r in counts.collect()] == [("a", 1), ("b", 1)]
    assert [r.share for r in with_share(counts, "n").collect()] == [0.5, 0.5]
    long = count_charts(df, {"g": F.col("g"), "h": F.col("h")}, "id")
    assert [tuple(r) for r in long.collect()] == [
        ("g", "a", 1, 0.5),
        ("g", "b", 1, 0.5),
        ("h", "x", 3, 1.0),
        ("h", "y", 0, 0.0),
    ]
    assert count_by(df, F.upper("g"), "id", "n", alias="G").columns == ["G", "n"]


def test_options_and_pairs(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (2, "b"), (3, "a")], "id int, name string")
    assert [tuple(r) for r in options(df, ["id", "name"], "name").collect()] == [(1, "a"), (3, "a"), (2, "b")]
    points = spark.createDataFrame([(1.0, None), (None, 1.0), (2.0, 3.0)], "x double, y double")
    assert rows_of(pairs(points, "x", "y")) == [(2.0, 3.0)]
