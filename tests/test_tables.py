import datetime
import os

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from emberlake import session
from emberlake.operators.lookup import DuplicateKeyError
from emberlake.session import require_utc, scratch_folder
from emberlake.sinks import tables as sink
from emberlake.sinks.tables import ConcurrentWriteError, append_missing, clean_versions, overwrite_table, upsert_table
from emberlake.sources import tables as source
from emberlake.sources.tables import current_version, query, read_table, table_exists


def frame(spark, rows, columns="k int, v string, p int"):
    return spark.createDataFrame(rows, columns)


def stored(spark, path, *columns):
    return rows_of(read_table(spark, path).select(*(columns or ("k", "v", "p"))))


def test_table_exists(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    os.mkdir(path)
    assert not table_exists(spark, path)
    overwrite_table(frame(spark, [(1, "a", 1)]), path)
    assert table_exists(spark, path)


def test_overwrite_replaces_all_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, [(1, "a", 1), (2, "a", 2)]), path, ["p"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        overwrite_table(frame(spark, [(3, "b", 2)]), path, ["p"], sort_by=["v"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stored(spark, path) == [(3, "b", 2)]


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, [(1, "a", 1), (2, "a", 2)]), path, ["p"])
    plan = plan_of(read_table(spark, path).filter("p = 2 AND k > 0"))
    assert "PartitionFilters: [isnotnull(p" in plan and "GreaterThan(k,0)" in plan


def test_hot_partition_is_split_over_files(spark, tmp_path):
    """One partition value with most rows must not end up in one task."""
    path = str(tmp_path / "t")
    # A hot value is split between outputs of map tasks, so there are more of them than cores.
    hash_text = F.sha2(F.col("id").cast("string"), 512).alias("v")
    cold = F.when(F.col("id") % 10 == 9, 1).otherwise(0).alias("p")
    rows = spark.range(0, 200000, 1, 16).select("id", hash_text, cold)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        overwrite_table(rows, path, ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in data_files(path) if f.startswith("/p=0/")]
    assert len(files) > 4
    assert read_table(spark, path).count() == 200000


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_upsert_and_rerun(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    first = frame(spark, [(1, "old", 1), (2, "old", 1), (3, "old", 2), (4, "old", None)])
    second = frame(spark, [(2, "new", 1), (5, "new", 3), (4, "new", None)])
    upsert_table(first, path, ["k"], partition_by)
    for _ in range(2):
        upsert_table(second, path, ["k"], partition_by)
        assert stored(spark, path) == sorted(
            [(1, "old", 1), (2, "new", 1), (3, "old", 2), (5, "new", 3), (4, "new", None)], key=repr
        )
        assert current_version(spark, path).number == 1


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(1, "old", 1), (2, "old", 2)]), path, ["k"], ["p"])
    before = os.listdir(f"{path}/p=2")
    upsert_table(frame(spark, [(1, "new", 1)]), path, ["k"], ["p"], keys_fix_partition=True)
    assert os.listdir(f"{path}/p=2") == before
    assert stored(spark, path) == [(1, "new", 1), (2, "old", 2)]


def test_merge_reads_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, [(i, "old", i % 5) for i in range(50)] + [(99, "old", None)]), path, ["p"])
    touched = sink._partitions(frame(spark, [(1, "x", 3), (2, "x", None)]), ["p"])
    target = sink._only_partitions(read_table(spark, path), ["p"], touched)
    assert rows_of(target.select("p").distinct()) == [(3,), (None,)]
    leaf = target._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    target.collect()
    assert leaf.metrics().get("numPartitions").get().value() == 2
    assert "PartitionFilters: [concat_ws" in plan_of(target)


def test_upsert_moves_rows_and_empties_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(1, "old", 1), (2, "old", 2), (3, "old", 2)]), path, ["k"], ["p"])
    upsert_table(frame(spark, [(1, "new", 2), (2, "new", 3)]), path, ["k"], ["p"])
    assert stored(spark, path) == [(1, "new", 2), (2, "new", 3), (3, "old", 2)]


def test_upsert_text_partitions(spark, tmp_path):
    """Folder names need escaping, and a text like 007 must stay text."""
    path = str(tmp_path / "t")
    columns = "k int, v string, p string, d date"
    day = datetime.date(2024, 1, 2)
    upsert_table(frame(spark, [(1, "old", "007", day), (2, "old", "a/b=c:d %", day)], columns), path, ["k"], ["p", "d"])
    upsert_table(frame(spark, [(1, "new", "a/b=c:d %", day), (2, "new", "8", None)], columns), path, ["k"], ["p", "d"])
    assert stored(spark, path, "k", "v", "p", "d") == [(1, "new", "a/b=c:d %", day), (2, "new", "8", None)]


def data_files(path):
    return {os.path.join(d, f)[len(path) :] for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def named_files(spark, path):
    """Files of the current version."""
    folders = set(current_version(spark, path).folders)
    return {f for f in data_files(path) if f[1:].rpartition("/")[0] in folders}


def test_merge_into_many_partitions_leaves_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3000).selectExpr("cast(id as int) AS k", "'old' AS v", "cast(id % 1000 as int) AS p")
    overwrite_table(rows.repartition(4, "p"), path, ["p"])
    before = named_files(spark, path)
    fresh = spark.range(700).selectExpr("cast(id as int) AS k", "'new' AS v", "cast(id as int) AS p").repartition(2, "p")
    upsert_table(fresh, path, ["k"], ["p"], keys_fix_partition=True)
    after = named_files(spark, path)
    kept = {f for f in before if int(f.split("/")[1][2:]) >= 700}
    assert before & after == kept and len(kept) >= 300
    assert read_table(spark, path).where("v = 'new'").count() == 700
    assert read_table(spark, path).count() == 3000


def test_duplicate_source_keys_raise_and_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(frame(spark, [(1, "old", 1)]), path, ["k"], ["p"])
    with pytest.raises(DuplicateKeyError):
        upsert_table(frame(spark, [(1, "a", 1), (1, "b", 1)]), path, ["k"], ["p"])
    with pytest.raises(DuplicateKeyError):
        append_missing(frame(spark, [(2, "a", 1), (2, "b", 1)]), path, ["k"], ["p"])
    assert stored(spark, path) == [(1, "old", 1)]


OLD, NEW = [(i, "old", i % 4) for i in range(8)], [(i, "new", i % 4 + 1) for i in range(4)]
MERGED = sorted(NEW + OLD[4:], key=repr)
REPLACED = sorted(NEW, key=repr)


@pytest.mark.parametrize("step", ["_write", "_commit", "clean_versions"])
@pytest.mark.parametrize("written", [False, True])
@pytest.mark.parametrize("partition_by", [[], ["p"]])
@pytest.mark.parametrize("merge", [True, False])
def test_a_killed_write_leaves_the_old_rows_or_the_new(spark, tmp_path, monkeypatch, step, written, partition_by, merge):
    """Killed before or after each step: only the rename inside the commit changes the table."""
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, OLD).repartition(4, "k"), path, partition_by)

    def write():
        rows = frame(spark, NEW).repartition(4, "k")
        upsert_table(rows, path, ["k"], partition_by) if merge else overwrite_table(rows, path, partition_by)

    real = getattr(sink, step)

    def dies(*args):
        if written:
            real(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(sink, step, dies)
        with pytest.raises(KeyboardInterrupt):
            write()
    wanted = MERGED if merge else REPLACED
    done = step == "clean_versions" or (step == "_commit" and written)
    assert stored(spark, path) == (wanted if done else sorted(OLD, key=repr))
    write()
    assert stored(spark, path) == wanted
    clean_versions(spark, path, keep=0)
    assert data_files(path) == named_files(spark, path)
    assert stored(spark, path) == wanted


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, OLD), path, ["p"])
    before = read_table(spark, path)
    upsert_table(frame(spark, NEW), path, ["k"], ["p"])
    overwrite_table(frame(spark, [(99, "other", 1)]), path, ["p"])
    assert rows_of(before) == sorted(OLD, key=repr)
    assert stored(spark, path) == [(99, "other", 1)]


def test_old_versions_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        overwrite_table(frame(spark, [(i, "x", 1)]), path, ["p"])
    assert source.version_numbers(spark, path) == [3, 4, 5]
    assert len(os.listdir(f"{path}/p=1")) == 3


def test_a_second_writer_raises(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, OLD), path)
    real = sink._write

    def overtaken(*args):
        monkeypatch.setattr(sink, "_write", real)
        folders = real(*args)
        overwrite_table(frame(spark, [(1, "first", 1)]), path)
        return folders

    monkeypatch.setattr(sink, "_write", overtaken)
    with pytest.raises(ConcurrentWriteError):
        overwrite_table(frame(spark, NEW), path)
    assert stored(spark, path) == [(1, "first", 1)]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_folders_of_other_writers_are_taken_over(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    frame(spark, OLD).write.partitionBy(*partition_by).parquet(path)
    assert stored(spark, path) == sorted(OLD, key=repr)
    upsert_table(frame(spark, NEW), path, ["k"], partition_by)
    assert stored(spark, path) == MERGED
    clean_versions(spark, path, keep=0)
    assert data_files(path) == named_files(spark, path)


def test_a_table_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, OLD).where("k < 0"), path, ["p"])
    assert table_exists(spark, path) and read_table(spark, path).count() == 0
    assert dict(read_table(spark, path).dtypes) == {"k": "int", "v": "string", "p": "int"}
    upsert_table(frame(spark, NEW), path, ["k"], ["p"])
    assert stored(spark, path) == REPLACED


def test_unchanged_rows_rewrite_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"v{i}", i % 10) for i in range(100)] + [(1000, None, None)]
    upsert_table(frame(spark, rows), path, ["k"], ["p"])
    before = named_files(spark, path)
    upsert_table(frame(spark, rows), path, ["k"], ["p"], keys_fix_partition=True)
    assert named_files(spark, path) == before and current_version(spark, path).number == 0
    # One changed row, one that moves, one that is new: only folders that hold the old ones go.
    fresh = [*rows[:50], (51, "changed", 1), (52, "v52", 7), (200, "new", 9), (1000, None, None)]
    upsert_table(frame(spark, [r for r in fresh]), path, ["k"], ["p"])
    gone = {f.split("/")[1] for f in before - named_files(spark, path)}
    assert gone == {"p=1", "p=2"}
    wanted = {r[0]: r for r in [*rows, *fresh]}
    assert stored(spark, path) == sorted(wanted.values(), key=repr)


def test_crowded_partitions_are_joined(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(sink.CROWDED + 3):
        upsert_table(frame(spark, [(i, "x", 1)]), path, ["k"], ["p"])
        assert len(current_version(spark, path).folders) <= sink.CROWDED
    assert len(stored(spark, path)) == sink.CROWDED + 3


def test_driver_calls_do_not_grow_with_files(spark, tmp_path, monkeypatch):
    calls = []
    for module in (sink, source):
        real = module.file_system
        monkeypatch.setattr(module, "file_system", lambda *a, real=real: calls.append(a) or real(*a))
    counts = []
    for parts in (1, 40):
        calls.clear()
        overwrite_table(spark.range(4000).repartition(parts), str(tmp_path / f"t{parts}"))
        counts.append(len(calls))
    assert counts[0] == counts[1] and len(data_files(str(tmp_path / "t40"))) > len(data_files(str(tmp_path / "t1")))


def test_rows_are_sorted_within_files(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(20000).selectExpr("id AS k", "hash(id) AS v", "id % 3 AS p"), path, ["p"], sort_by=["v"])
    folders = current_version(spark, path).folders
    for folder in folders:
        for name in os.listdir(f"{path}/{folder}"):
            if name.endswith(".parquet"):
                values = [r.v for r in spark.read.parquet(f"{path}/{folder}/{name}").collect()]
                assert values == sorted(values)


def test_a_failing_job_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, OLD), path)
    with pytest.raises(Exception, match="lost"):
        overwrite_table(frame(spark, NEW).withColumn("k", F.raise_error(F.lit("lost")).cast("int")), path)
    assert stored(spark, path) == sorted(OLD, key=repr)


def test_an_overwrite_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(frame(spark, OLD), path)
    overwrite_table(read_table(spark, path).where("k < 3"), path)
    assert stored(spark, path) == sorted(OLD[:3], key=repr)


def test_append_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    append_missing(frame(spark, [(1, "old", 1), (2, "old", 2)]), path, ["k"], ["p"])
    before = os.listdir(f"{path}/p=1")
    for _ in range(2):
        append_missing(frame(spark, [(2, "new", 2), (3, "new", 2)]), path, ["k"], ["p"])
    assert os.listdir(f"{path}/p=1") == before
    assert stored(spark, path) == [(1, "old", 1), (2, "old", 2), (3, "new", 2)]


def test_slices_equal_one_load(spark, tmp_path):
    rows = [(i, f"v{i % 3}", i % 4) for i in range(40)]
    whole, sliced = str(tmp_path / "whole"), str(tmp_path / "sliced")
    upsert_table(frame(spark, rows), whole, ["k"], ["p"])
    for start in range(0, 40, 10):
        upsert_table(frame(spark, rows[max(0, start - 3) : start + 10]), sliced, ["k"], ["p"])
    assert stored(spark, whole) == stored(spark, sliced)


def test_query_binds_values(spark):
    text = "SELECT count(*) AS n FROM {some_rows} WHERE v = :v"
    rows = frame(spark, [(1, "x' OR '1'='1", 1), (2, "y", 1)])
    assert query(spark, {"some_rows": rows}, text, v="x' OR '1'='1").first().n == 1


def test_scratch_is_under_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "a").startswith(root)
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")


def test_shuffles_fit_their_input(spark, tmp_path, monkeypatch):
    (tmp_path / "part").write_bytes(b"x" * 10000)
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert session.fit_shuffles(spark, str(tmp_path), str(tmp_path / "absent")) == 4
        monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
        assert session.fit_shuffles(spark, str(tmp_path)) == int(spark.conf.get(setting)) == 10
    finally:
        spark.conf.unset(setting)


def test_zone_must_be_utc(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
