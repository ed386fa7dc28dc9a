"""The pipeline's stages on rows that lack ids, repeat, or hold columns of private names."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emberlake.llm import language, mixing, near_dedup
from emberlake.llm.common import slices

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(3)
WORDS = ["".join(RNG.choices("abcdefgiklmnoprstu", k=RNG.randrange(3, 9))) for _ in range(300)]


def text_of(n):
    return " ".join(RNG.choices(WORDS, k=n))


def rows_of(spark, rows, more=""):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *rest) for i, t, s, *rest in rows], COLUMNS + more)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_rows_without_id_go_only_with_their_own_group(spark):
    a, b, c = text_of(60), text_of(60), text_of(60)
    rows = [(1, a, "x"), (None, a + " more", "x"), (None, b, "x"), (7, c, "y"), (None, "", "y"), (None, None, "y")]
    out = corpus_pipeline.near_dedup(spark, rows_of(spark, rows), "")
    assert kept(out) == sorted([(1, a), (None, b), (7, c), (None, ""), (None, None)], key=repr)


def test_groups_of_rows_without_id_keep_one_text(spark):
    a, b = text_of(80), text_of(80)
    near = [a, a + " one", a + " two"]
    out = corpus_pipeline.near_dedup(spark, rows_of(spark, [(None, t, "x") for t in [*near, b]]), "")
    texts = [t for _, t in kept(out)]
    assert b in texts and len(texts) == 2
    found = near_dedup.near_duplicates(rows_of(spark, [(None, t, "x") for t in [*near, b]] + [(4, "", "x")]))
    assert [r.component_id for r in found.orderBy("doc_id").collect()] == [None, None, None, None, 4]


def test_only_rows_with_the_greatest_ids_raise(spark):
    docs = rows_of(spark, [(2**63 - 1, text_of(9), "x"), (None, text_of(9), "x")])
    with pytest.raises(ValueError, match="leave no numbers"):
        near_dedup.near_duplicates(docs)


def test_rows_of_one_id_and_text_in_two_sources(spark):
    texts = {i: text_of(5 + i) for i in range(60)}
    rows = [(i, t, s) for i, t in texts.items() for s in ("a", "b")] + [(100 + i, text_of(30), "c") for i in range(40)]
    docs = rows_of(spark, rows)
    out = corpus_pipeline.mixing(spark, docs, "")
    assert out.columns == docs.columns
    counts = out.groupBy("doc_id", "source").count()
    assert counts.agg(F.max("count")).first()[0] <= 2
    got = dict(out.groupBy("source").agg(F.sum(F.size(F.split("text", " ")))).collect())
    targets = dict(mixing.mix(docs).select(F.substring("src", 2, 9), "target").distinct().collect())
    for source, words in got.items():
        assert words == pytest.approx(targets[source], rel=0.02)


def test_rows_repeated_as_a_whole_are_taken_alike(spark):
    docs = rows_of(spark, [(5, text_of(20), "a")] * 3 + [(i, text_of(20), "b") for i in range(6, 30)])
    counts = {r.doc_id: r["count"] for r in corpus_pipeline.mixing(spark, docs, "").groupBy("doc_id").count().collect()}
    assert counts.get(5, 0) in (0, 3, 6)


def test_clashing_columns_pass_through(spark):
    more = ", copies int, id string, size long, src string, kept boolean, component string, rank int"
    rows = [(i, text_of(40), "a", 9, "k", 1, "s", True, "c", 2) for i in range(20)]
    docs = rows_of(spark, [*rows, (50, rows[0][1], "b", *rows[0][3:])], more)
    for stage in (corpus_pipeline.language_id, corpus_pipeline.line_dedup, corpus_pipeline.near_dedup, corpus_pipeline.mixing):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        assert out.where("copies <> 9 OR size <> 1 OR component <> 'c'").count() == 0
    assert 50 not in {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_counting_works_in_slices():
    line = text_of(2000)
    texts = [line[RNG.randrange(500) :] for _ in range(20_000_000 // len(line))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts))], ["text", "lang"])
    tracemalloc.start()
    total = sum(sum(out.column("n").to_pylist()) for out in language._count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == sum(map(len, texts)) + len(texts)
    assert peak < 100_000_000


def test_slices_lose_no_rows():
    texts = ["", None, "x" * 50, "y" * 10, "", "z" * 9, None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = [p.column("text").to_pylist() for p in slices(iter([batch, batch.slice(0, 0)]), limit=20)]
    assert [t for p in parts for t in p] == texts
    assert all(sum(len(t or "") for t in p) <= 20 or len([t for t in p if t]) == 1 for p in parts)
