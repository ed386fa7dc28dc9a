"""Document fingerprints by order min-hash: sensitive to edits and to the order of a text's parts.

A text's k-mers of code points are numbered by occurrence and hashed. The hash deals each numbered k-mer to one of the
signature's places; a place keeps its few least ones, puts them back into text order, and hashes the tuple. Dealing
with one hash replaces one hash function for each place, so a text is read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import gram_hashes, id_of, mixed, rows_of_texts, text_key

# Code points in a k-mer, k-mers in a tuple, tuples in a signature (a power of two).
KMER, TUPLE, PLACES = 6, 2, 128
# Texts and code points handled at once; a longer text is handled alone.
BATCH_TEXTS, BATCH_CHARS = 256, 1 << 20
# Low values looked at for each place before all are.
LOW = 12
# Ranges of ids that a task compares one after another.
BUCKETS_A_TASK = 8
# Bits of a k-mer's hash that are kept, the same for every text, and of its position where both share a sort key.
GRAM_BITS, AT_BITS = 36, 20
_PLACE_BITS = PLACES.bit_length() - 1
_STEP = np.uint64(0xD1B54A32D192ED03)
_FAR = np.iinfo(np.int64).max


def _bits(n: int) -> np.uint64:
    return np.uint64(n)


def _below(n: int) -> np.uint64:
    return np.uint64((1 << n) - 1)


def _signatures(points: list[np.ndarray]) -> np.ndarray:
    """Signatures of a few texts in one pass.

    A sort key holds the text (8 bits), its k-mer's hash and its position, so that equal k-mers of a text stand
    together in text order. A longer text, whose positions do not fit, is alone and sorted by the same hash bits.
    """
    counts = np.array([max(len(p) - KMER + 1, min(len(p), 1)) for p in points])
    grams = np.concatenate([gram_hashes(p, min(KMER, len(p))) if len(p) else p for p in points])
    total = len(grams)
    if not total:
        return np.zeros((len(points), PLACES), np.uint16)
    text = np.repeat(np.arange(len(points), dtype=np.uint64), counts)
    gram = grams >> _bits(64 - GRAM_BITS)
    if total <= 1 << AT_BITS:
        keys = np.sort((text << _bits(GRAM_BITS + AT_BITS)) | (gram << _bits(AT_BITS)) | np.arange(total, dtype=np.uint64))
        at = keys & _below(AT_BITS)
        gram = keys >> _bits(AT_BITS)  # with the text in its high bits
    else:
        at = np.lexsort((gram, text)).astype(np.uint64)
        gram = (text << _bits(GRAM_BITS)) | gram[at.astype(np.int64)]
    index = np.arange(total)
    first = np.maximum.accumulate(np.where(np.append(True, gram[1:] != gram[:-1]), index, 0))
    gram &= _below(GRAM_BITS)
    with np.errstate(over="ignore"):
        numbered = mixed(gram + (index - first).astype(np.uint64) * _STEP)
    # ``text`` fits the sorted keys as well, since they are sorted by text first.
    bins = (text << _bits(_PLACE_BITS)) | (numbered >> _bits(64 - _PLACE_BITS))
    value = (numbered << _bits(_PLACE_BITS)) >> _bits(40)
    limit = np.minimum(LOW * PLACES / np.maximum(counts, 1), 1) * 2.0**24
    low = value < limit.astype(np.uint64)[text.astype(np.int64)]
    enough = np.bincount(bins[low].astype(np.int64), minlength=len(points) * PLACES).reshape(-1, PLACES).min(1) >= TUPLE
    low |= ~enough[text.astype(np.int64)]
    rows = np.flatnonzero(low)
    # Place, value, then k-mer order: 15 bits, 24 bits, the rest.
    order = np.sort((bins[rows] << _bits(49)) | (value[rows] << _bits(25)) | np.arange(len(rows), dtype=np.uint64)) if len(rows) < 1 << 25 else None
    if order is None:
        ranks = np.lexsort((value[rows], bins[rows]))
    else:
        ranks = (order & _below(25)).astype(np.int64)
    rows = rows[ranks]
    start = np.searchsorted(bins[rows], np.arange(len(points) * PLACES + 1, dtype=np.uint64))
    place = start[:-1, None] + np.arange(TUPLE)
    there = place < start[1:, None]
    row = rows[np.minimum(place, len(rows) - 1)]
    by_place = np.argsort(np.where(there, at[row].astype(np.int64), _FAR), axis=1, kind="stable")
    chosen = np.where(np.take_along_axis(there, by_place, 1), gram[np.take_along_axis(row, by_place, 1)] + np.uint64(1), np.uint64(0))
    tuples = np.zeros(len(chosen), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(TUPLE):
            tuples = mixed(tuples * _STEP + chosen[:, i])
    short = (tuples >> np.uint64(48)).astype(np.uint16)
    return np.where(there[:, 0], np.maximum(short, 1), 0).astype(np.uint16).reshape(-1, PLACES)


def signatures(texts: list[str]) -> np.ndarray:
    """For each text PLACES numbers of 16 bits; 0 where it has no k-mer for a place. A shorter text is one k-mer."""
    done, group, size = [np.zeros((0, PLACES), np.uint16)], [], 0
    for text in texts:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if group and (size + len(points) > BATCH_CHARS or len(group) == BATCH_TEXTS):
            done.append(_signatures(group))
            group, size = [], 0
        group.append(points)
        size += len(points)
    return np.concatenate([*done, _signatures(group)]) if group else done[0]


def as_text(marks: np.ndarray) -> str:
    """Four hexadecimal digits a place."""
    return marks.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal places among those that either text fills; 1 if neither fills any."""
    filled = (a > 0) | (b > 0)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text; null and empty texts have the fingerprint of zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            marks = [as_text(m) for m in signatures(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(marks, pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return rows_of_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, then a bucket's own rows before the row that follows it in the next bucket."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    bucket, last = None, None
    for batch in batches:
        columns = [batch.column(c) for c in ("bucket", "follower", "doc_id")]
        texts = [t or "" for t in batch.column("text").to_pylist()]
        marks = signatures(texts)
        pairs = []
        for i, (b, follower, doc_id) in enumerate(zip(*(c.to_pylist() for c in columns))):
            if b != bucket:
                bucket, last = b, None
            if last is None and follower:
                continue  # the bucket's own rows are done
            if last is not None:
                half = len(last[1]) // 2
                pairs.append((*last, marks[i], last[1][: len(last[1]) - half] + texts[i][:half]))
            last = None if follower else (doc_id, texts[i], marks[i])
        changed = signatures([p[-1] for p in pairs])
        rows = [
            (doc_id, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), as_text(own), as_text(new), likeness(own, new), likeness(own, after))
            for (doc_id, text, own, after, edited), new in zip(pairs, changed)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names)


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text whose second half is overwritten by the start of the next document.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Documents follow each
    other by descending id, after the last comes the first; null ids come first, rows that repeat an id follow by the
    hash of their texts. A single document follows itself. Other columns are ignored.

    Rows are dealt to buckets of neighbouring ids (bounds are quantiles of the ids), sorted there, and streamed; the
    first row of a bucket is also sent to the bucket before it. Texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = rows_of_texts(docs, id_col, text_col).withColumn("__id", id_of("doc_id"))
    n = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    # Several buckets a task, dealt by hash: long texts of neighbouring ids then spread over tasks.
    buckets = BUCKETS_A_TASK * n
    cuts = rows.agg(F.percentile_approx("__id", [i / buckets for i in range(1, buckets)], 4 * buckets)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        # Descending: the bucket of the largest ids is 0.
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(), side="left")).astype("int32")

    firsts = sorted((r["b"], r["first"]) for r in rows.select("__id", bucket_of("__id").alias("b")).groupBy("b").agg(F.max("__id").alias("first")).collect())
    # One row for each bucket: which id begins it and which bucket comes before.
    before = spark.createDataFrame([(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)], "__id long, __before int")
    own = rows.withColumns({"bucket": bucket_of("__id"), "follower": F.lit(False)})
    heads = rows.join(F.broadcast(before), "__id").withColumns({"bucket": F.col("__before"), "follower": F.lit(True)}).drop("__before")
    dealt = (
        own.unionByName(heads)
        .withColumn("__text", text_key("text"))
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "follower", F.desc("__id"), "__text")
    )
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("bucket", "follower", "doc_id", "text").mapInArrow(_compare, schema)


def op8_fingerprints(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    return compare_with_edited(table(spark, folder, "documents"))
