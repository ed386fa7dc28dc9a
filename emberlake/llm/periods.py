"""Runs of periodic words by enumeration of maximal pairs in the LCP-interval tree.

Two equal stretches of words that neither the word before nor the word after extends are a maximal pair. A run of
smallest period q that starts at s is the maximal pair (s, s + q): its common length is the run's length less q, so the
pair's distance and length say all about the run, and nothing is extended. The pairs come from the tree of
LCP-intervals, visited bottom-up: each interval has the positions of its suffixes in text order, every one labelled
with its class, the word to its left. Where two intervals meet in their parent, only a position and its next one in the
text can be s and s + q: a third occurrence between them would give a smaller period. Lists are merged small into large.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import gram_hashes, mixed, slices, word_hashes

RUN = "struct<start:long,length:long,period:long>"
Run = tuple[int, int, int]


def least_common(min_length: int, times: int) -> int:
    """No run has a maximal pair of fewer common words: period q asks for max(min_length - q, (times - 1) * q)."""
    return min(max(min_length - q, (times - 1) * q) for q in range(1, min_length + 1))


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and LCP array (``lcp[i]`` of suffixes i - 1 and i) by doubling the compared length.

    The ranks of each length are kept as 4 bytes a word for the LCP; lengths stop when all suffixes differ.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, step = [], 1
    while True:
        levels.append(np.append(rank, -1).astype(np.int32))
        if n < 2 or rank.max() == n - 1:
            break
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        step *= 2
    sa = np.argsort(rank)
    lcp = np.zeros(n, np.int64)
    a, b = sa[:-1].copy(), sa[1:].copy()
    for level in range(len(levels) - 2, -1, -1):  # the last level has no equal ranks
        same = levels[level][a] == levels[level][b]
        lcp[1:] += same.astype(np.int64) << level
        a += same.astype(np.int64) << level
        b += same.astype(np.int64) << level
    return sa, lcp


def _merge(depth: int, one: list[int], other: list[int], ids: list[int], min_length: int, times: int, found: list[Run]) -> list[int]:
    """Positions of both lists in text order; the runs among pairs of neighbours that the merge brings together."""
    if len(one) < len(other):
        one, other = other, one
    for x in other:
        insort(one, x)
    new = set(other) if len(other) > 1 else other

    def check(low: int, high: int) -> None:
        q = high - low
        if (times - 1) * q <= depth and depth + q >= min_length and (low == 0 or ids[low - 1] != ids[high - 1]):
            found.append((low, depth + q, q))

    for x in other:
        at = bisect_left(one, x)
        if at and one[at - 1] not in new:
            check(one[at - 1], x)
        if at + 1 < len(one) and one[at + 1] not in new:
            check(x, one[at + 1])
    return one


def runs_of(words: list, min_length: int = 24, times: int = 3) -> list[Run]:
    """(start, length, period) of every run of at least ``min_length`` words and ``times`` periods, by start and period."""
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    floor = least_common(min_length, times)
    if len(ids) <= floor:
        return []
    sa, lcp = suffix_order(np.array(ids, np.int64))
    deep = np.flatnonzero(lcp >= floor)
    found: list[Run] = []
    stack: list[list] = []  # open intervals: depth, positions
    last: list[int] = []
    before = -1

    def close(depth: int, last: list[int]) -> list[int]:
        while stack and stack[-1][0] > depth:
            own, positions = stack.pop()
            last = _merge(own, positions, last, ids, min_length, times, found)
        return last

    for i, common, left, own in zip(deep.tolist(), lcp[deep].tolist(), sa[deep - 1].tolist(), sa[deep].tolist()):
        if i != before + 1:  # another subtree
            close(-1, last)
            last = [left]
        last = close(common, last)
        if stack and stack[-1][0] == common:
            stack[-1][1] = _merge(common, stack[-1][1], last, ids, min_length, times, found)
        else:
            stack.append([common, last])
        last, before = [own], i
    close(-1, last)
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list, runs: list[Run]) -> list:
    """The words outside of all runs, and of each run its first period, unless another run drops it."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, gone in zip(words, np.cumsum(drop).tolist()) if not gone]


def _suspects(texts: list[list[bytes]], floor: int) -> np.ndarray:
    """Whether each text repeats some ``floor`` words; others have no interval deep enough. One sort for all texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    hashes = gram_hashes(word_hashes([w for t in texts for w in t]), floor)
    of = owner[: len(hashes)]
    inside = of == owner[floor - 1 :] if len(hashes) else of.astype(bool)
    keys = mixed(hashes[inside] + mixed(of[inside].astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(texts), bool)
    out[of[inside][order][1:][same]] = True
    return out


def periodic_runs(
    docs: DataFrame,
    min_length: int = 24,
    times: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each whole text, and its words without what runs repeat.

    Words are separated by ASCII white space. A run is a stretch with smallest period q of at least ``min_length`` words
    and ``times`` periods that no neighbouring word extends; runs come by start, then period. A word goes if any run
    contains it after that run's first period; the others are joined by one space. Null and empty texts have no words and
    no run. Rows are independent of each other: repeated and null ids are rows like others, and other columns are ignored.
    ``edit`` may change the words of a row before they are searched. No data move between tasks; a task holds about a
    megabyte of text and its longest text at a time.
    """
    floor = least_common(min_length, times)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            if edit:
                texts = [edit(i, words) for i, words in zip(ids, texts)]
            runs = [runs_of(words, min_length, times) if maybe else [] for words, maybe in zip(texts, _suspects(texts, floor).tolist())]
            kept = [b" ".join(without_repeats(words, r)) for words, r in zip(texts, runs)]
            listed = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], RUNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), listed, pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For a tenth of the ids, words from a place on repeat a few words; the id's crc32 says where and how many."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    rest = n - start
    period = 1 + rest // (3 + g % 8)
    return words[:start] + (words[start : start + period] * (rest // period + 1))[:rest]


def op12_periodic_runs(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    found = periodic_runs(table(spark, folder, "documents"), edit=repeated_tail)

    def by_exponent(a, b):
        """Greatest exact length / period first, then the smallest start, then the smallest period."""
        over = b["length"] * a["period"] - a["length"] * b["period"]
        return F.signum(F.coalesce(F.nullif(over, F.lit(0)), F.nullif(a["start"] - b["start"], F.lit(0)), a["period"] - b["period"])).cast("int")

    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.get(F.array_sort("runs", by_exponent), F.lit(0))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
