"""Substring dedup: passages that an earlier document holds are removed, found by suffix automata.

Candidates. Every window of WINDOW words holds a winnowed anchor, a short run of words of least hash, at the same place
in every document. Only windows around anchors that several documents hold are hashed; a window's first document is the
least id that has its hash. This tells which earlier documents a document must be compared with.

Comparison. The candidate regions of those earlier documents are dealt to shards of bounded size. A shard's suffix
automaton over words is built in each task that needs it, and the regions of the documents routed to the shard stream
through it: wherever the matching statistic reaches the window, the state tells the least id that holds those very
words. Words decide here, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import gram_hashes, id_of, rows_of_texts, stored, text_key, word_hashes
from emberlake.session import materialised

# Words in an anchor.
ANCHOR = 5
# Words of a shard's reference regions, and of the regions that stream through one copy of its automaton.
SHARD_WORDS, PART_WORDS = 40_000, 400_000


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Positions of the least hash in every ``span`` consecutive grams, the last one on ties."""
    if len(grams) < span:
        return np.empty(0, np.int64)
    backwards = np.lib.stride_tricks.sliding_window_view(grams, span)[:, ::-1]
    return np.unique(np.arange(len(backwards)) + span - 1 - backwards.argmin(1))


def _emit_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, places, counts = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                grams = gram_hashes(word_hashes(words), ANCHOR) if len(words) >= window else np.empty(0, np.uint64)
                at = anchors(grams, window - ANCHOR + 1)
                hashes.append(grams[at].view(np.int64)), places.append(at.astype(np.int32)), counts.append(len(at))
            ids = np.repeat(batch.column("id").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, t)) for x, t in ((hashes, np.int64), (places, np.int32))] + [pa.array(ids)], ["h", "at", "id"])

    return run


def runs_of(flags: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


def _cut_regions(window: int):
    """The words around repeated anchors, by runs of candidate windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, texts, sizes = [], [], []
            for text, marks in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("marks").to_pylist()):
                words = text.split()
                n = len(words) - window + 1
                change = np.zeros(max(n, 0) + 1, np.int32)
                if n > 0:
                    at = np.array(marks, np.int64)
                    np.add.at(change, np.clip(at + ANCHOR - window, 0, n), 1)
                    np.add.at(change, np.clip(at + 1, 0, n), -1)
                found = [(int(a), int(b) + window - 1) for a, b in runs_of(np.cumsum(change)[:-1] > 0)]
                merged: list[tuple[int, int]] = []
                for a, b in found:
                    if merged and a <= merged[-1][1]:
                        merged[-1] = (merged[-1][0], b)
                    else:
                        merged.append((a, b))
                starts.append([a for a, _ in merged])
                texts.append([b" ".join(words[a:b]).decode("utf-8") for a, b in merged])
                sizes.append(sum(b - a for a, b in merged))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tk"), pa.array(starts, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string())), pa.array(sizes, pa.int64())],
                ["id", "tk", "starts", "texts", "words"],
            )

    return run


def _hash_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = [np.empty(0, np.uint64)], []
            for texts in batch.column("texts").to_pylist():
                own = [gram_hashes(word_hashes(t.encode().split()), window) for t in texts]
                found = np.unique(np.concatenate(own)) if own else np.empty(0, np.uint64)
                hashes.append(found), counts.append(len(found))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.repeat(batch.column("id").to_numpy(), counts))], ["w", "id"])

    return run


class SuffixAutomaton:
    """Suffix automaton over the words of several regions; every state knows the least id among its occurrences."""

    def __init__(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [np.iinfo(np.int64).max]
        self.last, self.breaks = 0, 0

    def _extend(self, code: int, owner: int) -> None:
        nexts, link, length = self.next, self.link, self.length
        new = len(nexts)
        nexts.append({}), link.append(0), length.append(length[self.last] + 1), self.first.append(owner)
        p = self.last
        while p >= 0 and code not in nexts[p]:
            nexts[p][code] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][code]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q])), link.append(link[q]), length.append(length[p] + 1), self.first.append(self.first[q])
                while p >= 0 and nexts[p].get(code) == q:
                    nexts[p][code] = copy
                    p = link[p]
                link[q] = link[new] = copy
        self.last = new

    def add(self, words: list[bytes], owner: int) -> None:
        """A region; a symbol of its own separates it from the next."""
        codes = self.codes
        for word in words:
            self._extend(codes.setdefault(word, len(codes)), owner)
        self.breaks -= 1
        self._extend(self.breaks, owner)

    def finish(self) -> None:
        """A state occurs wherever the longer states that link to it do."""
        first, link = self.first, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            parent = link[state]
            if first[state] < first[parent]:
                first[parent] = first[state]

    def earlier(self, words: list[bytes], owner: int, window: int) -> list[int]:
        """Ends (exclusive) of the windows whose words also occur in a region of a smaller id."""
        nexts, link, length, first, codes = self.next, self.link, self.length, self.first, self.codes
        state = matched = 0
        ends = []
        for at, word in enumerate(words, 1):
            code = codes.get(word)
            if code is None:
                state = matched = 0
                continue
            while state and code not in nexts[state]:
                state = link[state]
                matched = length[state]
            if code in nexts[state]:
                state = nexts[state][code]
                matched += 1
            if matched >= window:
                # The state of the last ``window`` words: what is longer is not needed.
                while length[link[state]] >= window:
                    state = link[state]
                matched = window
                if first[state] < owner:
                    ends.append(at)
        return ends


def _stream(window: int):
    def run(reference: pa.Table, visitors: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if reference.num_rows and visitors.num_rows:
            automaton = SuffixAutomaton()
            for owner, texts in zip(reference["source"].to_pylist(), reference["source_texts"].to_pylist()):
                for text in texts:
                    automaton.add(text.encode().split(), owner)
            automaton.finish()
            for i, tk, starts, texts in zip(*(visitors[c].to_pylist() for c in ("id", "tk", "starts", "texts"))):
                spans = []
                for start, text in zip(starts, texts):
                    for end in automaton.earlier(text.encode().split(), i, window):
                        low, high = start + end - window, start + end
                        if spans and low <= spans[-1]:
                            spans[-1] = high
                        else:
                            spans += [low, high]
                if spans:
                    out[0].append(i), out[1].append(tk), out[2].append(spans)
        return pa.table({"id": pa.array(out[0], pa.int64()), "tk": pa.array(out[1], pa.int64()), "spans": pa.array(out[2], pa.list_(pa.int32()))})

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, lists in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
            words = (text or b"").split()
            gone = np.zeros(len(words), bool)
            for spans in lists or ():
                for low, high in zip(spans[::2], spans[1::2]):
                    gone[low:high] = True
            removed = int(gone.sum())
            n_words.append(len(words)), n_removed.append(removed)
            kept.append(b" ".join([w for w, g in zip(words, gone) if not g] if removed else words).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def removed_spans(rows: DataFrame, window: int) -> DataFrame:
    """(id, tk, spans): word positions [low, high, low, high, ...] of rows (id, tk, text) that an earlier id holds too."""
    # The two large tables of hashes are removed as soon as what they are for is stored.
    with materialised(rows.select("id", "text").mapInArrow(_emit_anchors(window), "h long, at int, id long"), "anchors") as marks:
        shared = marks.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h")
        marked = stored(marks.join(stored(shared, "shared-anchors"), "h").groupBy("id").agg(F.collect_list("at").alias("marks")), "marks")
    regions = stored(
        rows.where("text IS NOT NULL").join(marked, "id").select("id", "tk", "text", "marks").mapInArrow(_cut_regions(window), "id long, tk long, starts array<int>, texts array<string>, words long"),
        "regions",
    )
    with materialised(regions.select("id", "texts").mapInArrow(_hash_windows(window), "w long, id long"), "windows") as windows:
        firsts = windows.groupBy("w").agg(F.min("id").alias("source"), F.max("id").alias("most")).where("source < most").select("w", "source")
        routes = stored(windows.join(stored(firsts, "first-windows"), "w").where("source < id").select("id", "source").distinct(), "routes")

    sources = routes.select("source").distinct().join(regions.select(F.col("id").alias("source"), F.col("texts").alias("source_texts"), F.col("words").alias("source_words")), "source")
    sources = stored(sources, "sources")
    total = sources.agg(F.coalesce(F.sum("source_words"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("source"), F.lit(shards))
    visits = stored(routes.select("id", shard.alias("shard")).distinct(), "visits")
    visitors = stored(visits.join(regions, "id"), "visitors")
    # A shard that many documents visit is built in several tasks, each for a part of them.
    loads = visitors.groupBy("shard").agg(F.ceil(F.sum("words") / PART_WORDS).cast("long").alias("parts"))
    loads = stored(loads, "loads")
    built = sources.withColumn("shard", shard).join(loads, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "source", "source_texts")
    dealt = visitors.join(loads, "shard").select("shard", F.pmod(F.xxhash64(F.lit(1), "id"), "parts").alias("part"), "id", "tk", "starts", "texts")
    keys = ["shard", "part"]
    found = built.groupBy(*keys).cogroup(dealt.toDF("shard", "part", "id", "tk", "starts", "texts").groupBy(*keys)).applyInArrow(_stream(window), "id long, tk long, spans array<int>")
    return stored(found.groupBy("id", "tk").agg(F.collect_list("spans").alias("spans")), "spans")


def dedup_substrings(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every document without the passages that a smaller id holds too.

    Words are separated by ASCII white space and compared unchanged. A word goes if some window of ``window``
    consecutive words around it also stands in a document of a smaller id, as given, not as left after removal. Kept
    words are joined by one space. Null texts have no words; texts shorter than a window stay. A null id is larger than
    all others. Rows that repeat an id are one document and do not affect each other. Other columns are ignored.
    ``window`` must be larger than ANCHOR.
    """
    if window <= ANCHOR:
        raise ValueError(f"a window needs more than {ANCHOR} words")
    rows = rows_of_texts(docs, id_col, text_col).withColumns({"id": id_of("doc_id"), "tk": text_key("text")})
    spans = removed_spans(rows, window)
    joined = rows.join(spans, ["id", "tk"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept string")


def op10_substring_dedup(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    found = dedup_substrings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM split WHERE len(words) >= 13),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 12], ' ') AS w FROM starts),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT windows.doc_id, unnest(range(pos, pos + 13)) AS pos FROM windows JOIN firsts USING (w) WHERE doc_id > first),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split),
removed AS (SELECT DISTINCT doc_id, pos, true AS r FROM hits),
marked AS (SELECT p.doc_id, p.pos, p.word, r.r FROM placed p LEFT JOIN removed r ON p.doc_id = r.doc_id AND p.pos = r.pos),
kept AS (
    SELECT doc_id, count(r) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE r IS NULL), '') AS kept
    FROM marked GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
