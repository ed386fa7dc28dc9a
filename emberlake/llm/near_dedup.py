"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function orders all shingles; a document's sketch is its K least hashes. Inverted lists of retained values
generate candidate pairs, the overlap within the least K of the union of two sketches estimates their similarity and
filters, and full shingle sets confirm every link.

Lists are short by construction: each document enters only the lists of its rarest retained values, as many as a
similar document cannot all miss. What is similar must share so many retained values that leaving out the rest loses
nothing (documents whose sketches are whole) or loses a link with a chance below MISS. A list is never expanded into all
its pairs: each document is first compared with one leader. Documents whose lists still hold other components are then
joined on rare shingles of their full sets, with bounds on size and on what follows the first common shingle. Where many
hold the same rare shingles, as the heavily edited copies of one text do, they are joined on what sets them apart from
one of them. All these bounds are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import NO_ID, gram_hashes, id_of, rows_of_texts, slices, stored, text_key, word_hashes
from emberlake.llm.graph import components
from emberlake.llm.ordering import ranked

# Retained values of a document.
K = 96
# Accepted chance that two similar documents share no list, or that the estimate rejects them.
MISS = 1e-9
# Rounds in which documents are compared with one leader only, before all that are left are joined.
LEADER_ROUNDS = 2
# Lists of up to so many classes are joined with themselves, longer ones by differences from a leader. Both are exact.
SHORT_LIST = 16


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words, A-Z lower-cased; fewer words are one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(size, len(words))))


def least_overlap(k: int, percent: int, miss: float = MISS) -> int:
    """So many of k values drawn from the union of two sets of at least this similarity are shared, but for ``miss``."""
    t, below, s = percent / 100, 0.0, 0
    while True:
        below += math.comb(k, s) * t**s * (1 - t) ** (k - s)
        if below > miss:
            return s
        s += 1


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, k1, k2, sketch = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(text or b"", size)
                data = found.tobytes()
                n.append(len(found))
                k1.append(xxhash.xxh64_intdigest(data, 1) - 2**63)
                k2.append(xxhash.xxh64_intdigest(data, 2) - 2**63)
                sketch.append(found[:K].view(np.int64))
            columns = [batch.column(c) for c in ("doc_id", "id", "text_key")]
            made = [pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sketch, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns + made, ["doc_id", "id", "text_key", "n", "k1", "k2", "sketch"])

    return run


def _estimate(percent: int):
    """Keeps pairs whose sketches allow the similarity: exactly where both are whole, but for MISS otherwise."""
    least = least_overlap(K, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sketches = zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())
            for a, b in sketches:
                both = np.sort(np.array(a + b, np.int64).view(np.uint64))
                same = both[1:] == both[:-1]
                union = np.append(True, ~same)
                # Place of each shared value among the distinct ones.
                shared = (np.cumsum(union)[1:][same] <= K).sum()
                total = int(union.sum())
                whole = len(a) < K and len(b) < K
                keep.append(100 * shared >= percent * total if whole else shared >= min(least, total))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _whole_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t, size).view(np.int64) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            columns = [batch.column(c) for c in ("cls", "comp")]
            made = [pa.array([len(f) for f in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns + made, ["cls", "comp", "n", "all"])

    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = None, None
        for batch in batches:
            keep = []
            columns = (batch.column(c) for c in ("a", "text_a", "text_b"))
            for a, text_a, text_b in zip(*((c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for c in columns)):
                if known != (a, len(text_a)):  # a leader's rows come one after another
                    known, of = (a, len(text_a)), shingles(text_a, size)
                other = shingles(text_b, size)
                shared = len(np.intersect1d(of, other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(of) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) for every row.

    Documents are linked if 100 * intersection >= percent * union of their sets of ``size``-word shingles. Words are
    separated by ASCII white space, A-Z count as a-z, and fewer words than ``size`` are one shingle. Documents without
    words are linked with nothing. ``component_id`` is the least id reachable over links; ``kept`` marks its row.
    Rows that repeat an id are one document. Rows without an id are documents by their text: a null id is larger than
    all others, a group of such documents alone has a null ``component_id`` and keeps one text. ``text_key`` tells apart
    rows of one id. Other columns are ignored.
    """
    # A row is found again by what it holds, never by where a scan puts it: a second scan may be split otherwise.
    rows = rows_of_texts(docs, id_col, text_col).withColumns({"id": id_of("doc_id"), "text_key": text_key("text")})
    schema = "doc_id long, id long, text_key long, n long, k1 long, k2 long, sketch array<long>"
    sketches = stored(rows.select("doc_id", "id", "text_key", "text").mapInArrow(_sketch(size), schema), "sketches")
    # One row stands for all with equal sets: that of the least id.
    classes = stored(
        sketches.where("n > 0").groupBy("k1", "k2").agg(F.min(F.struct("id", "text_key")).alias("first")).select("k1", "k2", F.col("first.id").alias("cls"), F.col("first.text_key").alias("text_key")),
        "classes",
    )
    greatest = sketches.agg(F.max("doc_id")).first()[0]
    classes = _numbered(classes, greatest)
    known = F.col("cls") <= F.lit(NO_ID - 1 if greatest is None else greatest)
    known = F.lit(False) if greatest is None else known
    chosen = classes.select(F.when(known, F.col("cls")).otherwise(NO_ID).alias("id"), "text_key", "cls")
    # Rows that repeat both the id and the text are one.
    spread = stored(sketches.join(chosen, ["id", "text_key"]).dropDuplicates(["id", "text_key"]).select("cls", "n", "sketch"), "class-sketches")
    lists = _lists(spread, percent)
    named = chosen.join(lists.select("cls").distinct(), "cls")
    texts = stored(rows.join(named, ["id", "text_key"]).dropDuplicates(["id", "text_key"]).select("cls", "text"), "class-texts")
    links = _links(lists, spread, texts, size, percent)
    found = components(links)
    label = F.coalesce("component", "cls")
    labelled = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("k1", "k2", label.alias("component"), (label == F.col("cls")).alias("first"), F.col("text_key").alias("first_text"))
    joined = sketches.select("doc_id", "id", "n", "k1", "k2", "text_key").join(stored(labelled, "labels"), ["k1", "k2"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component", "id"))
    numbered = F.lit(True) if greatest is None else component > F.lit(greatest)
    alone = F.col("doc_id").isNull() & F.coalesce(F.col("first") & (F.col("first_text") == F.col("text_key")), F.lit(True))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(~numbered, component).alias("component_id"),
        (alone | (F.col("doc_id").isNotNull() & (component == F.col("id")))).alias("kept"),
        "text_key",
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns.

    Rows are told apart by id and text, so that a row without an id, or one that repeats an id, goes only with a text of
    its own group. Rows that repeat both share their fate.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.lit(11), docs[text_col]) == F.col("__text"))
    return docs.join(gone, same, "left_anti")


def _numbered(classes: DataFrame, greatest: int | None) -> DataFrame:
    """Classes of rows without id get numbers of their own from the greatest downwards; all ids must lie below."""
    without = classes.where(F.col("cls") == NO_ID)
    count = without.count()
    if not count:
        return classes
    if greatest is not None and greatest >= NO_ID - count:
        raise ValueError(f"ids up to {greatest} leave no numbers for {count} texts without id")
    numbers = ranked(without, ["k1", "k2"], "place").select("k1", "k2", (F.lit(NO_ID) - F.col("place")).alias("cls"), "text_key")
    return stored(classes.where(F.col("cls") != NO_ID).unionByName(numbers), "numbered-classes")


def _lists(spread: DataFrame, percent: int) -> DataFrame:
    """(value, cls, n, own): the lists of retained values that each class enters and that hold another class too.

    ``own`` is the number of retained values that no other class has.
    """
    values = spread.select("cls", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    shared = stored(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared-values")
    # Values of one class only come first in the order and generate nothing; the rest of the prefix is of shared ones.
    own = values.join(shared, "value").groupBy("cls", "n", "m").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"))
    n = F.col("n")
    whole = F.ceil(n * percent / 100)  # what a similar document shares at least
    # With few shingles the union with any similar document is retained as a whole.
    long_one = F.col("m") - F.least(F.lit(least_overlap(K, percent)), whole) + 1
    prefix = F.when(n * 100 <= K * percent, n - whole + 1).otherwise(long_one)
    alone = F.col("m") - F.size("values")
    quota = F.greatest(prefix - alone, F.lit(0)).cast("int")
    taken = own.select("cls", "n", alone.cast("int").alias("own"), F.explode(F.slice("values", 1, quota)).alias("x"))
    return stored(taken.select(F.col("x.value").alias("value"), "cls", "n", "own"), "lists")


def _links(lists: DataFrame, spread: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect what is connected."""
    links = tested = None
    for turn in range(LEADER_ROUNDS + 1):
        members = lists.withColumn("comp", F.col("cls"))
        if links is not None:
            found = components(links)
            members = lists.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("value", "cls", "n", "own", F.coalesce("component", "cls").alias("comp"))
        members = stored(members, "members")
        mixed_lists = members.groupBy("value").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("value")
        members = stored(members.join(stored(mixed_lists, "mixed-lists"), "value"), "members")
        pairs = _leader_pairs(members, turn, percent) if turn < LEADER_ROUNDS else _remaining_pairs(members, texts, size, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        # The bounds of the last join are exact; only leaders' pairs, which come from sketches alone, need the estimate.
        likely = _estimated(pairs, spread, percent) if turn < LEADER_ROUNDS else pairs
        confirmed = stored(_confirmed(likely, texts, size, percent), "links")
        links = confirmed if links is None else links.unionByName(confirmed)
    return links


def _near_in_size(percent: int, n: str, other: str):
    return F.least(n, other) * 100 >= F.greatest(n, other) * percent


def _ordered(left: str, right: str) -> list:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _leader_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each class with the leader of another component that most of its lists name.

    A list is first led by the class with the fewest values of its own, as an original has among its edited copies.
    """
    rank = F.col("own").cast("long") if turn == 0 else F.xxhash64(F.lit(turn), "cls")
    leaders = members.groupBy("value").agg(F.min(F.struct(rank.alias("rank"), "cls", "n", "comp")).alias("lead"))
    leaders = stored(leaders.select("value", F.col("lead.cls").alias("leader"), F.col("lead.n").alias("leader_n"), F.col("lead.comp").alias("leader_comp")), "leaders")
    met = members.join(leaders, "value").where((F.col("comp") != F.col("leader_comp")) & _near_in_size(percent, "n", "leader_n"))
    counted = met.groupBy("cls", "leader").agg(F.count("*").alias("times"))
    best = counted.groupBy("cls").agg(F.max(F.struct("times", (-F.col("leader")).alias("leader"))).alias("best"))
    return best.select("cls", (-F.col("best.leader")).alias("leader")).select(*_ordered("cls", "leader")).distinct()


def _remaining_pairs(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """All pairs of different components among the members that can be similar, and not many more.

    Shingles are ordered by how many members hold them, and a set enters the lists of its rarest n - ceil(t n) + 1.
    Similar sets meet in the list of their first common shingle, and what follows it in both bounds the intersection.
    A list of up to SHORT_LIST classes is joined with itself; the classes of a longer one are compared by what sets
    them apart from its leader.
    """
    named = members.select("cls", "comp").distinct()
    sets = stored(texts.join(named, "cls").select("cls", "comp", "text").mapInArrow(_whole_sets(size), "cls long, comp long, n long, all array<long>"), "whole-sets")
    values = sets.select("cls", "comp", "n", F.explode("all").alias("value"))
    common = stored(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "common-shingles")
    held = values.join(common, "value").groupBy("cls", "comp", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"))
    held = held.withColumn("m", F.size("values").cast("long")).where(F.col("m") * 100 >= F.col("n") * percent)
    held = stored(held, "common-sets")
    n, alone = F.col("n"), F.col("n") - F.col("m")
    count = F.greatest(n - F.ceil(n * percent / 100) + 1 - alone, F.lit(0)).cast("int")
    entries = held.select("cls", "comp", "n", "m", F.posexplode(F.slice("values", 1, count)).alias("place", "x"))
    # Shingles of one member only take the first places.
    entries = entries.select("cls", "comp", "n", "m", (F.col("place") + alone).alias("place"), F.col("x.value").alias("value"))
    entries = stored(entries, "rare-entries")
    counts = entries.groupBy("value").agg(
        F.count("*").alias("length"),
        F.min("comp").alias("least"),
        F.max("comp").alias("most"),
        # An original has the fewest shingles of its own; long lists of one family then name the same leader.
        F.min(F.struct(alone.alias("alone"), "cls")).alias("lead"),
    )
    counts = stored(counts.where("least <> most").select("value", "length", F.col("lead.cls").alias("leader")), "entry-counts")
    short = stored(entries.join(counts.where(F.col("length") <= SHORT_LIST), "value").select("cls", "comp", "n", "place", "value"), "short-lists")
    other = short.toDF("other", "other_comp", "other_n", "other_place", "value")
    left = F.least(n - F.col("place"), F.col("other_n") - F.col("other_place"))
    met = short.join(other, "value").where(
        (F.col("comp") != F.col("other_comp"))
        & (F.col("cls") < F.col("other"))
        & _near_in_size(percent, "n", "other_n")
        & (left * (100 + percent) >= (n + F.col("other_n")) * percent)
    )
    long = entries.join(counts.where(F.col("length") > SHORT_LIST), "value").select("cls", "comp", "n", "leader").distinct()
    pairs = met.select(*_ordered("cls", "other")).unionByName(_pairs_by_differences(stored(long, "long-lists"), sets, percent))
    return pairs.distinct()


def _pairs_by_differences(roles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can be similar, of classes (cls, comp, n) that share a leader.

    The difference of two sets from one another is the difference of their differences D from a leader's set R. Sets of
    p % similarity differ in at most r (n + n') shingles, r = (100 - p) / (100 + p). Two classes similar to the leader are
    in its component, and only their links to it are returned. Of any other two |D| + |D'| > r (n + n'), so they
    must share (|D| + |D'| - r (n + n')) / 2 elements of D, one at least: copies that were edited in different places share
    none, though nearly all of their shingles are common. ``s`` is (100 + p) |D| - (100 - p) n, so that two classes must
    share (s + s') / (2 (100 + p)) elements; with the least s' under a leader this bounds the elements to look up.
    """
    w, q = 100 + percent, 100 - percent
    led = sets.select(F.col("cls").alias("leader"), F.col("comp").alias("leader_comp"), F.col("n").alias("leader_n"), F.col("all").alias("of"))
    both = roles.where("cls <> leader").join(sets.select("cls", "all"), "cls").join(led, "leader")
    apart = F.concat(F.array_except("all", "of"), F.array_except("of", "all"))
    d = F.col("d")
    near = (d * w <= (F.col("n") + F.col("leader_n")) * q).alias("near")
    found = both.select("cls", "comp", "n", "leader", "leader_comp", "leader_n", apart.alias("apart")).withColumn("d", F.size("apart").cast("long"))
    found = stored(found.select("cls", "comp", "n", "leader", "leader_comp", "d", near, (d * w - F.col("n") * q).alias("s"), "apart"), "differences")
    straight = found.where(F.col("near") & (F.col("comp") != F.col("leader_comp"))).select(*_ordered("cls", "leader"))

    rows = found.select("leader", "cls", "comp", "n", "d", "s", "near", F.explode("apart").alias("value"))
    shared = rows.groupBy("leader", "value").agg(F.count("*").alias("df"), F.min("comp").alias("least"), F.max("comp").alias("most"), F.min("near").alias("all_near"))
    shared = stored(shared.where("least <> most AND NOT all_near").select("leader", "value", "df"), "shared-differences")
    kept = rows.join(shared, ["leader", "value"]).groupBy("leader", "cls", "comp", "n", "d", "s", "near")
    kept = kept.agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("values"))
    least = found.groupBy("leader").agg(F.min(F.when(~F.col("near"), F.col("s"))).alias("far_s"), F.min(F.when(F.col("near"), F.col("s"))).alias("near_s"))
    placed = kept.join(least, "leader").select("*", F.posexplode("values").alias("place", "x"))
    # What no other class under the leader can share takes the first places.
    left = F.size("values").cast("long") - F.col("place")
    names = ["cls", "comp", "n", "s", "left"]
    placed = placed.select("leader", F.col("x.value").alias("value"), "cls", "comp", "n", "s", left.alias("left"), "near", "far_s", "near_s")
    to_far, to_near = (F.col("left") * 2 * w >= F.col("s") + F.col(c) for c in ("far_s", "near_s"))
    placed = stored(placed.where(to_far | (~F.col("near") & to_near)), "rare-differences")
    key = ["leader", "value"]
    far = placed.where(~F.col("near"))
    seekers = far.where(to_far).select(*key, *names)
    partners = seekers.select(*key, *[F.col(c).alias(f"other_{c}") for c in names])
    among = seekers.join(partners, key).where(F.col("cls") < F.col("other_cls"))
    beside = placed.where(F.col("near") & to_far).select(*key, *[F.col(c).alias(f"other_{c}") for c in names])
    across = far.where(to_near).select(*key, *names).join(beside, key)
    possible = (
        (F.col("comp") != F.col("other_comp"))
        & _near_in_size(percent, "n", "other_n")
        & (F.least("left", "other_left") * 2 * w >= F.col("s") + F.col("other_s"))
    )
    met = [df.where(possible).select(*_ordered("cls", "other_cls")) for df in (among, across)]
    return straight.unionByName(met[0]).unionByName(met[1])


def _estimated(pairs: DataFrame, spread: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch allows the similarity."""
    sketch = spread.select("cls", "sketch")
    sides = pairs.join(sketch.toDF("b", "sketch_b"), "b").join(sketch.toDF("a", "sketch_a"), "a").select("a", "b", "sketch_a", "sketch_b")
    return stored(sides.mapInArrow(_estimate(percent), "a long, b long"), "likely")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar."""
    whole = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")
    return whole.mapInArrow(_confirm(size, percent), "a long, b long")


def op1_near_dedup(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    return near_duplicates(table(spark, folder, "documents")).drop("text_key")


SQL = r"""
WITH RECURSIVE
split AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM split),
grams AS (
    SELECT doc_id, n, pos, concat_ws(' ', w, lead(w, 1) OVER d, lead(w, 2) OVER d, lead(w, 3) OVER d, lead(w, 4) OVER d) AS gram
    FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
),
sets AS (SELECT DISTINCT doc_id, gram FROM grams WHERE pos <= greatest(n - 4, 1)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS met FROM documents UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.met),
least AS (SELECT doc_id, min(met) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
