"""Line dedup, substring dedup, near-dedup and fingerprints against brute force, with awkward rows."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from emberlake.llm import fingerprints, graph, line_dedup, near_dedup, substring_dedup

SCHEMA = "doc_id long, text string, source string, id long, k1 long, pos int, component string, value string"
SPACES = " \t\n\x0b\x0c\r"


def table_of(spark, texts, first=0):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(first + i, t, "s", 7, 7, 7, "x", "x") for i, t in enumerate(texts)], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def sentences(seed, vocabulary=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    return lambda n: " ".join(rng.choice(words) for _ in range(n)), rng


@pytest.fixture(scope="module")
def texts():
    make, rng = sentences(1)
    passage, line = make(30), "the same footer in many documents"
    base = make(150)
    out = [None, "", "   \n\t ", "one two", "ONE two", "É é " + make(3), make(2000)]
    out += [make(rng.randint(1, 80)) + "\n" + line + "\n" + make(20) for _ in range(40)]
    out += [make(20) + " " + passage + " " + make(25) for _ in range(30)]
    out += [base] * 12
    near = base.split()
    for i in range(25):
        changed = list(near)
        for _ in range(i % 6):
            changed[rng.randrange(len(changed))] = f"x{rng.random()}"
        out.append(" ".join(changed))
    out += ["x" * 5000, "a b\xa0c " * 9, "\n\n" + line.upper() + "  \n", "tie\ntie line number\ntie line number"]
    rng.shuffle(out)
    return out


def test_line_dedup(spark, texts):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(table_of(spark, texts)).collect()}
    lower = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    split = [(t or "").split("\n") for t in texts]
    holders = {}
    for i, lines in enumerate(split):
        for x in lines:
            key = x.strip(SPACES).translate(lower)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(i)
    for i, lines in enumerate(split):
        keep = [x for x in lines if len(h := holders.get(x.strip(SPACES).translate(lower), {i})) < 2 or min(h) == i]
        assert got[i] == (len(lines), len(lines) - len(keep), "\n".join(keep))


def test_line_dedup_keeps_columns(spark, texts):
    docs = table_of(spark, texts)
    found = line_dedup.without_repeated_lines(docs)
    assert found.columns == docs.columns
    assert found.count() == len(texts)


def test_line_dedup_needs_no_python(spark, texts):
    plan = line_dedup.dedup_lines(table_of(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_substring_dedup(spark, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup_substrings(table_of(spark, texts)).collect()}
    first = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    removed_somewhere = 0
    for i, t in enumerate(texts):
        w = words_of(t)
        gone = set()
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone.update(range(j, j + 13))
        removed_somewhere += bool(gone)
        assert got[i] == (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    assert removed_somewhere > 30


def test_substring_shards_are_split(spark, texts, monkeypatch):
    """Small shards and parts give the same result as large ones."""
    whole = substring_dedup.dedup_substrings(table_of(spark, texts)).collect()
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 200)
    monkeypatch.setattr(substring_dedup, "PART_WORDS", 300)
    assert sorted(map(repr, substring_dedup.dedup_substrings(table_of(spark, texts)).collect())) == sorted(map(repr, whole))


def test_suffix_automaton_keeps_the_least_id():
    automaton = substring_dedup.SuffixAutomaton()
    automaton.add([b"a", b"b", b"c", b"d"], 9)
    automaton.add([b"x", b"b", b"c", b"y"], 3)
    automaton.finish()
    assert automaton.earlier([b"q", b"b", b"c", b"q"], 5, 2) == [3]
    assert automaton.earlier([b"q", b"b", b"c", b"q"], 3, 2) == []
    assert automaton.earlier([b"a", b"b", b"c"], 10, 3) == [3]
    assert automaton.earlier([b"c", b"d", b"x", b"b"], 10, 2) == [2, 4]


def sets_of(texts):
    found = []
    for t in texts:
        w = (t or "").encode().lower().split()
        found.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return found


def groups_of(texts, percent):
    sets, parent = sets_of(texts), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sets, [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(spark, texts, percent):
    rows = near_dedup.near_duplicates(table_of(spark, texts), percent).collect()
    sets, roots = groups_of(texts, percent)
    assert len(set(roots)) < len(roots) - 10
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {i: (len(s), roots[i], roots[i] == i) for i, s in enumerate(sets)}


def test_near_duplicates_without_leaders(spark, texts, monkeypatch):
    """Comparing all that is left gives the links that the leaders would have found."""
    monkeypatch.setattr(near_dedup, "LEADER_ROUNDS", 0)
    rows = near_dedup.near_duplicates(table_of(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(groups_of(texts, 85)[1]))


def edited_family(seed, copies, length, edits, choices):
    """Copies of one text with words replaced from a few choices, so that some share their edits and most do not."""
    make, rng = sentences(seed, 5000)
    base = make(length).split()
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(*edits)):
            text[rng.randrange(length)] = f"e{rng.randrange(choices)}"
        out.append(" ".join(text[rng.randint(0, 1) : length - rng.randint(0, 2)]))
    return out


@pytest.mark.parametrize("percent, rounds, limit", [(85, 0, 0), (80, 2, 2)])
def test_near_duplicates_by_differences(spark, monkeypatch, percent, rounds, limit):
    """Families of edited copies, whose lists are long, give the links of all pairs."""
    texts = edited_family(3, 60, 45, (1, 2), 3) + edited_family(4, 60, 70, (0, 3), 400) + edited_family(5, 40, 120, (2, 6), 4)
    monkeypatch.setattr(near_dedup, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "SHORT_LIST", limit)
    rows = near_dedup.near_duplicates(table_of(spark, texts), percent).collect()
    roots = groups_of(texts, percent)[1]
    assert 3 < len(set(roots)) < len(texts) - 10
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(roots))


def test_differences_name_few_pairs(spark, monkeypatch):
    """Copies edited in different places share nearly all shingles, but few pairs of them are looked at."""
    texts = edited_family(6, 300, 60, (2, 2), 100000)
    monkeypatch.setattr(near_dedup, "LEADER_ROUNDS", 0)
    seen, plain = [], near_dedup._remaining_pairs
    monkeypatch.setattr(near_dedup, "_remaining_pairs", lambda *a: seen.append(plain(*a)) or seen[-1])
    rows = near_dedup.near_duplicates(table_of(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(groups_of(texts, 85)[1]))
    assert seen[0].count() < 2 * len(texts)


def test_near_duplicates_when_scans_are_split_otherwise(spark, texts, monkeypatch, tmp_path):
    """Each job deals the same files to other tasks, as after a lost executor; rows that repeat id and text are one."""
    path, option = str(tmp_path / "docs"), "spark.sql.files.openCostInBytes"
    docs = table_of(spark, texts)
    docs.unionByName(docs.where("doc_id % 3 = 0")).repartition(24).write.parquet(path)
    plain, before, turn = near_dedup.stored, spark.conf.get(option), [0]

    def stored(df, label):
        turn[0] += 1
        spark.conf.set(option, "512m" if turn[0] % 2 else "1")
        # The plan of a scan keeps its split, so every job reads the files anew.
        return plain(df, f"{turn[0]}-{label}")

    monkeypatch.setattr(near_dedup, "stored", stored)
    try:
        rows = near_dedup.near_duplicates(spark.read.parquet(path)).collect()
    finally:
        spark.conf.set(option, before)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(groups_of(texts, 85)[1]))
    assert len(rows) == len(texts) + len(texts[::3])


def test_least_overlap_is_a_safe_bound():
    assert 70 < near_dedup.least_overlap(128, 85) < 90
    assert near_dedup.least_overlap(128, 80) < near_dedup.least_overlap(128, 85)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200), (300, 250), (7, 7)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 250: 200, 300: 200}


def test_fingerprints_of_edited_texts(spark, texts):
    docs = table_of(spark, texts, first=10).unionByName(table_of(spark, [None], first=500))
    got = {r.doc_id: r for r in fingerprints.compare_with_edited(docs).collect()}
    order = sorted(got, reverse=True)
    by_id = {10 + i: t or "" for i, t in enumerate(texts)} | {500: ""}
    assert set(got) == set(by_id)
    for at, doc_id in enumerate(order):
        text, after = by_id[doc_id], by_id[order[(at + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new, next_one = fingerprints.signatures([text, edited, after])
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (fingerprints.as_text(own), fingerprints.as_text(new))
        assert (row.near_edited, row.near_next) == (fingerprints.likeness(own, new), fingerprints.likeness(own, next_one))


def test_signature_sees_edits_and_order():
    make, _ = sentences(5)
    text = make(800)
    words = text.split()
    few = " ".join(w if i % 100 else "changed" for i, w in enumerate(words))
    turned = " ".join(words[400:] + words[:400])
    reversed_blocks = " ".join(w for i in range(790, -1, -10) for w in words[i : i + 10])
    own, a, b, c, other = fingerprints.signatures([text, few, turned, reversed_blocks, make(800)])
    near = [fingerprints.likeness(own, x) for x in (own, a, b, c, other)]
    assert near[0] == 1 and near[1] > 0.6 and near[4] < 0.2
    # The same k-mers in another order are less like the text than a few edits make it.
    assert near[3] < near[2] < near[0] and near[3] < 0.65
    alone = fingerprints.signatures([text])[0]
    assert (alone == own).all()


def test_signatures_do_not_depend_on_the_length_of_the_key(monkeypatch):
    make, _ = sentences(6)
    group = [make(900), make(300), "", "abc", "ab " * 700]
    packed = fingerprints.signatures(group)
    monkeypatch.setattr(fingerprints, "AT_BITS", 8)
    assert (fingerprints.signatures(group) == packed).all()


def test_near_copies_on_both_sides_of_a_batch():
    make, _ = sentences(7, vocabulary=300_000)
    text = make(190_000)
    full = fingerprints.BATCH_CHARS
    assert len(text) > full + 200_000
    below, above, long = fingerprints.signatures([text[: full - 6], text[: full + 14], text])
    assert fingerprints.likeness(below, above) > 0.95
    half = fingerprints.signatures([text[: len(text) - len(text) // 2] + make(10)])[0]
    assert fingerprints.likeness(long, half) > 0.2


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(none).count() == 0
    assert substring_dedup.dedup_substrings(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert fingerprints.compare_with_edited(none).count() == 0
    assert fingerprints.fingerprints(none).count() == 0


def test_repeated_and_null_ids(spark):
    long_text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long_text), (1, long_text), (1, "other text here"), (None, long_text), (None, None), (5, long_text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()), key=repr)
    assert near == sorted([(1, 56, 1), (1, 56, 1), (1, 1, 1), (None, 56, 1), (None, 0, None), (5, 56, 1)], key=repr)
    removed = sorted(((r.doc_id, r.n_removed) for r in substring_dedup.dedup_substrings(docs).collect()), key=repr)
    assert removed == sorted([(1, 0), (1, 0), (1, 0), (None, 60), (None, 0), (5, 60)], key=repr)
    dropped = sorted(((r.doc_id, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    assert dropped == sorted([(1, 0), (1, 0), (1, 0), (None, 1), (None, 0), (5, 1)], key=repr)
    assert fingerprints.compare_with_edited(docs).count() == 6


@pytest.mark.parametrize("name", ["op1_near_dedup", "op7_line_dedup", "op10_substring_dedup"])
def test_queries_agree_with_sql(spark, data, name):
    from emberlake.llm.queries import QUERIES

    query = QUERIES[name]
    got = query.run(spark, data)
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    cursor = engine.execute(query.sql)
    names = [c[0] for c in cursor.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(cursor.fetchall())


def test_near_dedup_query_against_brute_force(spark, data):
    from emberlake.llm.queries import QUERIES

    docs = spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").select("doc_id", F.col("text")).collect()
    sets, roots = groups_of([r.text for r in docs], 85)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op1_near_dedup"].run(spark, data).collect()}
    assert got == {docs[i].doc_id: (len(s), docs[roots[i]].doc_id, roots[i] == i) for i, s in enumerate(sets)}
