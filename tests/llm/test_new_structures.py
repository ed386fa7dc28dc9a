"""Wavelet shards, runs of periodic words and the conversation trie against plain versions."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from emberlake.llm import periods, prefixes, wavelet
from emberlake.session import scratch_folder

DOCS = "doc_id long, text string, file binary, part int, runs string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, b"x", 7, "r") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def tokenizer_file():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_wavelet_matrix_against_arrays():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 3000):
        for top in (1, 2, 5, 49408):
            ids = rng.integers(0, top, n).astype(np.uint32)
            matrix = wavelet.Shard(wavelet.Shard.encode([1], [ids])).matrix
            assert (matrix.whole() == ids).all()
            some = rng.integers(0, n, 40) if n else np.empty(0, int)
            assert (matrix.access(some) == ids[some]).all()
            for symbol in {*ids[:5].tolist(), 3, 99999}:
                a, b = sorted(rng.integers(0, n + 1, 2).tolist())
                assert matrix.count(symbol, a, b) == (ids[a:b] == symbol).sum()
                assert (matrix.positions(symbol, a, b) == np.flatnonzero(ids[a:b] == symbol) + a).all()


def test_words_equal_the_library(tokenizer_file):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file)
    rng = random.Random(2)
    signs = list("aAbZ'sétİΣσßÀ×ÿ12 .,%<|\n\t\x0b\x1c\x85\xa0̸́あ一\U0001f600!?") + ["<|endoftext|>", "'re ", " ", "ﬁ", "ᄀ", "ᅡ"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(4000)] + ["x" * 5000 + "é."]
    import pyarrow as pa

    words = wavelet.WordIds(tokenizer_file, words=50, pieces=20)  # starts anew again and again
    assert words.plain
    for at in range(0, len(texts), 400):
        for text, ids in zip(texts[at : at + 400], words.encode(pa.array(texts[at : at + 400]))):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def expected_ids(rows, library):
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_shards_are_read_back(spark, tokenizer_file):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["ab", "Cé,", "don't", "12"], k=rng.randrange(60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (-5, "minus"), (None, "no id"), (300, "long " * 5000)]
    rng.shuffle(rows)
    library = Tokenizer.from_file(tokenizer_file)
    path = scratch_folder(spark, "shards")
    wavelet.write_shards(docs_of(spark, rows), path, tokenizer_file, 2, shard_ids=100)
    shards = wavelet.read_shards(spark, path)
    assert shards.count() > 10
    found = [tuple(r) for r in wavelet.token_checksums(shards).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected_ids(rows, library)
    whole = [x for r in sorted(wavelet.token_ids(shards).collect(), key=lambda r: r.start) for x in r.ids]
    places = sorted(r.position for r in wavelet.occurrences(shards, [2]).collect())
    assert places == [k for k, x in enumerate(whole) if x == 2] and len(places) == len(rows)


def test_repeated_ids_and_no_rows(spark, tokenizer_file):
    path = scratch_folder(spark, "shards")
    wavelet.write_shards(docs_of(spark, [(1, "a b"), (1, "a b"), (1, "c")]), path, tokenizer_file, 2)
    found = sorted(tuple(r) for r in wavelet.token_checksums(wavelet.read_shards(spark, path)).collect())
    assert sorted(r[2] for r in found) == [2, 3, 3] and sum(r[2] for r in found) == 8
    path = scratch_folder(spark, "shards")
    wavelet.write_shards(docs_of(spark, []), path, tokenizer_file, 2)
    assert wavelet.token_checksums(wavelet.read_shards(spark, path)).count() == 0


def test_query_of_ids(spark, data, tokenizer_file):
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in wavelet.op11_wavelet_ids(spark, data).collect()), key=lambda r: r[1])
    assert found == expected_ids(rows, Tokenizer.from_file(tokenizer_file))


def plain_runs(words, min_length=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_all_periods():
    rng = random.Random(1)
    for _ in range(1500):
        letters = rng.choice([1, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(rng.randrange(100))]
        unit = [rng.randrange(letters + 1) for _ in range(rng.randrange(1, 20))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 60)[: rng.randrange(150)]
        for least, times in ((24, 3), (6, 2)):
            assert periods.runs_of(words, least, times) == plain_runs(words, least, times)
    assert periods.runs_of(["a"] * 50_000) == [(0, 50_000, 1)]


def plain_row(doc_id, text):
    """The contract, step by step."""
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    from fractions import Fraction

    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines.encode()), sha(kept))


def test_query_of_runs(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    docs = sorted(docs, key=lambda r: len(r[1] or ""))[:150]  # the plain version takes a square of the length
    rows = {r.doc_id: tuple(r) for r in periods.op12_periodic_runs(spark, data).collect()}
    assert sum(rows[i][1] for i, _ in docs) > 5
    for i, text in docs:
        assert rows[i] == plain_row(i, text)


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "x y " * 20), (3, " \x0b"), (4, "a b c " * 9 + "d"), (4, "a b c " * 9 + "d"), (5, "é " * 30000)]
    found = periods.periodic_runs(docs_of(spark, rows))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    tail = [(4, 28, [(0, 27, 3)], "a b c d")] * 2
    expected = [(1, 0, [], ""), (1, 0, [], ""), (None, 40, [(0, 40, 2)], "x y"), (3, 0, [], ""), *tail, (5, 30000, [(0, 30000, 1)], "é")]
    assert got == sorted(expected, key=repr)
    assert periods.periodic_runs(docs_of(spark, [])).count() == 0


TURNS = "conv_id long, turn long, role string, text string, path string, shard int"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "p", 3) for r in rows], TURNS)


def plain_trie(paths):
    """Nodes of {conv_id: [(role, text), ...]} by all prefixes."""
    members: dict = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
        ends = sorted(c for c in members[node] if len(paths[c]) == len(node))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], sha))
    return sorted(out, key=repr)


def trie_of(paths, n):
    return sorted((tuple(r) for r in prefixes.prefix_trie(paths, n).select(*NAMES).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 5, 17])
def test_trie_against_all_prefixes(spark, n, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE_IDS", 3)
    rng = random.Random(n)
    paths, rows = {}, []
    for c in range(120):
        # Half of the conversations share all turns, which then reach over several shards.
        path = [("user", "same"), ("bot", "é" * 7)] if c % 2 else [(rng.choice("ab"), rng.choice("xyz")) for _ in range(rng.randrange(1, 5))]
        paths[c] = path
        rows += [(c, t, *turn) for t, turn in enumerate(path)]
    paths[500] = [("long", str(k % 3)) for k in range(400)]
    rows += [(500, t, *turn) for t, turn in enumerate(paths[500])]
    rng.shuffle(rows)
    found = prefixes.conversation_paths(turns_of(spark, rows))
    assert trie_of(found, n) == plain_trie(paths)


def test_rebuilt_conversations(spark):
    rng = random.Random(8)
    turns = {c: [(rng.choice("ab"), f"{c % 7} {k}") for k in range(rng.randrange(1, 9))] for c in [*range(0, 60), *range(100, 130), 230, 231, -7]}
    rows = [(c, k, *t) for c, path in turns.items() for k, t in enumerate(path)] + [(None, 1, "x", "y")]
    turns[300], turns[301] = [("", ""), ("u", "")], [("", "")]
    rows += [(300, None, None, None), (300, 4, "u", None), (301, None, None, "")]
    rng.shuffle(rows)
    expected = {}
    for c, path in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        expected[c] = turns.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + path[h:]
    found = prefixes.rebuilt(prefixes.conversation_paths(turns_of(spark, rows)))
    assert trie_of(found, 4) == plain_trie(expected)
    assert prefixes.prefix_trie(prefixes.rebuilt(prefixes.conversation_paths(turns_of(spark, [])))).count() == 0


def test_repeated_turns_are_turns_of_their_own(spark):
    rows = [(1, 1, "a", "x"), (1, 1, "a", "x"), (2, 1, "a", "x")]
    assert trie_of(prefixes.conversation_paths(turns_of(spark, rows)), 3) == plain_trie({1: [("a", "x")] * 2, 2: [("a", "x")]})


def test_trie_query_agrees_with_sql(spark, data):
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW conversations AS SELECT * FROM '{data}/conversations.parquet'")
    cursor = engine.execute(prefixes.SQL)
    names = [c[0] for c in cursor.description]
    got = prefixes.op13_conversation_trie(spark, data)
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == sorted(map(repr, cursor.fetchall()))
