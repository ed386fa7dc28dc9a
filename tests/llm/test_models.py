"""Language ID, toxicity, tokens, mixing, sharding, neighbours and the pipeline, with awkward rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emberlake.llm import language, mixing, neighbours, sharding, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, part int, place string, cls string"
SPACE = set(b" \t\n\x0b\x0c\r")


def docs_of(spark, rows):
    """Rows (text, lang, source) as documents with columns whose names the operators use inside."""
    data = [(i, t, lang, s, len(t or ""), 0.5, 1, "p", "c") for i, (t, lang, s) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def syllables(seed, sounds):
    rng = random.Random(seed)
    return lambda n: " ".join("".join(rng.choice(sounds) for _ in range(rng.randint(1, 3))) for _ in range(n))


EN, DE = syllables(1, ["the", "ing", "er", "an", "re", "ou"]), syllables(2, ["sch", "ung", "ei", "zu", "ä", "ver"])


def count_words(text):
    return len((text or "").encode().split())


def test_language_of_held_out_texts(spark):
    rows = [((EN if i % 2 else DE)(1 + i % 40), "en" if i % 2 else "de", "s") for i in range(200)]
    rows += [(None, "en", "s"), ("", "de", "s"), ("12 34 --", None, "s"), ("É", None, None)]
    docs = docs_of(spark, rows)
    out = language.held_out()
    model = language.train_languages(docs.where(~out))
    got = {r.doc_id: r for r in language.identify(docs, model, extra={"held_out": out}).collect()}
    assert len(got) == len(rows)
    wrong = 0
    for i, (text, lang, _) in enumerate(rows):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0)
        elif lang:
            wrong += got[i].held_out and got[i].lang_pred != lang
    assert wrong <= 2


def test_code_lengths_against_a_plain_context_tree(spark):
    """The table of costs equals escapes computed one symbol at a time."""
    text = EN(60).encode()
    context, symbol = language.symbols_of(text)
    keys, n = np.unique((context << 6) | symbol, return_counts=True)
    model = language.build_model(["x"] * len(keys), keys.astype(np.int64), n, min_context=1)
    pairs = [(int(k) >> 6, int(k) & 63, int(c)) for k, c in zip(keys, n)]

    def probability(past, s, order):
        if order < 0:
            return 1 / 64
        counts = {}
        for c, x, times in pairs:
            if order == 0 or c % 64**order == past % 64**order:
                counts[x] = counts.get(x, 0) + times
        total, kinds = sum(counts.values()), len(counts)
        if not total:
            return probability(past, s, order - 1)
        if s in counts:
            return counts[s] / (total + kinds)
        rest = sum(probability(past, x, order - 1) for x in range(64) if x not in counts)
        return kinds / (total + kinds) * probability(past, s, order - 1) / rest

    other = b"then zebra"
    context, symbol = language.symbols_of(other)
    expected = -sum(math.log2(probability(int(c), int(s), 3)) for c, s in zip(context, symbol))
    assert model.code_lengths(other)[0] == pytest.approx(expected, rel=1e-5)
    sums = np.exp2(-model.costs.reshape(-1, 64)).sum(1)
    assert np.allclose(sums, 1, atol=1e-4)


def test_language_filter_keeps_clean_rows_and_columns(spark):
    rows = [(EN(30), "en", "s") for _ in range(30)] + [(None, "en", "s"), ("123", "en", "s"), ("", None, None)]
    docs = docs_of(spark, rows)
    kept = language.keep_identified(docs, language.train_languages(docs))
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == list(range(30))


def test_no_labels_no_languages(spark):
    docs = docs_of(spark, [("some text", None, "s")])
    assert [r.lang_pred for r in language.identify(docs, language.train_languages(docs)).collect()] == ["und"]
    none = spark.createDataFrame([], SCHEMA)
    assert language.identify(none, language.train_languages(none)).count() == 0


@pytest.fixture(scope="module")
def model_file():
    public = pytest.importorskip("public_tokenizers")
    return public.path("piece_bpe_32k.model")


def test_tokens_equal_the_library(spark, model_file):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    rng = random.Random(3)
    letters = " \n▁a b\t\r\x00é漢\U0001f600<s>0x"
    texts = [None, "", " ", "  ", "▁", "\n", "a▁b", "x" * 30000, EN(3000)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    docs = docs_of(spark, [(t, None, None) for t in texts])
    got = {r.doc_id: r for r in tokens.encode_texts(docs, model_file).collect()}
    digests = {r.doc_id: r for r in tokens.token_digests(docs, model_file).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert (got[i].ids, got[i].decoded, got[i].n_tokens) == (",".join(map(str, ids)), sp.decode(ids), len(ids))
        assert digests[i].ids_sha256 == hashlib.sha256(got[i].ids.encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(got[i].decoded.encode()).hexdigest()


def test_token_table_starts_anew_when_full(model_file):
    small, large = tokens.ChunkTable(model_file, limit=50), tokens.ChunkTable(model_file)
    texts = [EN(200) for _ in range(20)]
    assert small.encode_all(texts) == large.encode_all(texts)
    short = tokens.ChunkTable(model_file, chars=5000)
    lines = ["".join(chr(0x4E00 + (i * 37 + j) % 9000) for j in range(2000)) for i in range(40)]
    assert [short.encode(t) for t in lines] == large.encode_all(lines)
    assert sum(map(len, short.table)) < 5000 + 3 * 2000 < sum(map(len, large.table))


def distance_to_prefix(word, stem):
    """Least Levenshtein distance of the stem to any beginning of the word."""
    row = list(range(len(stem) + 1))
    best = row[-1]
    for i, c in enumerate(word, 1):
        row = [i] + [0] * len(stem) if not (old := row) else [i, *([0] * len(stem))]
        for j, s in enumerate(stem, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (c != s))
        best = min(best, row[-1])
    return best


def test_matcher_against_plain_distances():
    stems = {"stupid": 3.0, "loser": 2.0, "scum": 2.0, "idiot": 3.0}
    matcher, rng = toxicity.StemMatcher(stems), random.Random(1)
    for _ in range(4000):
        stem = rng.choice(list(stems))
        word = list(stem + rng.choice(["", "s", "ity"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(1, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "s", "tt"])
        word = "".join(word)
        near = [(distance_to_prefix(word, s), s) for s in stems if word[:1] == s[0]]
        allowed = [(d, s) for d, s in near if d == 0 or (d == 1 and len(s) >= toxicity.MIN_FUZZY)]
        got = matcher.match(word)
        assert (got is None) == (not allowed), (word, got, allowed)
        if got:
            assert got[1] == min(allowed)[0]


def test_matcher_edits_the_first_letter():
    stems = {"stupid": 3.0, "loser": 2.0, "scum": 2.0, "idiot": 3.0, "moron": 2.0}
    matcher, rng = toxicity.StemMatcher(stems), random.Random(2)
    for word in ("diot", "ldiot", "xmoron", "tupid", "oron"):
        assert matcher.match(word)[1] == 1, word
    assert matcher.match("cum") is None and matcher.match("xscum") is None
    for _ in range(4000):
        word = list(rng.choice(list(stems)) + rng.choice(["", "s", "ity"]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(0, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "0", "*", "s"])
        word = "".join(word)
        near = [(distance_to_prefix(word, s), s) for s in stems]
        allowed = [d for d, s in near if d == 0 or (d == 1 and len(s) >= toxicity.MIN_FUZZY)]
        got = matcher.match(word)
        assert (got and got[1]) == min(allowed, default=None), (word, got, allowed)


def test_digits_and_symbols_in_words_are_edits():
    matcher = toxicity.StemMatcher({"stupid": 3.0, "idiot": 3.0})
    for text in ("idi0t", "1diot", "st*pid", "stup1d", "$tupid", "x/st_pid", "idio7", "s-tupid"):
        features = matcher.features(f"you {text}, so")
        assert (features[0], features[1]) == (0, pytest.approx(math.log(2))), text
    assert matcher.features("my-idiot")[0] == pytest.approx(math.log(2))
    assert not matcher.features("st**p1d st pid i.e. 4to").any()


def test_as_many_stems_as_tell_toxic_rows_apart(spark):
    bad = ["".join(chr(97 + n // 26**k % 26) for k in range(3)) + "zzqx" for n in range(700)]
    rows = [(" ".join(bad), 1)] * 40 + [("plain words only", 0)] * 60
    frame = spark.createDataFrame(rows, "text string, toxic int")
    assert set(toxicity.learn_stems(frame)) == set(bad)


def test_toxicity_is_learned_and_quotes_count_less(spark):
    clean, rng = syllables(5, ["the", "ing", "er", "an", "re", "ou", "be"]), random.Random(2)
    bad = ["stupid", "moron", "losers", "trashy"]
    rows = []
    for i in range(600):
        text = clean(rng.randint(5, 60)).split()
        if i % 5 == 0:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    model = toxicity.train_toxicity(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert {s[:4] for s in model.stems} >= {"stup", "moro", "lose", "tras"}
    plain = "the inger stupid anre theou and reing moron be"
    quoted = "the inger ”stupid“ anre theou and reing"
    typo = "the inger stuqid anre theou stuppid and reing morom"
    scores = {t: model.score(t) for t in (plain, quoted, typo, "", clean(40))}
    assert scores[plain] > 0.9 and scores[typo] > 0.5
    assert scores[quoted] < scores[plain] and scores[""] < 0.3 and list(scores.values())[-1] < 0.3
    docs = docs_of(spark, [(plain, None, None), (None, None, None), ("", None, None), (clean(5000), None, None)])
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert got[0] > 0.9 and got[1] == got[2] < 0.3 and got[3] < 0.3
    assert toxicity.score_toxicity(spark.createDataFrame([], SCHEMA), model).count() == 0


@pytest.mark.parametrize(
    "text, quoted",
    [
        ("you idiot", False),
        ('"hello" you idiot "bye"', False),
        ('he said "fine" and you are an idiot', False),
        ("`x` you idiot `y`", False),
        ("it's the dogs' idiot and cats' bone's", False),
        ('an open "quotation, idiot', False),
        ('a "line\nidiot" ends it', False),
        ('2" idiot 3"', False),
        ('"you idiot" was written there', True),
        ('"idiot"', True),
        ('he wrote "out, idiot, get out!" to me', True),
        ("they call it 'idiot' there", True),
        ("\u201cyou idiot\u201d", True),
        ("\u201eyou idiot\u201c", True),
        ("\u201dyou idiot\u201d", True),
        ("\u00ab you idiot \u00bb", True),
        ("\u00bbyou idiot\u00ab", True),
        ("''you idiot''", True),
        ("\u201cit said \u2018so\u2019, idiot, and went\u201d", True),
    ],
)
def test_hits_inside_pairs_of_marks_are_quoted(text, quoted):
    features = toxicity.StemMatcher({"idiot": 3.0}).features(text)
    assert (features[0] > 0, features[2] > 0) == (not quoted, quoted)


def test_contexts_are_learned_from_distinct_ones(spark):
    words, rng = syllables(6, ["the", "ing", "er", "an", "re", "ou", "be"]), random.Random(3)
    rows = [f"{words(9)} you idiot {words(9)}" for _ in range(120)] + [f"{words(9)} novel idiot {words(9)}" for _ in range(35)]
    rows += [words(rng.randint(1, 30)) for _ in range(300)]
    labelled = [(i, t, int(i < 120)) for i, t in enumerate(rows)]
    model = toxicity.train_toxicity(spark.createDataFrame(labelled, "doc_id long, text string, toxic int"))
    assert list(model.stems) == ["idiot"]
    assert model.contexts["novel"] < 0 < model.contexts["you"]
    assert model.score("re anthe you idiot bethe") > 0.7 > 0.3 > model.score("re anthe novel idiot bethe")
    copies = spark.createDataFrame([(rows[0], 1)] * 500 + [(rows[130], 0)] * 500, "text string, toxic int")
    assert toxicity.learn_contexts(copies, model.stems) == {}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string, toxic int")
    assert toxicity.train_toxicity(none).score("anything") < 0.3


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, targets, capped = share * sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        targets = {s: cap * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if targets[s] > cap * sizes[s]}
        if not over:
            return targets
        capped |= over


def test_mixing_meets_targets(spark):
    rng = random.Random(4)
    rows = [(EN(rng.randint(1, 60)), None, rng.choice(["a", "b", "é", "Z", "", None, "hot", "hot", "hot"])) for _ in range(900)]
    rows += [(None, None, "a"), ("", None, "none"), (" \n", None, "none"), (EN(4000), None, "b")]
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    again = {r.doc_id: r for r in mixing.mix(docs.repartition(3)).collect()}
    assert got == again
    sizes = {}
    for text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + count_words(text)
    targets, taken = expected_targets(sizes), {}
    for i, (text, _, source) in enumerate(rows):
        r = got[i]
        assert (r.size, r.source_size) == (count_words(text), sizes[source])
        assert r.target == pytest.approx(targets[source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[source] = taken.get(source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 20
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rates_are_tilted_exponentially(spark):
    """The solved multiplier meets the constraint: words at min(cap, exp(multiplier * size / mean)) sum to the target."""
    rng = random.Random(6)
    sizes = [rng.randint(1, 300) for _ in range(500)]
    sized = spark.createDataFrame([("=a", s) for s in sizes], "src string, size long")
    for share in (0.1, 0.7, 1.3, 1.95, 2.0):
        target = share * sum(sizes)
        targets = spark.createDataFrame([("=a", sum(sizes), len(sizes), target)], "src string, source_size long, docs long, target double")
        r = mixing.solve_multipliers(sized, targets, 2).first()
        rates = [2.0 if r.full else min(2.0, math.exp(r.multiplier * s / r["mean"])) for s in sizes]
        assert sum(s * q for s, q in zip(sizes, rates)) == pytest.approx(target, rel=1e-6)


def test_shards_are_exact(spark):
    rows = [(EN(1 + i % 50), None, None) for i in range(503)] + [(None, None, None)] * 6 + [("same", None, None)] * 200
    docs = docs_of(spark, rows).repartition(7)
    got = sharding.shard_uniformly(docs, 8).collect()
    assert len(got) == len(rows)
    places = {}
    for r in got:
        text = (rows[r.doc_id][0] or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        places.setdefault(r.shard, []).append(r.slot)
    assert sorted(places) == list(range(8))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1
    assert sharding.shard_uniformly(spark.createDataFrame([], SCHEMA), 8).count() == 0
    assert sorted(r.shard for r in sharding.shard_uniformly(docs.limit(3), 8).collect()) == [0, 1, 2]


def test_hypergeometric_draws():
    rng = np.random.default_rng(1)
    draws = np.array([sharding.draw_hypergeometric(rng, 30, 70, 20) for _ in range(20000)])
    expected = np.random.default_rng(2).hypergeometric(30, 70, 20, 20000)
    for k in range(2, 11):
        assert abs((draws == k).mean() - (expected == k).mean()) < 0.015
    large = sharding.draw_hypergeometric(rng, 10**12, 3 * 10**12, 10**9)
    assert abs(large - 25 * 10**7) < 12 * 14000
    matrix = sharding.communication_matrix([5, 0, 17, 8], [10, 10, 10], 3)
    assert [sum(r) for r in matrix] == [5, 0, 17, 8] and [sum(c) for c in zip(*matrix)] == [10, 10, 10]


def test_hilbert_order_is_continuous():
    cells = np.array([(x, y) for x in range(16) for y in range(16)])
    order = cells[np.argsort(neighbours.hilbert_keys(cells, 4))]
    assert len(set(neighbours.hilbert_keys(cells, 4).tolist())) == 256
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()
    cube = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = cube[np.argsort(neighbours.hilbert_keys(cube, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def exact_neighbours(vectors, query, k):
    own = vectors[query]
    scored = [(-float(np.dot(own, v)), i) for i, v in vectors.items() if i != query]
    return [i for _, i in sorted(scored)[:k]]


VECTORS = "vec_id long, embedding array<float>, label int, block int, cls string"


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    points = (centres[rng.integers(0, 20, 1000)] + 0.2 * rng.normal(size=(1000, 16))).astype(np.float32)
    points[300:600] = points[300]
    rows = [(i, p.tolist(), 1, 2, "x") for i, p in enumerate(points)]
    bad = [None, [0.0] * 16, [1.0] * 15 + [None], [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0] * 5]
    rows += [(2000 + 20 * i, v, 1, 2, "x") for i, v in enumerate(bad)] + [(None, points[0].tolist(), 1, 2, "x")]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    vectors = {i: p.astype(np.float64) for i, p in enumerate(points)}
    assert sorted(got) == list(range(0, 1000, 20))
    found = 0
    for query, ranks in got.items():
        assert sorted(ranks) == list(range(1, 21))
        listed = [ranks[i] for i in range(1, 21)]
        assert query not in {v for v, _ in listed}
        for v, s in listed:
            assert s == pytest.approx(float(np.dot(vectors[query], vectors[v])), abs=1e-9)
        assert listed == sorted(listed, key=lambda x: (-x[1], x[0]))
        found += len({v for v, _ in listed} & set(exact_neighbours(vectors, query, 20)))
    assert found / (20 * len(got)) >= 0.9


def test_few_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1, 1, "x"), (7, [0.5, 0.0], 1, 1, "x"), (5, [0.5, 0.0], 1, 1, "x"), (20, [-1.0, 1.0], 1, 1, "x")], VECTORS)
    got = sorted(tuple(r) for r in neighbours.nearest(few).collect())
    assert got == [(0, 1, 5, 0.5), (0, 2, 7, 0.5), (0, 3, 20, -1.0), (20, 1, 5, -0.5), (20, 2, 7, -0.5), (20, 3, 0, -1.0)]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_every_length_and_precision(spark, monkeypatch):
    """Doubles are not rounded, and each length is searched among its own; against all products."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(4)
    sizes = [1] * 5 + [2] * 130 + [3] * 40 + [700] * 2
    vectors = {20 * i if i % 3 else 20 * i + 1: 1e9 + rng.normal(size=d) for i, d in enumerate(sizes)}
    vectors |= {10_000: np.array([0.5, 1e39]), 10_001: np.array([1e-200, 0.0]), 10_003: np.full(5, 2.0), 10_020: np.full(4, 1e-170)}
    rows = [(i, v.tolist(), 1, 2, "x") for i, v in vectors.items()]
    got = {}
    found = neighbours.nearest(spark.createDataFrame(rows * 2, VECTORS.replace("float", "double")), share=1.0)
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = {}
    for query, own in vectors.items():
        scored = sorted((-float((own * v).sum()), i) for i, v in vectors.items() if i != query and len(v) == len(own))
        if query % 20 == 0 and scored:
            expected[query] = [(i, -s) for s, i in scored[:20]]
    assert got == expected
    assert got[10_000][0][1] > 1e47 and len(got[20]) == 4


def test_products_beyond_doubles(spark):
    rows = [(0, [1e300, -1e300], 1, 2, "x"), (1, [1e300, 1e300], 1, 2, "x"), (2, [1e300, 0.0], 1, 2, "x"), (3, [1.0, 0.0], 1, 2, "x"), (4, [-1e300, 0.0], 1, 2, "x")]
    got = [(r.vec_id, r.score) for r in neighbours.nearest(spark.createDataFrame(rows, VECTORS.replace("float", "double"))).orderBy("rank").collect()]
    assert got == [(2, math.inf), (3, 1e300), (1, -math.inf), (4, -math.inf)]


def test_pipeline_stages(spark, tmp_path):
    """Each stage against what its own input asks for."""
    base, footer = EN(120), "a footer line that all share"
    rows = [(f"{EN(40 + i)}\n{footer}\n{EN(10)}", "en", f"s{i % 4}") for i in range(60)]
    rows += [(f"{base} {EN(2)}", "en", "s1") for _ in range(6)] + [(None, "en", "s0"), ("999", None, None), ("", "en", "s2")]
    docs = docs_of(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now, steps = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        steps[name] = now = spark.createDataFrame(now.collect(), now.schema)
        if name != "tokens":
            assert now.columns == docs.columns
    assert sorted(r.doc_id for r in steps["language_id"].collect()) == list(range(66))
    lines = {r.doc_id: r.text for r in steps["line_dedup"].collect()}
    assert footer in lines[0] and all(footer not in lines[i] for i in range(1, 60))
    assert len(lines) == 66
    near = sorted(r.doc_id for r in steps["near_dedup"].collect())
    assert near == list(range(61))
    mixed = [r.doc_id for r in steps["mixing"].collect()]
    assert set(mixed) <= set(near) and max(mixed.count(i) for i in set(mixed)) <= 2
    words = sum(count_words(r.text) for r in steps["mixing"].collect())
    assert words == pytest.approx(1.5 * sum(count_words(lines[i]) for i in near), rel=0.01)
    assert sorted(r.doc_id for r in steps["tokens"].collect()) == sorted(mixed)


def test_registered_queries(spark, data):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    docs = spark.read.parquet(f"{data}/documents.parquet").count()
    for name in ("op3_toxicity", "op4_mixing", "op5_language_id", "op6_sharding", "op8_fingerprints"):
        assert entry.queries()[name](spark, data).agg(F.count("*")).first()[0] == docs
