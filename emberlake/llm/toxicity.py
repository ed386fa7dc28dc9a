"""Toxicity from a lexicon of stems, matched with misspellings, weighed by the context of each hit.

Stems and weights are learned. A trie of the stems is intersected with a Levenshtein automaton of one edit: the pairs
of trie node and spent edits that a word's letters can reach make one state, and states are built when first needed.

Context tells abuse from quotation: a hit between a pair of quotation marks is quoted, and the words around a hit weigh as
much as the labelled rows say they do.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import slices, stored

_WORD = re.compile(r"[^\W\d_]+")
# Quotation marks, and those that pair with one another; a quotation ends with its line at the latest.
_MARKS = re.compile("''|[\"“”„«»‹›`'‘’\n]")
_PAIRED = {"“": "”", "„": "”", "«": "»", "‹": "›", "‘": "'", "’": "'"}

MIN_STEM, MAX_STEM = 4, 10
# Shorter stems allow no edit: too many other words are near.
MIN_FUZZY = 5
# Characters on each side of a hit that make its context.
CONTEXT = 48
# Bounds of what the words around one hit weigh.
CONTEXT_LIMIT = 3.0
FEATURES = 7


def quotations(text: str) -> tuple[list[int], list[int]]:
    """Starts of the quotations of a text, ascending, and the farthest end of those that start up to there.

    A mark opens a quotation where a word may start after it, and closes the one of its kind that is open where a word
    may end before it; angle marks do so in turn, whichever way they point. An apostrophe inside a word is no mark.
    """
    opened: dict[str, int] = {}
    spans = []
    for found in _MARKS.finditer(text):
        mark, (at, end) = found.group(), found.span()
        if mark == "\n":
            opened.clear()
            continue
        kind = _PAIRED.get(mark, mark)
        angle, before, after = kind in "»›", text[at - 1 : at] if at else "", text[end : end + 1]
        if kind in opened and mark != "„" and (angle or not (before.isspace() or after.isalnum())):
            spans.append((opened.pop(kind), at))
        elif angle or (after and not after.isspace() and not before.isalnum()):
            opened[kind] = end
    starts, ends = [], []
    for start, end in sorted(spans):
        starts.append(start), ends.append(max(end, ends[-1]) if ends else end)
    return starts, ends


class StemMatcher:
    """Finds words that begin with a stem, or with a text one edit away from it."""

    def __init__(self, stems: dict[str, float], contexts: dict[str, float] | None = None) -> None:
        self.weights, self.contexts = stems, contexts or {}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.fuzzy: list[bool] = [False]
        for stem in sorted(stems):
            node = 0
            for char in stem:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({}), self.ends.append(None), self.fuzzy.append(False)
                node = self.children[node][char]
            self.ends[node] = stem
        # A node may spend an edit if a stem below it is long enough.
        for node in range(len(self.children) - 1, -1, -1):
            own = self.ends[node]
            self.fuzzy[node] = bool(own and len(own) >= MIN_FUZZY) or any(self.fuzzy[c] for c in self.children[node].values())
        self.states: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.members: list[frozenset] = []
        self.hits: list[tuple[str, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """The state of (node, edits) pairs, closed under leaving out a stem's letter; -1 for none."""
        todo, full = list(pairs), set(pairs)
        while todo:
            node, edits = todo.pop()
            if edits == 0:
                for child in self.children[node].values():
                    if self.fuzzy[child] and (child, 1) not in full:
                        full.add((child, 1)), todo.append((child, 1))
        full = {(n, e) for n, e in full if e == 0 or (n, 0) not in full}
        if not full:
            return -1
        key = frozenset(full)
        if key not in self.states:
            self.states[key] = len(self.steps)
            self.steps.append({}), self.members.append(key)
            ends = [(e, self.ends[n]) for n, e in key if self.ends[n] and (e == 0 or len(self.ends[n]) >= MIN_FUZZY)]
            best = min(ends, default=None)
            self.hits.append((best[1], best[0]) if best else None)
        return self.states[key]

    def _step(self, state: int, char: str) -> int:
        pairs = set()
        for node, edits in self.members[state]:
            if char in self.children[node]:
                pairs.add((self.children[node][char], edits))
            if edits == 0:
                if self.fuzzy[node]:
                    pairs.add((node, 1))
                pairs.update((c, 1) for c in self.children[node].values() if self.fuzzy[c])
        after = self._state(pairs)
        if len(self.steps[state]) < 512:  # a table, not a limit: what it lacks is computed again
            self.steps[state][char] = after
        return after

    def match(self, word: str) -> tuple[str, int] | None:
        """(stem, edits) of the best match, exact before misspelled."""
        state, found, steps = self.start, None, self.steps
        for char in word:
            after = steps[state].get(char)
            state = self._step(state, char) if after is None else after
            if state < 0:
                return found
            hit = self.hits[state]
            if hit:
                if hit[1] == 0:
                    return hit
                found = found or hit
        return found

    def matches(self, text: str) -> Iterator[tuple[str, int, int, int] | None]:
        """Of every word of a lower-cased text (stem, edits, start, end) where it matches, None otherwise."""
        done = 0
        seen: dict[str, tuple[str, int] | None] = {}

        def look(word: str) -> tuple[str, int] | None:
            if word not in seen:
                seen[word] = self.match(word)
            return seen[word]

        for found in _WORD.finditer(text):
            at, end = found.span()
            if at < done:
                continue
            hit = look(found.group())
            if hit is None:
                # One digit or symbol between letters may be the edit; a second one would be another edit.
                rest = _WORD.match(text, end + 1) if end < len(text) and not text[end].isspace() else None
                if rest is not None and (look(rest.group()) or ("", 1))[1] > 0:
                    hit = look(text[at : rest.end()])
                    if hit is not None:
                        end = done = rest.end()
            yield hit and (*hit, at, end)

    def features(self, text: str) -> np.ndarray:
        """Of a text: exact and misspelled abusive hits, quoted hits, density, heaviest stem, hits near other hits, contexts."""
        low = text.lower()
        words, exact, fuzzy, quoted, near, heaviest, last, around = 0, 0.0, 0.0, 0.0, 0, 0.0, -(10**9), 0.0
        quotes = None
        for hit in self.matches(low):
            words += 1
            if hit is None:
                continue
            stem, edits, at, end = hit
            quotes = quotes or quotations(low)
            place = bisect_right(quotes[0], at) - 1
            if place >= 0 and quotes[1][place] >= end:
                quoted += 1
            else:
                exact, fuzzy = exact + (edits == 0), fuzzy + (edits > 0)
                heaviest = max(heaviest, self.weights[stem] / (1 + edits))
                weight = sum(self.contexts.get(w, 0.0) for w in context_words(low, at, end)) if self.contexts else 0.0
                around += max(-CONTEXT_LIMIT, min(CONTEXT_LIMIT, weight))
            near += at - last < 2 * CONTEXT
            last = at
        hits = exact + fuzzy
        density = 100 * hits / max(words, 1)
        return np.array([np.log1p(exact), np.log1p(fuzzy), np.log1p(quoted), np.log1p(density), heaviest, np.log1p(near), around / max(hits, 1)])


def context_words(text: str, at: int, end: int) -> list[str]:
    """Distinct whole words within CONTEXT characters of a hit, ordered."""
    before, after = text[max(0, at - CONTEXT) : at], text[end : end + CONTEXT]
    if at > CONTEXT:  # a word that the window cuts does not count
        before = before.partition(" ")[2]
    if end + CONTEXT < len(text):
        after = after.rpartition(" ")[0]
    return sorted({*_WORD.findall(before), *_WORD.findall(after)})


@dataclass
class ToxicityModel:
    """Stems and words of contexts with log-odds, and the weights of the features (the last is the constant)."""

    stems: dict[str, float]
    weights: np.ndarray
    contexts: dict[str, float] = field(default_factory=dict)
    _matcher: StemMatcher | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"stems": self.stems, "weights": self.weights, "contexts": self.contexts, "_matcher": None}

    def score(self, text: str) -> float:
        if self._matcher is None:
            self._matcher = StemMatcher(self.stems, self.contexts)
        z = float(self._matcher.features(text) @ self.weights[:-1] + self.weights[-1])
        return 1 / (1 + np.exp(-z)) if z > -700 else 0.0


def _count_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word with this beginning; the empty one counts documents."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall(text.lower()))
            own = {w[:n] for w in words for n in range(MIN_STEM, min(len(w), MAX_STEM) + 1)}
            own.add("")
            counts[toxic].update(own)
        stems = list(counts[0].keys() | counts[1].keys())
        clean, toxic = ([c[s] for s in stems] for c in counts)
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())], ["stem", "clean", "toxic"])


def learn_stems(sample: DataFrame, size: int | None = None) -> dict[str, float]:
    """Word beginnings that tell toxic documents apart, with their log-odds; at most ``size`` if given.

    A beginning is kept if its likelihood ratio beats what the best of that many beginnings reaches by chance, and if
    most of its documents are toxic. Of beginnings of one another only the strongest stays, the longer one on ties.
    """
    counts = sample.mapInArrow(_count_prefixes, "stem string, clean long, toxic long").groupBy("stem")
    sums = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("stem = '' OR toxic >= 2")
    sums = stored(sums, "stems")
    head = sums.where("stem = ''").select("clean", "toxic").first()
    if head is None or not head["clean"] or not head["toxic"]:
        return {}
    share = head["toxic"] / (head["clean"] + head["toxic"])
    tried = max(sums.count(), 2)
    p = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    gain = F.col("toxic") * F.log(p / F.lit(share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - p) / F.lit(1 - share))).otherwise(0.0)
    ranked = (
        sums.where("stem <> ''")
        .select("stem", p.alias("p"), gain.alias("gain"), "clean", "toxic")
        .where((F.col("p") >= max(0.6, (1 + share) / 2)) & (F.col("gain") >= float(np.log(tried) + 1)))
        .orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem")
        .collect()
    )
    chosen: dict[str, float] = {}
    beginnings: set[str] = set()
    for row in ranked:
        stem = row["stem"]
        own = [stem[:n] for n in range(1, len(stem) + 1)]
        if (size is None or len(chosen) < size) and stem not in beginnings and not any(c in chosen for c in own):
            beginnings.update(own)
            odds = (row["toxic"] + 0.5) / (head["toxic"] + 1) / ((row["clean"] + 0.5) / (head["clean"] + 1))
            chosen[stem] = float(np.log(odds))
    return chosen


def learn_contexts(sample: DataFrame, stems: dict[str, float]) -> dict[str, float]:
    """Words around hits that tell abusive hits from others, with their log-odds.

    Each distinct context counts once, so that copies of one text do not. As with stems, a word must beat what the best of
    as many reaches by chance, either way.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = StemMatcher(stems)
        for batch in slices(batches):
            words, label = [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                low = text.lower()
                own = [context_words(low, *hit[2:]) for hit in matcher.matches(low) if hit]
                words += own
                label += [toxic] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(label, pa.int32())], ["words", "toxic"])

    if not stems:
        return {}
    contexts = stored(sample.mapInArrow(run, "words array<string>, toxic int").distinct(), "contexts")
    head = contexts.agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    if not head["clean"] or not head["toxic"]:
        return {}
    share = head["toxic"] / (head["clean"] + head["toxic"])
    counts = contexts.select(F.explode("words").alias("word"), "toxic").groupBy("word")
    counts = stored(counts.agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")).where("clean + toxic > 1"), "context-words")
    p = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    told = [F.when(F.col(c) > 0, F.col(c) * F.log(q / F.lit(of))).otherwise(0.0) for c, q, of in (("toxic", p, share), ("clean", 1 - p, 1 - share))]
    odds = F.log((F.col("toxic") + 0.5) / (head["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (head["clean"] + 1))
    found = counts.where(told[0] + told[1] >= float(np.log(max(counts.count(), 2)) + 1)).select("word", odds.alias("odds")).orderBy("word")
    return {r["word"]: r["odds"] for r in found.collect()}


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the prior mean says that hits are evidence and quoted ones are not.

    A misspelled hit is held to be worth part of an exact one unless the rows say otherwise: few rows hold any.
    """
    prior = np.array([2.0, 1.0, 0.0, 0.0, 0.3, 0.0, 0.5, -4.0])
    design = np.hstack([x, np.ones((len(x), 1))])
    w = prior.copy()
    penalty = np.diag([ridge * 20, 0.0, *[ridge * 20] * (FEATURES - 2), ridge])
    tie = np.zeros(len(prior))
    tie[:2] = -0.7, 1.0
    tied = np.outer(tie, tie)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ (w - prior) + tied @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty + tied
        move = np.linalg.solve(hessian, gradient)
        w = w - move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return w


def train_toxicity(labelled: DataFrame, lexicon: int | None = None, sample_rows: int = 20_000) -> ToxicityModel:
    """Learns from (text, toxic 0/1) rows with an id ``doc_id``; at most some ``sample_rows`` of them, by hash of the id.

    Rows without text or label are left out. Without toxic rows every score is low.
    """
    rows = labelled.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).where("text IS NOT NULL AND toxic IN (0, 1)")
    total = rows.count()
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000))
    sample = stored(rows.where(draw < int(min(1.0, sample_rows / max(total, 1)) * 1_000_000)), "toxic-sample")
    stems = learn_stems(sample.select("text", "toxic"), lexicon)
    contexts = learn_contexts(sample.select("text", "toxic"), stems)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = StemMatcher(stems, contexts)
        for batch in batches:
            x = np.array([matcher.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    found = sample.select("text", "toxic").mapInArrow(measure, "x array<double>, toxic int").toArrow()
    x = np.array(found["x"].to_pylist()).reshape(-1, FEATURES)
    return ToxicityModel(stems, fit_weights(x, found["toxic"].to_numpy().astype(float)), contexts)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, extra columns, score): score of every whole text, 0 to 1; null and empty texts score as texts without hits."""
    extra = extra or {}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[c.alias(k) for k, c in extra.items()], F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [model.score(t or "") for t in batch.column("text").to_pylist()]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores, pa.float64())], [*names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, score double")


def op3_toxicity(spark, folder: str) -> DataFrame:
    from emberlake.llm.language import held_out
    from emberlake.queries import table

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = held_out(folds=3, fold=1)
    known = docs.where(~out).select("doc_id", "text").join(labels.where(~out).select("doc_id", "toxic"), "doc_id")
    model = train_toxicity(known)
    scored = score_toxicity(docs, model, extra={"held_out": out})
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
