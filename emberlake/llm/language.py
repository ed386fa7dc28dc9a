"""Language identification by prediction by partial matching over folded bytes.

Each language has a context tree of order 3 over an alphabet of 64 folded bytes. A symbol's probability is that of
the longest context seen, and of shorter ones after escapes (method C: a context with n occurrences of d distinct
symbols escapes with d / (n + d)) with full exclusion, so that every context's probabilities sum to 1. The counts are
frozen after training; a text's code length under a language is the sum over all its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import slices

SYMBOLS = 64
UNDETERMINED = "und"


def _folding() -> np.ndarray:
    """Byte to symbol: 0 white space and text start, 1-26 letters, 27 digits, 28 ' and -, 29 other ASCII,
    30 the lead byte of Latin-1 letters, 31 other lead bytes, 32-63 continuation bytes without their case bit."""
    fold = np.full(256, 29, np.uint8)
    fold[list(b" \t\n\x0b\x0c\r")] = 0
    for i in range(26):
        fold[ord("a") + i] = fold[ord("A") + i] = i + 1
    fold[ord("0") : ord("9") + 1] = 27
    fold[list(b"'-")] = 28
    fold[0xC0:] = 31
    fold[0xC3] = 30
    for byte in range(0x80, 0xC0):
        fold[byte] = 32 + (byte & 31)
    return fold


FOLD = _folding()


def symbols_of(data: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Context (the three symbols before, as one number) and symbol at each byte."""
    padded = np.zeros(memoryview(data).nbytes + 3, np.int32)
    padded[3:] = FOLD[np.frombuffer(data, np.uint8)]
    return (padded[:-3] << 12) | (padded[1:-2] << 6) | padded[2:-1], padded[3:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of (language, context and symbol) in each slice of a batch; key -1 counts documents."""
    for batch in slices(batches):
        keys: dict[str, list[np.ndarray]] = {}
        for data, lang in zip(batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist()):
            context, symbol = symbols_of(data.as_buffer())
            keys.setdefault(lang, []).append(np.append((context << 6) | symbol, np.int32(-1)))
        for lang, parts in keys.items():
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array(key.astype(np.int32)), pa.array(n.astype(np.int64))], ["lang", "key", "n"])


@dataclass(frozen=True)
class LanguageModel:
    """Code lengths in bits: ``costs[rows[context] * 64 + symbol]`` has one per language; ``prior`` is added once."""

    languages: list[str]
    rows: np.ndarray
    costs: np.ndarray
    prior: np.ndarray

    def code_lengths(self, data: bytes) -> np.ndarray:
        context, symbol = symbols_of(data)
        return self.costs[self.rows[context] * SYMBOLS + symbol].sum(0, dtype=np.float64)


def escaped(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities of each context (row) from its counts and the next shorter context's probabilities."""
    n, seen = counts.sum(1, keepdims=True), counts > 0
    d = seen.sum(1, keepdims=True)
    rest = np.where(seen, 0, lower).sum(1, keepdims=True)
    full = d == counts.shape[1]
    escape = np.where(full, 0, d / np.maximum(n + d, 1))
    known = counts / np.maximum(np.where(full, n, n + d), 1)
    return np.where(n == 0, lower, np.where(seen, known, escape * lower / np.maximum(rest, 1e-300)))


def build_model(lang: list[str], key: np.ndarray, n: np.ndarray, min_context: int) -> LanguageModel:
    """The model of frozen counts. Contexts of order 3 with fewer than ``min_context`` occurrences in all are cut."""
    languages = sorted(set(lang))
    code = np.searchsorted(languages, lang) if languages else np.empty(0, int)
    docs = key < 0
    prior = np.array([n[docs & (code == i)].sum() for i in range(len(languages))], float)
    total = np.bincount(key[~docs] >> 6, n[~docs], SYMBOLS**3)
    deep = np.flatnonzero(total >= min_context)
    rows = np.full(SYMBOLS**3, -1, np.int64)
    rows[deep] = np.arange(len(deep))
    costs = np.empty(((len(deep) + SYMBOLS**2) * SYMBOLS, len(languages)), np.float32)
    for i in range(len(languages)):
        own = ~docs & (code == i)
        k, c = key[own], n[own].astype(float)
        p = np.full((1, SYMBOLS), 1 / SYMBOLS)
        for order in range(3):
            size = SYMBOLS ** (order + 1)
            counts = np.bincount(k % size, c, size).reshape(-1, SYMBOLS)
            # The next shorter context of row r is the row of its last symbols.
            p = escaped(counts, p[np.arange(len(counts)) % len(p)])
        kept = rows[k >> 6] >= 0
        counts = np.bincount(rows[k[kept] >> 6] * SYMBOLS + (k[kept] & 63), c[kept], len(deep) * SYMBOLS)
        third = escaped(counts.reshape(-1, SYMBOLS), p[deep % SYMBOLS**2])
        costs[:, i] = -np.log2(np.concatenate([third, p])).ravel()
    shallow = np.flatnonzero(rows < 0)
    rows[shallow] = len(deep) + shallow % SYMBOLS**2
    return LanguageModel(languages, rows, costs, -np.log2(np.maximum(prior, 1) / max(prior.sum(), 1)))


def train_languages(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", min_context: int = 20) -> LanguageModel:
    """Counts over all rows with text and language; the driver gets at most 64^4 sums a language, as Arrow.

    ``min_context`` bounds the deepest level: fewer occurrences of a context, over all languages, leave it out.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    counts = rows.mapInArrow(_count, "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    return build_model(found["lang"].to_pylist(), found["key"].to_numpy().astype(np.int64), found["n"].to_numpy(), min_context)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, extra columns, lang_pred, score, bits_per_byte), one row per row.

    The language of least code length over the whole text, ties to the first by name; its share of the probability of
    all languages is the score. A null text, one without any letter, and every text where the model knows no language
    is ``und`` with score 0; ``bits_per_byte`` is null there.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model)  # at most (64^3 + 64^2) * 64 code lengths a language
    extra = extra or {}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[c.alias(k) for k, c in extra.items()], F.col(text_col).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in slices(batches):
            text = batch.column("text")
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_pylist()
            langs, scores, rates = [], [], []
            for data, ok in zip(text.cast(pa.binary()).to_pylist(), letters):
                if not ok or not known.languages:
                    langs.append(UNDETERMINED), scores.append(0.0), rates.append(None)
                    continue
                bits = known.code_lengths(data)
                posterior = bits + known.prior
                best = int(posterior.argmin())
                langs.append(known.languages[best])
                scores.append(float(1 / np.exp2(np.maximum(posterior[best] - posterior, -1000)).sum()))
                rates.append(float(bits[best] / len(data)))
            arrays = [batch.column(c) for c in batch.schema.names[:-1]] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "lang_pred", "score", "bits_per_byte"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(score, f"{schema}, lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", most_bits: float = 6.0) -> DataFrame:
    """The rows, with all their columns, whose text is in one of the model's languages.

    Rejected are null texts, texts without a letter, and texts that no language codes in fewer than ``most_bits`` bits a
    byte: 6 is what a symbol of the folded alphabet costs without any model, so such a text resembles no language
    known. A model without languages rejects all.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in slices(batches, text_col):
            text = batch.column(text_col)
            letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_pylist()
            data = text.cast(pa.binary()).to_pylist()
            good = [bool(ok and known.languages and known.code_lengths(d).min() < most_bits * len(d)) for d, ok in zip(data, letters)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Rows kept out of training: crc32 of the id as text, modulo ``folds``. Rows without id are kept out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def op5_language_id(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    docs = table(spark, folder, "documents")
    model = train_languages(docs.where(~held_out()))
    return identify(docs, model, extra={"held_out": held_out()})
