"""SentencePiece encoding and decoding over a table of distinct chunks.

Where no piece holds a character after which the white space marker follows, nothing is merged across the place
before a marker, so a text's ids are those of its marked words in order. Each distinct chunk is segmented once per
table and its ids are joined back by position. The tables live in the tasks: the distinct words of a corpus have no
bound that would allow a broadcast, and shuffling every word of every text moves more than the texts themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from emberlake.llm.common import rows_of_texts, slices

MARK = "▁"
# Chunks, and characters of chunks, ids and decoded text, that a task's table holds before it starts anew: some 150 MB.
# Without spaces a chunk is a line, so their number alone bounds nothing. Only speed depends on either.
TABLE_CHUNKS, TABLE_CHARS = 400_000, 24_000_000


class ChunkTable:
    """Ids, as comma-joined text, and decoded text of distinct chunks under one model."""

    def __init__(self, model_file: str, limit: int = TABLE_CHUNKS, chars: int = TABLE_CHARS) -> None:
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross white space markers; its texts can't be cut into chunks")
        if self.sp.decode(self.sp.encode("  a éﬁ ")) != "  a éﬁ ":
            raise ValueError("this model normalises texts; chunks of the raw text would differ")
        # A line end is a chunk of its own where no piece holds one: then it is always spelled in bytes.
        lines = not any("\n" in p for p in pieces)
        self.pattern = re.compile(r" *[^ \n]+| +|\n" if lines else r" *[^ ]+| +")
        self.newline = self.sp.encode("\n")
        self.marker = self.sp.piece_to_id(MARK)
        self.names = [str(i) for i in range(len(pieces))]
        self.limit, self.chars, self.held = limit, chars, 0
        self.table: dict[str, tuple[str, str, int]] = {}

    def _segment(self, chunks: list[str]) -> None:
        """Adds chunks. The library puts a marker before each text: it stands for a chunk's first space, and a chunk
        without one follows a line end, whose ids are then cut off. One thread: tasks share the cores already."""
        marked = [c for c in chunks if c[0] == " "]
        bare = [c for c in chunks if c[0] != " "]
        cut = len(self.newline)
        # Encoding an empty text gives no id, but a lone space is a marker.
        ids = [i or [self.marker] for i in self.sp.encode([c[1:] for c in marked], num_threads=1)] if marked else []
        ids += [i[cut:] for i in self.sp.encode(["\n" + c for c in bare], num_threads=1)] if bare else []
        decoded = self.sp.decode(ids, num_threads=1)
        names, spaces = self.names, len(marked)
        for at, (chunk, own, text) in enumerate(zip(marked + bare, ids, decoded)):
            listed = ",".join([names[i] for i in own])
            self.table[chunk] = (listed, " " + text if at < spaces else text, len(own))
            self.held += len(chunk) + len(listed) + len(text)

    def encode_all(self, texts: list[str]) -> list[tuple[str, str, int]]:
        """Comma-joined ids, decoded text and number of ids of each text."""
        cut = [self.pattern.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        table = self.table
        new = {c for chunks in cut for c in chunks if c not in table}
        if new:
            if len(table) + len(new) > self.limit or self.held > self.chars:
                table.clear()
                self.held = 0
                new = {c for chunks in cut for c in chunks}
            self._segment(list(new))
        done = []
        for chunks in cut:
            found = [table[c] for c in chunks]
            done.append((",".join([f[0] for f in found]), "".join([f[1] for f in found])[1:], sum([f[2] for f in found])))
        return done

    def encode(self, text: str) -> tuple[str, str, int]:
        return self.encode_all([text])[0]


# Texts that are cut before their new chunks are segmented together.
TEXTS_AT_ONCE = 200


def _encoded(table: ChunkTable, texts: list[str | None]) -> Iterator[tuple[str, str, int]]:
    for at in range(0, len(texts), TEXTS_AT_ONCE):
        yield from table.encode_all([t or "" for t in texts[at : at + TEXTS_AT_ONCE]])


@lru_cache(maxsize=2)
def _table(model_file: str) -> ChunkTable:
    return ChunkTable(model_file)


def encode_texts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as comma-joined text and the text they decode to, for whole texts.

    As the library's encode without begin and end ids and its decode. Null and empty texts have no ids. One row per
    row, repeated ids included; other columns are ignored. ``model_file`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            done = list(_encoded(_table(model_file), batch.column("text").to_pylist()))
            ids, decoded, n = zip(*done) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    return rows_of_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string")


def token_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests made where the ids are, which are then not moved."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, ids, decoded = [], [], []
            for i, d, count in _encoded(_table(model_file), batch.column("text").to_pylist()):
                n.append(count), ids.append(sha(i)), decoded.append(sha(d))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows_of_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_sentencepiece(spark, folder: str) -> DataFrame:
    import public_tokenizers

    from emberlake.queries import table

    return token_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
