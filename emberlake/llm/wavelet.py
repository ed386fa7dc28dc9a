"""Token ids in wavelet matrices: one compressed file a shard that answers queries without being unpacked.

A wavelet matrix keeps a sequence of ids as bit planes, the highest bit first. Each plane orders the sequence stably by
the bits of the planes above, zeros before ones, so an id is found by following its bits down with rank, an occurrence
by following its place back up with select, and all occurrences of an id are neighbours below the last plane. Planes
take one bit an id each; rank and select need a directory of one 32-bit count for every 512 bits.

A shard file, all little-endian: the magic text, then as u64 the number of ids, of planes and of documents; the number
of zeros of each plane as u64; the documents' ids (i64), a byte for each that is 1 if it has no id, their first places
in the shard and the shard's length (u64); then plane by plane the directory (u32) and the bits (u64).
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import id_of, slices, text_key
from emberlake.session import scratch_folder

MAGIC = b"WAVELET1"
# Bits that one count of the directory covers, and words of 64 bits in them.
BLOCK, BLOCK_WORDS = 512, 8
# Ids after which a shard is closed; documents are never divided.
SHARD_IDS = 1 << 19
# Entries of a task's tables of distinct words and of their pieces, some 200 bytes each, before a table starts anew;
# only speed depends on them.
TABLE_WORDS, TABLE_PIECES = 300_000, 450_000
# Bytes of text whose words are looked up together.
TEXT_BYTES = 8 << 20
_ONE = np.uint64(1)


class WaveletMatrix:
    """Bit planes over a sequence of ids below 2^32; positions and results are numpy arrays."""

    def __init__(self, n: int, zeros: np.ndarray, directory: list[np.ndarray], bits: list[np.ndarray]) -> None:
        self.n, self.zeros, self.directory, self.bits = n, zeros, directory, bits

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        n, now = len(ids), ids.astype(np.uint32)
        width = max(int(now.max()).bit_length(), 1) if n else 1
        zeros, directories, planes = np.empty(width, np.int64), [], []
        for level in range(width):
            bit = (now & np.uint32(1 << (width - 1 - level))) != 0
            packed = np.zeros(-(-max(n, 1) // BLOCK) * BLOCK // 8, np.uint8)
            packed[: -(-n // 8)] = np.packbits(bit, bitorder="little")
            words = packed.view("<u8")
            counts = np.bitwise_count(words).reshape(-1, BLOCK_WORDS).sum(1, dtype=np.int64)
            directories.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u4"))
            planes.append(words)
            zeros[level] = n - int(counts.sum())
            now = now[np.concatenate([np.flatnonzero(~bit), np.flatnonzero(bit)])]
        return cls(n, zeros, directories, planes)

    def _ones(self, level: int, position: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block, inside = position // BLOCK, position % BLOCK
        found = self.directory[level][block].astype(np.int64)
        words, full = self.bits[level], inside // 64
        last = len(words) - 1
        for w in range(BLOCK_WORDS):
            word = words[np.minimum(block * BLOCK_WORDS + w, last)]
            found += np.where(w < full, np.bitwise_count(word), 0)
            part = word & ((_ONE << (inside % 64).astype(np.uint64)) - _ONE)
            found += np.where(w == full, np.bitwise_count(part), 0)
        return found

    def _bit(self, level: int, position: np.ndarray) -> np.ndarray:
        return (self.bits[level][position // 64] >> (position % 64).astype(np.uint64)) & _ONE

    def access(self, positions: np.ndarray) -> np.ndarray:
        """The ids at the positions."""
        position = np.asarray(positions, np.int64)
        out = np.zeros(len(position), np.uint32)
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, position).astype(bool), self._ones(level, position)
            out = (out << np.uint32(1)) | bit
            position = np.where(bit, zeros + ones, position - ones)
        return out

    def whole(self) -> np.ndarray:
        """All ids in order: from the last plane up, each deals the zeros and ones of its order out to their places."""
        now = np.zeros(self.n, np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = np.unpackbits(self.bits[level].view(np.uint8), count=self.n, bitorder="little").astype(bool)
            above, zeros = np.empty(self.n, np.uint32), self.zeros[level]
            above[~bit] = now[:zeros]
            above[bit] = now[zeros:] | np.uint32(1 << (len(self.zeros) - 1 - level))
            now = above
        return now

    def _span(self, symbol: int, start: int, stop: int) -> tuple[int, int]:
        """Places of the occurrences of an id from ``start`` to ``stop`` below the last plane."""
        width = len(self.zeros)
        if symbol < 0 or symbol >> width:
            return 0, 0
        edges = np.array([start, stop], np.int64)
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level, edges)
            edges = zeros + ones if (symbol >> (width - 1 - level)) & 1 else edges - ones
        return int(edges[0]), int(edges[1])

    def count(self, symbol: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id from ``start`` to before ``stop``."""
        low, high = self._span(symbol, start, self.n if stop is None else stop)
        return high - low

    def _select(self, level: int, bit: int, rank: np.ndarray) -> np.ndarray:
        """Position of the set (or clear) bit that ``rank`` such bits precede."""
        ones = self.directory[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = np.searchsorted(before, rank, "right") - 1
        left, position = rank - before[block], block * BLOCK
        done = np.zeros(len(rank), bool)
        for w in range(BLOCK_WORDS):
            word = self.bits[level][block * BLOCK_WORDS + w]
            word = word if bit else ~word
            here = np.bitwise_count(word).astype(np.int64)
            inside = ~done & (left < here)
            if inside.any():
                rows = np.unpackbits(word[inside].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                position[inside] += (np.cumsum(rows, 1) > left[inside, None]).argmax(1)
            rest = ~done & ~inside
            left[rest] -= here[rest]
            position[rest] += 64
            done |= inside
        return position

    def positions(self, symbol: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Where an id occurs, in order: its neighbours below the last plane, followed back up."""
        low, high = self._span(symbol, start, self.n if stop is None else stop)
        place = np.arange(low, high)
        width = len(self.zeros)
        for level in range(width - 1, -1, -1) if high > low else ():
            bit = (symbol >> (width - 1 - level)) & 1
            place = self._select(level, bit, place - (self.zeros[level] if bit else 0))
        return np.sort(place)


class Shard:
    """A shard file: a wavelet matrix with the documents whose ids it holds one after another."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a file of token ids")
        n, width, docs = np.frombuffer(data, "<u8", 3, 8).astype(np.int64).tolist()
        at = 32

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        zeros = take("<u8", width).astype(np.int64)
        self.doc_ids, self.without_id = take("<i8", docs), take("u1", docs).astype(bool)
        self.starts = take("<u8", docs + 1).astype(np.int64)
        blocks = -(-max(n, 1) // BLOCK)
        planes = [(take("<u4", blocks + 1), take("<u8", blocks * BLOCK_WORDS)) for _ in range(width)]
        self.matrix = WaveletMatrix(n, zeros, [d for d, _ in planes], [b for _, b in planes])

    @staticmethod
    def encode(doc_ids: list[int | None], ids: list[np.ndarray], first: list[int] | None = None) -> bytes:
        """File content for documents and their ids; ``first`` tells a document's first array if some have several."""
        matrix = WaveletMatrix.of(np.concatenate(ids) if ids else np.empty(0, np.uint32))
        head = np.array([matrix.n, len(matrix.zeros), len(doc_ids)], "<u8")
        starts = np.cumsum([0, *map(len, ids)]).astype("<u8")
        starts = starts if first is None else starts[first]
        parts = [head, matrix.zeros.astype("<u8"), np.array([i or 0 for i in doc_ids], "<i8"), np.array([i is None for i in doc_ids], "u1"), starts]
        for directory, bits in zip(matrix.directory, matrix.bits):
            parts += [directory, bits]
        return MAGIC + b"".join(p.tobytes() for p in parts)


# Words that the tokenizer's normaliser leaves as they are but for case: Latin letters, digits and ASCII signs. Left to
# the library are apostrophes, which begin pieces of their own, and "<", with which special tokens begin.
_PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
# Byte-level models write a byte as a sign: itself where that can be seen, else the next one from 256 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SIGN = {b: chr(b) for b in _SEEN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SEEN))}
_BYTE_SIGNS = {c: "".join(_SIGN[b] for b in chr(c).encode()) for c in range(128, 256)}


class _Numbers(dict):
    """Numbers what it is asked for in order."""

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        return number


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class WordIds:
    """Ids of texts under a tokenizer that treats the words between ASCII white space each for itself.

    Distinct words are encoded once a table; a text's ids are gathered from the table by its words.
    """

    def __init__(self, file: str, words: int = TABLE_WORDS, pieces: int = TABLE_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer, self.words, self.pieces = Tokenizer.from_file(file), words, pieces
        mixed_text = "A b's\tc\n12 <|endoftext|>é é ́x あ一!? a\x0bb"
        parts = self._library(mixed_text.split(" ")) + self._library([mixed_text])
        if b"".join(parts[:-1]) != parts[-1]:
            raise ValueError("this tokenizer joins words over white space; texts can't be cut there")
        self.piece: dict[str, bytes] = {}
        self._clear()
        # Words of Latin letters may go to the model piece by piece if that gives what the whole library gives.
        latin = "".join(map(chr, range(0xC0, 0x100))).replace("×", "").replace("÷", "")
        probes = [c + "aB" + d for c in latin + "Qz7.!_~" for d in latin + "x0;#"] + ["a1234b", "x..,y", "--", "A&B", "{|}", "ÀÉ%%%"]
        self.plain = self._library(probes) == list(map(self._pieces, probes))

    def _library(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, word: str) -> bytes:
        """Ids of a plain word: of each of its runs of letters, digits and runs of signs."""
        word = word.lower()
        known = self.piece.get(word)
        if known is not None:
            return known
        ids = []
        for piece in _PIECE.findall(word):
            found = self.piece.get(piece)
            if found is None:
                signs = piece if piece.isascii() else piece.translate(_BYTE_SIGNS)
                found = self.piece[piece] = _packed([t.id for t in self.tokenizer.model.tokenize(signs)])
            ids.append(found)
        return b"".join(ids)

    def _clear(self) -> None:
        self.number = _Numbers()
        self.start, self.flat = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _add(self, new: list[str]) -> None:
        """Ids of the words that were numbered last."""
        if len(self.piece) > self.pieces:
            self.piece.clear()
        plain = [self.plain and _PLAIN.fullmatch(w) is not None for w in new]
        others = iter(self._library([w for w, p in zip(new, plain) if not p]))
        ids = [self._pieces(w) if p else next(others) for w, p in zip(new, plain)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), np.uint32)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; null and empty texts have none. Arrow finds the distinct words of all texts together."""
        if len(self.number) > self.words:
            self._clear()
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        distinct = words.flatten().dictionary_encode()
        known = len(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, distinct.dictionary.to_pylist()), np.int64)
        if len(self.number) > known:
            self._add(list(islice(self.number, known, None)))
        at = numbers[distinct.indices.to_numpy()]
        first, lengths = self.start[at], self.start[at + 1] - self.start[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(first - ends[:-1], lengths) + np.arange(ends[-1])]
        return np.split(ids, ends[np.cumsum(words.value_lengths().to_numpy())[:-1]]) if len(texts) else []


@lru_cache(maxsize=2)
def _words(file: str) -> WordIds:
    return WordIds(file)


def write_shards(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Writes shards (part, seq, before, n_ids, n_docs, file) of the texts' ids in ascending order of document ids.

    Ids are those of the tokenizers library without special ones, and ``end_id`` after each document. A shard is one
    row with its file's content, and Parquet files hold one shard each: so any store that Spark writes to will do, and a
    task that is lost is repeated without trace. A shard is closed at ``shard_ids`` ids, documents are never divided.
    ``before`` counts the ids of earlier shards of the same part; parts are in order. Null ids come last, rows that repeat
    an id in the order of their texts' hashes; null and empty texts have the end id only. Other columns are ignored.
    ``tokenizer_file`` must exist on every executor.
    """
    order = [id_of("doc_id"), text_key("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        held: list[np.ndarray] = []
        count, end = 0, np.array([end_id], np.uint32)

        def shard() -> pa.RecordBatch:
            whole = [2 * i for i in range(len(ids) + 1)]  # each document is its ids and the end
            columns = [[part], [seq], [before], [count], [len(ids)], [Shard.encode(ids, held, whole)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], NAMES)

        for batch in slices(batches, limit=TEXT_BYTES):
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), _words(tokenizer_file).encode(batch.column("text"))):
                if count and count + len(own) >= shard_ids:
                    yield shard()
                    seq, before, ids, held, count = seq + 1, before + count, [], [], 0
                ids.append(doc_id)
                held += own, end
                count += len(own) + 1
        if ids:
            yield shard()

    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, SHARDS).write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)


SHARDS = "part int, seq int, before long, n_ids long, n_docs long, file binary"
NAMES = ["part", "seq", "before", "n_ids", "n_docs", "file"]
KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.large_binary()]


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards below a folder with ``start``, the number of ids before each. One sum a part passes the driver."""
    shards = spark.read.schema(SHARDS).parquet(path)
    offsets, total = [], 0
    for part, n in sorted(shards.groupBy("part").agg(F.sum("n_ids")).collect()):
        offsets.append((part, total))
        total += n
    table = spark.createDataFrame(offsets, "part int, offset long")
    return shards.join(F.broadcast(table), "part").withColumn("start", F.col("offset") + F.col("before")).drop("offset")


def _documents(shards: DataFrame, digest, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, file in zip(batch.column("start").to_pylist(), batch.column("file")):
                shard = Shard(file.as_buffer())
                ids = shard.matrix.whole()
                edges = shard.starts
                made = list(map(digest, np.split(ids, edges[1:-1]))) if len(edges) > 1 else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, mask=shard.without_id), pa.array(edges[:-1] + start), pa.array(np.diff(edges)), pa.array(made)],
                    ["doc_id", "start", "n_tokens", "out"],
                )

    return shards.select("start", "file").mapInArrow(run, f"doc_id long, start long, n_tokens long, out {kind}")


def token_ids(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in shards."""
    return _documents(shards, lambda ids: ids.astype(np.int64), "array<long>").withColumnRenamed("out", "ids")


def token_checksums(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in shards: crc32 of the ids as little-endian 32-bit numbers."""
    return _documents(shards, lambda ids: zlib.crc32(ids.astype("<u4", copy=False)), "long").withColumnRenamed("out", "ids_crc32")


def occurrences(shards: DataFrame, ids: list[int]) -> DataFrame:
    """(id, position) of every occurrence of a few ids over all shards, found by select on the planes alone."""
    wanted = [int(i) for i in ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, file in zip(batch.column("start").to_pylist(), batch.column("file")):
                matrix = Shard(file.as_buffer()).matrix
                for symbol in wanted:
                    found = matrix.positions(symbol) + start
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), symbol)), pa.array(found)], ["id", "position"])

    return shards.select("start", "file").mapInArrow(run, "id long, position long")


def op11_wavelet_ids(spark, folder: str) -> DataFrame:
    import public_tokenizers

    from emberlake.queries import table

    path = scratch_folder(spark, "token-shards")
    write_shards(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_checksums(read_shards(spark, path))
