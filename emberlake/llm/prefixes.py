"""The trie of conversation prefixes, by range-partitioned paths and the skeleton of their splitters.

A conversation is a path of turns, each a 128-bit digest of role and text. Sorted paths hold every node of the trie as
one stretch of rows. Range-partitioning deals the stretches out to shards; only nodes on the path of a splitter (the
first path of a shard that is also a prefix of what the shard before ends with) reach over a border. That skeleton is
broadcast as two depths a shard, to which its first and last paths are shared with its neighbours; the turns on these
paths a shard reads off its own rows. So each sorted shard finishes all other nodes by itself, with a stack as deep as
its paths, and gives partial aggregates of its skeleton nodes, which add up: a node's own terms are counted in the shard
where it begins, and whether it is a leaf is known in the shard where it ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import stored

# Bytes of a turn's digest.
TURN = 16
# Ids in one piece of a skeleton node's list.
PIECE_IDS = 8192
# Rows that a task gives out at once.
ROWS_OUT = 10_000


def turn_digest(role: Column, text: Column) -> Column:
    """Hex digest of a turn; the length of the role keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * TURN)


def conversation_paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, sizes): digests of a conversation's turns one after another, and their texts' code points.

    Turns are ordered by number, null first, then by digest; null roles and texts are empty ones. Rows without a
    conversation belong to none and are left out. A path takes 20 bytes a turn and must fit a row.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    thin = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), turn_digest(role, text).alias("e"), F.char_length(text).alias("size")).alias("t"),
    )
    # Lists are joined up in each task before the shuffle.
    whole = thin.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    path = F.unhex(F.array_join(F.transform("ts", lambda t: t["e"]), ""))
    return whole.select("conv_id", path.alias("path"), F.transform("ts", lambda t: t["size"]).alias("sizes"))


def rebuilt(paths: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Paths whose first h turns are those of the conversation that opens the id's group; h is the id's crc32 modulo ``most``.

    All turns of that conversation if it has fewer, none if there is none; then the path's own turns after its first h.
    """
    paths = stored(paths, "paths")
    opening = F.col("conv_id") - F.col("conv_id") % group
    heads = paths.where(opening == F.col("conv_id")).select(
        F.col("conv_id").alias("head_id"), F.expr(f"substring(path, 1, {TURN * (most - 1)})").alias("head"), F.slice("sizes", 1, most - 1).alias("head_sizes")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = paths.withColumns({"h": h, "head_id": opening}).join(heads, "head_id", "left")
    none = F.array().cast("array<int>")
    return joined.select(
        "conv_id",
        F.expr(f"concat(substring(coalesce(head, x''), 1, {TURN} * h), substring(path, {TURN} * h + 1))").alias("path"),
        F.concat(F.slice(F.coalesce("head_sizes", none), F.lit(1), F.col("h")), F.slice("sizes", F.col("h") + 1, F.greatest(F.size("sizes"), F.lit(1)))).alias("sizes"),
    )


def shared_turns(one: bytes, other: bytes) -> int:
    """Turns with which both paths begin."""
    most = min(len(one), len(other)) // TURN
    if one[: most * TURN] == other[: most * TURN]:
        return most
    low, high = 0, most - 1  # that many are shared; at most so many
    while low < high:
        middle = (low + high + 1) // 2
        if one[: middle * TURN] == other[: middle * TURN]:
            low = middle
        else:
            high = middle - 1
    return low


def _skeleton(shards: DataFrame) -> dict[int, tuple[int, int]]:
    """Depths that each shard's first path shares with the shard before and its last path with the next one; -1 if none."""

    def depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("first", "before"))
            shared = [-1 if before is None else shared_turns(first, before) for first, before in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(shared, pa.int32())], ["shard", "shared"])

    borders = stored(shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")), "borders")
    order = sorted(r["shard"] for r in borders.select("shard").collect())
    following = borders.sparkSession.createDataFrame(list(zip(order[1:], order)), "shard int, previous int")
    pairs = borders.select("shard", "first").join(F.broadcast(following), "shard", "left")
    pairs = pairs.join(borders.select(F.col("shard").alias("previous"), F.col("last").alias("before")), "previous", "left")
    shared = dict(tuple(r) for r in pairs.select("shard", "first", "before").mapInArrow(depths, "shard int, shared int").collect())
    nexts = dict(zip(order, order[1:]))
    return {s: (shared[s], shared[nexts[s]] if s in nexts else -1) for s in order}


COLUMNS = {
    "kind": pa.int32(),  # 0: whole node, 1: part of a skeleton node, 2: piece of a skeleton node's ids
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(),
    "ids": pa.string(),
    "shard": pa.int32(),
    "seq": pa.int32(),
}
PARTS = (
    "kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, ids string, shard int, seq int"
)


class _Node:
    """An open node: sums over the members that this shard has."""

    __slots__ = ("turn", "size", "begins", "key", "least", "count", "children", "inner", "leaves", "saved", "ends", "waiting")

    def __init__(self, turn: bytes, size: int, begins: bool, key: bytes | None) -> None:
        self.turn, self.size, self.begins, self.key = turn, size, begins, key
        self.least = self.count = self.children = self.leaves = self.saved = 0
        self.inner = False  # has children here
        self.ends: list[int] = []
        self.waiting: list[list] = []  # whole children, until this node's least member is known


def _child_key(key: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(key + turn).digest()[:TURN]


ROOT = bytes(TURN)


class ShardTrie:
    """Nodes of one sorted shard whose borders share ``left`` and ``right`` turns with its neighbours (-1: no neighbour)."""

    def __init__(self, shard: int, left: int, right: int) -> None:
        self.shard, self.left, self.right = shard, left, right
        self.out: list[list] = []
        self.stack: list[_Node] = []
        self.path = b""

    def add(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        stack = self.stack
        if not stack:
            stack.append(_Node(b"", 0, self.left < 0, ROOT if self.left >= 0 else None))
            first = True
        else:
            first = False
            shared = shared_turns(self.path, path)
            while len(stack) > shared + 1:
                self._close(False)
        for depth in range(len(stack), len(path) // TURN + 1):
            turn = path[(depth - 1) * TURN : depth * TURN]
            across = first and depth <= self.left
            stack[-1].inner = True
            stack.append(_Node(turn, sizes[depth - 1], not across, _child_key(stack[-1].key, turn) if across else None))
        stack[-1].ends.append(conv_id)
        self.path = path

    def finish(self) -> None:
        """Closes what is open; nodes on the border to the next shard get their keys first."""
        for depth, node in enumerate(self.stack[: self.right + 1]):
            if node.key is None:
                node.key = ROOT if depth == 0 else _child_key(self.stack[depth - 1].key, node.turn)
        while self.stack:
            self._close(len(self.stack) - 1 <= self.right)

    def _close(self, goes_on: bool) -> None:
        node = self.stack.pop()
        depth, parent = len(self.stack), self.stack[-1] if self.stack else None
        if node.ends:
            node.count += len(node.ends)
            node.least = min(node.ends[0], node.least) if node.inner else node.ends[0]
        if not node.inner and not goes_on:
            node.leaves += 1
        node.saved += node.size * (node.count - node.begins)
        if parent:
            parent.least = node.least if parent.count == 0 else min(parent.least, node.least)
            parent.count += node.count
            parent.children += node.begins
            parent.leaves += node.leaves
            parent.saved += node.saved
        row = [0, node.key, None, node.least, depth, None, node.count, node.children, node.leaves, node.saved, None, None, self.shard, 0]
        if node.key is not None:
            row[0], row[2] = 1, parent.key if parent else None
            self.out.append(row)
            for at in range(0, len(node.ends), PIECE_IDS):
                ids = ",".join(map(str, node.ends[at : at + PIECE_IDS]))
                self.out.append([2, node.key, None, None, depth, None, 0, 0, 0, 0, None, ids, self.shard, at // PIECE_IDS])
            for child in node.waiting:
                child[2] = node.key
        else:
            row[10] = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest()
            if parent is None:
                self.out.append(row)
            elif parent.key is not None:
                row[2] = parent.key
                self.out.append(row)
            else:
                parent.waiting.append(row)
            for child in node.waiting:
                child[5] = node.least
        self.out += node.waiting


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), COLUMNS.values())], list(COLUMNS))


def _shard_tries(skeleton: dict[int, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie: ShardTrie | None = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "sizes"))
            for shard, conv_id, path, sizes in zip(*columns):
                if trie is None or trie.shard != shard:
                    if trie is not None:
                        trie.finish()
                        yield _batch(trie.out)
                    trie = ShardTrie(shard, *skeleton[shard])
                trie.add(conv_id, path, sizes)
                if len(trie.out) >= ROWS_OUT:
                    yield _batch(trie.out)
                    trie.out = []
        if trie is not None:
            trie.finish()
            yield _batch(trie.out)

    return run


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's pieces, which come in order; one piece is held at a time."""
    key, digest = None, None
    done: list[tuple[bytes, str]] = []
    for batch in batches:
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if own != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if key is not None:
        done.append((key, digest.hexdigest()))
    keys, digests = zip(*done) if done else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends"])


def prefix_trie(paths: DataFrame, partitions: int | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row a node.

    ``paths`` has (conv_id, path, sizes). A node is a distinct sequence of first turns, from the root of none; its members
    are the conversations that begin with it, its ``conv_id`` the least of them. Leaves and saved tokens are summed over
    its subtree: each node there saves its last text's code points for all members but one. ``ends_sha256`` is the digest
    of the members that end at the node, in ascending order, joined by commas. Without conversations there is no node.
    Conversations of equal paths are dealt out by id, so no group of them has to meet in one task.
    """
    spark = paths.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["path", "conv_id"]
    ordered = paths.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id())
    shards = stored(ordered, "sorted-paths")
    skeleton = _skeleton(shards)  # two numbers a shard
    dealt = shards.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", *order)
    parts = stored(dealt.select("shard", "conv_id", "path", "sizes").mapInArrow(_shard_tries(skeleton), PARTS), "trie-parts")
    pieces = parts.where("kind = 2").select("key", "shard", "seq", "ids")
    ends = pieces.repartition(n, "key").sortWithinPartitions("key", "shard", "seq").mapInArrow(_joined_ids, "key binary, ends string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = parts.where("kind = 1").groupBy("key", "parent_key", "depth").agg(F.min("conv_id").alias("conv_id"), *sums)
    nodes = stored(nodes.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit(""), 256))), "skeleton")
    known = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    # Whole nodes at the top of a shard's subtrees hang on skeleton nodes; all others know their parent already.
    named = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = parts.where("kind = 0 AND parent_key IS NULL").select(*named)
    top = parts.where("kind = 0 AND parent_key IS NOT NULL").join(known, "parent_key").withColumn("parent_conv_id", F.col("found"))
    skeleton_rows = nodes.join(known, "parent_key", "left").withColumn("parent_conv_id", F.col("found"))
    return inner.unionByName(top.select(*named)).unionByName(skeleton_rows.select(*named))


def op13_conversation_trie(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    return prefix_trie(rebuilt(conversation_paths(table(spark, folder, "conversations"))))


SQL = """
WITH turns AS (
    SELECT conv_id, turn, substr(sha256(strlen(r)::VARCHAR || ':' || r || t), 1, 32) AS e, length(t) AS size
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
),
own AS (
    SELECT conv_id, list({'e': e, 'size': size} ORDER BY turn NULLS FIRST, e) AS path,
        xor(4294967295, list_reduce(
            [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda v, u: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)
        )) % 6 AS h
    FROM turns GROUP BY conv_id
),
rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.path[1:o.h], []), o.path[o.h + 1:]) AS path
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
),
prefixes AS (
    SELECT conv_id, d AS depth, sha256(array_to_string(list_transform(path[1:d], lambda x: x.e), ',')) AS key,
        CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(path[1:d - 1], lambda x: x.e), ',')) END AS parent,
        CASE WHEN d > 0 THEN path[d].size ELSE 0 END AS size, d = len(path) AS ends
    FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT depth, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * any_value(size) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, key
),
children AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY ALL),
above AS (  -- each node with its ancestors and itself
    SELECT DISTINCT a.depth, a.key, p.depth AS below_depth, p.key AS below
    FROM prefixes p JOIN prefixes a ON a.conv_id = p.conv_id AND a.depth <= p.depth
),
sums AS (
    SELECT a.depth, a.key, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM above a JOIN nodes n ON n.key = a.below AND n.depth = a.below_depth
    LEFT JOIN children c ON c.parent = n.key AND c.depth = n.depth
    GROUP BY a.depth, a.key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
    s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.key = n.key AND s.depth = n.depth
LEFT JOIN nodes p ON p.key = n.parent AND p.depth = n.depth - 1
LEFT JOIN children c ON c.parent = n.key AND c.depth = n.depth
"""
