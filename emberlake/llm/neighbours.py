"""Approximate nearest neighbours by inner product over shifted space-filling curves.

Vectors are projected several times at random, each time to a few dimensions, shifted, and ordered along a Hilbert
curve; Spark range-partitions all orders at once. A query is compared with the rows of a window around its place on
every curve, and the windows' best are merged and ranked by exact products.

Vectors of one length are searched among themselves, all lengths in the same jobs; components keep their own precision.

A window is a share of all rows of a length. On clustered vectors a small share is enough; on vectors that are far apart in all
directions no order keeps neighbours together, and the share decides the recall (see the README for figures).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from emberlake.llm.common import stored
from emberlake.llm.ordering import ranked

CURVES, DIMENSIONS, BITS = 10, 8, 7
# Rows of a block, the unit of comparison, and queries that meet a block in one task.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer cells (one row each) on a Hilbert curve, as 64-bit numbers; dimensions * bits <= 63.

    From the most significant bit down, the part of space not yet resolved is mirrored or turned so that successive
    cells touch; the Gray code of the turned coordinates, read across dimensions, is the place.
    """
    axes = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        top, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for i in range(len(axes)):
            upper = (axes[i] & top) != 0
            swap = np.where(upper, np.uint64(0), (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] & np.uint64(1 << bit)) != 0, turn ^ np.uint64((1 << bit) - 1), turn)
    keys = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << one) | (((axis ^ turn) >> np.uint64(bit)) & one)
    return keys.astype(np.int64)


def _matrix(packed: list[bytes], kind: str) -> np.ndarray:
    """Packed vectors of one length as rows of doubles."""
    return np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype(np.float64)


def _curve_keys(kind: str, curves: int, seed: int):
    """Emits each vector once a curve with its place on it; ``largest`` is the largest norm of its length.

    Products become distances by scaling with the largest norm and one more component that fills every vector up to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for batch in batches:
            lengths = batch.column("d").to_numpy()
            for dimension in np.unique(lengths).tolist():
                if dimension not in drawn:
                    rng, width = np.random.default_rng(seed), min(DIMENSIONS, dimension + 1)
                    turns = [np.linalg.qr(rng.normal(size=(dimension + 1, width)))[0] for _ in range(curves)]
                    if len(drawn) == 64:  # a table, not a limit
                        drawn.clear()
                    drawn[dimension] = turns, rng.random((curves, width))
                turns, shifts = drawn[dimension]
                part = batch.filter(pa.array(lengths == dimension))
                x = _matrix(part.column("vec").to_pylist(), kind) / (part.column("largest").to_numpy()[:, None] * (1 + 1e-9))
                filled = np.hstack([x, np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))])
                for c in range(curves):
                    # Spread over the unit cube as normal components would be; the shift moves the curve's seams.
                    spread = 1 / (1 + np.exp(-1.7 * np.sqrt(dimension + 1) * (filled @ turns[c])))
                    cells = ((spread + shifts[c]) / 2 * (1 << BITS)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("d"), pa.array(np.full(len(x), c, np.int32)), pa.array(hilbert_keys(cells, BITS)), *(part.column(n) for n in ("cls", "asked", "vec"))],
                        ["d", "curve", "key", "cls", "asked", "vec"],
                    )

    return run


def _compare(kind: str, wanted: int):
    """Best rows of a block for each query that visits it, without those that can't reach its ``floor``."""

    def run(block: pa.Table, visitors: pa.Table) -> pa.Table:
        out = ([], [], [])
        if block.num_rows and visitors.num_rows:
            ids = block["cls"].to_numpy()
            rows, queries = _matrix(block["vec"].to_pylist(), kind), _matrix(visitors["query_vec"].to_pylist(), kind)
            names, floors = visitors["query"].to_numpy(), visitors["floor"].to_numpy()
            for at in range(0, len(queries), 512):
                part = queries[at : at + 512]
                with np.errstate(over="ignore", invalid="ignore"):
                    rough = part @ rows.T
                limit = floors[at : at + 512][:, None]
                if rough.shape[1] > wanted:
                    limit = np.maximum(limit, np.partition(rough, -wanted, axis=1)[:, -wanted][:, None])
                # Products of different summation order differ in the last bits; those near the limit are ranked exactly.
                with np.errstate(over="ignore", invalid="ignore"):
                    slack = 1e-12 * np.abs(part).max(initial=1) * np.abs(rows).max(initial=1) * rows.shape[1]
                    # What overflows compares with nothing and is ranked exactly too.
                    q, r = np.nonzero(~(rough < limit - slack))
                    exact = (part[q] * rows[r]).sum(1)
                exact[np.isnan(exact)] = -np.inf
                order = np.lexsort((ids[r], -exact, q))
                q, r, exact = q[order], r[order], exact[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
                keep = rank < wanted
                for column, values in zip(out, (names[at + q[keep]], ids[r[keep]], exact[keep])):
                    column.append(values)
        parts = [np.concatenate(c) if c else np.empty(0, t) for c, t in zip(out, (np.int64, np.int64, np.float64))]
        return pa.table(dict(zip(("query", "cls", "score"), map(pa.array, parts))))

    return run


def _classes(vectors: DataFrame, wanted: int) -> DataFrame:
    """(cls, vec, ids, asked): one row for each distinct vector with its ``wanted`` least ids; more can't be in a result."""
    order = Window.partitionBy("v").orderBy("vec_id")
    least = vectors.select("vec_id", "v").distinct().withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= wanted)
    ids = least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = vectors.groupBy("v").agg(F.max("asked").alias("asked"))
    return ids.join(asked, "v").select(F.get("ids", F.lit(0)).alias("cls"), "v", "ids", "asked")


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    share: float = 0.08,
    curves: int = CURVES,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row whose id ``every`` divides.

    Score is the inner product in double precision; ties go to the smaller id; a query's own row is no candidate. On
    each of ``curves`` orders a query meets the rows within ``share`` of all distinct vectors on both sides, rounded up
    to whole blocks; vectors of another length than the query's are no candidates, since there is no product with them.
    Components keep the precision of the column. A product beyond the range of doubles is infinite; one that is not
    a number counts as the least. Vectors that are null, zero, or hold null or non-finite components take no part, nor
    rows without id. Equal vectors are indexed once and keep their least ids, which is
    all that a result can show. Repeated rows count once. Other columns are ignored.
    """
    components = F.col("v")
    kind = "float32" if vectors.schema[vector_col].dataType.elementType == FloatType() else "float64"
    element = "float" if kind == "float32" else "double"
    plain = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(components, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{element}>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(plain).withColumn("asked", F.col("vec_id") % every == 0)
    classes = stored(_classes(rows, k + 1).withColumn("d", F.size("v")), "vector-classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    lengths = classes.groupBy("d").agg(F.count("*").alias("n"), F.max(norm).alias("largest"), F.count_if("asked").alias("questions")).where("questions > 0")
    # Squares of the least doubles vanish.
    lengths = stored(lengths.withColumn("largest", F.when(F.col("largest") > 0, F.col("largest")).otherwise(1.0)), "vector-lengths")

    pack = F.pandas_udf(lambda v: v.map(lambda x: np.asarray(x, kind).tobytes()), "binary")
    keyed = classes.join(lengths.select("d", "largest"), "d").select("cls", "asked", "d", "largest", pack("v").alias("vec"))
    keyed = keyed.mapInArrow(_curve_keys(kind, curves, seed), "d int, curve int, key long, cls long, asked boolean, vec binary")
    at = ranked(keyed, ["d", "curve", "key", "cls"], "at")
    starts = at.groupBy("d").agg(F.min("at").alias("start"))
    blocks, groups = (F.ceil(F.col(c) / size).cast("int") for c, size in (("n", BLOCK_ROWS), ("questions", BLOCK_QUERIES)))
    sizes = stored(lengths.join(starts, "d").select("d", "n", "start", F.ceil(F.col("n") * share).alias("reach"), blocks.alias("blocks"), groups.alias("groups")), "vector-sizes")
    at = at.join(sizes, "d").withColumn("at", F.col("at") - F.col("start") - F.col("curve") * F.col("n"))
    home = F.floor(F.col("at") / BLOCK_ROWS).cast("int")
    members = at.select("d", "curve", home.alias("block"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), "cls", "vec")
    low = F.greatest(F.floor((F.col("at") - F.col("reach")) / BLOCK_ROWS), F.lit(0)).cast("int")
    high = F.least(F.floor((F.col("at") + F.col("reach")) / BLOCK_ROWS), F.col("blocks") - 1).cast("int")
    part = F.pmod(F.xxhash64("cls"), F.col("groups")).cast("int")
    asking = at.where("asked").select("d", "curve", home.alias("home"), F.explode(F.sequence(low, high)).alias("block"), part.alias("part"), "cls", "vec")
    asking = stored(asking.toDF("d", "curve", "home", "block", "part", "query", "query_vec"), "asking")
    keys = ["d", "curve", "block", "part"]
    best = Window.partitionBy("query").orderBy(F.desc("score"), "cls")

    def best_of(visitors: DataFrame, before: DataFrame | None) -> DataFrame:
        met = members.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(_compare(kind, k + 1), "query long, cls long, score double")
        met = met if before is None else met.unionByName(before)
        found = met.groupBy("query", "cls").agg(F.max("score").alias("score")).withColumn("__at", F.row_number().over(best))
        return stored(found.where(F.col("__at") <= k + 1).select("query", "cls", "score"), "found")

    # A query's own block on every curve comes first. What the rest of its windows adds must reach the last of these.
    near = best_of(asking.where("block = home").withColumn("floor", F.lit(float("-inf"))), None)
    floors = stored(near.groupBy("query").agg(F.when(F.count("*") > k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("floor")), "floors")
    found = best_of(asking.where("block <> home").join(floors, "query"), near)
    spelled = found.join(classes.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("vec_id"))
    listed = spelled.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("worse"), "vec_id"))).alias("results"))
    results = stored(listed.select("query", F.slice("results", 1, k + 1).alias("results")), "results")
    queries = rows.where("asked").select("vec_id", "v").distinct()
    own = stored(queries.join(classes.where("asked").select("v", F.col("cls").alias("query")), "v").select(F.col("vec_id").alias("query_id"), "query"), "queries")
    others = F.slice(F.filter("results", lambda x: x.vec_id != F.col("query_id")), 1, k)
    return (
        own.join(results, "query")
        .select("query_id", F.posexplode(others).alias("at", "x"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.worse")).alias("score"))
    )


def op9_neighbours(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    return nearest(table(spark, folder, "embeddings"))
