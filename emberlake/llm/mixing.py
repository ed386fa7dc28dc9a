"""Mixing sources to target weights by entropy balancing.

Rates of documents minimise their relative entropy to one copy each, under one token constraint a source and a cap of
copies: rate = min(cap, exp(multiplier * size)). The multipliers solve a convex dual, one Newton step for all sources
in each distributed pass over (source, size) counts. Rates are then rounded to whole copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import stored
from emberlake.llm.ordering import ranked

# Fixed value: what separates words.
WORD = r"[^\x20\x09-\x0D]+"
# Buckets in each pass that narrows the rounding threshold, and passes: 2^36 places in all.
BUCKETS, PASSES = 4096, 3
NEWTON_STEPS, TOLERANCE = 60, 1e-9


def source_key(source: Column) -> Column:
    """Sources by code point, null last, as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(src, source_size, docs, target): weighted shares of ``share`` times all sizes, none above ``cap`` source sizes."""
    totals = sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_rank = ranked(totals, ["src"], "rank")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    sources = stored(by_rank.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(cap))}).drop("rank"), "sources")
    level, before = 0.0, -1.0
    # The excess of capped sources goes to the others by weight: the level rises until no further source is capped.
    while level > before:
        full = F.col("weight") * F.lit(level) >= F.col("most")
        total, taken, free = sources.agg(
            F.coalesce(F.sum("source_size") * F.lit(float(share)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        before, level = level, ((total - taken) / free if free else level)
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), "most")).drop("weight", "most")


def _rate(cap: float) -> Column:
    """Rate of a document; ``x`` is its size over its source's mean size."""
    x = F.col("size") / F.col("mean")
    tilted = F.exp(F.least(F.col("multiplier") * x, F.lit(700.0)))
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(tilted, F.lit(float(cap))))


def solve_multipliers(sized: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Targets with ``mean``, ``full`` (every document at the cap) and the ``multiplier`` of each source.

    Newton steps on the dual's derivative, which rises with the multiplier, kept inside a bracket: at its lower end no
    document exceeds target / size, at its upper end all are at the cap. A step that leaves it is halved instead.
    """
    sizes = stored(sized.where("size > 0").groupBy("src", "size").agg(F.count("*").alias("n")), "sizes")
    least = sizes.groupBy("src").agg(F.min("size").alias("least"))
    ratio = F.col("target") / F.col("source_size")
    state = (
        targets.where("source_size > 0")
        .join(least, "src")
        .withColumns({"mean": F.col("source_size") / F.col("docs"), "full": ratio >= F.lit(cap * (1 - 1e-12))})
        .withColumns(
            {
                "low": F.least(F.log(ratio) * F.col("mean") / F.col("least"), F.lit(0.0)),
                "high": F.log(F.lit(float(cap))) * F.col("mean") / F.col("least"),
                "multiplier": F.least(F.log(ratio), F.lit(0.0)),
            }
        )
        .drop("least")
    )
    state = stored(state, "multipliers")
    for _ in range(NEWTON_STEPS):
        rate, x = _rate(cap), F.col("size") / F.col("mean")
        words = F.col("n") * F.col("size") * rate
        sums = (
            sizes.join(state.select("src", "mean", "full", "multiplier"), "src")
            .groupBy("src")
            .agg(F.sum(words).alias("words"), F.sum(F.when(rate < cap, words * x).otherwise(0.0)).alias("slope"))
        )
        over = F.col("words") - F.col("target")
        step = F.col("multiplier") - over / F.when(F.col("slope") > 0, F.col("slope"))
        state = (
            state.select("src", "source_size", "docs", "target", "mean", "full", "low", "high", "multiplier")
            .join(sums, "src")
            .withColumns(
                {
                    "low": F.when(over < 0, F.col("multiplier")).otherwise(F.col("low")),
                    "high": F.when(over > 0, F.col("multiplier")).otherwise(F.col("high")),
                    "step": step,
                    "error": F.when(F.col("full"), F.lit(0.0)).otherwise(F.abs(over) / F.col("target")),
                }
            )
            .withColumn(
                "multiplier",
                F.when(F.col("error") <= TOLERANCE, F.col("multiplier"))
                .when((F.col("step") > F.col("low")) & (F.col("step") < F.col("high")), F.col("step"))
                .otherwise((F.col("low") + F.col("high")) / 2),
            )
        )
        state = stored(state, "multipliers")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("src", "mean", "full", "multiplier")


def _thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(src, edge): rows with ``order`` below the edge hold at most ``wanted`` words, and the next few reach it.

    Words by bucket of ``order`` are summed, and the bucket that crosses ``wanted`` is cut again. The windows run over
    at most BUCKETS rows a source.
    """
    edges = wanted.select("src", "wanted", F.lit(0.0).alias("edge"))
    width = 1.0
    for _ in range(PASSES):
        inside = rows.join(edges, "src").where((F.col("order") >= F.col("edge")) & (F.col("order") < F.col("edge") + width))
        bucket = F.least(F.floor((F.col("order") - F.col("edge")) / (width / BUCKETS)), F.lit(BUCKETS - 1)).cast("int")
        sums = inside.groupBy("src", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        whole = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("src").orderBy("bucket")))
        passed = (
            whole.join(edges, "src")
            .where(F.col("upto") <= F.col("wanted"))
            .groupBy("src")
            .agg(F.max("upto").alias("words"), (F.max("bucket") + 1).alias("bucket"))
        )
        width /= BUCKETS
        edges = stored(
            edges.join(passed, "src", "left").select(
                "src",
                (F.col("wanted") - F.coalesce("words", F.lit(0))).alias("wanted"),
                (F.col("edge") + F.coalesce("bucket", F.lit(0)) * F.lit(width)).alias("edge"),
            ),
            "edges",
        )
    return edges


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: int = 2,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    corrections: int = 4,
) -> DataFrame:
    """(doc_id, text_key, src, size, source_size, target, copies, taken): how many copies of each document the mix takes.

    Sizes are words; sources in code point order, null last, get the ``weights`` in turn, and together ``share`` times
    all words; no source gets more than ``cap`` times its words and no document more than ``cap`` copies. ``taken`` is
    copies times size. A document's rate is rounded down, and the remaining words of its source are taken in a seeded
    random order in proportion to the remaining fractions; ``corrections`` single documents then close most of the
    gap that whole documents leave. All draws are hashes of id and text, so reruns agree and rows repeated as a whole
    are rounded alike. Null texts have no words; sources without words take nothing. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.lit(11), F.col(text_col)).alias("text_key"),
        source_key(F.col(source_col)).alias("src"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = stored(rows, "sized")
    targets = stored(source_targets(sized, weights, share, cap), "targets")
    solved = stored(solve_multipliers(sized, targets, cap), "solved")
    uniform = (F.xxhash64(F.lit(seed), "doc_id", "text_key").bitwiseAND((1 << 52) - 1) + 1) / F.lit(float(1 << 52))
    rated = (
        sized.join(targets.join(solved, "src", "left"), "src")
        .withColumn("rate", F.when(F.col("size") > 0, _rate(cap)).otherwise(F.lit(1.0)))
        .withColumn("copies", F.floor("rate"))
        .withColumn("fraction", F.col("rate") - F.col("copies"))
        .select("src", "doc_id", "text_key", "size", "source_size", "target", "copies", "fraction", uniform.alias("u"))
        .withColumn("order", F.when(F.col("fraction") > 0, _ratio(F.col("u"), F.col("fraction"))).otherwise(F.lit(2.0)))
    )
    rated = stored(rated, "rated")
    base = rated.groupBy("src").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("wanted"))
    edges = _thresholds(rated.where((F.col("order") < 1) & (F.col("size") > 0)).select("src", "size", "order"), stored(base, "wanted"))
    more = (F.col("order") < F.col("edge")).cast("long")
    rounded = stored(
        rated.join(edges.select("src", "edge"), "src").withColumn("copies", F.col("copies") + more).drop("edge", "order", "fraction", "u"),
        "rounded",
    )
    for _ in range(corrections):
        rounded = stored(_corrected(rounded, cap), "rounded")
    return rounded.select(
        "doc_id", "text_key", "src", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"), (F.col("copies") * F.col("size")).alias("taken")
    )


def repeated_to_targets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them, with the columns they have.

    A row's copies are found by its id, text and source, nulls included; rows that repeat all three are taken alike,
    each as often as the other, so none comes more than ``cap`` times. Columns of any other name pass through.
    """
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    taken = taken.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"), F.col("src").alias("__src"), F.col("copies").alias("__copies")).distinct()
    same = (
        docs[id_col].cast("long").eqNullSafe(F.col("__id"))
        & (F.xxhash64(F.lit(11), docs[text_col]) == F.col("__text"))
        & (source_key(docs[source_col]) == F.col("__src"))
    )
    joined = docs.join(taken, same).where(F.col("__copies") > 0)
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), "__copies")).alias("__copy")).drop("__copy")


def _ratio(u: Column, fraction: Column) -> Column:
    """u / fraction, whose values up to 1 have the odds of ``fraction``, mapped into [0, 1)."""
    ratio = u / fraction
    return ratio / (1 + ratio)


def _corrected(rounded: DataFrame, cap: int) -> DataFrame:
    """One copy more or less of one document a source, if that brings its words nearer to the target.

    What is known of a source is stored before rows are joined with it: then no source's rows must meet in one task.
    """
    gaps = stored(rounded.groupBy("src").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap")), "gaps")
    open_rows = rounded.join(gaps, "src").where(
        (F.col("size") > 0) & F.when(F.col("gap") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
    )
    miss = F.abs(F.abs("gap") - F.col("size"))
    best = (
        open_rows.where(miss < F.abs("gap"))
        .groupBy("src")
        .agg(F.min(F.struct(miss.alias("miss"), "doc_id", "text_key", F.signum("gap").cast("long").alias("change"))).alias("best"))
        .select("src", F.col("best.doc_id").alias("best_id"), F.col("best.text_key").alias("best_text"), "best.change")
    )
    same = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_key") == F.col("best_text"))
    joined = rounded.join(stored(best, "corrections"), "src", "left")
    return joined.withColumn("copies", F.col("copies") + F.when(same, F.col("change")).otherwise(F.lit(0))).drop("best_id", "best_text", "change")


def op4_mixing(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
