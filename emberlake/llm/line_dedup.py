"""Line dedup: lines found in several documents stay only in the first of them. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import ASCII_SPACE, LOWER, UPPER, id_of, rows_of_texts, stored, text_key


def line_key(line: Column) -> Column:
    """A line with ASCII white space stripped at both ends and A-Z lower-cased."""
    key = F.btrim(line, F.lit(ASCII_SPACE))
    # lower() of plain ASCII touches A-Z only and is much faster than translate().
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def _without(lines: Column, drops: Column) -> Column:
    """``lines`` without the 0-based positions in the sorted array ``drops``; linear in both."""

    def between(i: Column) -> Column:
        low = F.when(i == 0, F.lit(0)).otherwise(F.get(drops, i - 1) + 1)
        high = F.when(i == F.size(drops), F.size(lines)).otherwise(F.get(drops, i))
        return F.slice(lines, low + 1, high - low)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), between))


def _repeated_lines(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(__id, __text, drops): positions of the lines that rows (__id, __text, text) lose."""
    key = line_key(F.col("line"))
    keyed = (
        rows.select("__id", "__text", F.posexplode(_lines("text")).alias("pos", "line"))
        .select("__id", "__text", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("__id", "__text", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))
    )
    holders = keyed.select("k1", "k2", "__id").distinct().groupBy("k1", "k2")
    counted = holders.agg(F.min("__id").alias("first"), F.count("*").alias("n"))
    repeated = stored(counted.where(F.col("n") >= min_docs).select("k1", "k2", "first"), "repeated-lines")
    dropped = keyed.join(repeated, ["k1", "k2"]).where(F.col("__id") > F.col("first"))
    return dropped.groupBy("__id", "__text").agg(F.array_sort(F.collect_set("pos")).alias("__drops"))


def _lines(text: Column | str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _kept(text: Column | str) -> Column:
    whole = F.array_join(_lines(text), "\n")
    return F.when(F.col("__drops").isNull(), whole).otherwise(F.array_join(_without(_lines(text), F.col("__drops")), "\n"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every document with the lines that stay.

    Lines end at ``\\n``. Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold lose all
    their lines except in the smallest id; repetitions inside that document stay. Shorter lines always stay. A null or
    empty text is one empty line, kept. A null id is larger than every other id and rows without id count as one
    document. Rows that repeat an id count as one document and each gets its own result. Other columns are ignored.
    Keys are compared by two 64-bit hashes. No key's lines meet in one task: distinct documents are counted after a
    dedup by (key, id), and the join with repeated keys can be split.
    """
    rows = rows_of_texts(docs, id_col, text_col).withColumns({"__id": id_of("doc_id"), "__text": text_key("text")})
    found = rows.join(_repeated_lines(rows, min_chars, min_docs), ["__id", "__text"], "left")
    return found.select(
        "doc_id",
        F.size(_lines("text")).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drops"), F.lit(0)).cast("long").alias("n_dropped"),
        _kept("text").alias("kept"),
    )


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """The rows with all their columns and the text that ``dedup_lines`` keeps; null texts become empty ones."""
    keyed = docs.withColumns({"__id": id_of(id_col), "__text": text_key(text_col)})
    rows = keyed.select("__id", "__text", F.col(text_col).alias("text"))
    found = keyed.join(_repeated_lines(rows, min_chars, min_docs), ["__id", "__text"], "left")
    return found.withColumn(text_col, _kept(text_col)).select(*docs.columns)


def op7_line_dedup(spark, folder: str) -> DataFrame:
    from emberlake.queries import table

    found = dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
exploded AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
    FROM exploded
),
repeated AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > r.first, false) AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
