"""A training corpus from the table of documents, in five stages.

Every stage takes all rows that its predecessor kept and returns the columns of ``documents``; the last returns the
tokens. Each stage's result is written and read again, so a lost executor never reaches back past one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake.llm.common import stored
from emberlake.llm.language import held_out, keep_identified, train_languages
from emberlake.llm.line_dedup import without_repeated_lines
from emberlake.llm.mixing import repeated_to_targets
from emberlake.llm.near_dedup import without_near_duplicates
from emberlake.llm.tokens import token_digests
from emberlake.queries import Query, table

# Near-duplicates in the corpus share at least this percentage of their five-word shingles.
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no language the model knows; learns from labelled rows outside the held-out fold."""
    return keep_identified(docs, train_languages(docs.where(~held_out())))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds; every document stays."""
    return without_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group of near-duplicates; without ids, one text of each group."""
    return without_near_duplicates(docs, percent=NEAR_PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources meet their target weights; a row comes up to twice."""
    return repeated_to_targets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text and decodes its ids; one row for each copy."""
    import public_tokenizers

    return token_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

# Context trees, hashes and seeded rounding have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": Query(run, ORACLE_SQL)}
