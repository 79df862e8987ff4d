"""From raw documents to token ids, in five stages.

Each stage gets what the one before it kept, reread from Parquet, and returns the
columns of ``documents``, but for the last, which returns token ids. Documents that
a stage drops are gone for all later ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from featloom.llm import exact_dedup, jaccard_join, mixing, quality
from featloom.llm.common import fresh, located, stored
from featloom.llm.queries import GOOD_FROM, quality_model, tokenizer

# A learned score, a float64 sum over passages, has no SQL.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as good; the classifier learns from labels outside the
    evaluation fold."""
    (score,) = fresh(docs, "score")
    rated = quality.scored(docs, quality_model(spark, sf_dir, docs), into=score)
    return rated.where(F.col(score) >= GOOD_FROM).select(docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, white space aside, the one of smallest id."""
    return exact_dedup.survivors(docs)


def distinct_shingles(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles, directly or not, the one of smallest id."""
    return jaccard_join.firsts(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of words of each source to its target, a row per document and block."""
    docs = located(docs)
    return mixing.mixed(docs, mixing.plan(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, and whether they decode to it again."""
    coder = tokenizer(spark)
    rows = docs.select("doc_id", "source", "text", coder.round_trip(F.col("text")).alias("trip"))
    same = F.col("trip.decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return rows.select(
        "doc_id",
        "source",
        F.col("trip.ids").alias("ids"),
        F.size("trip.ids").cast("long").alias("n_tokens"),
        same.alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("jaccard_join", distinct_shingles),
    ("mix", mixed_sources),
    ("bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
