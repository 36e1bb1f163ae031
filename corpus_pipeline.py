"""The corpus pipeline: toxicity, quality rules, near duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import remainder_col, staged
from tidewater.llm.jaccard_join import keep_one
from tidewater.llm.packing import pack_documents
from tidewater.llm.quality_rules import judge
from tidewater.llm.substring_dedup import remove_repeats
from tidewater.llm.toxicity import score_toxicity

#: No SQL: a trained network, similarity links and a packing order can't be stated in it.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def _aside(docs: DataFrame) -> DataFrame:
    """`docs` with names that no operator makes itself for all columns that the filters don't read."""
    return docs.toDF(*[c if c in ("doc_id", "lang", "text") else f"_own_{i}" for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network doesn't call toxic; it learns from the labels that aren't held out."""
    own = _aside(docs)
    scored = score_toxicity(own, _labels(spark, sf_dir), remainder_col(F.col("doc_id"), 3) != 1)
    return scored.filter("predicted = 0").select(*own.columns).toDF(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep."""
    own = _aside(docs)
    return judge(own, _labels(spark, sf_dir)).filter("kept").select(*own.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 50-word windows that a smaller document has too."""
    return remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their place in sequences of 2048."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("near copies", drop_near_copies),
    ("repeated passages", drop_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs)
    return docs
