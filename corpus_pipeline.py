"""From raw documents to training text: each stage works on all that its predecessor kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes each stage's rows as Parquet in the
shared folder and reads them back as the documents of the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopfloor.llm import exact_dedup, mixing, ngram_join, quality_rules, segmentation
from shopfloor.llm.queries import tokenizer_file
from shopfloor.llm.shared import free_shuffles, shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id."""
    return exact_dedup.drop_exact(docs)


def similar_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8 or more): the smallest id."""
    return ngram_join.drop_similar(docs, n=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def segmentation_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document, as ids: the training examples."""
    return segmentation.segmentations(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", similar_stage),
    ("mixing", mixing_stage),
    ("segmentation", segmentation_stage),
]

#: The mix and the sampled segmentations draw by hash and by Philox, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
        free_shuffles(spark)
    return docs
