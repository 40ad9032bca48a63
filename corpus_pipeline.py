"""The corpus pipeline: quality rules, exact copies, near copies, mixing, packing.

A stage's result is written before the next stage starts; the tables that a stage staged for itself
are removed when the next one is called.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesmith.llm import common, exact_dedup, mixing, ngram_join, quality
from ratesmith.llm.queries import packed_pieces
from ratesmith.sources.workspace import discard, noted, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, their texts whole."""
    documents = common.numbered_documents(docs)
    return common.rows_kept(documents, quality.survivors(documents))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    documents = common.numbered_documents(docs)
    return common.rows_kept(documents, exact_dedup.decide(documents).where("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    documents = common.numbered_documents(docs)
    found = ngram_join.near_components(documents, words=5, percent=80)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", common.ROW)
    alone = found.where("n_shingles = 0").select(common.ROW)
    kept = found.where("n_shingles > 0").groupBy("component_id").agg(
        F.min(order).alias("least")).select(F.col(f"least.{common.ROW}").alias(common.ROW))
    return common.rows_kept(documents, kept.unionByName(alone))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mixture takes, documents drawn twice in two rows."""
    return mixing.mixed_documents(common.numbered_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents."""
    return packed_pieces(docs)


_staged_before: list[str] = []


def _stage(function):
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, *_staged_before)
        with noted() as paths:
            result = function(spark, docs, sf_dir)
        _staged_before[:] = paths
        return result

    return run_stage


STAGES = [
    ("quality_rules", _stage(quality_rules)),
    ("exact_dedup", _stage(exact_copies)),
    ("near_copies", _stage(near_copies)),
    ("mix_sources", _stage(mix_sources)),
    ("packing", _stage(pack)),
]

# the tokenizer is beyond SQL; tests/llm holds the stages against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
