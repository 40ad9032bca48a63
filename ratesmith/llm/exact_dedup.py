"""Exact copies, with the heaviest groups split off by Misra-Gries.

Texts are equal when identical without white space; NULL counts as empty. Frequent digests come
from Misra-Gries counters (`freqItems`, at most 1 / support of them), are verified by an exact
count, and their groups are settled in the map tasks with a broadcast of at most 1 / support
rows. All other groups hold less than a `support` share of the rows and meet by a shuffle of
their digests. Of equal texts the longest original stays, then the smallest doc_id (NULL last),
then the first row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratesmith.llm.common import ROW, SPACES, numbered, text_of
from ratesmith.sources.workspace import staged

SUPPORT = 0.001


def digests(documents: DataFrame) -> DataFrame:
    """Row number, doc_id, digest of the text without white space, code points of the text."""
    text = text_of()
    return documents.select(
        ROW, "doc_id",
        F.sha2(F.translate(text, SPACES, ""), 256).alias("digest"),
        F.char_length(text).cast("long").alias("size"),
    )


def heavy_groups(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digests held by at least a `support` share of all rows, with the row that stays."""
    candidates = rows.stat.freqItems(["digest"], support).select(
        F.explode("digest_freqItems").alias("digest"))
    total = rows.count()
    return (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(
            F.count("*").alias("group_size"),
            F.min(F.struct((-F.col("size")).alias("order"), F.col("doc_id").isNull().alias("no_id"),
                           "doc_id", ROW)).alias("keep"),
        )
        .where(F.col("group_size") >= max(2.0, support * total))
    )


def decide(documents: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: row number, doc_id, keep_id, group_size, kept, text_sha256."""
    rows = staged(digests(documents), "digests")
    heavy = staged(heavy_groups(rows, support), "heavy_digests")
    light = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    order = group.orderBy(
        F.col("size").desc(), F.col("doc_id").asc_nulls_last(), F.col(ROW))
    shuffled = light.select(
        ROW, "doc_id",
        F.first("doc_id").over(order).alias("keep_id"),
        F.count("*").over(group).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
        "digest",
    )
    mapped = rows.join(F.broadcast(heavy), "digest").select(
        ROW, "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col(ROW) == F.col(f"keep.{ROW}")).alias("kept"), "digest",
    )
    return shuffled.unionByName(mapped).withColumnRenamed("digest", "text_sha256")


def exact_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of `docs`, dropped ones too; an empty table gives none."""
    return decide(numbered(docs, "doc_id", "text"), support).drop(ROW)
