"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

1. Every text becomes a SHA-256 digest of its A-Z-lower-cased form (null counts as empty); digests are stored
   once in the shared checkpoint folder, so the texts are read a single time.
2. Misra-Gries counters (``freqItems``, at most 1/support of them) give every digest that can hold a share of
   ``support`` of the rows; an exact recount verifies them. These winners number at most 1/support by
   arithmetic, so they are broadcast and their copies are resolved map-side: a digest with a third of all rows
   never meets in one task.
3. The remaining digests are shuffled as usual; none of them holds more than ``support`` of the rows.

Defined cases: null text = empty text; rows that repeat a doc_id with an equal text form one group and exactly one
of them is kept; a null doc_id loses against any other; an empty table gives an empty result; further input
columns are ignored by ``resolve`` and kept by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, stored

SUPPORT = 0.001  # share of rows from which a digest counts as heavy; at most 1000 heavy digests exist


def heavy_digests(digests: DataFrame, order: str, support: float = SUPPORT) -> DataFrame:
    """(text_sha256, heavy_best, heavy_size) of each verified heavy digest; ``order`` is the SQL struct that picks the winner."""
    candidates = digests.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    floor = digests.agg((F.count(F.lit(1)) * support).alias("floor"))
    exact = (
        digests.join(F.broadcast(candidates), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.expr(f"max({order})").alias("heavy_best"), F.count(F.lit(1)).alias("heavy_size"))
    )
    return exact.where((F.col("heavy_size") > 1) & (F.col("heavy_size") >= floor.scalar()))


def resolve(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256. The largest doc_id of equal texts stays."""
    digests = stored(
        docs.select(F.col("doc_id"), F.sha2(ascii_lower(F.col("text")), 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row_no")),
        "digests",
    )
    order = "struct(doc_id, row_no)"
    heavy = stored(heavy_digests(digests, order, support), "heavy")
    split = digests.join(F.broadcast(heavy), "text_sha256", "left")
    group = Window.partitionBy("text_sha256")
    light = split.where(F.col("heavy_size").isNull()).withColumns({"best": F.expr(f"max({order})").over(group), "size": F.count(F.lit(1)).over(group)})
    hot = split.where(F.col("heavy_size").isNotNull()).withColumns({"best": F.col("heavy_best"), "size": F.col("heavy_size")})
    both = light.unionByName(hot)
    return both.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("best.row_no") == F.col("row_no")).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The documents with one row per distinct text (largest doc_id), all columns as they came."""
    columns = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("doc")
    work = docs.select(row, F.col("doc_id").alias("doc_id"), F.sha2(ascii_lower(F.col("text")), 256).alias("text_sha256"))
    digests = stored(work.select("doc_id", "text_sha256", F.lit(0).alias("row_no")), "digests")
    heavy = stored(heavy_digests(digests, "struct(doc_id, row_no)", support), "heavy")
    split = work.join(F.broadcast(heavy.withColumn("is_heavy", F.lit(True))), "text_sha256", "left")
    # heavy: only rows with the winning doc_id go on, pre-aggregated to one per digest before they move
    hot = (
        split.where(F.col("is_heavy") & F.col("doc_id").eqNullSafe(F.col("heavy_best.doc_id")))
        .groupBy("text_sha256")
        .agg(F.first("doc").alias("doc"))
        .select("doc")
    )
    rank = Window.partitionBy("text_sha256").orderBy(F.col("doc_id").desc_nulls_last())
    light = split.where(F.col("is_heavy").isNull()).withColumn("n", F.row_number().over(rank)).where("n = 1").select("doc")
    both = light.unionByName(hot)
    return both.select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(columns)])


ORACLE_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""
