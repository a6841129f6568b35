"""Bounded, deterministic training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, allowed: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each class, chosen by the hash of their id.

    ``per_class`` is the bound: at most that many ids per class are kept (top-k of a hash, so no shuffle of the table),
    and only their texts leave the scan. ``allowed`` is a condition on doc_id for rows that may be learned from.
    """
    ids = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if allowed is not None:
        ids = ids.where(allowed)
    ids = ids.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # a document with labels of both classes counts as class 0
    chosen = None
    for value in (0, 1):
        part = ids.where(F.col("label") == value).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"))
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
