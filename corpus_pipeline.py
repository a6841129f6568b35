"""The corpus pipeline: quality rules, toxicity, exact dedup, n-gram Jaccard join, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next
stage's ``docs``. Filtering stages return the columns of ``docs`` as they came; the last returns the packed pieces.
Labels come from the folder's ``labels`` table. A stage treats nulls, ties, repeated rows and empty tables as its operator
does (see the operators' docstrings).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import exact_dedup, ngram_join, packing, quality, toxicity
from vigil.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keeping(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The documents under column names that no operator adds, with doc_id and text also under theirs."""
    names = [f"__doc_{i}__" for i in range(len(docs.columns))]
    held = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], F.col("doc_id"), F.col("text"))
    return held, names


def _restored(docs: DataFrame, scored: DataFrame, names: list[str]) -> DataFrame:
    return scored.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep."""
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    held, names = _keeping(docs)
    return _restored(docs, quality.label_lines(held, crf).where("kept"), names)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held, names = _keeping(docs)
    return _restored(docs, toxicity.score(held, net).where("predicted = 0"), names)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return ngram_join.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of the remaining documents."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=False).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

#: The stages hold trained models and a tokenizer, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents, each written to the shared folder and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
