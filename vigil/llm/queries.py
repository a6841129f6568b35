"""The registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, chat, exact_dedup, lm, mixing, ngram_join, packing, periodic, quality, repair, token_counts, toxicity, warc
from vigil.llm.common import table
from vigil.session import ensure_checkpoint_dir


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
    return packed.drop("ids")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.canonical_frame(chat.with_extra(table(spark, sf_dir, "conversations")))
    return chat.digest(chat.format_turns(turns))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).drop("mark")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.resolve(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.label_lines(docs, crf).drop("text")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.digest(warc.read_records(spark, path, payloads=False))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.digest(periodic.detect(docs, order=periodic.planted, key=F.col("doc_id")))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(repair.repair(repair.damaged(table(spark, sf_dir, "conversations"))))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_structure_repair": op12_structure_repair,
    "op13_source_mixing": op13_source_mixing,
}
ORACLES: dict[str, str] = {
    "op4_chat_formatting": chat.ORACLE_SQL,
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op11_periodic_runs": periodic.ORACLE_SQL,
    "op12_structure_repair": repair.ORACLE_SQL,
    "op13_source_mixing": mixing.ORACLE_SQL,
}
