"""The registered queries of this package and the DuckDB SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm import (audit, bpe, bwtmerge, chat, decontaminate, html, jaccard, mixing, oracle, pii, quality, rank,
                          recompression, secrets)
from daypulse.llm.spark_utils import narrow_batches


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return narrow_batches(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secrets.find(docs, secrets.fit_model(docs))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(_read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit_model(docs))


#: What conversation -1 says in both of its turns.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    got = chat.read_back(chat.format_windows(chats.unionByName(control)))
    return got.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
                      F.char_length("loss_text").cast("long").alias("loss_chars"),
                      F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_groups(_read(spark, sf_dir, "documents"), spec=jaccard.Spec(size=4, percent=85))


def op9_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwtmerge.remove_repeats(_read(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, _read(spark, sf_dir, "benchmark"), drop_text=True)


def op11_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.top_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary_path(), drop_text=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_secrets": op2_secrets,
    "op3_html": op3_html,
    "op4_recompression": op4_recompression,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_chat": op7_chat,
    "op8_jaccard": op8_jaccard,
    "op9_bwt_merge": op9_bwt_merge,
    "op10_decontaminate": op10_decontaminate,
    "op11_rank": op11_rank,
    "op12_audit": op12_audit,
    "op13_bpe": op13_bpe,
}
ORACLE: dict[str, str] = dict(oracle.ORACLE)
