"""A corpus pipeline of five operators: filter, deduplicate, decontaminate, redact, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daypulse.llm import decontaminate, jaccard, mixing, quality, secrets
from daypulse.llm.spark_utils import narrow_batches, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or a soft rule on a strict host, go."""
    narrow_batches(spark)  # for this stage and, in one session, the following ones
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return jaccard.keep_one(docs)


def benchmark_hits(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    return secrets.redact(docs, secrets.fit_model(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that the sources reach their targets."""
    return mixing.mix(docs)


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("decontaminate", benchmark_hits),
          ("secrets", secret_redaction), ("mix", source_mix)]

#: Near duplicates, content hashes and the trained scan cannot be put in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
