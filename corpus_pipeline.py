"""The corpus pipeline: each stage works on all that its predecessor kept.

quality_rules drops documents that the rules reject, near_duplicates keeps one document of each class,
decontamination drops documents that cover a benchmark item, mixing repeats documents of small sources (no source
is read less than once, and none REPEAT_LIMIT times as often as another), and token_output writes the token files
and returns their digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkwright.llm import decontam, lshforest, mixing, quality, tokenbin
from linkwright.llm.runtime import written

REPEAT_LIMIT = 1.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.read_labels(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lshforest.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, REPEAT_LIMIT)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenbin.token_digest(tokenbin.tokens_of(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_output", token_output),
]

#: The verdict of the quality model and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
