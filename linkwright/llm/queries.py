"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, lshforest, mixing, oracles, pii, quality, spans, suffix, tokenbin, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % toxicity.FOLDS == 0).alias("held_out")
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out, "score", "predicted")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.through_archives(_table(spark, sf_dir, "pages"), columns=("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.coverage(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "items", "coverage", (F.size("items") > 0).alias("contaminated"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ratio = quality.fit_ratio(docs, _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, ratio)


#: The entropy of op7's mixture lies half-way between that of the token shares and that of equal weights.
ENTROPY_SHARE = 0.5


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"), ENTROPY_SHARE)


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.token_digest(tokenbin.tokens_of(_table(spark, sf_dir, "documents")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_table(spark, sf_dir, "documents"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans.remove_spans(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_sentences", "n_removed", F.length("kept").cast("long").alias("kept_chars"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_warc, op3_decontamination, op4_near_duplicates, op5_repeats, op6_quality, op7_mixing, op8_tokens, op9_pii, op10_sentence_spans)}

ORACLES: dict[str, str] = {
    "op2_warc": oracles.OP2_WARC,
    "op4_near_duplicates": oracles.OP4_NEAR_DUPLICATES,
    "op5_repeats": oracles.OP5_REPEATS,
    "op7_mixing": oracles.OP7_MIXING,
}
