"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Two multinomials over hashed word unigrams and bigrams are estimated: the raw one from every document, the
target one from the trusted documents (labels.quality = 1; at most MAX_TRUSTED of them, those with the smallest
crc32 of their id, a bound of the fit only). The raw counts are scaled to the target's total, and both are smoothed
by PRIOR counts a bucket, so that an n-gram seen a few times says little either way. A document's
verdict is the mean over its n-grams of log p_target - log p_raw, compared with a fixed threshold, so
that equal texts always get equal verdicts.

Defined cases: null and empty texts have no words and fail the base rule; a text of any length is
read whole; without trusted documents every ratio is zero, which
passes; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import bounded_batches, ids_of, map_arrow, text_input, tidy
from .textcore import NOT_SPACE, U, Block, Words, blocks, per_row_sum, run_hash, splitmix, words

BUCKETS = 1 << 18
MAX_TRUSTED = 50_000
THRESHOLD = -0.17
#: Pseudo-counts of every bucket, in units of the target's counts, so that rare n-grams decide little.
PRIOR = 4.0
MIN_WORDS = 50
MAX_REPEAT = 50  # per cent

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80
_DOC = U(0x9E3779B97F4A7C15)

BASE_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Ratio:
    """log p_target - log p_raw of each bucket; always BUCKETS numbers, so safe to broadcast."""

    weights: np.ndarray


def _buckets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every unigram and bigram."""
    two, at = w.gram(2)
    shift = U(64 - BUCKETS.bit_length() + 1)
    return np.concatenate([w.hash >> shift, two >> shift]).astype(np.int64), np.concatenate([w.doc, w.doc[at]])


def base_counts(b: Block, w: Words) -> dict[str, np.ndarray]:
    rows = b.rows
    inside = NOT_SPACE[b.data]
    out = {"n_words": w.counts(rows), "word_chars": per_row_sum(inside & _STARTS_CHAR[b.data], b.off), "n_symbols": per_row_sum(_SYMBOL[b.data], b.off)}
    # lines: between the ends of rows and the newlines
    cut = np.flatnonzero(b.data == 10)
    begin = np.sort(np.concatenate([b.off[:-1], cut + 1]), kind="stable")
    end = np.sort(np.concatenate([b.off[1:], cut]), kind="stable")
    some = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    keep = some[np.maximum(end, begin)] > some[begin]
    begin, end = begin[keep], end[keep]
    doc = np.searchsorted(b.off, begin, "right") - 1
    key = splitmix(run_hash(b.data, begin, end) + doc.astype(U) * _DOC)
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(doc, minlength=rows) - np.bincount(doc[first], minlength=rows)
    three, at = w.gram(3)
    hit = np.zeros(len(w.doc), bool)
    if len(at):
        _, inv, n = np.unique(splitmix(three + w.doc[at].astype(U) * _DOC), return_inverse=True, return_counts=True)
        again = at[n[inv] > 1]
        for j in range(3):
            hit[again + j] = True
    out["n_repeat_words"] = np.bincount(w.doc[hit], minlength=rows)
    return out


def fit_ratio(docs: DataFrame, labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> Ratio:
    spark = docs.sparkSession
    ids = labels.filter(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    picked = ids.orderBy(F.crc32(F.col("doc_id").cast("string")), "doc_id").limit(max_trusted).toPandas()["doc_id"]
    trusted = spark.sparkContext.broadcast(np.sort(picked.to_numpy(np.int64)))
    schema = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])

    def count(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        good = trusted.value
        for batch in batches:
            ids = ids_of(batch)
            is_good = np.isin(ids, good) if len(good) else np.zeros(len(ids), bool)
            for b in blocks(batch.column("text")):
                k, doc = _buckets(words(b, NOT_SPACE))
                sums[0] += np.bincount(k, minlength=BUCKETS)
                mine = is_good[b.first + doc]
                if mine.any():
                    sums[1] += np.bincount(k[mine], minlength=BUCKETS)
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[0][at]), pa.array(sums[1][at])], schema=schema)

    found = text_input(docs).mapInArrow(tidy(count), "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = found["bucket"].to_numpy(np.int64)
    raw[at], target[at] = found["raw"], found["target"]
    if not target.sum():
        return Ratio(np.zeros(BUCKETS, np.float32))
    raw *= target.sum() / raw.sum()
    return Ratio((np.log(target + PRIOR) - np.log(raw + PRIOR)).astype(np.float32))


def score_quality(docs: DataFrame, ratio: Ratio, threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """The base counts, ratio (mean over n-grams, 0 without any), base_failed and kept per row, after
    the columns named in keep."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ratio.weights)
    bounded_batches(spark)
    text = f"_keep_{keep.index('text')}" if "text" in keep else "text"  # which travels once
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(keep)], *([] if "text" in keep else ["text"]))
    fields = [*((c, pa.int64()) for c in BASE_FIELDS), ("ratio", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]

    def make(batch):
        weights = shared.value
        parts = []
        for b in blocks(batch.column(text)):
            w = words(b, NOT_SPACE)
            c = base_counts(b, w)
            k, doc = _buckets(w)
            n = np.bincount(doc, minlength=b.rows)
            mean = np.bincount(doc, weights=weights[k].astype(np.float64), minlength=b.rows) / np.maximum(n, 1)
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT * c["n_words"])
            parts.append([*(c[f].astype(np.int64) for f in BASE_FIELDS), mean, failed, ~failed & (mean >= threshold)])
        cols = [pa.array(np.concatenate(x), f[1]) for x, f in zip(zip(*parts), fields)] if parts else [pa.array([], f[1]) for f in fields]
        keeps = [batch.column(f"_keep_{i}") for i in range(len(keep))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *keeps, *cols], names=["doc_id", *(f"_keep_{i}" for i in range(len(keep))), *(f[0] for f in fields)])

    kinds = dict(given.dtypes)
    schema = "doc_id long, " + "".join(f"_keep_{i} {kinds[f'_keep_{i}']}, " for i in range(len(keep)))
    schema += ", ".join(f"{c} long" for c in BASE_FIELDS) + ", ratio double, base_failed boolean, kept boolean"
    return map_arrow(given, make, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose verdict is to keep them. One pass: the verdict is computed
    beside the row, so no join by doc_id is needed and repeated ids do no harm."""
    ratio = fit_ratio(docs, labels)
    cols = docs.columns
    scored = score_quality(docs, ratio, keep=tuple(cols)).filter("kept")
    return scored.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(cols)])


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
