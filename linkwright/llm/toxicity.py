"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed unigrams, bigrams and one-word skip-grams of a lower-cased text.
FTRL-proximal keeps a learning rate for each coordinate, and its L1 term leaves only few weights, which
are broadcast as a sparse vector of at most BUCKETS entries. The fit takes at most MAX_TRAIN labelled
rows, those with the smallest md5 of their id (a bound of the fit only), in that order, in one task of
bounded size; scoring covers every row.

Defined cases: null and empty texts have no features and get the bias's score; without labelled rows
all weights are zero and every score is 0.5 (label 1); of several labels of an id the largest
counts; rows with a null id are scored and never train; repeated rows each give a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ids_of, map_arrow, text_input, tidy
from .textcore import U, WORDISH, Words, blocks, splitmix, words

BUCKETS = 1 << 20
MAX_TRAIN = 12_000
FOLDS = 5


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    epochs: int = 4


def _features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of all n-grams and skip-grams, repeats included."""
    shift = U(64 - BUCKETS.bit_length() + 1)
    two, at = w.gram(2)
    n = max(0, len(w.doc) - 2)
    skip = np.flatnonzero(w.doc[:n] == w.doc[2 : n + 2])
    over = splitmix(w.hash[skip] * U(0xD6E8FEB86659FD93) + w.hash[skip + 2])
    return np.concatenate([w.hash >> shift, two >> shift, over >> shift]).astype(np.int64), np.concatenate([w.doc, w.doc[at], w.doc[skip]])


def _distinct(bucket: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(doc * BUCKETS + bucket)
    return key % BUCKETS, key // BUCKETS


def fit_rows(rows: list[tuple[np.ndarray, float]], how: Ftrl) -> tuple[np.ndarray, float]:
    """Weights and bias after the rows in the given order, epochs times."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weight(zi, ni):
        return -np.sign(zi) * np.maximum(np.abs(zi) - how.l1, 0) / ((how.beta + np.sqrt(ni)) / how.alpha + how.l2)

    for _ in range(how.epochs):
        for idx, y in rows:
            at = np.append(idx, BUCKETS)
            zi, ni = z[at], n[at]
            w = weight(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / how.alpha * w
            n[at] = ni + g * g
    w = weight(z, n)
    return w[:BUCKETS], float(w[BUCKETS])


def fit_toxicity(docs: DataFrame, labels: DataFrame, how: Ftrl = Ftrl(), max_train: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray, float]:
    """Indices and values of the weights that are not zero, and the bias."""
    spark = docs.sparkSession
    use = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0))
    use = use.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = use.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_train).toPandas()
    order = np.argsort(picked["doc_id"].to_numpy(np.int64), kind="stable")
    chosen = spark.sparkContext.broadcast((picked["doc_id"].to_numpy(np.int64)[order], picked["toxic"].to_numpy(np.int32)[order], order))
    schema = pa.schema([("place", pa.int64()), ("toxic", pa.int32()), ("features", pa.binary())])

    def rows(batch):
        ids, toxic, place = chosen.value
        own = ids_of(batch)
        out = [[], [], []]
        at = np.flatnonzero(np.isin(own, ids)) if len(ids) else []
        if len(at):
            some = batch.take(pa.array(at))
            own = own[at].astype(np.int64)
            for b in blocks(some.column("text"), lower=True):
                k, doc = _distinct(*_features(words(b, WORDISH)))
                cut = np.searchsorted(doc, np.arange(b.rows + 1))
                for i in range(b.rows):
                    j = np.searchsorted(ids, own[b.first + i])
                    out[0].append(int(place[j]))
                    out[1].append(int(toxic[j]))
                    out[2].append(k[cut[i] : cut[i + 1]].astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    made = pa.schema([("bucket", pa.int64()), ("weight", pa.float64())])

    def fit(batches):
        train = []
        for batch in batches:
            cols = [batch.column(i) for i in range(3)]
            train += [(p.as_py(), np.frombuffer(f.as_buffer() or b"", np.int32), float(y.as_py())) for p, y, f in zip(*cols)]
        train.sort(key=lambda r: (r[0], r[1].tobytes()[:64]))
        w, bias = fit_rows([(f, y) for _, f, y in train], how)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, BUCKETS)), pa.array(np.append(w[at], bias))], schema=made)

    train = map_arrow(text_input(docs), rows, "place long, toxic int, features binary")
    model = train.repartition(1).mapInArrow(tidy(fit), "bucket long, weight double").toPandas()
    at, w = model["bucket"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)
    is_bias = at == BUCKETS
    return at[~is_bias], w[~is_bias], float(w[is_bias].sum())


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch):
        at, w, bias = shared.value
        dense = np.zeros(BUCKETS, np.float32)
        dense[at] = w
        parts = []
        for b in blocks(batch.column("text"), lower=True):
            k, doc = _features(words(b, WORDISH))
            hit = dense[k] != 0
            k, doc = _distinct(k[hit], doc[hit])
            x = np.bincount(doc, weights=dense[k].astype(np.float64), minlength=b.rows) + bias
            parts.append(1 / (1 + np.exp(-np.clip(x, -35, 35))))
        s = np.concatenate(parts) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_arrow(text_input(docs), make, "doc_id long, score double, predicted int")
