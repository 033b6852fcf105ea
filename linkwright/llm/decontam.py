"""Benchmark decontamination by greedy string tiling.

Karp-Rabin hashes of runs of SEED words are computed for every benchmark item and text; items that share a
seed with a text are joined to it. For such a pair the hashes of all windows are run against each other,
equal windows that follow one another make maximal matches, and the longest match not yet overlapped is
marked again and again (what an earlier tile leaves of a match competes anew), down to SEED words. An item's
coverage is the share of its words under tiles, wherever in the text they lie, so that reordered passages
count in full. A text whose coverage of some item reaches THRESHOLD is contaminated.

The benchmark's seeds are broadcast while there are at most MAX_BROADCAST_SEEDS of them; a larger benchmark is
joined to the texts' seeds by a shuffle, and tiled pair by pair. Tiles that cover THRESHOLD of an item's words hold at least a fifth
as many of its seeds, so it's enough to join all but so many of an item's seeds, less one: the most frequent ones stay out, and a seed that
a large share of the texts have makes no pairs.

Words are lower-cased runs of letters, digits and underscores. Defined cases: null and empty texts are
clean; items with null or fewer than SEED words match nothing; texts of any length are read whole; repeated rows
each give a row, and repeated items count once each; an empty benchmark leaves all texts clean, an empty
table gives an empty one; other columns are passed on or ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import map_arrow, text_input, written
from .textcore import WORDISH, U, Words, blocks, words

SEED = 5
THRESHOLD = 0.5
MAX_BROADCAST_SEEDS = 2_000_000
_SIEVE_BITS = 22


def _windows(w: Words, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of SEED words, row by row, the offsets of the rows, and the rows' words."""
    h, at = w.gram(SEED)
    return h, np.searchsorted(w.doc[at], np.arange(rows + 1)), w.counts(rows)


def least_seeds(n_words, threshold: float):
    """How many of its places a text must share with an item of so many words to cover the threshold of it."""
    return np.maximum(1, np.ceil(np.ceil(threshold * np.asarray(n_words) - 1e-9) / SEED)).astype(np.int64)


def matches(item: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal matches (words, place in the item, place in the text) from the windows of both."""
    run = np.zeros(len(text) + 1, np.int64)
    found = []
    for i in range(len(item) + 1):
        now = np.zeros(len(text) + 1, np.int64)
        if i < len(item):
            hit = np.flatnonzero(text == item[i])
            now[hit + 1] = run[hit] + 1
        ended = np.flatnonzero(run[:-1] * (now[1:] == 0))
        found += [(int(run[j]) + SEED - 1, i - int(run[j]), int(j) - int(run[j])) for j in ended]
        if run[-1]:
            found.append((int(run[-1]) + SEED - 1, i - int(run[-1]), len(text) - int(run[-1])))
        run = now
    return found


def tile(item: np.ndarray, text: np.ndarray, item_words: int, text_words: int) -> np.ndarray:
    """Which words of the item greedy tiling marks."""
    marked, used = np.zeros(item_words, bool), np.zeros(text_words, bool)
    queue = [(-n, i, j) for n, i, j in matches(item, text)]
    heapq.heapify(queue)
    while queue:
        n, i, j = heapq.heappop(queue)
        free = ~(marked[i : i - n] | used[j : j - n])
        if free.all():
            marked[i : i - n] = used[j : j - n] = True
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= SEED:
                heapq.heappush(queue, (int(a - b), i + int(a), j + int(a)))
    return marked


class Index:
    """The benchmark's windows: which items have a seed, and the items' windows and lengths."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.windows, self.sizes = ids, [], []
        seeds, owners = [], []
        for i, b in ((b.first, b) for b in blocks(pa.array(texts, pa.string()), lower=True)):
            h, off, n = _windows(words(b, WORDISH), b.rows)
            self.windows += [h[off[k] : off[k + 1]] for k in range(b.rows)]
            self.sizes += n.tolist()
            seeds.append(h)
            owners.append(i + np.repeat(np.arange(b.rows), np.diff(off)))
        seeds, owners = np.concatenate([np.zeros(0, U), *seeds]), np.concatenate([np.zeros(0, np.int64), *owners])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owners = seeds[order], owners[order]
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.seeds >> U(64 - _SIEVE_BITS)] = True

    def candidates(self, h: np.ndarray, threshold: float = 0.0) -> list[int]:
        """Items that share enough places of seeds with the windows h to be covered to the threshold."""
        h = np.unique(h)
        lo, hi = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        some = [self.owners[a:b] for a, b in zip(lo, hi) if b > a]
        if not some:
            return []
        items, n = np.unique(np.concatenate(some), return_counts=True)
        return items[n >= self.least(threshold)[items]].tolist()

    def least(self, threshold: float) -> np.ndarray:
        return least_seeds(self.sizes, threshold)

    def coverages(self, column: pa.Array, threshold: float) -> list[list[tuple[int, float]]]:
        """(item, coverage) of the items that cover the threshold with each text."""
        out = []
        for b in blocks(column, lower=True):
            h, off, n = _windows(words(b, WORDISH), b.rows)
            hit = np.concatenate([[0], np.cumsum(self.sieve[h >> U(64 - _SIEVE_BITS)])])
            for i in range(b.rows):
                pairs = []
                if hit[off[i + 1]] > hit[off[i]]:
                    own = h[off[i] : off[i + 1]]
                    for k in self.candidates(own, threshold):
                        share = float(tile(self.windows[k], own, self.sizes[k], int(n[i])).mean())
                        if share >= threshold:
                            pairs.append((self.ids[k], share))
                out.append(pairs)
        return out


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")


def _seeds(rows: DataFrame, key: str) -> DataFrame:
    """h, key, tag and n_words of each row of key, tag, text, for every place of a seed in it."""
    schema = pa.schema([("h", pa.int64()), (key, pa.int64()), ("tag", pa.int32()), ("n_words", pa.int64())])

    def make(batch):
        ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in (key, "tag"))
        for b in blocks(batch.column("text"), lower=True):
            h, off, n = _windows(words(b, WORDISH), b.rows)
            own = np.repeat(np.arange(b.rows), np.diff(off))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[b.first + own]), pa.array(tags[b.first + own]), pa.array(n[own])], schema=schema)

    return map_arrow(rows.select(key, "tag", "text"), make, f"h long, {key} long, tag int, n_words long")


def _telling_seeds(items: DataFrame, docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """h, item_id, item_tag of the seeds to join, and h, key, tag of the texts' seeds that some item has."""
    places = written(_seeds(items, "item_id"), "bench-seeds")
    known = written(places.select("h").distinct(), "bench-known")
    theirs = written(_seeds(docs, "key").select("h", "key", "tag").join(known, "h").distinct(), "bench-theirs")
    often = written(theirs.groupBy("h").agg(F.count("*").alias("often")), "bench-often")
    rank = F.row_number().over(Window.partitionBy("item_id", "tag").orderBy(F.desc("often"), "h"))
    ranked = places.join(often, "h", "left").na.fill(0, ["often"]).withColumn("rank", rank)
    least = F.greatest(F.lit(1), F.ceil(F.ceil(F.lit(threshold) * F.col("n_words") - 1e-9) / SEED))
    kept = ranked.filter(F.col("rank") >= least).filter("often > 0").select("h", "item_id", F.col("tag").alias("item_tag")).distinct()
    return written(kept, "bench-telling"), theirs


def _broadcast_index(benchmark: DataFrame, limit: int):
    """The Index as a broadcast, or None if the benchmark has more seeds than limit."""
    items = _items(benchmark)
    n = items.select(F.sum(F.size(F.split("text", r"\s+"))).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    if (n["n"] or 0) > limit or (n["b"] or 0) > 16 * limit:
        return None
    rows = sorted((r["item_id"], r["text"]) for r in items.collect())
    return benchmark.sparkSession.sparkContext.broadcast(Index([r[0] for r in rows], [r[1] for r in rows]))


def coverage(documents: DataFrame, benchmark: DataFrame, limit: int = MAX_BROADCAST_SEEDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, items (the ids covered to the threshold, ascending) and coverage (the most of any of these items, 0 without) of every
    row."""
    index = _broadcast_index(benchmark, limit)
    if index is None:
        return _coverage_by_join(documents, benchmark, threshold).drop("key")
    schema = pa.schema([("doc_id", pa.int64()), ("items", pa.list_(pa.int64())), ("coverage", pa.float64())])

    def make(batch):
        pairs = index.value.coverages(batch.column("text"), threshold)
        items = [sorted({i for i, _ in p}) for p in pairs]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(items, schema.types[1]), pa.array([max([0.0, *(c for _, c in p)]) for p in pairs])], schema=schema)

    return map_arrow(text_input(documents), make, "doc_id long, items array<long>, coverage double")


def _row_key() -> Column:
    """A name for a row by its id and text, null or not."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))


def _coverage_by_join(documents: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """coverage() beyond what can be broadcast, with the key and tag of each row."""
    docs = text_input(documents).withColumns({"key": _row_key(), "tag": F.hash("text")})
    items = _items(benchmark).dropDuplicates().withColumn("tag", F.hash("text"))
    telling, seeds = _telling_seeds(items, docs, threshold)
    pairs = written(seeds.join(telling, "h").select("key", "tag", "item_id", "item_tag").distinct(), "bench-pairs")
    theirs = items.select("item_id", F.col("tag").alias("item_tag"), F.col("text").alias("item"))
    work = pairs.join(theirs, ["item_id", "item_tag"]).join(docs.dropDuplicates(["key", "tag"]), ["key", "tag"])
    schema = pa.schema([("key", pa.int64()), ("tag", pa.int32()), ("item_id", pa.int64()), ("coverage", pa.float64())])

    def make(batch):
        got = []
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            index = Index([0], [item])
            got.append(max([0.0, *(c for _, c in index.coverages(pa.array([text], pa.string()), threshold)[0])]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "tag", "item_id")), pa.array(got)], schema=schema)

    tiled = map_arrow(work.select("key", "tag", "item_id", "item", "text"), make, "key long, tag int, item_id long, coverage double")
    each = tiled.filter(F.col("coverage") >= threshold).groupBy("key", "tag").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage"))
    none = F.array().cast("array<long>")
    return docs.join(each, ["key", "tag"], "left").select("key", "doc_id", F.coalesce("items", none).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def keep_clean(documents: DataFrame, benchmark: DataFrame, limit: int = MAX_BROADCAST_SEEDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents, all columns, that are not contaminated."""
    index = _broadcast_index(benchmark, limit)
    if index is None:
        key = "key"
        while key in documents.columns:
            key = f"_{key}"
        bad = _coverage_by_join(documents, benchmark, threshold).filter("size(items) > 0").select(F.col("key").alias(key)).distinct()
        return documents.withColumn(key, _row_key()).join(written(bad, "bench-found"), key, "left_anti").drop(key)

    names = documents.columns  # which may hold dots, so columns go by place
    rows = documents.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"

    def make(batch):
        pairs = index.value.coverages(batch.column(text), threshold)
        yield batch.filter(pa.array([not p for p in pairs], pa.bool_()))

    return map_arrow(rows, make, rows.schema).toDF(*names)
