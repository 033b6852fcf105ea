"""TF-IDF vectors of names and addresses, and the cosine channel.

A record's vector holds the n-grams of its name and of its address as separate terms, each field normalised, scaled
by its weight, and the whole normalised again. Vocabularies and weights are fitted for each country.

Vectors have some thirty times the bytes of the texts that they are made of, so records travel as texts: every task gets those of its
block and its country's vocabulary, and makes the vectors itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import tokens as T
from ..functions.similarity import ranges
from ..sources.storage import spread, written
from .blocking import block_grid, block_of, every_block, top

#: Records of a block; two blocks meet in one task, of about 100 MB and 50 MB of terms and weights.
ROWS_S1, ROWS_S23 = 32_768, 16_384
#: Blocks of S23 texts that meet a block of S1 texts one after the other in one task, which returns only the best of them all.
TURNS = 8
#: Records whose vectors one task returns at once, and whose n-grams are counted at once.
ROWS_VECTORS = 4096
#: Numbers in the dense matrix of the right block's frequent terms, which at least one in DENSE_SHARE records have, scores held at once, and
#: records of the right block that they are of.
DENSE_CELLS, DENSE_SHARE, SCORE_CELLS, COLUMNS = 18 << 20, 24, 1 << 20, 4096


def gram_rows(records: DataFrame) -> DataFrame:
    """country_norm, entity_id, field, term, tf. Records are dealt by id before they become n-grams, of which there are far more bytes, so
    that neither counting nor norms move those again."""
    records = spread(records.select("country_norm", "entity_id", "name_norm", "addr_norm"), "entity_id")
    fields = F.array(F.struct(F.lit("n").alias("field"), F.col("name_norm").alias("x")), F.struct(F.lit("a").alias("field"), F.col("addr_norm").alias("x")))
    each = records.select("country_norm", "entity_id", F.explode(fields).alias("f")).select("country_norm", "entity_id", "f.field", F.explode(T.padded_ngrams(F.col("f.x"))).alias("term"))
    return each.groupBy("country_norm", "entity_id", "field", "term").agg(F.count("*").alias("tf"))


def fit_rows(records: DataFrame, limit: int | None = L.FIT_ROWS) -> DataFrame:
    """The records to fit on: all of a country of up to limit records, else those whose hash falls into that share of the
    range, which is about limit of them and needs no global sort. Without a limit all records."""
    if limit is None:
        return records
    n = records.groupBy("country_norm").agg(F.count("*").alias("_n"))
    share = F.pmod(F.xxhash64("entity_id"), F.lit(1 << 30)) / float(1 << 30)
    return records.join(n, "country_norm").filter((F.col("_n") <= limit) | (share < F.lit(float(limit)) / F.col("_n"))).drop("_n")


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


def _padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters, the text of each, and where two neighbours belong to one word. Words with their spaces are laid end to end, where
    two spaces part them, which no n-gram has inside."""
    padded = ["".join(f" {w} " for w in (x or "").split(" ") if w) for x in texts]
    char = _codes(padded)
    space = char == 32
    return char, np.repeat(np.arange(len(texts)), [len(p) for p in padded]), ~(space[:-1] & space[1:])


def _counted(texts: list[str], of: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The n-grams of texts of the records of, the number of records that have each, and of times it occurs: what T.padded_ngrams gives."""
    char, owner, inside = _padded(texts)
    place = np.zeros(0x110000, np.int64)
    place[char] = 1
    known = np.flatnonzero(place)
    place[known] = np.arange(1, len(known) + 1)
    place, bits, ids = place[char], len(known).bit_length(), int(of.max(initial=0)).bit_length()
    if bits * L.GRAM_MAX + ids > 62:
        raise ValueError("n-grams of too many different characters")
    key, good, pairs = place, np.ones(len(char), bool), [np.zeros(0, np.int64)]
    for n in range(2, L.GRAM_MAX + 1):
        if len(char) < n:
            break
        key = (key[:-1] << bits) | place[n - 1 :]
        good = good[:-1] & inside[n - 2 :]
        if n >= L.GRAM_MIN:
            pairs.append(key[good] << ids | of[owner[: len(key)][good]])
    pair, tf = np.unique(np.concatenate(pairs), return_counts=True)
    first = np.flatnonzero(np.diff(pair >> ids, prepend=-1))
    gram, letters = pair[first] >> ids, ["", *map(chr, known.tolist())]
    grams = [""] * len(gram)
    for i in reversed(range(L.GRAM_MAX)):
        grams = [g + letters[c] for g, c in zip(grams, (gram >> bits * i & ((1 << bits) - 1)).tolist())]
    return grams, np.diff(np.append(first, len(pair))), np.add.reduceat(tf, first) if len(first) else tf


def _gram_counts(texts: pa.Table) -> pa.Table:
    """country_norm, field, term, df, n of a block of records."""
    _, of = np.unique(np.array(texts["entity_id"].to_pylist(), object), return_inverse=True)
    parts = []
    for field, column in (("n", "name_norm"), ("a", "addr_norm")):
        term, df, n = _counted(texts[column].to_pylist(), of)
        each = [pa.repeat(pa.scalar(x, pa.string()), len(term)) for x in (texts["country_norm"][0].as_py(), field)]
        parts.append(pa.table([*each, pa.array(term, pa.string()), pa.array(df), pa.array(n)], names=["country_norm", "field", "term", "df", "n"]))
    return pa.concat_tables(parts)


def _blocks(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records' texts with the number i of a block of about ROWS_VECTORS of their country, and each country's number of blocks, _n."""
    blocks = records.groupBy("country_norm").agg(F.ceil(F.count("*") / ROWS_VECTORS).cast("int").alias("_n"))
    texts = records.select("country_norm", "entity_id", "name_norm", "addr_norm").join(F.broadcast(blocks), "country_norm")
    return texts.withColumn("i", block_of(F.col("_n"))).drop("_n"), blocks


def vocabulary(records: DataFrame, min_df: int = L.VOCABULARY_MIN_DF, size: int = L.VOCABULARY) -> DataFrame:
    """country_norm, field, term, df, n_docs: the terms that occur in min_df records, the most frequent ones first if there are
    more than size; ties by term. n_docs counts all records of the country, those with empty fields too. N-grams are counted in the
    task that makes them, a block of records at a time, so that only counts are shuffled."""
    texts, _ = _blocks(records)
    counts = spread(texts, "country_norm", "i").groupBy("country_norm", "i").applyInArrow(_gram_counts, "country_norm string, field string, term string, df long, n long")
    terms = counts.groupBy("country_norm", "field", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).filter(F.col("df") >= min_df)
    order = Window.partitionBy("country_norm", "field").orderBy(F.desc("n"), "term")
    kept = terms.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size).drop("_rank", "n")
    docs = records.groupBy("country_norm").agg(F.count("*").alias("n_docs"))
    return kept.join(docs, "country_norm")


class _Terms:
    """A country's vocabulary, to look up the n-grams of whole blocks of texts at once. A term of up to four characters is one number
    of 16 bits a character, its place among the characters of the vocabulary."""

    def __init__(self, field: list[str], term: list[str], df: list[int], n_docs: int):
        self.field, self.term = np.array(field, object), np.array(term, object)
        self.idf = np.log((1 + n_docs) / (1 + np.array(df, np.float64))) + 1
        known = np.unique(_codes(term))
        if len(known) >= 1 << 16 or L.GRAM_MAX > 4:
            raise ValueError("n-grams of more than four characters, or of more than 65535 different ones")
        self.place = np.zeros(0x110000, np.uint64)
        self.place[known] = np.arange(1, len(known) + 1, dtype=np.uint64)
        size, flat = np.array([len(t) for t in term], np.int64), self.place[_codes(term)]
        first, key = np.cumsum(size) - size, np.zeros(len(term), np.uint64)
        for i in range(int(size.max(initial=0))):
            more = size > i
            key[more] = (key[more] << np.uint64(16)) | flat[first[more] + i]
        self.sorted = {}
        for name in ("n", "a"):
            at = np.flatnonzero(self.field == name)
            at = at[np.argsort(key[at])]
            self.sorted[name] = (key[at], at)

    def found(self, name: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Text and term of every n-gram in a field of the vocabulary, with repeats: what T.padded_ngrams gives."""
        keys, at = self.sorted[name]
        char, owner, inside = _padded(texts)
        place = self.place[char]
        key, good, rows, terms = place, place > 0, [], []
        for n in range(2, L.GRAM_MAX + 1):
            if len(char) < n or not len(keys):
                break
            key = (key[:-1] << np.uint64(16)) | place[n - 1 :]
            good = good[:-1] & (place[n - 1 :] > 0) & inside[n - 2 :]
            if n >= L.GRAM_MIN:
                mine, row = key[good], owner[: len(key)][good]
                where = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                hit = keys[where] == mine
                rows.append(row[hit])
                terms.append(at[where[hit]])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(rows or none), np.concatenate(terms or none)

    def weights(self, ids: list[str], names: list[str], addresses: list[str], whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different ids in order, and of all their terms the id's place, the term's and the weight, by place and term; each field
        normalised, and with whole both together. Texts of one id count as one."""
        ids, of = np.unique(np.array(ids, object), return_inverse=True)
        n_terms, pairs, order = max(len(self.term), 1), [(np.zeros(0, np.int64),) * 2], np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(0, len(ids) + 4096, 4096))  # between ids, so that the parts' pairs follow one another
        for mine in (order[lo:hi] for lo, hi in zip(cut, cut[1:])):
            both = []
            for name, texts in (("n", names), ("a", addresses)):
                row, term = self.found(name, [texts[i] for i in mine])
                both.append(of[mine][row] * n_terms + term)
            pairs.append(np.unique(np.concatenate(both), return_counts=True))
        pair, tf = (np.concatenate(x) for x in zip(*pairs))
        row, term = np.divmod(pair, n_terms)
        w = (1 + np.log(tf)) * self.idf[term]
        address = (self.field == "a")[term]
        side = row * 2 + address
        w /= np.sqrt(np.bincount(side, w * w, 2 * len(ids)))[side]
        if whole:
            w *= np.where(address, L.ADDRESS_WEIGHT, L.NAME_WEIGHT)
            w /= np.sqrt(np.bincount(row, w * w, len(ids)))[row]
        return ids, row, term, w


def _terms(vocab: pa.Table) -> _Terms:
    row = vocab.slice(0, 1).to_pylist()[0] if vocab.num_rows else {"fields": [], "words": [], "dfs": [], "n_docs": 0}
    return _Terms(row["fields"], row["words"], row["dfs"], row["n_docs"])


def _vocabulary_rows(vocab: DataFrame) -> DataFrame:
    """A country's vocabulary as one row; its size is bounded by that of vocabularies."""
    lists = [F.collect_list(F.struct("field", "term", "df")).alias("_v"), F.first("n_docs").alias("n_docs")]
    return vocab.groupBy("country_norm").agg(*lists).select("country_norm", F.col("_v.field").alias("fields"), F.col("_v.term").alias("words"), F.col("_v.df").alias("dfs"), "n_docs")


def _weights(records: DataFrame, vocab: DataFrame, whole: bool) -> DataFrame:
    texts, blocks = _blocks(records)
    words = _vocabulary_rows(vocab).join(F.broadcast(blocks), "country_norm").withColumn("i", every_block(F.col("_n"))).drop("_n")

    def block(texts: pa.Table, vocab: pa.Table) -> pa.Table:
        terms = _terms(vocab)
        ids, row, term, weight = terms.weights(*(texts[c].to_pylist() for c in ("entity_id", "name_norm", "addr_norm")), whole)
        country = texts["country_norm"][0].as_py() if texts.num_rows else ""
        each = lambda values, at: pa.array(values, pa.string()).take(pa.array(at))
        columns = [each([country], np.zeros(len(row), np.int64)), each(ids, row), each(terms.field, term), each(terms.term, term), pa.array(weight)]
        return pa.table(columns, names=["country_norm", "entity_id", "field", "term", "weight"])

    keys = ["country_norm", "i"]
    words = words.toDF(*words.columns)  # the vocabulary may be of the same records
    both = spread(texts, *keys).groupBy(*keys).cogroup(spread(words, *keys).groupBy(*keys))
    return both.applyInArrow(block, "country_norm string, entity_id string, field string, term string, weight double")


def tfidf(records: DataFrame, vocab: DataFrame) -> DataFrame:
    """country_norm, entity_id, field, term, weight, each field of a record normalised."""
    return _weights(records, vocab, False)


def record_vectors(records: DataFrame, vocab: DataFrame) -> DataFrame:
    """country_norm, entity_id, field, term, weight of the whole record, normalised."""
    return _weights(records, vocab, True)


def cosine_pairs_by_join(v1: DataFrame, v23: DataFrame) -> DataFrame:
    """sid, cid, score of all pairs that share a term, by a join on terms: clear, and costly where terms are common."""
    a = v1.select("country_norm", "field", "term", F.col("entity_id").alias("sid"), F.col("weight").alias("w1"))
    b = v23.select("country_norm", "field", "term", F.col("entity_id").alias("cid"), F.col("weight").alias("w2"))
    return a.join(b, ["country_norm", "field", "term"]).groupBy("sid", "cid").agg(F.sum(F.col("w1") * F.col("w2")).alias("score"))


def _packed(v: DataFrame) -> DataFrame:
    return v.groupBy("country_norm", "entity_id").agg(F.collect_list(F.xxhash64("field", "term")).alias("terms"), F.collect_list("weight").alias("weights"))


def _flat(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, weights, and the offsets of the rows."""
    size = part["terms"].map(len).to_numpy()
    return np.concatenate(part["terms"].to_list()), np.concatenate(part["weights"].to_list()), np.concatenate([[0], np.cumsum(size)])


def _first(row: np.ndarray, column: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the best k a row, by row; ties by column."""
    order = np.lexsort((column, -score, row))
    at = row[order]
    return order[np.arange(len(at)) - np.searchsorted(at, at) < k]


class _Right:
    """A block of n records (terms below n_terms, weights and offsets of the records) to multiply others with. Its most frequent terms are
    columns of a dense matrix, which a matrix product handles faster than their long lists; the others go over an inverted index for
    each COLUMNS records. Products are in single precision: they tell which pairs may be among the best, whose scores are
    then computed in double precision."""

    def __init__(self, n: int, right: tuple, n_terms: int):
        self.n, self.n_terms, self.vectors = n, n_terms, right
        term, weight, off = right
        df, row = np.bincount(term, minlength=n_terms), np.repeat(np.arange(n), np.diff(off))
        frequent = np.argsort(-df, kind="stable")[: max(1, DENSE_CELLS // n)]
        frequent = frequent[df[frequent] * DENSE_SHARE >= n]
        self.column = np.full(n_terms, -1)
        self.column[frequent] = np.arange(len(frequent))
        at = self.column[term]
        self.dense = np.zeros((n, len(frequent)), np.float32)
        self.dense[row[at >= 0], at[at >= 0]] = weight[at >= 0]
        term, weight, row = term[at < 0], weight[at < 0], row[at < 0]
        self.wide = min(n, COLUMNS)
        part = row // self.wide * n_terms + term
        order = np.argsort(part, kind="stable")
        self.row, self.weight = (row % self.wide)[order], weight[order]
        self.size = np.bincount(part, minlength=-(-n // self.wide) * n_terms)
        self.first = np.cumsum(self.size) - self.size
        #: An absolute bound of the error of a score in single precision, whose factors have the length 1 and no negative weights.
        self.error = (len(frequent) + 8) * 2.0**-23

    def scores(self, lo: int, wide: np.ndarray, of: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of rows with the records from lo on, as many as an index has."""
        hi = min(lo + self.wide, self.n)
        out = wide @ self.dense[lo:hi].T
        if len(term):
            at = lo // self.wide * self.n_terms + term
            m = self.size[at]
            where = ranges(self.first[at], m)
            out += np.bincount(self.row[where] + np.repeat(of * (hi - lo), m), self.weight[where] * np.repeat(weight, m), out.size).reshape(out.shape)
        return out

    def exact(self, of: np.ndarray, term: np.ndarray, weight: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The scores of pairs of rows and records, rounded."""
        step, out = max(1, SCORE_CELLS // self.n_terms), np.zeros(len(row))
        terms, weights, off = self.vectors
        for lo in range(0, int(row.max(initial=-1)) + 1, step):
            x, mine = np.zeros((step, self.n_terms)), slice(*np.searchsorted(of, [lo, lo + step]))
            x[of[mine] - lo, term[mine]] = weight[mine]
            pair = slice(*np.searchsorted(row, [lo, lo + step]))
            m = np.diff(off)[column[pair]]
            where = ranges(off[column[pair]], m)
            value = weights[where] * x.ravel()[np.repeat((row[pair] - lo) * self.n_terms, m) + terms[where]]
            if len(value):  # a pair in it has a term
                out[pair] = np.add.reduceat(value, np.cumsum(m) - m)
        return np.round(out, 6)


def _best(n_left: int, left: tuple, right: _Right, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column, score of the best k a row in the product of n_left records (terms, weights and offsets) and a block, a few rows at a time;
    ties by column. Pairs below a row's least, if given, may be left out."""
    terms, weights, offsets = left
    step, slack, out = max(1, SCORE_CELLS // right.wide), 2 * right.error + 1e-6, []
    for i in range(0, n_left, step):
        off = offsets[i : i + step + 1]
        rows, mine = len(off) - 1, slice(off[0], off[-1])
        of, term, weight = np.repeat(np.arange(rows), np.diff(off)), terms[mine], weights[mine]
        common = right.column[term] >= 0
        wide = np.zeros((rows, right.dense.shape[1]), np.float32)
        wide[of[common], right.column[term[common]]] = weight[common]
        rest = of[~common], term[~common], weight[~common]
        floor = np.full(rows, 4e-7)  # what is below is 0 once rounded
        if least is not None:
            floor = np.maximum(floor, least[i : i + step] - slack)
        found, n_found = [], 0
        for lo in range(0, right.n, right.wide):
            scores = right.scores(lo, wide, *rest)
            if lo == 0 and scores.shape[1] > k and floor.min() < 1e-6:
                floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k] - slack)
            row, column = np.divmod(np.flatnonzero(scores >= floor.astype(np.float32)[:, None]), scores.shape[1])
            found.append((row, column + lo, scores[row, column].astype(float)))
            n_found += len(row)
            if n_found > 2 * k * rows or lo + right.wide >= right.n:
                row, column, score = (np.concatenate(x) for x in zip(*found))
                kept = _first(row, column, score, k)
                full = np.bincount(row[kept], minlength=rows) >= k
                last = np.full(rows, np.inf)
                np.minimum.at(last, row[kept], score[kept])
                floor = np.where(full, np.maximum(floor, last - slack), floor)  # all that may reach the k-th score once rounded, so that ties are cut by id alone
                kept = score >= floor[row]
                found, n_found = [(row[kept], column[kept], score[kept])], 0
        row, column, _ = found[0]
        order = np.argsort(row, kind="stable")
        row, column = row[order], column[order]
        score = right.exact(of, term, weight, row, column)
        row, column, score = (x[score > 0] for x in (row, column, score))
        kept = _first(row, column, score, k)
        out.append((row[kept] + i, column[kept], score[kept]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _block_top(k: int):
    """The best k a row of two blocks of vectors."""

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"sid": pd.Series(dtype=str), "cid": pd.Series(dtype=str), "score": pd.Series(dtype=float)})
        right = right.sort_values("entity_id")
        (own, own_weight, own_off), (term, weight, off) = _flat(left), _flat(right)
        known, term = np.unique(term, return_inverse=True)
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        shared = known[at] == own
        own_off = np.concatenate([[0], np.cumsum(shared)])[own_off]
        row, column, score = _best(len(left), (at[shared], own_weight[shared], own_off), _Right(len(right), (term, weight, off), len(known)), k)
        return pd.DataFrame({"sid": left["entity_id"].to_numpy()[row], "cid": right["entity_id"].to_numpy()[column], "score": score})

    return best


def _cell_top(k: int):
    """key, cid, score: the best k a key of a block of S1 texts and several blocks of S23 texts, by turns. Equal texts are multiplied once. The
    best k of different texts, ties by their first id, hold the best k ids, since each of them has an id before all ids of the others."""

    def vectors(terms: _Terms, ids: list, texts: pa.ChunkedArray) -> tuple[np.ndarray, tuple]:
        each, size = pa.compute.list_flatten(texts), pa.compute.list_value_length(texts).to_numpy()
        fields = [pa.compute.struct_field(each, c).to_pylist() for c in ("name_norm", "addr_norm")]
        ids, row, term, weight = terms.weights(np.repeat(np.array(ids, object), size), *fields)
        return ids, (term, weight, np.searchsorted(row, np.arange(len(ids) + 1)))

    def best(texts: pa.Table, vocab: pa.Table) -> pa.Table:
        terms, one, other = _terms(vocab), texts.filter(pa.compute.equal(texts["side"], 1)), texts.filter(pa.compute.equal(texts["side"], 2))
        found, cids, flat = tuple(np.zeros(0, t) for t in (np.int64, np.int64, float)), [], np.zeros(0, object)
        keys = np.zeros(0, object)
        if one.num_rows and other.num_rows:
            keys, left = vectors(terms, one["key"].to_pylist(), one["texts"])
            cids = other["cids"].to_pylist()
            order = sorted(range(len(cids)), key=lambda x: cids[x][0])
            cids, other = [cids[x] for x in order], other["texts"].take(pa.array(order))
            for lo in range(0, len(cids), ROWS_S23):
                ids, right = vectors(terms, [x[0] for x in cids[lo : lo + ROWS_S23]], other.slice(lo, ROWS_S23))
                if len(left[0]) and len(right[0]):
                    n, least = np.bincount(found[0], minlength=len(keys)), np.zeros(len(keys))
                    least[n == k] = found[2][np.cumsum(n)[n == k] - 1]
                    row, column, score = _best(len(keys), left, _Right(len(ids), right, len(terms.term)), k, least)
                    row, column, score = (np.concatenate(x) for x in zip(found, (row, column + lo, score)))
                    kept = _first(row, column, score, k)
                    found = row[kept], column[kept], score[kept]
            size, flat = np.array([len(x) for x in cids]), np.array([c for x in cids for c in x], object)
            row, column, score = found
            m = size[column]
            at = ranges((np.cumsum(size) - size)[column], m)  # all ids of the texts found
            place = np.argsort(np.argsort(flat))
            row, score = np.repeat(row, m), np.repeat(score, m)
            kept = _first(row, place[at], score, k)
            found = row[kept], at[kept], score[kept]
        return pa.table([pa.array(keys, pa.binary()).take(pa.array(found[0])), pa.array(flat, pa.string()).take(pa.array(found[1])), pa.array(found[2])], names=["key", "cid", "score"])

    return best


def _keyed(records: DataFrame) -> DataFrame:
    """country_norm, entity_id, texts, key: all texts of an id, and a hash that records of a country share if their texts are equal."""
    pair = F.struct("name_norm", "addr_norm")
    ids = records.groupBy("country_norm", "entity_id").agg(F.array_sort(F.collect_list(pair)).alias("texts"))
    return ids.withColumn("key", F.unhex(F.md5(F.to_json(F.struct("country_norm", "texts")))))


def cosine_candidates(v1: DataFrame, v23: DataFrame, k: int = L.TOP_COSINE) -> DataFrame:
    """cosine_of_records, from vectors. Every vector is shuffled once for each block of the other side."""
    grid = block_grid(v1, v23, ROWS_S1, ROWS_S23, F.count_distinct("entity_id"))
    a = _packed(v1).join(F.broadcast(grid), "country_norm").select("country_norm", "entity_id", "terms", "weights", block_of(F.col("n1")).alias("i"), every_block(F.col("n2")).alias("j"))
    b = _packed(v23).join(F.broadcast(grid), "country_norm").select("country_norm", "entity_id", "terms", "weights", block_of(F.col("n2")).alias("j"), every_block(F.col("n1")).alias("i"))
    a, b = a.toDF(*a.columns), b.toDF(*b.columns)  # both may come from one table
    keys = ["country_norm", "i", "j"]
    a, b = spread(a, *keys), spread(b, *keys)
    found = a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(_block_top(k), "sid string, cid string, score double")
    return top(found, "sid", [F.desc("score"), F.asc("cid")], k, "cos_rank")


def cosine_of_records(s1: DataFrame, s23: DataFrame, vocab: DataFrame, k: int = L.TOP_COSINE) -> DataFrame:
    """sid, cid, score (to 6 digits), cos_rank: the k records of the same country with the greatest cosine above 0; ties by
    cid. Records with equal texts count as one of S1, and of S23 with the first k of their ids, as no list has room for others. Every
    block of S1 texts meets every block of S23 texts of its country in a sparse product that gives back only its best
    k a row, so what is shuffled is each side's texts once for each block of the other, the vocabulary once a product, and k rows a
    product; neither vectors nor other scores ever leave a task. The number of blocks follows the country's size; a block never grows."""
    one, other = _keyed(s1), _keyed(s23)
    a = one.groupBy("country_norm", "key").agg(F.first("texts").alias("texts"))
    first = Window.partitionBy("country_norm", "key").orderBy("entity_id")
    b = other.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k).groupBy("country_norm", "key")
    b = written(b.agg(F.first("texts").alias("texts"), F.array_sort(F.collect_list("entity_id")).alias("cids")), "texts")
    a = written(a.withColumn("cids", F.array().cast("array<string>")), "texts")
    grid = block_grid(a, b, ROWS_S1, ROWS_S23 * TURNS, F.sum(F.greatest(F.size("cids"), F.lit(1))))
    texts = lambda s, side: s.withColumn("side", F.lit(side)).join(F.broadcast(grid), "country_norm")
    a = texts(a, 1).withColumn("i", block_of(F.col("n1"), "key")).withColumn("j", every_block(F.col("n2")))
    b = texts(b, 2).withColumn("j", block_of(F.col("n2"), "key")).withColumn("i", every_block(F.col("n1")))
    words = _vocabulary_rows(vocab).join(F.broadcast(grid), "country_norm").withColumn("i", every_block(F.col("n1"))).withColumn("j", every_block(F.col("n2"))).drop("n1", "n2")
    words = words.toDF(*words.columns)  # the vocabulary may be of the same records
    keys = ["country_norm", "i", "j"]
    both, words = spread(a.unionByName(b).drop("n1", "n2"), *keys), spread(words, *keys)
    found = both.groupBy(*keys).cogroup(words.groupBy(*keys)).applyInArrow(_cell_top(k), "key binary, cid string, score double")
    best = [F.desc("score"), F.asc("cid")]
    members = one.select("key", F.col("entity_id").alias("sid"))
    return top(top(found, "key", best, k, "_r").drop("_r").join(members.toDF(*members.columns), "key").drop("key"), "sid", best, k, "cos_rank")
