"""Candidate generation: shared tokens, sparse cosine, and the union of both channels.

The country is part of every key and never a key by itself, so a few large countries don't make a few large tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import tokens as T
from ..functions.text import normalize_address, normalize_country, normalize_name
from ..sources.storage import spread, written

#: A country of fewer than SPREAD pairs of blocks has its S1 records split into smaller blocks, of at least ROWS_LEAST, so that it isn't the
#: work of one task. Each block of S1 takes a copy of all S23 records of its country, so more of them cost disk and the making of vectors.
SPREAD, ROWS_LEAST = 8, 2048
#: Records of a block of the token channel, and pairs of records with a common token that a task holds at once.
ROWS_TOKENS, SHARED_ROWS = 262_144, 1 << 21


def normalized(records: DataFrame, *keep: str) -> DataFrame:
    """entity_id, name_norm, addr_norm, country_norm."""
    fields = [normalize_name(F.col("business_name")).alias("name_norm"), normalize_address(F.col("business_address")).alias("addr_norm")]
    return records.select("entity_id", *keep, *fields, normalize_country(F.col("country")).alias("country_norm"))


def one_per_id(records: DataFrame, position: str = "row_pos") -> DataFrame:
    """Of records with equal ids, the last one by position."""
    others = [c for c in records.columns if c not in ("entity_id", position)]
    return records.groupBy("entity_id").agg(F.max_by(F.struct(*others), position).alias("_r")).select("entity_id", "_r.*")


def country_partitions(s1: DataFrame, s23: DataFrame) -> DataFrame:
    """Every country with its numbers of records, those that one side lacks included."""
    both = s1.select("country_norm", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(s23.select("country_norm", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.groupBy("country_norm").agg(F.sum("a").alias("n_s1"), F.sum("b").alias("n_s23")).orderBy("country_norm")


def token_rows(records: DataFrame) -> DataFrame:
    """country_norm, token, entity_id: the distinct significant tokens of each record."""
    return records.select("country_norm", "entity_id", F.explode(T.significant_tokens(F.col("name_norm"), F.col("addr_norm"))).alias("token"))


def token_index(s23: DataFrame, min_df: int = L.MIN_DF, max_df: int = L.MAX_DF) -> DataFrame:
    """country_norm, token, cid, df of the tokens that neither too few nor too many records of the country have. The
    upper bound is part of the operator's meaning; it also bounds what a token can be joined to."""
    rows = token_rows(s23)
    df = rows.groupBy("country_norm", "token").agg(F.count("*").alias("df")).filter(F.col("df").between(min_df, max_df))
    return rows.join(df, ["country_norm", "token"]).select("country_norm", "token", F.col("entity_id").alias("cid"), "df")


def top(rows: DataFrame, key: str, order: list[Column], k: int, rank: str) -> DataFrame:
    """The first k rows of each key, with their rank. Spark cuts to k below the shuffle for this shape of filter."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("long"))


def block_grid(s1: DataFrame, s23: DataFrame, rows1: int, rows23: int, n: Column | None = None) -> DataFrame:
    """country_norm, n1, n2: the numbers of blocks of both sides in a country, by the number n of its records."""
    n = F.count("*") if n is None else n
    n2 = F.ceil(F.col("_n2") / rows23)
    n1 = F.greatest(F.ceil(F.col("_n1") / rows1), F.least(F.ceil(SPREAD / n2), F.ceil(F.col("_n1") / ROWS_LEAST)))
    sizes = s1.groupBy("country_norm").agg(n.alias("_n1")).join(s23.groupBy("country_norm").agg(n.alias("_n2")), "country_norm")
    return sizes.select("country_norm", n1.cast("int").alias("n1"), n2.cast("int").alias("n2"))


def block_of(n: Column, by: str = "entity_id") -> Column:
    return F.pmod(F.xxhash64(by), n).cast("int")


def every_block(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def _shared_top(k: int):
    """sid, cid, n_shared: for every S1 record of a block the k S23 records that share most tokens with it; ties by cid."""

    def tokens(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """The different ids in order, the id's place for each token, and the tokens."""
        lists = [t.split(" ") for t in rows["tokens"].to_pylist()]
        ids, of = np.unique(np.array(rows["entity_id"].to_pylist(), object), return_inverse=True)
        return ids, np.repeat(of, [len(x) for x in lists]), [t for x in lists for t in x]

    def best(rows: pa.Table) -> pa.Table:
        sids, of, own = tokens(rows.filter(pa.compute.equal(rows["side"], 1)))
        cids, row, other = tokens(rows.filter(pa.compute.equal(rows["side"], 2)))
        known: dict[str, int] = {}
        code = np.array([known.setdefault(t, len(known)) for t in other], np.int64)
        row, size = row[np.argsort(code, kind="stable")], np.bincount(code, minlength=len(known))
        first = np.cumsum(size) - size
        at = np.array([known.get(t, -1) for t in own], np.int64)
        order = np.argsort(of, kind="stable")
        order = order[at[order] >= 0]
        of, at = of[order], at[order]
        ends = np.flatnonzero(np.append(np.diff(of) > 0, len(of) > 0)) + 1  # of the tokens of an S1 record
        upto, lo, out = np.cumsum(size[at]), 0, []
        while lo < len(of):
            done = upto[lo - 1] if lo else 0
            hi = ends[max(np.searchsorted(upto[ends - 1], done + SHARED_ROWS, "right") - 1, np.searchsorted(ends, lo, "right"))]
            t, m = at[lo:hi], size[at[lo:hi]]
            where = np.arange(m.sum()) + np.repeat(first[t] - (np.cumsum(m) - m), m)
            pair, n = np.unique(np.repeat(of[lo:hi], m) * len(cids) + row[where], return_counts=True)
            s, c = np.divmod(pair, len(cids))
            order = np.lexsort((-n, s))  # ties by cid, since it is stable
            s, c, n = s[order], c[order], n[order]
            out.append([x[np.arange(len(s)) - np.searchsorted(s, s) < k] for x in (s, c, n)])
            lo = hi
        s, c, n = (np.concatenate(x) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(sids, pa.string()).take(pa.array(s)), pa.array(cids, pa.string()).take(pa.array(c)), pa.array(n)], names=["sid", "cid", "n_shared"])

    return best


def token_candidates(s1: DataFrame, s23: DataFrame, k: int = L.TOP_TOKENS) -> DataFrame:
    """sid, cid, n_shared, tok_rank: the k records of the same country that share most indexed tokens; ties by cid. Blocks of both sides
    meet in a task with their tokens, so that pairs which share one, of which there are far more than results, never leave it."""
    own = T.significant_tokens(F.col("name_norm"), F.col("addr_norm"))
    grid = block_grid(s1, s23, ROWS_TOKENS, ROWS_TOKENS)
    a = s1.select("country_norm", "entity_id", F.array_join(own, " ").alias("tokens"), F.lit(1).alias("side"))
    b = token_index(s23).groupBy("country_norm", F.col("cid").alias("entity_id")).agg(F.array_join(F.collect_list("token"), " ").alias("tokens")).withColumn("side", F.lit(2))
    a = a.join(F.broadcast(grid), "country_norm").withColumn("i", block_of(F.col("n1"))).withColumn("j", every_block(F.col("n2")))
    b = b.join(F.broadcast(grid), "country_norm").withColumn("j", block_of(F.col("n2"))).withColumn("i", every_block(F.col("n1")))
    keys = ["country_norm", "i", "j"]
    found = spread(a.unionByName(b).drop("n1", "n2"), *keys).groupBy(*keys).applyInArrow(_shared_top(k), "sid string, cid string, n_shared long")
    return top(found, "sid", [F.desc("n_shared"), F.asc("cid")], k, "tok_rank")


def candidate_union(cosine: DataFrame, tokens: DataFrame) -> DataFrame:
    """sid, cid, rank, cos_rank, tok_rank: the cosine channel in its order, then what only the token channel found. Both are dealt by sid
    once, which serves the pairs and the ranks."""
    none = F.lit(None).cast("long")
    rows = cosine.select("sid", "cid", "cos_rank", none.alias("tok_rank")).unionByName(tokens.select("sid", "cid", none.alias("cos_rank"), "tok_rank"))
    both = spread(rows, "sid").groupBy("sid", "cid").agg(F.max("cos_rank").alias("cos_rank"), F.max("tok_rank").alias("tok_rank"))
    order = Window.partitionBy("sid").orderBy(F.asc_nulls_last("cos_rank"), F.asc_nulls_last("tok_rank"), "cid")
    return both.withColumn("rank", F.row_number().over(order).cast("long"))


def candidates_per_entity(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every S1 record with its number of candidates, 0 included."""
    n = candidates.groupBy("sid").agg(F.count("*").alias("n_candidates"))
    return s1.select(F.col("entity_id").alias("sid")).join(n, "sid", "left").select("sid", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))


def existing(candidates: DataFrame, s23: DataFrame) -> DataFrame:
    """Candidates whose record exists."""
    return candidates.join(s23.select(F.col("entity_id").alias("cid")), "cid", "left_semi")


def _common_texts(s1: DataFrame, s23: DataFrame) -> DataFrame:
    """entity_id, text of both sides' records, once a row: the least id of those with the same name and address, neither empty, if both
    sides have some, else null. Two records of different sides agree if it is equal."""
    both = s1.select("entity_id", "name_norm", "addr_norm", F.lit(1).alias("side")).unionByName(s23.select("entity_id", "name_norm", "addr_norm", F.lit(2).alias("side")))
    groups = both.filter("name_norm <> '' and addr_norm <> ''").groupBy("name_norm", "addr_norm")
    common = groups.agg(F.min("entity_id").alias("text"), F.min("side").alias("_a"), F.max("side").alias("_b")).filter("_a <> _b").drop("_a", "_b")
    return both.join(common, ["name_norm", "addr_norm"], "left").select("entity_id", "side", "text")


def with_exact(candidates: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """Candidates with is_exact: equal names and equal addresses, neither empty. Pairs are shuffled with what stands for the texts that both
    sides have, which most records lack, instead of the texts."""
    texts = written(_common_texts(s1, s23), "exact")
    a = texts.filter("side = 1").select(F.col("entity_id").alias("sid"), F.col("text").alias("_t1"))
    b = texts.filter("side = 2").select(F.col("entity_id").alias("cid"), F.col("text").alias("_t2"))
    return candidates.join(a, "sid").join(b, "cid").withColumn("is_exact", F.coalesce(F.col("_t1") == F.col("_t2"), F.lit(False))).drop("_t1", "_t2")
