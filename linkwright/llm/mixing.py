"""Mixing sources to target weights by temperature, in DataFrame functions alone.

Token shares p of the sources are raised to an exponent a in 0..1 and normalised to weights. The exponent is
bisected until the weights' entropy meets a target between that of the shares (a = 1) and that of equal weights
(a = 0), or until the most repeated source is read at most so many times as the least repeated one. A round
evaluates the 31 exponents that five bisections can ask for in one aggregation over the sources, of which
there may be any number.

The weights are then realised. Each source's rows stand in a permutation, by md5 of seed and id, which is cut into
blocks of about BLOCK_ROWS rows by leading bits; tokens are summed by block before any row is placed, so that a
hot source is spread over as many tasks as it has blocks. A row whose place (the tokens of its source before it) is
below the source's quota is taken, and again for each further round of the permutation that reaches it: n_copies
times in all.

A text's tokens are its white-space words, at least one. Defined cases: null texts count one token; a null source is
a source of its own; rows equal in doc_id, source and text have places in no fixed order among
themselves; a single source gets weight 1 and is read as its quota says; an empty table gives an empty one; mixed_rows
passes columns of any name on (they travel in one struct), mixture ignores other columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import written

ROUNDS = 8
BLOCK_ROWS = 500
MAX_BLOCK_BITS = 20
MAX_BROADCAST_SOURCES = 10_000
SEED = "mix"
_KEY = "_source"


def n_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def _bisected(sources: DataFrame, measure, meets) -> float:
    """The exponent of 0..1, to 9 digits, up to which measure(a), an aggregate over the sources, meets the condition."""
    lo, hi = 0.0, 1.0
    if meets(sources.agg(measure(1.0).alias("m")).first()["m"]):
        return 1.0
    for _ in range(ROUNDS):
        tries = [lo + (hi - lo) * i / 32 for i in range(1, 32)]
        got = sources.agg(*[measure(a).alias(f"m{i}") for i, a in enumerate(tries)]).first()
        a, b = -1, 31  # tries[a] meets the condition, tries[b] does not
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if meets(got[mid]) else (a, mid)
        lo, hi = (tries[a] if a >= 0 else lo), (tries[b] if b < 31 else hi)
    return round(lo, 9)


def entropy(a: float, share: Column) -> Column:
    power = F.pow(share, F.lit(a))
    return F.log(F.sum(power)) - F.sum(power * F.log(power)) / F.sum(power)


def source_weights(sources: DataFrame, entropy_share: float | None = None, repeat_limit: float | None = None) -> DataFrame:
    """source columns with _alpha, _weight and _quota (tokens to read); sources has _n_source (tokens), a row for
    each source. One of the two modes:

    entropy_share: the entropy lies so far between that of the shares (0) and that of equal weights (1); all quotas
    together are all tokens.
    repeat_limit: the least repeated source is read once in full, the most repeated one at most so many times."""
    total, n, most = sources.agg(F.sum("_n_source"), F.count("*"), F.max("_n_source")).first()
    if not n:
        return sources.withColumns({"_alpha": F.lit(1.0), "_weight": F.lit(1.0), "_quota": F.lit(0).cast("long")})
    share = F.col("_n_source") / F.lit(total)
    if entropy_share is not None:
        own = sources.agg(entropy(1.0, share).alias("m")).first()["m"]
        target = own + entropy_share * (math.log(n) - own)
        alpha = _bisected(sources, lambda a: entropy(a, share), lambda m: m >= target - 1e-12)
        budget = float(total)
    else:
        # repeats go with share ** (a - 1), so their spread falls with a: bisect 1 - a
        alpha = round(1 - _bisected(sources, lambda b: F.pow(F.max(share) / F.min(share), F.lit(b)), lambda m: m <= repeat_limit), 9)
        budget = None
    z = sources.agg(F.sum(F.pow(share, F.lit(alpha))).alias("z")).first()["z"]
    if budget is None:
        budget = total * z * (most / total) ** (1 - alpha)
    weight = F.round(F.pow(share, F.lit(alpha)) / F.lit(z), 9)
    quota = F.round(weight * F.lit(budget)).cast("long")
    if repeat_limit is not None:
        quota = F.greatest(quota, F.col("_n_source"))
    return sources.withColumns({"_alpha": F.lit(alpha), "_weight": weight, "_quota": quota})


def place(rows: DataFrame, entropy_share: float | None = None, repeat_limit: float | None = None) -> DataFrame:
    """rows with _alpha, _weight, _quota, _place and _n_copies; rows has doc_id, source, _n_tokens and _tie."""
    rows = rows.withColumns({_KEY: F.coalesce(F.concat(F.lit("="), "source"), F.lit("")), "_order": F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string")))})
    sources = rows.groupBy(_KEY).agg(F.sum("_n_tokens").alias("_n_source"), F.count("*").alias("_n_rows"))
    sources = written(sources, "mix-sources")
    bits = F.least(F.lit(MAX_BLOCK_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n_rows") / BLOCK_ROWS)))).cast("int")
    weights = source_weights(sources.withColumn("_bits", bits).drop("_n_rows"), entropy_share, repeat_limit)
    weights = F.broadcast(weights) if sources.count() <= MAX_BROADCAST_SOURCES else weights
    leading = F.conv(F.substring("_order", 1, 5), 16, 10).cast("long")
    rows = rows.join(weights, _KEY).withColumn("_block", F.floor(leading / F.pow(F.lit(2.0), F.lit(MAX_BLOCK_BITS) - F.col("_bits"))).cast("long"))
    blocks = written(rows.groupBy(_KEY, "_block").agg(F.sum("_n_tokens").alias("_n_block")), "mix-blocks")
    before = Window.partitionBy(_KEY).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(_KEY, "_block", F.coalesce(F.sum("_n_block").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(_KEY, "_block").orderBy("_order", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_within", F.coalesce(F.sum("_n_tokens").over(within), F.lit(0))).join(blocks, [_KEY, "_block"])
    rows = rows.withColumn("_place", F.col("_before") + F.col("_within"))
    copies = F.expr("CASE WHEN _quota > _place THEN (_quota - _place + _n_source - 1) div _n_source ELSE 0L END")
    return rows.withColumn("_n_copies", copies)


def mixture(documents: DataFrame, entropy_share: float) -> DataFrame:
    """doc_id, source, n_tokens, alpha, weight, quota, place and n_copies of every row."""
    rows = documents.select("doc_id", "source", n_tokens(F.col("text")).alias("_n_tokens"), F.xxhash64("text").alias("_tie"))
    out = place(written(rows, "mix-rows"), entropy_share=entropy_share)
    return out.select("doc_id", "source", *[F.col(f"_{c}").alias(c) for c in ("n_tokens", "alpha", "weight", "quota", "place", "n_copies")])


def mixed_rows(documents: DataFrame, repeat_limit: float) -> DataFrame:
    """The rows of documents, all columns, each as often as the mixture reads it."""
    own = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_own")
    rows = documents.select("doc_id", "source", n_tokens(F.col("text")).alias("_n_tokens"), F.xxhash64("text").alias("_tie"), own)
    out = place(rows, repeat_limit=repeat_limit).filter("_n_copies > 0")
    return out.select(F.explode(F.sequence(F.lit(1).cast("long"), "_n_copies")), "_own").select("_own.*")
