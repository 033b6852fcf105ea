"""The pairwise similarity vector of 29 values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import spread
from . import lexicon as L
from . import similarity as S
from . import tokens as T

#: What a record carries for its pairs, computed once for each record.
PARTS = ("name_tokens", "addr_tokens", "name_grams", "addr_grams", "numbers")


def parts(name: Column, addr: Column, prefix: str = "") -> dict[str, Column]:
    """The token and n-gram sets of a record."""
    sets = {"name_tokens": T.name_tokens(name), "addr_tokens": T.address_tokens(addr), "name_grams": T.char_ngrams(name), "addr_grams": T.char_ngrams(addr)}
    return {prefix + k: v for k, v in sets.items()}


def with_parts(records: DataFrame) -> DataFrame:
    """Records with their token, n-gram and number sets."""
    return records.withColumns(parts(F.col("name_norm"), F.col("addr_norm"))).withColumn("numbers", T.numbers(F.col("addr_tokens")))


def paired(pairs: DataFrame, s1: DataFrame, s23: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """pairs (sid, cid, ...) with the normalised fields of both records as a_* and b_*, and those of S1 in keep as a_*; pairs of unknown ids go.
    Pairs are shuffled with the texts of their S23 record, whose sets, of many times the bytes, are made afterwards; those of S1 records are
    made once a record."""
    texts = ("name_norm", "addr_norm", "country_norm")
    a = with_parts(s1).select(F.col("entity_id").alias("sid"), *[F.col(c).alias(f"a_{c}") for c in (*texts, *PARTS, *keep)])
    b = s23.select(F.col("entity_id").alias("cid"), *[F.col(c).alias(f"b_{c}") for c in texts])
    rows = spread(spread(pairs, "cid").join(b, "cid"), "sid").join(a, "sid")
    return rows.withColumns(parts(F.col("b_name_norm"), F.col("b_addr_norm"), "b_")).withColumn("b_numbers", T.numbers(F.col("b_addr_tokens")))


def set_features() -> dict[str, Column]:
    """The values that need no edit distance, over the columns of paired()."""
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    out = {"country_match": F.when(a("country_norm") == b("country_norm"), 1.0).otherwise(0.0)}
    for field, short in (("name", "name"), ("addr", "addr")):
        x, y = a(f"{short}_tokens"), b(f"{short}_tokens")
        out |= {
            f"{field}_jaccard": S.jaccard(x, y),
            f"{field}_contain_1in2": S.containment(x, y),
            f"{field}_contain_2in1": S.containment(y, x),
            f"{field}_ngram_jaccard": S.gram_jaccard(a(f"{short}_norm"), b(f"{short}_norm")),
            f"{field}_len_ratio": S.length_ratio(a(f"{short}_norm"), b(f"{short}_norm")),
            f"{field}_ntokens1": F.size(x).cast("double"),
            f"{field}_ntokens2": F.size(y).cast("double"),
        }
    out["addr_num_jaccard"] = S.jaccard(a("numbers"), b("numbers"))
    out["both_have_nums"] = F.when((F.size(a("numbers")) > 0) & (F.size(b("numbers")) > 0), 1.0).otherwise(0.0)
    return out


def edit_features(pairs: DataFrame) -> DataFrame:
    """pairs with the eight edit ratios."""
    out = pairs.withColumns({"_n": S.edit_ratios(F.col("a_name_norm"), F.col("b_name_norm")), "_a": S.edit_ratios(F.col("a_addr_norm"), F.col("b_addr_norm"))})
    return out.withColumns({f"{field}_{r}": F.col(f"_{field[0]}.{r}") for field in ("name", "addr") for r in S.RATIOS}).drop("_n", "_a")


def combined_features() -> dict[str, Column]:
    """The values made from the edit ratios."""
    mean = lambda f: (F.col(f"{f}_levenshtein") + F.col(f"{f}_token_sort") + F.col(f"{f}_token_set")) / 3
    name, addr = mean("name"), mean("addr")
    return {"name_avg_sim": name, "addr_avg_sim": addr, "name_addr_interaction": name * addr, "min_name_addr": F.least(name, addr)}


def exact() -> Column:
    """Over the columns of paired(): equal names and equal addresses, neither empty."""
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    return (a("name_norm") == b("name_norm")) & (a("addr_norm") == b("addr_norm")) & (a("name_norm") != "") & (a("addr_norm") != "")


def pair_features(pairs: DataFrame, s1: DataFrame, s23: DataFrame, keep: tuple[str | Column, ...] = (), where: Column | None = None) -> DataFrame:
    """sid, cid, the columns in keep and the 29 values as floats; with where only of the pairs that pass it. Both may be over the
    columns of paired(), so that pairs meet their texts once."""
    rows = paired(pairs, s1, s23)
    out = edit_features(rows if where is None else rows.filter(where)).withColumns(combined_features() | set_features())
    return out.select("sid", "cid", *keep, *[F.col(f).cast("float").alias(f) for f in L.FEATURES])


def surrogate_score() -> Column:
    """A score without a model, for runs that must be equal everywhere: the product of the n-gram Jaccard similarities."""
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    return F.round(S.gram_jaccard(a("name_norm"), b("name_norm")) * S.gram_jaccard(a("addr_norm"), b("addr_norm")), 6)
