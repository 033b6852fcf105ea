"""Recall of blocking, macro F0.5, and the search for a threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L


def blocking_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """n_truth, n_found, recall over the true pairs; 1 without any."""
    hit = candidates.select("sid", "cid", F.lit(1).alias("_hit")).distinct()
    rows = truth.select("sid", "cid").join(hit, ["sid", "cid"], "left")
    return rows.agg(F.count("*").alias("n_truth"), F.count("_hit").alias("n_found")).withColumn("recall", F.when(F.col("n_truth") == 0, 1.0).otherwise(F.col("n_found") / F.col("n_truth")))


def f05(n_true: Column, n_pred: Column, n_hit: Column) -> Column:
    """1 if both sides are empty, 0 if one is or nothing is hit, else F0.5."""
    p, r = n_hit / n_pred, n_hit / n_true
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when((n_true == 0) | (n_pred == 0) | (n_hit == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def f05_per_entity(entities: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """sid, n_true, n_pred, n_hit, f05 of every entity in entities (sid)."""
    both = truth.select("sid", "cid", F.lit(1).alias("t")).join(predicted.select("sid", "cid", F.lit(1).alias("q")), ["sid", "cid"], "full_outer")
    counts = both.groupBy("sid").agg(F.count("t").alias("n_true"), F.count("q").alias("n_pred"), F.count(F.col("t") + F.col("q")).alias("n_hit"))
    rows = entities.select("sid").join(counts, "sid", "left").na.fill(0)
    return rows.withColumn("f05", f05(F.col("n_true"), F.col("n_pred"), F.col("n_hit")))


def f05_macro(per_entity: DataFrame) -> DataFrame:
    return per_entity.agg(F.count("*").alias("n_entities"), F.coalesce(F.avg("f05"), F.lit(0.0)).alias("f05_macro"))


def coarse_grid() -> list[float]:
    return [round(0.60 + 0.02 * i, 3) for i in range(19)]


def fine_grid(best: float) -> list[float]:
    return [t for i in range(-8, 9) if 0.50 <= (t := round(best + 0.005 * i, 3)) < 0.99]


def sweep(entities: DataFrame, truth: DataFrame, assigned: DataFrame, grid: list[float]) -> DataFrame:
    """threshold, f05_macro for every threshold of the grid, from one assignment (sid, cid, p): above any threshold it is
    what resolving at that threshold gives. Every entity is one row with a number of pairs and of hits for each threshold."""
    grid = sorted(grid)
    pairs = assigned.join(truth.select("sid", "cid", F.lit(True).alias("t")), ["sid", "cid"], "left")
    passed = [F.count_if(F.col("p") >= F.lit(t)).alias(f"n{i}") for i, t in enumerate(grid)]
    hit = [F.count_if((F.col("p") >= F.lit(t)) & F.coalesce("t", F.lit(False))).alias(f"h{i}") for i, t in enumerate(grid)]
    true = truth.groupBy("sid").agg(F.count("*").alias("n_true"))
    rows = entities.select("sid").join(true, "sid", "left").join(pairs.groupBy("sid").agg(*passed, *hit), "sid", "left").na.fill(0)
    means = [F.coalesce(F.avg(f05(F.col("n_true"), F.col(f"n{i}"), F.col(f"h{i}"))), F.lit(0.0)) for i in range(len(grid))]
    swept = rows.agg(F.array(*[F.struct(F.lit(t).alias("threshold"), m.alias("f05_macro")) for t, m in zip(grid, means)]).alias("s"))
    return swept.select(F.inline("s"))


def best_of(swept: DataFrame) -> tuple[float, float]:
    """The first threshold of the greatest value (compared to 12 digits), and the value; the default one if all are 0."""
    row = swept.orderBy(F.desc(F.round("f05_macro", 12)), "threshold").first()
    return (row["threshold"], row["f05_macro"]) if row and row["f05_macro"] > 0 else (L.DEFAULT_THRESHOLD, 0.0)


def tune_threshold(entities: DataFrame, truth: DataFrame, assigned: DataFrame) -> tuple[float, float]:
    """Coarse grid, then a fine one around its best; a later value must be strictly better."""
    coarse = best_of(sweep(entities, truth, assigned, coarse_grid()))
    fine = best_of(sweep(entities, truth, assigned, fine_grid(coarse[0])))
    return fine if round(fine[1], 12) > round(coarse[1], 12) else coarse


def class_balance(labelled: DataFrame) -> DataFrame:
    pos, neg = F.col("n_positive"), F.col("n_negative")
    counts = labelled.agg(F.count_if(F.col("label") == 1).alias("n_positive"), F.count_if(F.col("label") == 0).alias("n_negative"))
    return counts.withColumn("positive_weight", F.greatest(F.lit(0.1), neg / F.greatest(pos, F.lit(1))))


def match_summary(matching: DataFrame) -> DataFrame:
    """Rows, those with and without a match, and matched ids, of the result lists."""
    some = F.col("matched_entity_ids") != ""
    n = F.when(some, F.size(F.split("matched_entity_ids", ","))).otherwise(0)
    return matching.agg(F.count("*").alias("n_entities"), F.count_if(some).alias("n_matched"), F.count_if(~some).alias("n_singletons"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n_matches"))
