"""Linkage from records to result lists: the train and test modes, and the run with the surrogate score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions import lexicon as L
from ..operators import blocking as B
from ..operators import metrics, model, pairs, resolve, vectors
from ..sources import tsv
from ..sources.storage import written

#: Of the surrogate score, which spreads lower than a model's.
SURROGATE_THRESHOLD = 0.5


def cosine_channel(s1: DataFrame, s23: DataFrame, fit_rows: int | None = L.FIT_ROWS) -> DataFrame:
    """sid, cid, score, cos_rank. Vocabularies are fitted on the records of both sides, on about fit_rows of a country if given."""
    vocab = written(vectors.vocabulary(vectors.fit_rows(s1.unionByName(s23), fit_rows)), "vocabulary")
    return vectors.cosine_of_records(s1, s23, vocab)


def block(s1: DataFrame, s23: DataFrame, fit_rows: int | None = L.FIT_ROWS) -> DataFrame:
    """Both channels: sid, cid, rank, cos_rank, tok_rank."""
    cosine = cosine_channel(s1, s23, fit_rows)
    return written(B.candidate_union(cosine, B.token_candidates(s1, s23)), "candidates")


def scored_by_surrogate(candidates: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """sid, cid, p, is_exact, s1_pos: exact pairs at 1, the others by the surrogate score."""
    rows = X.paired(candidates.select("sid", "cid"), s1, s23, keep=("row_pos",))
    return rows.select("sid", "cid", X.exact().alias("is_exact"), F.when(X.exact(), 1.0).otherwise(X.surrogate_score()).alias("p"), F.col("a_row_pos").alias("s1_pos"))


def scored_by_model(fitted, candidates: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """The same with a model's probability; exact pairs never reach it."""
    rows = B.with_exact(B.existing(candidates.select("sid", "cid"), s23), s1, s23)
    exact = rows.filter("is_exact").select("sid", "cid", F.lit(1.0).alias("p"), F.lit(True).alias("is_exact"))
    rest = model.predict(fitted, X.pair_features(rows.filter("not is_exact").select("sid", "cid"), s1, s23)).withColumn("is_exact", F.lit(False))
    return exact.unionByName(rest).join(s1.select(F.col("entity_id").alias("sid"), F.col("row_pos").alias("s1_pos")), "sid")


@dataclass
class Trained:
    model: object
    threshold: float
    f05: float
    recall: float


def load(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Normalised records of several files; of repeated ids the last one."""
    out = None
    for i, path in enumerate(paths):
        rows = B.one_per_id(tsv.read_source(spark, path).withColumn("row_pos", F.col("row_pos") + (i << 50)).withColumn("_p", F.col("row_pos")), "_p")
        out = rows if out is None else out.unionByName(rows)
    return written(B.normalized(out, "row_pos"), "records")


def sampled_features(candidates: DataFrame, truth: DataFrame, s1: DataFrame, s23: DataFrame, max_positives: int, max_pairs: int) -> DataFrame:
    labelled = pairs.label_pairs(B.existing(candidates.select("sid", "cid"), s23), truth)
    sampled = written(pairs.pair_budget(pairs.hard_negatives(labelled), max_positives, max_pairs), "pairs")
    return written(X.pair_features(sampled, s1, s23, keep=("label",)), "features")


def train(s1: DataFrame, s23: DataFrame, truth: DataFrame, out: str | None = None, **parameters) -> Trained:
    """Split, block, sample, fit, and search the threshold on the held-out entities."""
    split = written(pairs.entity_split(truth), "split")
    sides = {}
    for name, held in (("train", False), ("validation", True)):
        ids = split.filter(F.col("is_validation") == held).select("sid")
        part = s1.join(ids.withColumnRenamed("sid", "entity_id"), "entity_id", "left_semi")
        own = truth.join(ids, "sid", "left_semi")
        cands = block(part, s23)
        scale = (L.MAX_POSITIVES, L.MAX_PAIRS) if not held else (250_000, 600_000)
        sides[name] = (part, own, cands, sampled_features(cands, own, part, s23, *scale))
    fitted = model.train(sides["train"][3], sides["validation"][3], **parameters)
    part, own, cands, features = sides["validation"]
    assigned = written(resolve.best_per_candidate(scored_by_model(fitted, features.select("sid", "cid"), part, s23)), "assigned")
    entities = features.select("sid").distinct()
    threshold, score = metrics.tune_threshold(entities, own.join(entities, "sid", "left_semi"), assigned)
    recall = metrics.blocking_recall(own, cands).first()["recall"]
    if out:
        model.save(fitted, threshold, score, out)
    return Trained(fitted, threshold, score, recall)


def apply(fitted, threshold: float, s1: DataFrame, s23: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The matching and the candidate lists."""
    cands = block(s1, s23)
    assigned = written(resolve.resolve(scored_by_model(fitted, cands, s1, s23), threshold), "assigned")
    return resolve.matching_lists(s1, assigned), resolve.candidate_lists(s1, cands, assigned)


def run(spark: SparkSession, mode: str, data: str, work: str, single: bool = False) -> None:
    """train: fit on data/train_*; test: link data/test_* with the saved model; full: both. Result files are folders of part files in
    order, each with the header, or with single one file each."""
    trained = None
    if mode in ("train", "full"):
        s1 = load(spark, [f"{data}/train_source1.tsv"])
        s23 = load(spark, [f"{data}/train_source2.tsv", f"{data}/train_source3.tsv"])
        truth = tsv.read_truth(spark, f"{data}/train_ground_truth.tsv")
        each = written(truth.select("sid", F.explode("cids").alias("cid")), "truth")
        trained = train(s1, s23, each, f"{work}/model")
        print(f"recall of blocking {trained.recall:.4f}, macro F0.5 {trained.f05:.4f} at {trained.threshold}")
    if mode in ("test", "full"):
        fitted, threshold = (trained.model, trained.threshold) if trained else model.load(spark, f"{work}/model")
        s1 = load(spark, [f"{data}/test_source1.tsv"])
        s23 = load(spark, [f"{data}/test_source2.tsv", f"{data}/test_source3.tsv"])
        matching, cands = apply(fitted, threshold, s1, s23)
        tsv.write_lists(matching, L.MATCHING_HEADER, f"{work}/matching_results.tsv", single)
        tsv.write_lists(cands, L.CANDIDATE_HEADER, f"{work}/candidate_pairs.tsv", single)
        print(matching.transform(metrics.match_summary).first().asDict())
