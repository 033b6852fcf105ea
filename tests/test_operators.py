"""Blocking, assignment, metrics, sampling and sources on small cases and against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkwright.functions import features as X
from linkwright.functions import lexicon as L
from linkwright.operators import blocking as B
from linkwright.operators import metrics, model, pairs, resolve, vectors
from linkwright.plans import linkage
from linkwright.plans.records import Records
from linkwright.sources import tsv


def records(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, name_norm string, addr_norm string, country_norm string")


def test_token_candidates_by_brute_force(spark, sf_dir):
    r = Records(spark, sf_dir)
    from linkwright.functions import tokens as T

    sets = {x["entity_id"]: (x["country_norm"], set(x["t"])) for x in r.all.select("entity_id", "country_norm", T.significant_tokens(F.col("name_norm"), F.col("addr_norm")).alias("t")).collect()}
    df = Counter((c, t) for i, (c, s) in sets.items() if not i.startswith("S1-") for t in s)
    want = set()
    for i, (c, s) in sets.items():
        if i.startswith("S1-"):
            n = {j: len([t for t in s & u if 2 <= df[c, t] <= 1000]) for j, (d, u) in sets.items() if d == c and not j.startswith("S1-")}
            ranked = sorted((j for j in n if n[j]), key=lambda j: (-n[j], j))[:40]
            want |= {(i, j, n[j], k + 1) for k, j in enumerate(ranked)}
    assert {tuple(x) for x in B.token_candidates(r.s1, r.s23).select("sid", "cid", "n_shared", "tok_rank").collect()} == want


def test_cosine_blocks_equal_the_join(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS_S1", 20)
    monkeypatch.setattr(vectors, "ROWS_S23", 30)
    r = Records(spark, sf_dir)
    vocab = vectors.vocabulary(vectors.fit_rows(r.all))
    v1, v23 = vectors.record_vectors(r.s1, vocab), vectors.record_vectors(r.s23, vocab)
    got = {(x["sid"], x["cid"]): x["score"] for x in vectors.cosine_candidates(v1, v23, 10).collect()}
    joined = vectors.cosine_pairs_by_join(v1, v23).withColumn("score", F.round("score", 6)).filter("score > 0")
    want = {(x["sid"], x["cid"]): x["score"] for x in B.top(joined, "sid", [F.desc("score"), F.asc("cid")], 10, "k").collect()}
    assert got == pytest.approx(want) and len(got) > 100
    assert all(v <= 1 + 1e-9 for v in got.values())


@pytest.mark.parametrize("cells, share, scores", [(1 << 24, 64, 1 << 20), (1 << 24, 4, 100), (0, 4, 1), (1 << 24, 0, 1 << 20)])
def test_block_product_by_definition(monkeypatch, cells, share, scores):
    """Dense and sparse terms, a row or many at a time, ties cut by id, rows that share nothing."""
    for name, value in (("DENSE_CELLS", cells), ("DENSE_SHARE", share), ("SCORE_CELLS", scores)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(3)

    def block(prefix, n):
        terms = [rng.choice(40, rng.integers(1, 8), False, 1 / np.arange(1, 41) / np.sum(1 / np.arange(1, 41))) for _ in range(n)]
        terms[1] = terms[0]
        return pd.DataFrame({"entity_id": [f"{prefix}{i:03d}" for i in rng.permutation(n)], "terms": terms, "weights": [np.full(len(t), 0.25) for t in terms]})

    left, right = block("a", 30), block("b", 50)
    left.loc[len(left)] = ["a999", np.array([77]), np.array([1.0])]
    got = vectors._block_top(7)(left, right)
    want = set()
    for a in left.itertuples():
        score = {b.entity_id: len(set(a.terms) & set(b.terms)) / 16 for b in right.itertuples()}
        want |= {(a.entity_id, c, score[c]) for c in sorted((c for c in score if score[c]), key=lambda c: (-score[c], c))[:7]}
    assert {tuple(r) for r in got.itertuples(index=False)} == want and len(got) == len(want)
    assert vectors._block_top(7)(left[:0], right).empty and vectors._block_top(7)(left, right[:0]).empty


def test_candidates_stay_in_their_country(spark):
    s1 = records(spark, [("S1-1", "acme steel", "", "in"), ("S1-2", "", "", "fr")])
    s23 = records(spark, [("S2-1", "acme steel", "", "in"), ("S2-2", "acme steel", "", "fr"), ("S3-1", "acme steel", "", "in")])
    got = B.token_candidates(s1, s23)
    assert [(r.sid, r.cid) for r in got.orderBy("cid").collect()] == [("S1-1", "S2-1"), ("S1-1", "S3-1")]
    assert {r.sid: r.n_candidates for r in B.candidates_per_entity(s1, got).collect()} == {"S1-1": 2, "S1-2": 0}
    exact = B.with_exact(got, s1, s23)
    assert exact.filter("is_exact").count() == 0  # addresses are empty


def test_union_keeps_the_cosine_order(spark):
    cos = spark.createDataFrame([("s", "c", 1), ("s", "a", 2)], "sid string, cid string, cos_rank int")
    tok = spark.createDataFrame([("s", "a", 1), ("s", "b", 2)], "sid string, cid string, tok_rank int")
    assert [r.cid for r in B.candidate_union(cos, tok).orderBy("rank").collect()] == ["c", "a", "b"]


def test_resolver(spark):
    rows = [("s1", "c1", 0.9, 1), ("s2", "c1", 0.8, 2), ("s2", "c2", 0.7, 2), ("s1", "c2", 0.7, 1), ("s3", "c3", 0.4, 3)]
    scored = spark.createDataFrame([(*r[:3], False, r[3]) for r in rows] + [("s3", "c4", 1.0, True, 3), ("s1", "c4", 1.0, False, 1)], "sid string, cid string, p double, is_exact boolean, s1_pos int")
    got = {r.cid: r.sid for r in resolve.resolve(scored, 0.5).collect()}
    assert got == {"c1": "s1", "c2": "s1", "c4": "s3"}
    assert {r.cid for r in resolve.resolve(scored, 0.8).collect()} <= set(got)


def test_lists(spark):
    s1 = spark.createDataFrame([("S1-1", 1), ("S1-2", 2)], "entity_id string, row_pos int")
    got = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-9"), ("S1-1", "S1-7")], "sid string, cid string")
    assert [r.matched_entity_ids for r in resolve.matching_lists(s1, got).orderBy("row_pos").collect()] == ["S2-9,S3-1", ""]
    cands = spark.createDataFrame([("S1-1", "S3-1", 2), ("S1-1", "S2-4", 1)], "sid string, cid string, rank int")
    assert [r.candidate_entity_ids for r in resolve.candidate_lists(s1, cands, got.filter("cid <> 'S1-7'")).orderBy("row_pos").collect()] == ["S2-4,S3-1,S2-9", ""]


def test_f05(spark):
    pair = lambda *rows: spark.createDataFrame(list(rows), "sid string, cid string")
    entities = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "sid string")
    truth, predicted = pair(("x", "a"), ("x", "c"), ("z", "a")), pair(("x", "a"), ("x", "b"), ("x", "c"), ("w", "q"))
    got = {r.sid: r.f05 for r in metrics.f05_per_entity(entities, truth, predicted).collect()}
    assert got == pytest.approx({"x": 0.714286, "y": 1.0, "z": 0.0, "w": 0.0}, abs=1e-6)
    assert metrics.f05_macro(metrics.f05_per_entity(entities.limit(0), truth, predicted)).first()["f05_macro"] == 0
    recall = metrics.blocking_recall(truth, predicted).first()
    assert (recall["n_truth"], recall["n_found"]) == (3, 2)
    assert metrics.blocking_recall(truth.limit(0), predicted).first()["recall"] == 1


def test_sweep_equals_resolving_at_each_threshold(spark):
    entities = spark.createDataFrame([("x",), ("y",)], "sid string")
    truth = spark.createDataFrame([("x", "a"), ("y", "b")], "sid string, cid string")
    assigned = spark.createDataFrame([("x", "a", 0.7), ("x", "c", 0.62), ("y", "b", 0.9)], "sid string, cid string, p double")
    grid = [0.6, 0.65, 0.8]
    got = {r.threshold: r.f05_macro for r in metrics.sweep(entities, truth, assigned, grid).collect()}
    for t in grid:
        want = metrics.f05_macro(metrics.f05_per_entity(entities, truth, assigned.filter(F.col("p") >= t))).first()["f05_macro"]
        assert got[t] == pytest.approx(want)
    assert metrics.tune_threshold(entities, truth, assigned)[0] == pytest.approx(0.64)
    assert len(metrics.coarse_grid()) == 19 and metrics.fine_grid(0.96)[-1] == 0.985


def test_sampling(spark):
    lab = spark.createDataFrame([("p", f"c{i}", int(i == 0)) for i in range(20)] + [("q", f"d{i}", 0) for i in range(5)], "sid string, cid string, label int")
    out = pairs.hard_negatives(lab)
    n = {(r.sid, r.label): r["count"] for r in out.groupBy("sid", "label").count().collect()}
    assert n == {("p", 1): 1, ("p", 0): 5, ("q", 0): 1}
    assert pairs.pair_budget(out, 1, 4).count() == 4
    truth = spark.createDataFrame([(f"s{i}", "c") for i in range(101)], "sid string, cid string")
    assert pairs.entity_split(truth).filter("is_validation").count() == math.floor(101 * 0.15)


def test_best_round():
    assert model.best_round([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2
    assert model.best_round([3.0, 2.0, 2.5, 1.0, 1.0], patience=3) == 4
    assert model.best_round([1.0]) == 1


def test_rounds_after_the_best_are_cut_off(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"s{i}", f"c{i}", int(i % 4 == 0) ^ int(rng.random() < 0.2), *[rng.random() + (i % 4 == 0) * (k < 3) * 0.4 for k in range(len(L.FEATURES))]) for i in range(400)]
    schema = "sid string, cid string, label int, " + ", ".join(f"{f} float" for f in L.FEATURES)
    fit, held = spark.createDataFrame(rows[:300], schema), spark.createDataFrame(rows[300:], schema)
    small = {"maxIter": 12, "maxDepth": 3, "minInstancesPerNode": 2, "stepSize": 0.5}
    whole, kept = model.train(fit, **small), model.train(fit, held, **small)
    n = kept.getNumTrees
    assert whole.getNumTrees == 12 and 1 <= n < 12
    short = model.train(fit, **(small | {"maxIter": n}))
    p = lambda m: {r.cid: r.p for r in model.predict(m, held).collect()}
    assert p(kept) == pytest.approx(p(short)) and p(kept) != pytest.approx(p(whole))
    model.save(kept, 0.7, 0.9, str(tmp_path))
    again, threshold = model.load(spark, str(tmp_path))
    assert p(again) == pytest.approx(p(kept)) and threshold == 0.7


def test_models_without_bagging_use_all_rows(spark, tmp_path, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    monkeypatch.setattr(GBTClassifier, "_fit", None)  # Spark's own takes split points from some 10,000 rows
    # two rows in 30,000 tell that a feature's value of 0.5 means label 1
    rows = [(f"s{i}", f"c{i}", int(i < 50), *[0.5 if i // 2 == k and i < 50 else 0.0 for k in range(len(L.FEATURES))]) for i in range(30_000)]
    schema = "sid string, cid string, label int, " + ", ".join(f"{f} float" for f in L.FEATURES)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    small = {"maxIter": 4, "maxDepth": 8, "minInstancesPerNode": 1, "featureSubsetStrategy": "1.0", "subsamplingRate": 1.0}
    p = lambda m, t: {r.cid: r.p for r in model.predict(m, t).collect()}
    other = table.repartition(7, "cid")
    a, b = (model.train(t, **small) for t in (table, other))
    assert a.getNumTrees == 4 and a.treeWeights == [1.0, 0.05, 0.05, 0.05]
    got = p(a, table)
    assert got == p(b, table)  # however rows are dealt
    found = sum(got[f"c{i}"] > 0.5 for i in range(50))
    assert found >= 16 and max(got[f"c{i}"] for i in range(50, 30_000)) <= min(got[f"c{i}"] for i in range(50))


def test_models_without_bagging_agree_with_a_slow_definition(spark):
    rng = random.Random(4)
    rows = [(f"s{i}", f"c{i}", int(i % 3 == 0), *[rng.randrange(8) / 8 + (i % 3 == 0) * (k < 4) * 0.25 for k in range(len(L.FEATURES))]) for i in range(300)]
    schema = "sid string, cid string, label int, " + ", ".join(f"{f} float" for f in L.FEATURES)
    table = spark.createDataFrame(rows, schema)
    fitted = model.train(table, maxIter=2, maxDepth=2, minInstancesPerNode=5, featureSubsetStrategy="1.0", stepSize=0.5, subsamplingRate=1.0)
    weight = {1: 2.0, 0: 1.0}  # 200 to 100

    def grow(rows, target, depth):
        w = sum(weight[r[2]] for r in rows)
        mean = sum(weight[r[2]] * target[r[1]] for r in rows) / w
        best = None
        for k in range(len(L.FEATURES)) if depth else ():
            for v in sorted({r[3 + k] for r in rows})[:-1]:
                sides = [[r for r in rows if r[3 + k] <= v], [r for r in rows if r[3 + k] > v]]
                if min(map(len, sides)) >= 5:
                    gain = sum(sum(weight[r[2]] * target[r[1]] for r in s) ** 2 / sum(weight[r[2]] for r in s) for s in sides)
                    if best is None or gain > best[0] + 1e-9:
                        best = gain, sides
        return {r[1]: mean for r in rows} if best is None else {c: v for s in best[1] for c, v in grow(s, target, depth - 1).items()}

    y = {r[1]: 2.0 * r[2] - 1 for r in rows}
    first = grow(rows, y, 2)
    second = grow(rows, {c: 4 * y[c] / (1 + math.exp(2 * y[c] * first[c])) for c in y}, 2)
    got = {r.cid: r.p for r in model.predict(fitted, table).collect()}
    assert got == pytest.approx({c: 1 / (1 + math.exp(-2 * (first[c] + 0.5 * second[c]))) for c in y}, abs=1e-4)


def test_scan(spark, tmp_path):
    head = "\t".join(L.RECORD_COLUMNS)
    lines = [head, 'S2-1\t"A" x\tb, c\tUS', "S2-2\tshort", "S2-3\ta\tb\tc\textra", "", "S2-4\t\t\t", 'S2-5\t"open\tNA\tnull']
    (tmp_path / "s.tsv").write_text("\n".join(lines) + "\n")
    rows = tsv.read_source(spark, str(tmp_path / "s.tsv"))
    assert [tuple(r)[1:] for r in rows.orderBy("row_pos").collect()] == [
        ("S2-1", '"A" x', "b, c", "US"),
        ("S2-2", "short", "", ""),
        ("S2-4", "", "", ""),
        ("S2-5", '"open', "NA", "null"),
    ]


def test_truth_scan_and_last_wins(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1\nS1-2\t\nS1-1\tS2-2,S2-2\n")
    got = {r.sid: r.cids for r in tsv.read_truth(spark, str(tmp_path / "t.tsv")).collect()}
    assert got == {"S1-1": ["S2-2"], "S1-2": []}
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "entity_id string, v string, row_pos int")
    assert [tuple(r) for r in B.one_per_id(rows).collect()] == [("a", "y")]


def test_sinks(spark, tmp_path):
    lists = spark.createDataFrame([(2, "S1-2", ""), (1, "S1-1", 'S2-1,"q')], "row_pos int, source1_entity_id string, matched_entity_ids string")
    tsv.write_lists(lists, L.MATCHING_HEADER, str(tmp_path / "m"), single=True)
    text = (tmp_path / "m").read_text()
    assert text == 'source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,"q\nS1-2\t\n'
    assert {r.entity_id for r in tsv.read_ids(spark, str(tmp_path / "m")).collect()} == {"S1-1", "S1-2"}


def test_vectors_travel_as_texts(spark, sf_dir, monkeypatch):
    """Vectors are made where they are needed: no join or window on n-grams, and in the cosine channel none on vectors."""
    r = Records(spark, sf_dir)
    vocab = spark.createDataFrame(vectors.vocabulary(r.all).collect())
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for made in (vectors.tfidf(r.all, vocab), vectors.record_vectors(r.all, vocab), vectors.cosine_of_records(r.s1, r.s23, vocab)):
        assert "flatten" not in plan(made)
    monkeypatch.setattr(vectors, "ROWS_S23", 7)
    monkeypatch.setattr(vectors, "TURNS", 3)
    monkeypatch.setattr(vectors, "ROWS_S1", 20)
    got = {(x["sid"], x["cid"]): x["score"] for x in vectors.cosine_of_records(r.s1, r.s23, vocab, 10).collect()}
    joined = vectors.cosine_pairs_by_join(vectors.record_vectors(r.s1, vocab), vectors.record_vectors(r.s23, vocab)).withColumn("score", F.round("score", 6)).filter("score > 0")
    want = {(x["sid"], x["cid"]): x["score"] for x in B.top(joined, "sid", [F.desc("score"), F.asc("cid")], 10, "k").collect()}
    assert got == pytest.approx(want) and len(got) > 100


def test_equal_texts_are_multiplied_once(spark, tmp_path, monkeypatch):
    """Copies on both sides, also of an id with two rows: a text enters the product once, with no more ids than a list has room for."""
    names = ["alpha bridge", "alpha bridges", "copper delta", "copper delta two", "delta alpha"]
    s1 = records(spark, [(f"S1-{i}", names[i % 3], "", "x") for i in range(9)] + [("S1-0", "ember", "", "x"), ("S1-9", "ember", "", "y")])
    s23 = records(spark, [(f"S2-{i:02}", names[i % 5], "", "x") for i in range(40)] + [("S2-01", "copper", "", "x"), ("S2-02", "ember", "", "y")])
    vocab = spark.createDataFrame(vectors.vocabulary(s1.unionByName(s23), 1).collect())
    monkeypatch.setattr(vectors, "written", lambda df, name: storage_written(df, name, tmp_path))
    got = [tuple(x) for x in vectors.cosine_of_records(s1, s23, vocab, 3).select("sid", "cid", "cos_rank").collect()]
    joined = vectors.cosine_pairs_by_join(vectors.record_vectors(s1, vocab), vectors.record_vectors(s23, vocab)).withColumn("score", F.round("score", 6)).filter("score > 0")
    assert sorted(got) == sorted(tuple(x) for x in B.top(joined, "sid", [F.desc("score"), F.asc("cid")], 3, "k").select("sid", "cid", "k").collect())
    one, other = sorted((spark.read.parquet(str(x)).collect() for x in tmp_path.iterdir()), key=lambda rows: max(len(x.cids) for x in rows))
    assert len(one) == 5 and len(other) == 7 and max(len(x.cids) for x in other) == 3 and not any(x.cids for x in one)


def storage_written(df, name, folder):
    path = str(folder / f"{name}-{len(list(folder.iterdir()))}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_vectors_of_odd_texts(spark):
    """Empty, short and repeated words, characters outside the vocabulary or beyond ASCII, a country without a vocabulary."""
    fitted = records(spark, [("S1-1", "aa b aa", "", "x"), ("S1-2", "aa b", "é", "x"), ("S1-3", "", "é é", "x")])
    rows = fitted.unionByName(records(spark, [("S1-4", "aac  b", "", "x"), ("S1-5", "", "", "x"), ("S1-6", "aa", "", "y"), ("S1-7", "zz", "qé", "x")]))
    vocab = vectors.vocabulary(fitted)
    terms = {(v["field"], v["term"]): v for v in vocab.collect()}
    want = {}
    for x in vectors.gram_rows(rows).collect():
        v = terms.get((x["field"], x["term"]))
        if v and x["country_norm"] == "x":
            want[x["entity_id"], x["field"], x["term"]] = (1 + math.log(x["tf"])) * (math.log((1 + v["n_docs"]) / (1 + v["df"])) + 1)
    norm = Counter()
    for (i, f, _), w in want.items():
        norm[i, f] += w * w
    got = {(x["entity_id"], x["field"], x["term"]): x["weight"] for x in vectors.tfidf(rows, vocab).collect()}
    assert got == pytest.approx({k: w / math.sqrt(norm[k[:2]]) for k, w in want.items()}) and ("S1-7", "a", "é ") in got


def test_shared_tokens_in_blocks(spark, sf_dir, monkeypatch):
    """The token channel by small blocks, few pairs at a time; pairs that share a token don't leave a task."""
    r = Records(spark, sf_dir)
    found = lambda: {tuple(x) for x in B.token_candidates(r.s1, r.s23, 5).select("sid", "cid", "n_shared", "tok_rank").collect()}
    whole = found()
    monkeypatch.setattr(B, "ROWS_TOKENS", 9)
    monkeypatch.setattr(B, "SHARED_ROWS", 3)
    assert found() == whole and len(whole) > 100
    lone = records(spark, [("S1-1", "zebra", "", "in")])
    assert B.token_candidates(lone, records(spark, [("S2-1", "zebra", "", "in"), ("S2-2", "", "", "in")])).count() == 0  # no token of two records


def test_pairs_are_dealt_without_sets(spark, sf_dir):
    """Sets of S23 records are made after the last shuffle of the pairs."""
    r = Records(spark, sf_dir)
    rows = X.paired(B.token_candidates(r.s1, r.s23).select("sid", "cid"), r.s1, r.s23).select("sid", "cid", "b_name_tokens", "b_addr_grams", "b_numbers")
    last, *dealt = rows._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(dealt) >= 2 and "split(b_name_norm" in last and "split(b_name_norm" not in "".join(dealt)


@pytest.mark.parametrize("columns, scores", [(4096, 1 << 20), (16, 64), (7, 1)])
def test_single_precision_only_chooses(monkeypatch, columns, scores):
    """Scores that differ by less than single precision can tell are ordered in double precision, and pairs below least may go."""
    monkeypatch.setattr(vectors, "COLUMNS", columns)
    monkeypatch.setattr(vectors, "SCORE_CELLS", scores)
    rng = np.random.default_rng(7)

    def block(n):
        x = rng.random((n, 30)) * (rng.random((n, 30)) < 0.6) + 1e-9
        x[1::2] = np.abs(x[::2] + rng.normal(0, 1e-8, x[::2].shape))  # nearly equal neighbours
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        return x, (np.tile(np.arange(30), n), x.ravel(), np.arange(n + 1) * 30)

    (a, left), (b, right) = block(20), block(60)
    exact = np.round(a @ b.T, 6)
    want = [(r, c, exact[r, c]) for r in range(20) for c in np.lexsort((np.arange(60), -exact[r]))[:9]]
    for share in (1, 10**6):
        monkeypatch.setattr(vectors, "DENSE_SHARE", share)
        for least in (None, np.array([want[r * 9 + 8][2] for r in range(20)])):
            got = list(zip(*(x.tolist() for x in vectors._best(20, left, vectors._Right(60, right, 30), 9, least))))
            assert [x[:2] for x in got] == [x[:2] for x in want] and [x[2] for x in got] == pytest.approx([x[2] for x in want])


def test_vocabulary_counts_in_the_task_that_makes_ngrams(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS_VECTORS", 3)
    texts = ["", None, "a", "aa  aa", " b\u00e9b \U0001f600\U0001f600", "abcde abcde", "x" * 70, "aa aa"]
    rows = records(spark, [(f"S1-{i}", t, texts[-i], "in" if i % 3 else "us") for i, t in enumerate(texts)] + [("S1-5", "abcde again", "aa", "in")])
    found = vectors.vocabulary(rows, 1)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    want = vectors.gram_rows(rows).groupBy("country_norm", "field", "term").agg(F.count("*").alias("df"))
    assert {(x.country_norm, x.field, x.term, x.df) for x in found.collect()} == {tuple(x) for x in want.collect()}
    tf = {(x.country_norm, x.field, x.term): x.n for x in vectors.gram_rows(rows).groupBy("country_norm", "field", "term").agg(F.sum("tf").alias("n")).collect()}
    first = lambda f: {x.term for x in vectors.vocabulary(rows, 1, 5).filter(f"field = '{f}' and country_norm = 'in'").collect()}
    for f in "na":
        assert first(f) == {t for _, t in sorted((-n, k[2]) for k, n in tf.items() if k[:2] == ("in", f))[:5]}


@pytest.mark.parametrize("head", [1, 120, 256])
def test_name_and_address_from_the_head(spark, tmp_path, monkeypatch, head):
    """Texts whose first characters are mostly white space, or few."""
    from linkwright.plans import records as R

    assert R.HEAD >= 112
    monkeypatch.setattr(R, "HEAD", head)
    texts = [None, "", " " * 300 + "a b" + "\n" * 300 + "c" * 200, "ab " * 85 + " \t" * 90 + "end", "x" * 111, "x" * 111 + "  y", "x" * 112 + "\n\n" + "y" * 300]
    spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for x in R.er_records(spark, str(tmp_path)).collect():
        flat = re.sub(r"\s+", " ", texts[x.row_pos] or "", flags=re.ASCII)
        assert (x.business_name, x.business_address, x.body) == (flat[:48], flat[48:112], flat[112:])


def test_features_of_the_pairs_that_are_not_exact(spark):
    """The model's pairs meet their texts once: no joins before those of their features."""
    s1 = records(spark, [("S1-1", "zebra crossing", "1 main", "in"), ("S1-2", "", "1 main", "in")])
    s23 = records(spark, [("S2-1", "zebra crossing", "1 main", "in"), ("S2-2", "zebra", "1 main", "in"), ("S2-3", "", "1 main", "in")])
    cands = spark.createDataFrame([(s, c) for s in ("S1-1", "S1-2", "S1-9") for c in ("S2-1", "S2-2", "S2-3")], "sid string, cid string")
    got = X.pair_features(cands, s1, s23, where=~X.exact())
    rest = B.with_exact(cands, s1, s23).filter("not is_exact").select("sid", "cid")
    assert {tuple(x) for x in got.collect()} == {tuple(x) for x in X.pair_features(rest, s1, s23).collect()}
    assert {(x.sid, x.cid) for x in got.collect()} == {(s, c) for s in ("S1-1", "S1-2") for c in ("S2-1", "S2-2", "S2-3")} - {("S1-1", "S2-1")}
    joins = lambda df: len(re.findall("Join", df._jdf.queryExecution().optimizedPlan().toString()))
    assert joins(got) == joins(X.pair_features(cands, s1, s23)) < joins(X.pair_features(rest, s1, s23))


def test_scores_carry_the_position(spark):
    """Scored pairs aren't shuffled once more for the position of their S1 record."""
    s1 = records(spark, [("S1-1", "zebra crossing", "1 main", "in"), ("S1-2", "zebra", "1 main", "in")]).withColumn("row_pos", F.length("name_norm"))
    s23 = records(spark, [("S2-1", "zebra crossing", "1 main", "in"), ("S2-2", "zebra", "2 main", "in")])
    cands = spark.createDataFrame([(s, c) for s in ("S1-1", "S1-2", "S1-9") for c in ("S2-1", "S2-2")], "sid string, cid string")
    at = {r.entity_id: r.row_pos for r in s1.collect()}
    got = linkage.scored_by_surrogate(cands, s1, s23)
    assert {(r.sid, r.cid, r.s1_pos) for r in got.collect()} == {(s, c, at[s]) for s in ("S1-1", "S1-2") for c in ("S2-1", "S2-2")}
    assert {(r.sid, r.cid) for r in got.filter("is_exact and p = 1").collect()} == {("S1-1", "S2-1")}
    assert len(re.findall("Join", got._jdf.queryExecution().optimizedPlan().toString())) == 2


def test_exact_pairs_travel_without_texts(spark):
    """Pairs are exact by what stands for equal texts: empty fields, texts of one side alone and texts that only look alike when joined aren't."""
    texts = [("a b", "c"), ("a", "b c"), ("a b", ""), ("", "c"), ("", ""), ("only one", "x"), ("same", "y"), ("same", "y")]
    s1 = records(spark, [(f"S1-{i}", n, a, "in") for i, (n, a) in enumerate(texts)])
    s23 = records(spark, [(f"S{2 + i % 2}-{i}", n, a, "us") for i, (n, a) in enumerate(texts) if n != "only one"] + [("S2-8", "only other", "x", "in"), ("S2-9", "only other", "x", "in")])
    a, b = ({r.entity_id: (r.name_norm, r.addr_norm) for r in x.collect()} for x in (s1, s23))
    cands = spark.createDataFrame([(s, c, 1) for s in [*a, "S1-99"] for c in [*b, "S2-99"]], "sid string, cid string, rank int")
    got = B.with_exact(cands, s1, s23)
    assert {(r.sid, r.cid): r.is_exact for r in got.collect()} == {(s, c): a[s] == b[c] and "" not in a[s] for s in a for c in b}
    assert got.columns == ["cid", "sid", "rank", "is_exact"] and "_norm" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_of_a_country_are_few(spark):
    """Every block of S1 takes a copy of the other side: a country has no more blocks than its work needs."""
    side = lambda n: spark.range(n).select(F.lit("x").alias("country_norm"))
    grid = lambda a, b: tuple(B.block_grid(side(a), side(b), 32_768, 131_072).select("n1", "n2").first())
    assert grid(60_000, 120_000) == (8, 1) and grid(600_000, 400_000) == (19, 4) and grid(3000, 9000) == (2, 1)
