"""The pipeline's stages, each against a plain version on its own input, and the registered queries."""

from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from linkwright.llm import quality, queries, tokenbin


def table(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(P.STAGES)
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "token_output"]

    good = P.written(stages["quality_rules"](spark, docs, sf_dir), "t")
    verdict = quality.score_quality(docs, quality.fit_ratio(docs, quality.read_labels(spark, sf_dir)))
    assert good.columns == columns and [i for i, _ in table(good)] == sorted(r.doc_id for r in verdict.filter("kept").collect())
    assert all(not brute.quality_base(t)[5] for _, t in table(good))

    one = P.written(stages["near_duplicates"](spark, good, sf_dir), "t")
    classes = {i: c for i, c, _ in brute.near_duplicates(table(good))}
    assert one.columns == columns and [i for i, _ in table(one)] == sorted(set(classes.values()))

    clean = P.written(stages["decontamination"](spark, one, sf_dir), "t")
    items = [brute.lower_words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seeds = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in items]

    def contaminated(text):
        w = brute.lower_words(text)
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        return any(s & own and np.mean(brute.tiling(i, w)) >= 0.5 for i, s in zip(items, seeds))

    assert clean.columns == columns and [i for i, _ in table(clean)] == [i for i, t in table(one) if not contaminated(t)]

    mixed = P.written(stages["mixing"](spark, clean, sf_dir), "t")
    times = Counter(i for i, _ in table(mixed))
    assert mixed.columns == columns and set(times) == {i for i, _ in table(clean)} and max(times.values()) <= 2
    by = {}
    for r in clean.collect():
        n = len(brute.SPACE_WORD.findall(r.text))
        a, b = by.get(r.source, (0, 0))
        by[r.source] = (a + n, b + n * times[r.doc_id])
    rates = [b / a for a, b in by.values()]
    assert min(rates) == pytest.approx(1, abs=1e-9) and max(rates) < P.REPEAT_LIMIT + 0.6  # a source of few texts overshoots by part of one

    last = stages["token_output"](spark, mixed, sf_dir).collect()
    library = tokenbin.encoder(tokenbin.default_tokenizer()).library
    start = 0
    for r in sorted(last, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    texts = {i: t for i, t in table(clean)}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in last) == Counter((i, *brute.tokens([(i, texts[i])], library)[0][2:]) for i, t in table(mixed))


def test_run_equals_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, sf_dir), "t")
    got = sorted(map(tuple, P.run(spark, sf_dir).collect()))
    assert got == sorted(map(tuple, docs.collect())) and got


def test_stages_on_hard_input(docs_of, spark, sf_dir):
    long = " ".join(f"w{i} x{i % 7}" for i in range(60)) + "."
    for docs in (docs_of([(1, "x")]).limit(0), docs_of([(None, None), (None, long), (3, long), (3, long), (4, long + " y"), (5, "")], clash=True)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() >= 0
            assert name == "token_output" or out.columns == docs.columns


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_their_columns(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    n = spark.read.parquet(f"{sf_dir}/{'pages' if name.startswith('op2') else 'documents'}.parquet").count()
    assert len(rows) == n and df.dtypes[0][1] == "bigint"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_its_sql(spark, sf_dir, name):
    from tests.test_linkage import same

    same(spark, sf_dir, queries.QUERIES[name], queries.ORACLES[name])


def test_held_out_accuracy(spark):
    """On the labelled rows that were not learnt from."""
    import os

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    out = queries.op1_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out")
    r = out.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("acc"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("fp")).first()
    assert r["acc"] > 0.95 and r["fp"] < 0.01
