"""The modes end to end, the stream, and the registered queries against their SQL twins."""

import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from linkwright.operators.validate import validate
from linkwright.plans import catalog, linkage
from linkwright.plans.records import Records, er_records
from linkwright.sources import tsv
from linkwright.streaming import arrivals


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    """Businesses and noisy copies of them."""
    folder, rng = tmp_path_factory.mktemp("er"), random.Random(5)
    words = ["alpha", "bridge", "copper", "delta", "ember", "falcon", "garnet", "harbor", "indigo", "juniper", "krypton", "lagoon", "mosaic", "nimbus", "orchid", "pioneer"]
    for split in ("train", "test"):
        sources, truth = {1: [], 2: [], 3: []}, []
        for i in range(120):
            name = " ".join(rng.sample(words, 3))
            addr = f"{rng.randrange(1, 999)} {rng.choice(words)} road {rng.choice(words)} nagar"
            country = rng.choice(["IN", "US"])
            sources[1].append((f"S1-{i}", name.title() + " Pvt Ltd", addr, country))
            mine = []
            for k in (2, 3):
                if rng.random() < 0.7:
                    noisy = name if rng.random() < 0.5 else name.replace(name.split()[0], name.split()[0][:-1])
                    sources[k].append((f"S{k}-{i}", noisy.upper(), addr.replace("road", "rd"), country))
                    mine.append(f"S{k}-{i}")
            truth.append((f"S1-{i}", ",".join(mine)))
        head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
        for k, rows in sources.items():
            (folder / f"{split}_source{k}.tsv").write_text(head + "".join("\t".join(r) + "\n" for r in rows))
        (folder / f"{split}_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(r) + "\n" for r in truth))
    return str(folder)


def test_full_mode(spark, data, tmp_path, monkeypatch):
    from linkwright.operators import model

    monkeypatch.setattr(model, "PARAMETERS", model.PARAMETERS | {"maxIter": 5, "maxDepth": 4, "minInstancesPerNode": 5})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # for result files of several parts
    linkage.run(spark, "full", data, str(tmp_path))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    matching, cands = f"{tmp_path}/matching_results.tsv", f"{tmp_path}/candidate_pairs.tsv"
    got = {r.sid: set(r.cids) for r in tsv.read_truth(spark, matching).collect()}
    want = {r.sid: set(r.cids) for r in tsv.read_truth(spark, f"{data}/test_ground_truth.tsv").collect()}
    assert set(got) == set(want)
    assert sum(len(got[s] & want[s]) for s in want) > 0.8 * sum(map(len, want.values()))
    every = [c for ids in got.values() for c in ids]
    assert len(every) == len(set(every))  # one S1 record at most for each candidate
    report = validate(spark, matching, cands, data, check_ids=True)  # folders of several files
    assert len([p for p in os.listdir(matching) if p.startswith("part-")]) > 1
    assert report.passed and not report.warnings, report
    linkage.run(spark, "test", data, str(tmp_path))  # with the saved model
    assert {r.sid: set(r.cids) for r in tsv.read_truth(spark, matching).collect()} == got
    linkage.run(spark, "test", data, str(tmp_path), single=True)  # one file each
    lines = open(matching).read().split("\n")
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and lines[-1] == "" and len(lines) == len(got) + 2
    assert [x.split("\t")[0] for x in lines[1:-1]] == [f"S1-{i}" for i in range(120)]
    assert validate(spark, matching, cands, data, check_ids=True).passed


def test_stream(spark, sf_dir, tmp_path):
    r = Records(spark, sf_dir)
    new = er_records(spark, sf_dir).filter("entity_id not like 'S1-%'").select("entity_id", "business_name", "business_address", "country")
    rows = ["\t".join(x.replace("\t", " ") for x in row) for row in new.collect()]
    (tmp_path / "in").mkdir()
    s1 = r.s1.cache()

    def arrive(name, lines):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        writer = arrivals.link_arrivals(arrivals.read_arrivals(spark, str(tmp_path / "in")), s1, str(tmp_path / "out"), str(tmp_path / "check"))
        writer.trigger(availableNow=True).start().awaitTermination()

    arrive("a", rows[: len(rows) // 2])
    half = {x.cid: x for x in arrivals.read_assignments(spark, str(tmp_path / "out")).collect()}
    arrive("b", rows[len(rows) // 2 :])
    arrive("c", rows[:5])  # that came before
    after = {x.cid: x for x in arrivals.read_assignments(spark, str(tmp_path / "out")).collect()}
    assert all(after[c] == x for c, x in half.items()) and len(after) > len(half)
    parts = os.listdir(tmp_path / "out")
    assert len(parts) > 10 and all(1 <= len(os.listdir(tmp_path / "out" / p)) <= 3 for p in parts if p.startswith("part="))
    got = arrivals.read_assignments(spark, str(tmp_path / "out"))
    assert got.count() == got.select("cid").distinct().count() > 0
    exact = {(x.sid, x.cid) for x in catalog.QUERIES["exact_matches"](spark, sf_dir).collect()}
    found = {(x.sid, x.cid) for x in got.filter("is_exact").collect()}
    assert {c for _, c in exact} <= {c for _, c in found}


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return str([shown(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    df, cur = query(spark, sf_dir), con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in names) for r in df.collect())
    assert got == sorted(tuple(map(shown, r)) for r in cur.fetchall())
    return len(got)


@pytest.fixture(scope="module")
def blocked(spark, sf_dir):
    """Records and candidates, which test_oracle[candidate_union] compares, once for all others."""
    r = catalog._records(spark, sf_dir)
    return r, catalog._candidates(r)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, sf_dir, name, blocked, monkeypatch):
    if name not in ("candidate_union", "cosine_topk"):
        monkeypatch.setattr(catalog, "_records", lambda *_: blocked[0])
        monkeypatch.setattr(catalog, "_candidates", lambda _: blocked[1])
    same(spark, sf_dir, catalog.QUERIES[name], catalog.ORACLES[name])


def test_vocabulary_counts_all_records(spark, sf_dir, monkeypatch):
    fit = catalog.vectors.fit_rows
    monkeypatch.setattr(catalog.vectors, "fit_rows", lambda records, limit=5: fit(records, limit))  # a sample's size in reach
    same(spark, sf_dir, catalog.QUERIES["tfidf_vocab"], catalog.ORACLES["tfidf_vocab"])


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["gbt_train_score", "feature_importance"])
def test_queries_without_sql(spark, sf_dir, name, blocked, monkeypatch):
    from linkwright.operators import model

    monkeypatch.setattr(catalog, "_candidates", lambda _: blocked[1])
    monkeypatch.setattr(model, "PARAMETERS", model.PARAMETERS | {"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 2})
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", ["gbt_train_score", "feature_importance"])
def test_models_are_fitted_on_all_candidates(spark, sf_dir, name, blocked, monkeypatch):
    from linkwright.operators import model

    fitted_on, train = [], model.train
    monkeypatch.setattr(catalog, "_records", lambda *_: blocked[0])
    monkeypatch.setattr(catalog, "_candidates", lambda _: blocked[1])
    monkeypatch.setattr(model, "PARAMETERS", model.PARAMETERS | {"maxIter": 2, "maxDepth": 2})
    monkeypatch.setattr(model, "train", lambda features, *a, **b: fitted_on.append((features, b)) or train(features, *a, **b))
    catalog.QUERIES[name](spark, sf_dir)
    (features, parameters), labelled = fitted_on[0], catalog.QUERIES["label_pairs"](spark, sf_dir)
    every = lambda rows: sorted(map(tuple, rows.select("sid", "cid", "label").collect()))
    assert every(features) == every(labelled) and len({r.label for r in labelled.collect()}) == 2
    assert parameters.get("subsamplingRate", 1.0) == 1.0  # nor a part of them in a round


def test_pair_features_agree_with_the_parts(spark, sf_dir):
    a = {(r.sid, r.cid): r for r in catalog.QUERIES["pair_features"](spark, sf_dir).collect()}
    b = {(r.sid, r.cid): r for r in catalog.QUERIES["edit_features"](spark, sf_dir).collect()}
    assert a.keys() == b.keys() and all(abs(a[k].addr_partial - b[k].addr_partial) < 1e-5 for k in a)
    assert all(0 <= r[f] <= 1 for r in a.values() for f in ("name_partial", "name_token_set", "min_name_addr"))
