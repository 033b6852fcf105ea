"""One fixture for each rule."""

import pytest

from linkwright.operators.validate import validate

GOOD = "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
CANDS = "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1,S3-1,S2-2\nS1-2\tS2-2\n"


@pytest.fixture
def run(spark, tmp_path):
    for i, ids in ((1, ["S1-1", "S1-2"]), (2, ["S2-1", "S2-2"]), (3, ["S3-1"])):
        (tmp_path / f"test_source{i}.tsv").write_text("entity_id\tbusiness_name\n" + "".join(f"{x}\tn\n" for x in ids))

    def go(matching, candidates=CANDS, check_ids=False):
        paths = []
        for name, text in (("m.tsv", matching), ("c.tsv", candidates)):
            path = tmp_path / name
            if text is None:
                path.unlink(missing_ok=True)
            else:
                path.write_text(text)
            paths.append(str(path))
        return validate(spark, *paths, str(tmp_path), check_ids)

    return go


def test_good(run):
    r = run(GOOD, check_ids=True)
    assert r.passed and not r.warnings and len(r.info) == 2


@pytest.mark.parametrize(
    "matching, what",
    [
        (None, "missing"),
        ("", "empty"),
        (GOOD.replace("\t", ","), "commas"),
        (GOOD.replace("matched", "other"), "header"),
        (GOOD + "S1-9\n", "without a tab"),
        (GOOD + "S1-2\tS2-2\n", "several rows"),
        (GOOD.replace("S3-1", "S2-1"), "repeated id"),
        (GOOD.replace("S3-1", "S1-2"), "S1 id in a list"),
        (GOOD.replace("S3-1", ""), "without S2- or S3-"),
        (GOOD.replace("S3-1", "X-1"), "without S2- or S3-"),
        (GOOD.replace("S1-2\t\n", ""), "missing S1 ids"),
        (GOOD + "S1-3\t\n", "unexpected S1 ids"),
    ],
)
def test_errors(run, matching, what):
    r = run(matching)
    assert not r.passed and any(what in e for e in r.errors), r


def test_unknown_ids_only_on_demand(run):
    bad = GOOD.replace("S3-1", "S3-9")
    assert run(bad, CANDS.replace("S3-1", "S3-9")).passed
    r = run(bad, CANDS.replace("S3-1", "S3-9"), check_ids=True)
    assert any("unknown" in e for e in r.errors)


def test_warnings(run):
    r = run(GOOD, CANDS.replace("S3-1,", ""))
    assert r.passed and "aren't candidates" in r.warnings[0]
    r = run(GOOD, None)
    assert r.passed and "no candidate file" in r.warnings[0]


def test_line_numbers_across_tasks(spark, run):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        r = run(GOOD + "".join(f"S1-{i}\t\n" for i in range(10, 60)) + "broken\n" + "S1-60\t\n")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert any("1 rows without a tab, in lines [54]" in e for e in r.errors), r


def test_command_line(run, tmp_path, capsys):
    from linkwright.cli import main

    args = ["validate", "--matching", str(tmp_path / "m.tsv"), "--candidate", str(tmp_path / "c.tsv"), "--test-dir", str(tmp_path), "--check-ids"]
    run(GOOD)
    assert main(args) == 0 and "PASS" in capsys.readouterr().out
    (tmp_path / "m.tsv").write_bytes(GOOD.encode() + b"S1-2\tS2-\xff\n")
    assert main(args) == 1 and "UTF-8" in capsys.readouterr().out
