"""Constraint checks of result files, as queries over their lines.

A problem is a row (rule, label, severity, detail, n): n cases, of which detail shows the first five.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..sources.storage import written
from ..sources.tsv import read_ids

SHOWN = 5


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    info: list[str] = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return not self.errors


def split_lists(rows: DataFrame) -> DataFrame:
    """sid and ids (in order, untrimmed, repeats kept) from two columns id, list."""
    ids = F.when(F.trim(F.col("list")) == "", F.array().cast("array<string>")).otherwise(F.split("list", ","))
    return rows.select("sid", ids.alias("ids"))


def _wrong_prefix(t: Column) -> Column:
    return ~t.startswith("S1-") & ~t.startswith("S2-") & ~t.startswith("S3-")


#: Rules of one row: name and the ids that offend.
ROW_RULES = {
    "repeated id in a list": lambda: F.filter(F.array_distinct("ids"), lambda t: F.size(F.filter(F.col("ids"), lambda u: u == t)) > 1),
    "S1 id in a list": lambda: F.filter(F.array_distinct("ids"), lambda t: t.startswith("S1-")),
    "id without S2- or S3- prefix": lambda: F.filter(F.array_distinct("ids"), _wrong_prefix),
}


def duplicates(lists: DataFrame) -> DataFrame:
    """sid, n of ids that have several rows."""
    return lists.groupBy("sid").agg(F.count("*").alias("n")).filter("n > 1")


def row_problems(lists: DataFrame) -> DataFrame:
    """rule, sid, cid of every offending id."""
    rules = F.array(*[F.struct(F.lit(k).alias("rule"), f().alias("bad")) for k, f in ROW_RULES.items()])
    return lists.select("sid", F.explode(rules).alias("r")).select("r.rule", "sid", F.explode("r.bad").alias("cid"))


def coverage(lists: DataFrame, required: DataFrame) -> DataFrame:
    """problem (missing or unexpected) and sid; required has entity_id."""
    seen, need = lists.select("sid").distinct(), required.select(F.col("entity_id").alias("sid")).distinct()
    missing = need.join(seen, "sid", "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(seen.join(need, "sid", "left_anti").withColumn("problem", F.lit("unexpected")))


def unknown_ids(lists: DataFrame, known: DataFrame) -> DataFrame:
    """sid, cid of listed ids that known (entity_id) lacks."""
    listed = lists.select("sid", F.explode(F.array_distinct("ids")).alias("cid"))
    return listed.join(known.select(F.col("entity_id").alias("cid")).distinct(), "cid", "left_anti").select("sid", "cid")


def not_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """sid, cid of matched ids that the candidate file's row of the same sid lacks."""
    a = matching.select("sid", F.explode(F.array_distinct("ids")).alias("cid"))
    b = candidates.select("sid", F.explode(F.array_distinct("ids")).alias("cid"))
    return a.join(b, ["sid", "cid"], "left_anti")


def counts(lists: DataFrame) -> DataFrame:
    some = F.size("ids") > 0
    return lists.agg(F.count("*").alias("n_rows"), F.count_if(~some).alias("n_empty"), F.count_if(some).alias("n_filled"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias("n_ids"))


def shown(values: DataFrame, column: str) -> tuple[int, str]:
    """How many distinct values there are, and the first five."""
    n = values.select(column).distinct()
    first = [r[0] for r in n.orderBy(column).limit(SHOWN).collect()]
    total = n.count()
    return total, ", ".join(map(repr, first)) + (", ..." if total > SHOWN else "")


def examples(rows: DataFrame) -> DataFrame:
    """rule, n, first: the distinct ids of every rule, the first five of them."""
    listed = rows.groupBy("rule").agg(F.collect_set("cid").alias("s"))
    return listed.select("rule", F.size("s").cast("long").alias("n"), F.array_join(F.slice(F.array_sort("s"), 1, SHOWN), ",").alias("first"))


def lines_of(spark: SparkSession, path: str) -> DataFrame | None:
    """value, line (from 0) and is_first (of its file) of the lines of a file, or of a folder's files in the order of their names.
    Tasks number their own lines; what comes before a part of a file is added from a table of one row a part."""
    try:
        rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    rows = written(rows, "lines")
    sums = rows.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_at").alias("_least"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = rows.join(sums.withColumn("_before", before), ["_file", "_start"])
    return numbered.select("value", (F.col("_at") - F.col("_least") + F.col("_before")).alias("line"), ((F.col("_start") == 0) & (F.col("_at") == F.col("_least"))).alias("is_first"))


def without_tab(lines: DataFrame) -> DataFrame:
    """The lines that are neither blank nor have a tab."""
    return lines.filter((F.trim("value") != "") & ~F.col("value").contains("\t"))


def check_file(spark: SparkSession, path: str, header: tuple[str, str], label: str, required: DataFrame | None, known: DataFrame | None, report: Report) -> DataFrame | None:
    """The file's lists, or None if it can't be read; problems go to the report."""
    lines = lines_of(spark, path)
    if lines is None:
        report.errors.append(f"{label}: the file is missing: {path}")
        return None
    # every file of a folder has a header
    heads = [r["value"] for r in lines.filter("is_first").select("value").distinct().orderBy("value").limit(SHOWN).collect()]
    if not any(h.strip() for h in heads):
        report.errors.append(f"{label}: the file is empty")
        return None
    if lines.filter(~F.is_valid_utf8("value")).head(1):
        report.errors.append(f"{label}: the file isn't UTF-8")
        return None
    for head in heads:
        names = [x.strip().lower() for x in head.lstrip("\ufeff").split("\t")]
        if len(names) == 1 and "," in names[0]:
            report.errors.append(f"{label}: the header has commas; fields must be separated by tabs")
            return None
        if names != list(header):
            report.errors.append(f"{label}: the header is {names}, not {list(header)}")
            return None
    body = lines.filter(~F.col("is_first") & (F.trim("value") != ""))
    bad = without_tab(body)
    if n := bad.count():
        at = [r["line"] + 1 for r in bad.orderBy("line").limit(SHOWN).collect()]
        report.errors.append(f"{label}: {n} rows without a tab, in lines {at}")
    parts = F.split("value", "\t")
    lists = split_lists(body.filter(F.col("value").contains("\t")).select(F.trim(parts[0]).alias("sid"), F.trim(parts[1]).alias("list")))
    for what, rows, column in [("several rows of an id", duplicates(lists), "sid"), *((rule, row_problems(lists).filter(F.col("rule") == rule), "cid") for rule in ROW_RULES)]:
        n, first = shown(rows, column)
        if n:
            report.errors.append(f"{label}: {what}: {n}, {first}")
    if known is not None:
        n, first = shown(unknown_ids(lists, known), "cid")
        if n:
            report.errors.append(f"{label}: unknown ids: {n}, {first}")
    if required is not None:
        gaps = coverage(lists, required)
        for problem in ("missing", "unexpected"):
            n, first = shown(gaps.filter(F.col("problem") == problem), "sid")
            if n:
                report.errors.append(f"{label}: {problem} S1 ids: {n}, {first}")
    c = counts(lists).first()
    report.info.append(f"{label}: {c['n_rows']} rows, {c['n_filled']} with ids, {c['n_empty']} without")
    return lists


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def validate(spark: SparkSession, matching: str, candidates: str | None, test_dir: str, check_ids: bool = False) -> Report:
    """Check the result files against the sources in test_dir."""
    report = Report()
    required = read_ids(spark, f"{test_dir}/test_source1.tsv")
    known = None
    if check_ids:
        try:
            known = read_ids(spark, f"{test_dir}/test_source2.tsv").union(read_ids(spark, f"{test_dir}/test_source3.tsv")).distinct()
        except AnalysisException:
            report.warnings.append("sources 2 and 3 are missing; ids aren't looked up")
    lists = check_file(spark, matching, L.MATCHING_HEADER, "matching", required, known, report)
    if candidates is None or not exists(spark, candidates):
        report.warnings.append("there is no candidate file")
        return report
    cands = check_file(spark, candidates, L.CANDIDATE_HEADER, "candidates", required, known, report)
    if lists is not None and cands is not None:
        n, first = shown(not_candidates(lists, cands), "sid")
        if n:
            report.warnings.append(f"matches that aren't candidates, in {n} rows: {first}")
    return report
