"""Tab-separated sources and sinks. Quotes are ordinary characters in records; no type is ever inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L


def _line_numbers(lines: DataFrame) -> DataFrame:
    """value with row_pos, which grows along a file (and from file to file)."""
    return lines.withColumn("row_pos", F.monotonically_increasing_id())


def _fields(lines: DataFrame, columns: tuple[str, ...], header: str) -> DataFrame:
    """Lines split at tabs: blank lines, the header and lines with too many fields go; missing fields are empty."""
    rows = lines.withColumn("value", F.regexp_replace("value", r"\r$", "")).filter((F.col("value") != "") & (F.col("value") != header))
    rows = rows.withColumn("_f", F.split("value", "\t")).filter(F.size("_f") <= len(columns))
    return rows.select("row_pos", *[F.coalesce(F.get("_f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """A source of records: row_pos and the four record columns, all strings."""
    return _fields(_line_numbers(spark.read.text(path)), L.RECORD_COLUMNS, "\t".join(L.RECORD_COLUMNS))


def id_list(x: Column) -> Column:
    """A comma-separated list as an array without repeats; ids aren't trimmed, a blank list is empty."""
    return F.when(F.trim(x) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(x, ",")))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """sid and cids; of repeated ids the last line counts."""
    raw = spark.read.option("sep", "\t").option("quote", '"').option("escape", '"').schema("source1_entity_id string, matched_entity_ids string").csv(path)
    rows = _line_numbers(raw).filter(F.col("source1_entity_id").isNotNull() & (F.col("source1_entity_id") != L.MATCHING_HEADER[0]))
    last = rows.groupBy("source1_entity_id").agg(F.max_by("matched_entity_ids", "row_pos").alias("list"))
    return last.select(F.col("source1_entity_id").alias("sid"), id_list(F.coalesce("list", F.lit(""))).alias("cids"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct first fields of a file, trimmed; blank ones and the first line's go."""
    lines = spark.read.option("sep", "\t").option("quote", "").option("header", "true").csv(path)
    first = lines.select(F.trim(F.col(lines.columns[0])).alias("entity_id"))
    return first.filter(F.col("entity_id").isNotNull() & (F.col("entity_id") != "")).distinct()


def _write_lines(rows: DataFrame, header: tuple[str, ...], path: str) -> None:
    """Lines as one unquoted column, whose name is the header of every file; nothing is trimmed."""
    out = rows.withColumnRenamed("value", "\t".join(header)).write.mode("overwrite")
    settings = {"header": "true", "quote": "", "sep": "\x01", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    out.options(**settings).csv(path)


def write_lists(lists: DataFrame, header: tuple[str, str], path: str, single: bool = False) -> None:
    """Two columns (id, comma-separated list) with a header line in every file; files are in the order of row_pos. With single, path is
    one file, for consumers that need it, which only fits results of moderate size."""
    rows = lists.orderBy("row_pos").select(F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in header]).alias("value"))
    if not single:
        _write_lines(rows, header, path)
        return
    _write_lines(rows.coalesce(1), header, f"{path}-parts")
    jvm, conf = rows.sparkSession.sparkContext._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folder, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}-parts", path))
    store = folder.getFileSystem(conf)
    (part,) = [f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")]
    store.delete(target, True)
    if not store.rename(part, target):
        raise OSError(f"can't move {part} to {path}")
    store.delete(folder, True)


def write_records(records: DataFrame, path: str) -> None:
    """Records as read_source reads them."""
    rows = records.select(F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in L.RECORD_COLUMNS]).alias("value"))
    _write_lines(rows, L.RECORD_COLUMNS, path)
