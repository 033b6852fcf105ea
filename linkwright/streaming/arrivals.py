"""Linking arriving records to a fixed S1 side with Structured Streaming. An addition to the batch operators.

Every micro-batch of S2 and S3 records is blocked against S1 by shared tokens, scored and assigned, and its assignments are
merged into a table of the best one for each candidate. The table has PARTS parts by the candidate's hash, and a batch writes a
new version of those parts alone that it touches; the version before stays until the next one, for readers. Merging is
idempotent (the greatest p wins, then the first position), so a batch that runs again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import lexicon as L
from ..operators import blocking as B
from ..operators import resolve
from ..plans.linkage import scored_by_surrogate
from ..sources.storage import written

PARTS = 64
SOURCE_SCHEMA = ", ".join(f"{c} string" for c in L.RECORD_COLUMNS)


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """New tab-separated record files (without a header) of a folder, as a stream."""
    return spark.readStream.schema(SOURCE_SCHEMA).option("sep", "\t").option("quote", "").option("emptyValue", "").csv(path).na.fill("")


def assign_batch(batch: DataFrame, s1: DataFrame, s1_index: DataFrame) -> DataFrame:
    """sid, cid, p, is_exact, s1_pos of a batch: the best S1 record for each new one. The index is that of S1's tokens."""
    new = B.normalized(batch)
    pairs = B.token_rows(new).withColumnRenamed("entity_id", "cid").join(s1_index, ["country_norm", "token"])
    counts = pairs.groupBy("sid", "cid").agg(F.count("*").alias("n_shared"))
    scored = scored_by_surrogate(B.top(counts, "cid", [F.desc("n_shared"), F.asc("sid")], L.TOP_TOKENS, "rank"), s1, new)
    positions = scored.select("sid", "s1_pos").distinct()
    return resolve.best_per_candidate(scored).join(positions, "sid")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    order = Window.partitionBy("cid").orderBy(F.desc("p"), F.desc("is_exact"), "s1_pos", "sid")
    return old.unionByName(new).withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def link_arrivals(stream: DataFrame, s1: DataFrame, table: str, checkpoint: str, max_df: int = L.MAX_DF) -> DataStreamWriter:
    """A writer that keeps assignments in parts below table, each part's versions named by the batches that wrote them."""
    index = B.token_rows(s1)
    df = index.groupBy("country_norm", "token").agg(F.count("*").alias("df")).filter(F.col("df") <= max_df)
    index = index.join(df, ["country_norm", "token"]).select("country_norm", "token", F.col("entity_id").alias("sid"))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = written(assign_batch(batch, s1, index).withColumn("part", F.pmod(F.xxhash64("cid"), F.lit(PARTS)).cast("int")), "arrivals")
        touched = {r["part"] for r in new.select("part").distinct().collect()}  # at most PARTS
        if not touched:
            return
        versions = _versions(spark, table)
        old = {p: v for p in touched if (v := [b for b in versions.get(p, []) if b < batch_id])}
        paths = [f"{table}/part={p}/batch={v[-1]:012d}" for p, v in old.items()]
        if paths:
            before = spark.read.parquet(*paths).withColumn("part", F.pmod(F.xxhash64("cid"), F.lit(PARTS)).cast("int"))
            new = merged(before.select(new.columns), new)
        version = f"batch={batch_id:012d}"
        staged = f"{table}/_staged/{version}"
        new.repartition("part").write.mode("overwrite").partitionBy("part").parquet(staged)
        store, path = _store(spark, table)
        for p in touched:  # a rename is what makes a part's version visible
            target = path(f"{table}/part={p}/{version}")
            store.mkdirs(target.getParent())
            store.delete(target, True)
            store.rename(path(f"{staged}/part={p}"), target)
            for b in old.get(p, [])[:-1]:
                store.delete(path(f"{table}/part={p}/batch={b:012d}"), True)
        store.delete(path(staged), True)

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)


def _store(spark: SparkSession, table: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, table: str) -> dict[int, list[int]]:
    """The batches that wrote each part, in order."""
    store, path = _store(spark, table)
    found: dict[int, list[int]] = {}
    for status in store.globStatus(path(f"{table}/part=*/batch=*")) or []:
        at = status.getPath()
        found.setdefault(int(at.getParent().getName()[5:]), []).append(int(at.getName()[6:]))
    return {p: sorted(v) for p, v in found.items()}


def read_assignments(spark: SparkSession, table: str) -> DataFrame | None:
    """The assignments after the last batch, or None."""
    paths = [f"{table}/part={p}/batch={v[-1]:012d}" for p, v in sorted(_versions(spark, table).items())]
    return spark.read.parquet(*paths) if paths else None
