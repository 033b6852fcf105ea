"""Record tables for the queries. The tables at hand hold no businesses, so records are taken from documents: thirds of
them are the three sources, the language is the country, and the whole text is split in three: the first letters are the name, the
next ones the address, and all others the body, which tells whether two records are the same business."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocking import normalized
from ..sources.storage import spread, written


#: Characters of a text that mostly hold its name and address.
HEAD = 256


def er_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text counts. Name and address come from its first HEAD characters if these are long enough with their white space squeezed,
    since they are then the first ones of the whole squeezed text."""
    text, squeezed = F.coalesce(F.col("text"), F.lit("")), lambda x: F.regexp_replace(x, r"\s+", " ")
    flat, first = squeezed(text), squeezed(F.substring(text, 1, HEAD))
    head = F.when(F.length(first) >= 112, first).otherwise(flat)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(
        F.concat(F.lit("S"), (F.pmod("doc_id", F.lit(3)) + 1).cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("entity_id"),
        F.substring(head, 1, 48).alias("business_name"),
        F.substring(head, 49, 64).alias("business_address"),
        F.coalesce("lang", F.lit("")).alias("country"),
        F.substring(flat, 113, 2**31 - 1).alias("body"),
        F.col("doc_id").alias("row_pos"),
    )


class Records:
    """The normalised sources of a folder of tables; once: as a table, for plans that read them several times."""

    def __init__(self, spark: SparkSession, sf_dir: str, once: bool = False):
        self.raw = er_records(spark, sf_dir)
        self.all = normalized(self.raw, "row_pos")
        if once:
            self.all = written(spread(self.all, "entity_id"), "records")
        self.s1 = self.all.filter(F.col("entity_id").startswith("S1-"))
        self.s23 = self.all.filter(~F.col("entity_id").startswith("S1-"))

    @property
    def truth(self) -> DataFrame:
        """sid, cid: records whose bodies agree; a cid belongs to the least sid."""
        rows = self.raw.filter(F.length("body") >= 60).withColumn("body", F.sha2("body", 256))
        a = rows.filter(F.col("entity_id").startswith("S1-")).groupBy("country", "body").agg(F.min("entity_id").alias("sid"))
        b = rows.filter(~F.col("entity_id").startswith("S1-")).select("country", "body", F.col("entity_id").alias("cid"))
        return a.join(b, ["country", "body"]).select("sid", "cid")
