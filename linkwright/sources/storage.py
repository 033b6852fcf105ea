"""The session's shared folder and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where it is unset and all run in one process (a
    local master, as in tests) a temporary one is made and set for the session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="linkwright-")
        spark.conf.set("spark.checkpoint.dir", found)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; nothing is ever reused by name."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: cuts lineage and survives the loss
    of any executor. Columns of type void become strings, which Parquet can hold."""
    path = fresh_path(df.sparkSession, name)
    df = df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "void"})
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over all shuffle partitions, for rows whose work is large for their bytes: partitions of few bytes would be
    merged otherwise and leave few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
