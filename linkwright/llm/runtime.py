"""What the operators need from the session: the shared folder, bounded batches, file access."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import fresh_path, shared_dir, written  # noqa: F401


def open_shared(uri: str, mode: str):
    """A binary file in the shared folder, from a driver or an executor. Local mounts are opened
    directly, other schemes through pyarrow's file systems."""
    if uri.startswith("file:"):
        path = "/" + uri[5:].lstrip("/")
        if "w" in mode:
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    if "://" not in uri:
        return open(uri, mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if "w" in mode:
        store.create_dir(os.path.dirname(path), recursive=True)
        return store.open_output_stream(path)
    return store.open_input_file(path)


#: Bytes of an Arrow batch: it is held by the JVM, the Python worker and in between at once.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_BYTES, so that workers' memory doesn't follow the rows' length."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = spark.conf.get(key).rstrip("b")
    if not have.isdigit() or int(have) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def release_memory() -> None:
    """Give freed memory back to the system: Python workers are kept between tasks, and what they hold adds up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run for mapInArrow, releasing memory after each task."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def map_arrow(df: DataFrame, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow for a function of one batch."""
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            yield from make(batch)

    return df.mapInArrow(tidy(run), schema)


#: Stands for a null doc_id where ids are keys: null ids come after all others and match each other.
NO_ID = (1 << 63) - 1


def keyed_input(docs: DataFrame) -> DataFrame:
    """doc_id (never null), text (never null) and tag, a 64-bit hash of the text, which tell texts apart where many
    rows share an id or lack one."""
    tag = F.xxhash64("text")
    return text_input(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("tag", tag)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def unkeyed(df: DataFrame, *columns: str) -> DataFrame:
    """df with null for NO_ID in the columns named."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NO_ID)) for c in columns})


def ids_of(batch: pa.RecordBatch):
    """The doc_id column as int64; null ids as NO_ID."""
    return batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)


def text_input(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the named columns, whatever else docs has; a null text is an empty one."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)
