"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points that the text contracts call white space, as a Java/Python regex class.
WHITE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    Taken from ``spark.checkpoint.dir``; only where that is unset and Spark runs in
    this one machine a fresh temporary folder is used and remembered in the session.
    On a cluster a missing setting is an error: executors do not see each other's disks.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("meridian.shared.dir", None)
    if not found and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="meridian-")
        spark.conf.set("meridian.shared.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/meridian/{label}-{uuid.uuid4().hex}"


#: With this Spark removes the shuffle files of a query when it ends; else they stay until the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage there: whatever reads the result survives the loss of any
    executor, and two readers see the same rows. Shuffle files go once it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard_tables(*tables: DataFrame) -> None:
    """Remove tables that ``materialise`` wrote and that nothing reads any more."""
    for df in tables:
        discard(df.sparkSession, df.inputFiles()[0].rpartition("/")[0])


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder that a later one has taken the place of."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def text_bytes(name: str = "text") -> F.Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def limited_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is: a shuffled join then.

    ``df`` should be cheap to count, as a written table is.
    """
    return F.broadcast(df) if df.count() <= rows else df


#: Keys of many rows that are sent to every task.
LARGE_KEYS = 50_000


def join_known(rows: DataFrame, known: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with what ``known`` (one row for each key) says, nulls where it says nothing; ``count`` is each key's number of rows.

    Rows of large keys stay where they are. So many rows make a key large that at most
    ``LARGE_KEYS`` are. ``known`` should be a written table.
    """
    large = max(1000, -(-(known.agg(F.sum(count)).first()[0] or 0) // LARGE_KEYS))
    few = F.broadcast(known.where(F.col(count) >= large).drop(count))
    rest = rows.join(few, key, "left_anti").join(known.where(F.col(count) < large).drop(count), key, "left")
    return rows.join(few, key).unionByName(rest)


def hash_sample(df: DataFrame, bound: int, *key: str) -> DataFrame:
    """At most ``bound`` rows of ``df``, those whose ``key`` has the smallest hashes; every row may be among them.

    Where the table is large all but a small share is left out before rows are ordered,
    so that no task sends its own ``bound`` rows.
    """
    order = F.xxhash64(*key)
    n = df.count()
    if n > 4 * bound:
        df = df.where(order < F.lit(int(-(2**63) + 2**64 * (2 * bound / n))))
    return df.orderBy(order, *key).limit(bound)


#: A row's mark beside its doc_id, so that null and repeated doc_ids are told apart by their texts.
TEXT_HASH = "text_hash"


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn(TEXT_HASH, F.xxhash64("text"))


def drop_rows(docs: DataFrame, gone: DataFrame, rows: int = 500_000) -> DataFrame:
    """``docs`` without the rows that ``gone`` (doc_id, text_hash) names, all columns kept.

    ``gone`` is broadcast up to ``rows`` rows, beyond that the join is shuffled.
    """
    gone = materialise(gone.select("doc_id", TEXT_HASH).distinct(), "gone")
    own, id_, hash_ = free_names(docs, 3)
    side = limited_broadcast(gone.select(F.col("doc_id").alias(id_), F.col(TEXT_HASH).alias(hash_)), rows)
    named = docs.withColumn(own, F.xxhash64("text"))
    on = (named[own] == side[hash_]) & named["doc_id"].eqNullSafe(side[id_])
    return named.join(side, on, "left_anti").drop(own)


def free_names(df: DataFrame, n: int) -> list[str]:
    """Names that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    return [x for k in range(n + len(taken)) if (x := f"__own{k}") not in taken][:n]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task computes for one batch stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
    release_memory()


def release_memory() -> None:
    """Give back what a task has freed: its worker lives on beside those of later stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)
