"""Incremental ingest: new files become catalogue rows, each once, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_stream(spark: SparkSession, source: str, schema: str, table: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, key: tuple[str, ...] = ("dataset_id", "path"), max_files: int = 1000) -> StreamingQuery:
    """Take in what has arrived in a folder of metadata files, then stop.

    Each batch is written under its own number, so a batch that is run again after a
    failure replaces itself; readers keep the latest row of a key.
    """

    def write(batch: DataFrame, number: int) -> None:
        prepare(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{table}/batch={number:09d}")

    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(source)
    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str, key: tuple[str, ...] = ("dataset_id", "path")) -> DataFrame:
    """The latest row of each key over all batches."""
    rows = spark.read.parquet(f"{table}/*")
    names = [c for c in rows.columns if c not in key]
    latest = rows.groupBy(*key).agg(F.max_by(F.struct(*names), "batch").alias("row"))
    return latest.select(*key, "row.*").drop("batch")


def changed_groups(before: DataFrame, after: DataFrame) -> DataFrame:
    """Execution keys whose data are new or different since the last solve."""
    old = before.select("dataset_key", F.col("dataset_hash").alias("old_hash"))
    return after.join(old, "dataset_key", "left").where(~F.col("dataset_hash").eqNullSafe(F.col("old_hash"))).drop("old_hash")
