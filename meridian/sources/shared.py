"""Tables written once to the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset and Spark runs in this one machine, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("meridian.shared.dir", None)
    if not found and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="meridian-")
        spark.conf.set("meridian.shared.dir", found)
    return found.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/meridian/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table that is computed once: all who read it see the same rows, whichever executors are lost."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def complete_parts(spark: SparkSession, folder: str, key: str) -> list[str]:
    """The values of ``key`` whose folder ``key=value`` holds a table that was written to its end."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{key}=*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(f.getPath().getParent().getName().partition("=")[2] for f in found or ())


def read_parts(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """The rows of those tables that are there, none where none is."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    here = [p for p in paths if (x := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(x)]
    return spark.read.schema(schema).parquet(*here) if here else spark.createDataFrame([], schema)
