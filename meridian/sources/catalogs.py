"""Catalogues, results and bundles as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.functions.calendars import ordinal, parse_time, time_text
from meridian.functions.catalog import null_to_nan, version_key
from meridian.operators.windows import latest_version

SERIES = (
    "attributes map<string,string>, dimensions map<string,string>, index array<string>, index_name string, "
    "values array<double>, kind string"
)
OUTPUT = "map<string, struct<filename:string,long_name:string,description:string,dimensions:map<string,string>>>"


def with_times(df: DataFrame) -> DataFrame:
    """``start_time`` and ``end_time`` texts as calendar times, and their seconds for comparing."""
    calendar = F.col("calendar") if "calendar" in df.columns else F.lit("standard")
    for name in ("start", "end"):
        df = df.withColumn(f"{name}_time", parse_time(F.col(f"{name}_time"), calendar)).withColumn(f"{name}_ord", ordinal(F.col(f"{name}_time"), calendar))
    return df


def load_catalog(datasets: DataFrame, files: DataFrame, latest: Sequence[str] = ()) -> DataFrame:
    """One row per file of the latest datasets that are not retracted, with its times."""
    kept = datasets.where("retracted_at is null") if "retracted_at" in datasets.columns else datasets
    kept = latest_version(kept, latest) if latest else kept
    return with_times(kept.join(files, "dataset_id"))


def write_catalog(df: DataFrame, path: str) -> None:
    """Times go out as texts."""
    times = {c: time_text(F.col(c)) for c in ("start_time", "end_time") if c in df.columns}
    df.withColumns(times).drop("start_ord", "end_ord").write.mode("overwrite").parquet(path)


def read_catalogs(spark: SparkSession, folder: str, source_types: Sequence[str], latest: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """One catalogue per source type, each in a file of its own."""
    found = {}
    for t in source_types:
        df = spark.read.parquet(f"{folder}/{t}.parquet")
        found[t] = with_times(latest_version(df, (latest or {}).get(t, ())) if (latest or {}).get(t) else df)
    return found


def union_catalogs(frames: Sequence[DataFrame], prefixes: Mapping[str, str] | None = None) -> DataFrame:
    """Several scans in one, path prefixes rewritten."""
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    path = F.col("path")
    for old, new in (prefixes or {}).items():
        path = F.when(path.startswith(old), F.concat(F.lit(new), F.substr(path, F.lit(len(old) + 1)))).otherwise(path)
    return df.withColumn("path", path)


def with_version_key(df: DataFrame) -> DataFrame:
    return df.withColumn("version_key", version_key(F.col("version")))


def deduplicated(df: DataFrame, key: str = "key", order: str = "row_id") -> DataFrame:
    """Search results with one row per key: the first, with the widest time span."""
    first = Window.partitionBy(key).orderBy(order)
    every = Window.partitionBy(key)
    rows = df.withColumns({"__n": F.row_number().over(first), "time_start": F.min("time_start").over(every), "time_end": F.max("time_end").over(every)})
    return rows.where("__n = 1").drop("__n")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """``series.json``: a list of series; missing numbers are NaN, kinds default to model."""
    df = spark.read.schema(SERIES).option("multiLine", "true").json(path)
    return df.withColumns({"values": null_to_nan(F.col("values")), "kind": F.coalesce("kind", F.lit("model"))})


def write_series(df: DataFrame, path: str) -> None:
    """One series per line, in the order of dimensions, kind and index; default kinds are left out."""
    rows = df.withColumn("kind", F.when(F.col("kind") != "model", F.col("kind")))
    rows.orderBy(F.to_json("dimensions"), F.coalesce("kind", F.lit("model")), "index_name").write.mode("overwrite").json(path)


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """``diagnostic.json``: the dimensions' order, the results as JSON, and the rest."""
    text = spark.read.text(path, wholetext=True)
    parts = "DIMENSIONS struct<json_structure:array<string>>, RESULTS string"
    return text.select(F.from_json("value", parts).alias("b"), "value").select(F.col("b.DIMENSIONS.json_structure").alias("json_structure"), F.get_json_object("value", "$.RESULTS").alias("results"))


def read_outputs(spark: SparkSession, path: str) -> DataFrame:
    """``output.json``: one row per registered plot, data or html file."""
    text = spark.read.text(path, wholetext=True)
    kinds = ("plots", "data", "html")
    body = text.select(F.from_json("value", ", ".join(f"{k} {OUTPUT}" for k in kinds)).alias("o"))
    rows = [body.select(F.lit(k.rstrip("s")).alias("output_type"), F.explode(f"o.{k}").alias("short_name", "x")).select("output_type", "short_name", "x.*") for k in kinds]
    return reduce(DataFrame.unionByName, rows)


def write_bundle(results: DataFrame, path: str, json_structure: Sequence[str]) -> None:
    """``diagnostic.json`` of nested results (one row, column results), as ``read_bundle`` reads it."""
    order = F.to_json(F.struct(F.array(*map(F.lit, json_structure)).alias("json_structure")))
    results.select(F.concat(F.lit('{"DIMENSIONS": '), order, F.lit(', "RESULTS": '), "results", F.lit("}"))).coalesce(1).write.mode("overwrite").text(path)  # one row


def write_outputs(outputs: DataFrame, path: str) -> None:
    """``output.json`` of an execution's registered files, as ``read_outputs`` reads it."""
    fields = [c for c in outputs.columns if c not in ("output_type", "short_name", "execution_id")]
    entries = outputs.groupBy("output_type").agg(F.map_from_entries(F.collect_list(F.struct("short_name", F.struct(*fields)))).alias("files"))  # the files of one execution
    kind = F.when(F.col("output_type") == "plot", "plots").otherwise(F.col("output_type"))
    entries.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(kind, "files"))))).write.mode("overwrite").text(path)


def read_metric_tables(spark: SparkSession, path: str, key: Sequence[str] = ("source", "region", "analysis", "name")) -> DataFrame:
    """All CSV files of a folder in one; only ``NaN`` is missing, and of repeated rows the first file's stays."""
    df = spark.read.option("header", "true").csv(path)
    # Spark reads an empty field as null, whatever else is to be null
    df = df.withColumns({c: F.nullif(F.coalesce(c, F.lit("")), F.lit("NaN")) for c in df.columns}).withColumn("__file", F.input_file_name())
    w = Window.partitionBy(*key).orderBy("__file", F.monotonically_increasing_id())
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__file")


def run_sql(spark: SparkSession, query: str, tables: Mapping[str, DataFrame], limit: int = 100) -> tuple[DataFrame, int]:
    """A query over named tables: its first rows, and how many were left out."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    rows = spark.sql(query)
    return rows.limit(limit), max(0, rows.count() - limit)


def list_tables(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, len(df.columns)) for n, df in sorted(tables.items())], "name string, columns int")
