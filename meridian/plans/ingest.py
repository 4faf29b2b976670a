"""What an execution leaves behind, as rows: scalar values, series with shared axes, outputs.

Each function gives the rows to append. Values outside a vocabulary are taken in all
the same; they are listed beside as violations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.catalog import axis_hash, reference_id
from meridian.operators.bundles import flatten, undeclared, validated_kind
from meridian.plans.upsert import new_by_hash


def scalar_values(bundles: DataFrame, dimensions: Sequence[str], vocabulary: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The scalar values of bundles (execution_id, results) and, given a vocabulary (dimension, value), what is not in it."""
    rows = flatten(bundles, "results", dimensions)
    return rows, None if vocabulary is None else undeclared(rows, vocabulary, [d for d in dimensions if d != "kind"])


def series_values(series: DataFrame, axes: DataFrame, dimensions: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of series, and the index axes that are new.

    ``series``: execution_id, values, index, index_name, kind, the dimensions and perhaps
    reference_source_id. ``axes``: hash, index_name, index. Equal axes are one row, however
    many series share them. Only reference series get a reference_id.
    """
    rows = validated_kind(series).withColumn("hash", axis_hash(F.col("index_name"), F.col("index")))
    fresh = new_by_hash(axes, rows.select("hash", "index_name", "index"))
    source = F.col("reference_source_id") if "reference_source_id" in series.columns else F.lit(None).cast("string")
    named = F.when(F.col("kind") == "reference", reference_id(F.col("values"), F.col("index"), source))
    return rows.withColumn("reference_id", named).select("execution_id", *dimensions, "kind", "values", F.col("hash").alias("axis"), "reference_id"), fresh


def output_rows(outputs: DataFrame) -> DataFrame:
    """Registered outputs tied to their execution: execution_id, output_type, short_name, filename, long_name, description."""
    wanted = ("filename", "long_name", "description")
    named = [F.col(c) if c in outputs.columns else F.lit(None).cast("string").alias(c) for c in wanted]
    return outputs.select("execution_id", "output_type", "short_name", *named)
