"""Ranking and ordering: latest versions and runs, first members, gaps, overlaps, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.catalog import version_key


def latest_version(df: DataFrame, group_by: Sequence[str] = (), version: str = "version") -> DataFrame:
    """All rows of the highest version of their group.

    The maximum is an aggregate joined back, so a group of any size is pre-aggregated.
    """
    keyed = df.withColumn("__v", version_key(F.col(version)))
    if not group_by:
        top = keyed.agg(F.max("__v").alias("__top"))
        return keyed.join(F.broadcast(top), F.col("__v") == F.col("__top")).select(*df.columns)  # one row
    top = keyed.groupBy(*group_by).agg(F.max("__v").alias("__top"))
    on = [keyed[c].eqNullSafe(top[c]) for c in group_by] + [keyed["__v"] == top["__top"]]
    return keyed.join(top, on, "left_semi").select(*df.columns)


def ranked_latest(df: DataFrame, group_by: Sequence[str], key: str, where: Column | None = None) -> DataFrame:
    """Latest rows by rank, ties included; a filter applies before ranking."""
    df = df if where is None else df.where(where)
    order = Window.partitionBy(*group_by).orderBy(F.desc(key))
    return df.withColumn("__rank", F.rank().over(order)).where("__rank = 1").drop("__rank")


def latest_per_group(df: DataFrame, group_by: Sequence[str], created: str, tie: str, before: Column | None = None, after: Column | None = None) -> DataFrame:
    """The one latest row of each group, the highest id among equally late ones.

    ``before`` filters the candidates, ``after`` the winners.
    """
    df = df if before is None else df.where(before)
    order = Window.partitionBy(*group_by).orderBy(F.desc(created), F.desc(tie))
    top = df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")
    return top if after is None else top.where(after)


def oldest_per_group(df: DataFrame, group_by: Sequence[str], created: str, tie: str) -> DataFrame:
    order = Window.partitionBy(*group_by).orderBy(created, tie)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def first_value(df: DataFrame, column: str, group_by: Sequence[str], order: str) -> DataFrame:
    """Gives all rows of a group the value of its first row."""
    return df.withColumn(column, F.first(column).over(Window.partitionBy(*group_by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def first_of_time(df: DataFrame, group_by: Sequence[str], time: str, order: str) -> DataFrame:
    """Of rows that repeat a time the first one."""
    w = Window.partitionBy(*group_by, time).orderBy(order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def overlaps(df: DataFrame, group_by: Sequence[str], start: str, end: str, tie: str) -> DataFrame:
    """Rows that start before the latest end of the rows before them."""
    w = Window.partitionBy(*group_by).orderBy(start, tie).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("covered_until", F.max(end).over(w)).where(F.col(start) <= F.col("covered_until"))


def page(df: DataFrame, order: Sequence[str | Column], offset: int = 0, limit: int | None = None) -> DataFrame:
    """One page in a total order."""
    df = df.orderBy(*order).offset(offset)
    return df if limit is None else df.limit(limit)


def one_per(df: DataFrame, group_by: Sequence[str], order: Sequence[str | Column], count: int = 1) -> DataFrame:
    """The first rows of each group in an order."""
    w = Window.partitionBy(*group_by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= count).drop("__n")


def latest_by_aggregate(df: DataFrame, group_by: Sequence[str], created: str, tie: str) -> DataFrame:
    """``latest_per_group`` without sorting whole groups: one pre-aggregated maximum of each."""
    row = F.max_by(F.struct(*df.columns), F.struct(created, tie)).alias("row")
    return df.groupBy(*group_by).agg(row).select("row.*")


def sorted_catalog(df: DataFrame) -> DataFrame:
    """By instance, then by the text of the start time; fixed fields come last."""
    start = F.col("start_time").cast("string")
    return df.orderBy("instance_id", F.asc_nulls_last(start))


def latest_by_slug(df: DataFrame, slug: str) -> DataFrame:
    """The one dataset of a slug with the highest version, the highest id among equal ones."""
    return df.where(F.col("slug") == slug).orderBy(F.desc("version_key"), F.desc("id")).limit(1)
