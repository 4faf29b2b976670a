"""Outlier screening of scalar metric values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.quantiles import BROADCAST_GROUPS, exact_percentiles
from meridian.sources.shared import written

#: Fixed value: the source whose values are never outliers for being far off.
REFERENCE = "Reference"


@dataclass(frozen=True)
class OutlierPolicy:
    """Interquartile screening: ``method`` is ``iqr`` or ``off``."""

    method: str = "iqr"
    factor: float = 10.0
    min_n: int = 4
    group_by: tuple[str, ...] = ("statistic", "metric")

    def __post_init__(self) -> None:
        if self.method not in ("iqr", "off") or self.min_n < 2:
            raise ValueError("method is iqr or off, and min_n is at least 2")


def is_finite(value: Column) -> Column:
    return F.coalesce(~F.isnan(value) & (F.abs(value) != float("inf")), F.lit(False))


def _in_use(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    """The columns that exist and are not null everywhere."""
    here = [n for n in names if n in df.columns]
    if not here:
        return []
    seen = df.agg(*(F.count(n).alias(n) for n in here)).first()
    return [n for n in here if seen[n]]


def detect(df: DataFrame, policy: OutlierPolicy = OutlierPolicy()) -> DataFrame:
    """``df`` with ``is_outlier`` and ``verification_status``.

    Bounds are ``factor`` times the interquartile range around the quartiles of a
    group: of its sources' means where there are sources, else of its values. Too few
    of them, or no spread, set no bounds. Values that are not finite are outliers in
    any case. Rows with a null in a policy key belong to no group and are no outliers.
    The bounds are worked out when this is called, for which ``df`` is read several times.
    """
    verified = F.when(F.col("is_outlier"), "unverified").otherwise("verified").alias("verification_status")
    if policy.method == "off":
        return df.withColumn("is_outlier", F.lit(False)).select("*", verified)
    keys, sourced = _in_use(df, policy.group_by), bool(_in_use(df, ("source_id",)))
    finite = is_finite(F.col("value"))
    usable = df.where(finite)
    for k in keys:
        usable = usable.where(F.col(k).isNotNull())
    if sourced:
        points = usable.where(F.col("source_id").isNotNull() & (F.col("source_id") != REFERENCE)).groupBy(*keys, "source_id").agg(F.avg("value").alias("x"))
        points = written(points, "source-means")
    else:
        points = usable.withColumn("x", F.col("value"))
    x = F.col("x")
    quartiles = exact_percentiles(points, keys, {"q1": (x, 0.25), "q3": (x, 0.75)})
    sizes = points.groupBy(*keys).agg(F.count("*").alias("points"))
    bounds = quartiles.join(sizes, keys) if keys else quartiles.join(F.broadcast(sizes), F.lit(True))  # one row
    spread = (F.col("q3") - F.col("q1")) * policy.factor
    bounds = bounds.where((F.col("points") >= policy.min_n) & (F.col("q3") > F.col("q1"))).select(*keys, (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper"))
    bounds = written(bounds, "outlier-bounds")
    few = bounds.count() <= BROADCAST_GROUPS  # rows stay where they are unless the groups are many
    joined = df.join(F.broadcast(bounds) if few else bounds, keys, "left") if keys else df.join(F.broadcast(bounds), F.lit(True), "left")  # one row
    beyond = F.coalesce((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")), F.lit(False))
    if sourced:
        beyond &= ~F.col("source_id").eqNullSafe(F.lit(REFERENCE))
    grouped = F.lit(True)
    for k in keys:
        grouped &= F.col(k).isNotNull()
    return joined.withColumn("is_outlier", grouped & (~finite | beyond)).select(*df.columns, "is_outlier", verified)
