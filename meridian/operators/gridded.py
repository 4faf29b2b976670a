"""Reductions of gridded data in long form: year, month, lat, lon [, lev], value, area and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weights count only where there is a value; a null weight is 0; null without any weight."""
    known = value.isNotNull() & ~F.isnan(value)
    w = F.when(known, F.coalesce(weight, F.lit(0.0)))
    total = F.sum(w)
    return F.when(total != 0, F.sum(F.when(known, value * F.coalesce(weight, F.lit(0.0)))) / total)


def annual_then_global(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unweighted mean over a year's months in each cell, then the area-weighted mean over the cells."""
    cells = df.groupBy(*keys, "year", "lat", "lon").agg(F.avg(F.nanvl("value", F.lit(None).cast("double"))).alias("value"), F.first("area", ignorenulls=True).alias("area"))
    return cells.groupBy(*keys, "year").agg(weighted_mean(F.col("value"), F.col("area")).alias("value"))


def global_then_annual(df: DataFrame, keys: Sequence[str], weight: Column | None = None) -> DataFrame:
    """The weighted mean over the cells in each month, then the mean over a year's months."""
    weight = F.col("area") if weight is None else weight
    months = df.groupBy(*keys, "year", "month").agg(weighted_mean(F.col("value"), weight).alias("value"))
    return months.groupBy(*keys, "year").agg(F.avg("value").alias("value"))


def cos_lat() -> Column:
    return F.cos(F.radians("lat"))


def bias(model: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Model minus reference on the years that both have."""
    other = reference.select("year", F.col("value").alias("reference"))
    return model.join(other, "year").select(*keys, "year", F.col("value").alias("model"), "reference", (F.col("value") - F.col("reference")).alias("bias"))


def bias_statistics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean bias and root mean square error; without common years there are no rows."""
    return rows.groupBy(*keys).agg(F.avg("bias").alias("mean_bias"), F.sqrt(F.avg(F.pow("bias", 2))).alias("rmse"), F.count("*").alias("years"))


def coarsen(df: DataFrame, keys: Sequence[str], resolution: float = 0.5) -> DataFrame:
    """Area-weighted block means on cells of ``resolution`` degrees.

    A grid stays as it is when the diagonal of its mean spacing has that length already.
    """
    mean = {c: (F.max(c) - F.min(c)) / F.nullif(F.count_distinct(c) - 1, F.lit(0)) for c in ("lat", "lon")}
    diagonal = F.sqrt(sum((F.pow(F.coalesce(x, F.lit(0.0)), F.lit(2)) for x in mean.values()), F.lit(0.0)))
    spacing = df.groupBy(*keys).agg((diagonal >= resolution).alias("__coarse")).withColumnsRenamed({k: f"__key_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    places = {c: F.when(F.col("__coarse"), F.col(c)).otherwise((F.floor(F.col(c) / resolution) + 0.5) * resolution) for c in ("lat", "lon")}
    rows = df.join(spacing, same).withColumns(places)
    return rows.groupBy(*keys, "lat", "lon").agg(weighted_mean(F.col("value"), F.col("area")).alias("value"), F.sum("area").alias("area"))


def coarsen_time(df: DataFrame, keys: Sequence[str], months: int = 12) -> DataFrame:
    """Means over blocks of whole months."""
    block = F.floor((F.col("year") * 12 + F.col("month") - 1) / months)
    return df.groupBy(*keys, block.alias("block")).agg(F.avg("value").alias("value"))


def valid_times(df: DataFrame, keys: Sequence[str], time: Sequence[str] = ("year", "month")) -> DataFrame:
    """Without the time steps in which every value is missing."""
    seen = df.groupBy(*keys, *time).agg(F.count(F.nanvl("value", F.lit(None).cast("double"))).alias("n")).where("n > 0").drop("n")
    return df.join(seen, [*keys, *time], "left_semi")


def concatenated(df: DataFrame, keys: Sequence[str], order: str, time: Sequence[str] = ("year", "month")) -> DataFrame:
    """Several files' time steps in one: of repeated steps in a cell, the first file's."""
    w = Window.partitionBy(*keys, *time, "lat", "lon").orderBy(order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def masked(df: DataFrame, mask: DataFrame, least: float = 0.5) -> DataFrame:
    """Only the cells of a mask (lat, lon, fraction) with at least some fraction."""
    return df.join(mask.where(F.col("fraction") >= least).select("lat", "lon"), ["lat", "lon"], "left_semi")


def monthly_climatology(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, "month").agg(F.avg("value").alias("value"))


def zonal_mean(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, "lat").agg(F.avg("value").alias("value"))


def anomalies(df: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Yearly values minus their mean over the base years."""
    base = df.where(F.col("year").between(first, last)).groupBy(*keys).agg(F.avg("value").alias("base"))
    return df.join(base, list(keys)).withColumn("anomaly", F.col("value") - F.col("base")).drop("base")


def trend(df: DataFrame, keys: Sequence[str], time: str = "year", value: str = "value") -> DataFrame:
    """Slope and intercept of the least-squares line of each group."""
    return df.groupBy(*keys).agg(F.regr_slope(value, time).alias("slope"), F.regr_intercept(value, time).alias("intercept"), F.count(value).alias("n"))


def joint_histogram(df: DataFrame, keys: Sequence[str], x: str, y: str, x_edges: tuple[float, float, int], y_edges: tuple[float, float, int]) -> DataFrame:
    """Counts over a grid of equal bins; values outside are left out."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    low_x, high_x, n_x = x_edges
    low_y, high_y, n_y = y_edges
    bx, by = F.floor((F.col(x) - low_x) / ((high_x - low_x) / n_x)), F.floor((F.col(y) - low_y) / ((high_y - low_y) / n_y))
    rows = rows.select(*keys, bx.cast("int").alias("x_bin"), by.cast("int").alias("y_bin")).where(F.col("x_bin").between(0, n_x - 1) & F.col("y_bin").between(0, n_y - 1))
    return rows.groupBy(*keys, "x_bin", "y_bin").agg(F.count("*").alias("n"))


def nino_index(df: DataFrame, keys: Sequence[str], lat: tuple[float, float], lon: tuple[float, float]) -> DataFrame:
    """Monthly anomalies of a box's mean from its own climatology."""
    box = df.where(F.col("lat").between(*lat) & F.col("lon").between(*lon))
    months = box.groupBy(*keys, "year", "month").agg(weighted_mean(F.col("value"), F.coalesce("area", cos_lat())).alias("value"))
    usual = months.groupBy(*keys, "month").agg(F.avg("value").alias("usual"))
    return months.join(usual, [*keys, "month"]).select(*keys, "year", "month", (F.col("value") - F.col("usual")).alias("value"))


def regressed_on(field: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slope and correlation of each cell's values on an index (keys, year, month, value): a teleconnection pattern."""
    rows = field.join(index.select(*keys, "year", "month", F.col("value").alias("index")), [*keys, "year", "month"])
    return rows.groupBy(*keys, "lat", "lon").agg(F.regr_slope("value", "index").alias("slope"), F.corr("value", "index").alias("correlation"), F.count("*").alias("n"))


def scores(model: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bias, error, seasonal, interannual and spatial scores of a model against a reference, each from 0 to 1.

    Both are on one grid; bring others there with ``regrid.on_common_grid``. A cell's bias
    score is exp(-|bias| / the reference's spread), its error score exp(-centred error /
    the same); cells count by area. The seasonal score falls with the months between the
    two climatologies' maxima. The interannual score is exp(-|relative error|) of the
    spread of what is left without the climatology. The spatial score is Taylor's, of the
    two fields of means: their correlation R and ratio of spreads s give
    2 (1 + R) / (s + 1/s)^2. Without a common cell and time the scores are null.
    """
    other = reference.select("lat", "lon", "year", "month", F.col("value").alias("reference"))
    rows = model.join(other, ["lat", "lon", "year", "month"])
    own = [*keys, "lat", "lon"]
    weight = F.coalesce("area", cos_lat()) if "area" in model.columns else cos_lat()
    cell = rows.groupBy(*own).agg(
        F.avg("value").alias("m"), F.avg("reference").alias("r"), F.stddev_pop("reference").alias("spread"), F.avg(F.pow(F.col("value") - F.col("reference"), 2)).alias("square"),
        *([F.first("area", ignorenulls=True).alias("area")] if "area" in model.columns else []),
    ).withColumn("weight", weight)
    months = rows.groupBy(*own, "month").agg(F.avg("value").alias("m"), F.avg("reference").alias("r"), F.count("*").alias("n"), F.sum(F.pow("value", 2)).alias("m2"), F.sum(F.pow("reference", 2)).alias("r2"))
    left = {c: F.sqrt(F.greatest(F.sum(F.col(f"{c}2") - F.col("n") * F.pow(c, 2)) / F.sum("n"), F.lit(0.0))) for c in "mr"}  # around the climatology
    year = months.groupBy(*own).agg((F.max_by("month", F.struct("m", "month")) - F.max_by("month", F.struct("r", "month"))).alias("shift"), left["m"].alias("m_left"), left["r"].alias("r_left"))
    apart = F.least(F.abs("shift"), 12 - F.abs("shift"))
    cell = cell.where("spread > 0").withColumn("bias", F.col("m") - F.col("r")).join(year, own)
    error = F.sqrt(F.greatest(F.col("square") - F.pow("bias", 2), F.lit(0.0)))
    cell = cell.withColumns({
        "bias_score": F.exp(-F.abs("bias") / F.col("spread")), "rmse_score": F.exp(-error / F.col("spread")), "season_score": (1 + F.cos(2 * F.pi() * apart / 12)) / 2,
        "interannual_score": F.when(F.col("r_left") > 1e-6 * F.col("spread"), F.exp(-F.abs(F.col("m_left") - F.col("r_left")) / F.col("r_left"))),
    })
    w = F.col("weight")
    moments = {f"__{n}": F.sum(w * x) for n, x in (("w", F.lit(1.0)), ("m", F.col("m")), ("r", F.col("r")), ("mm", F.pow("m", 2)), ("rr", F.pow("r", 2)), ("mr", F.col("m") * F.col("r")))}
    names = ("bias", "bias_score", "rmse_score", "season_score", "interannual_score")
    found = cell.groupBy(*keys).agg(*(weighted_mean(F.col(c), w).alias(c) for c in names), *(v.alias(k) for k, v in moments.items()))
    spread = {c: F.sqrt(F.greatest(F.col(f"__{c}{c}") / F.col("__w") - F.pow(F.col(f"__{c}") / F.col("__w"), 2), F.lit(0.0))) for c in "mr"}
    joint = F.col("__mr") / F.col("__w") - F.col("__m") * F.col("__r") / F.pow("__w", F.lit(2))
    ratio = F.when((spread["m"] > 0) & (spread["r"] > 0), spread["m"] / spread["r"])
    taylor = 2 * (1 + joint / (spread["m"] * spread["r"])) / F.pow(ratio + 1 / ratio, F.lit(2))
    return found.withColumn("spatial_score", F.when(ratio.isNotNull(), taylor)).select(*keys, *names, "spatial_score")
