"""Life cycles of an index: trends taken out, smoothing, events, composites, profiles, and metrics.

Series are long: keys, time (months counted from any start), value. A month that is not
there breaks a run and leaves no mean around it; nothing is carried over a gap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.gridded import cos_lat, weighted_mean

#: How far an index must be from 0, and for how many months, to be an event.
THRESHOLD, LEAST_MONTHS = 0.5, 5
#: The equatorial Pacific, whose profiles are compared, in degrees.
PACIFIC = {"lat": (-5.0, 5.0), "lon": (150.0, 270.0)}
PACIFIC_NORTH_SOUTH = {"lat": (-15.0, 15.0), "lon": (150.0, 270.0)}


def _known(df: DataFrame, value: str = "value") -> DataFrame:
    return df.where(F.col(value).isNotNull() & ~F.isnan(value))


def detrended(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each series without its least-squares line; one of a single time without its mean."""
    rows = _known(df)
    fit = rows.groupBy(*keys).agg(F.regr_slope("value", "time").alias("__slope"), F.avg("time").alias("__t"), F.avg("value").alias("__v"))
    line = F.col("__v") + F.coalesce("__slope", F.lit(0.0)) * (F.col("time") - F.col("__t"))
    joined = rows.join(fit, list(keys)) if keys else rows.join(F.broadcast(fit), F.lit(True))  # one row
    return joined.withColumn("value", F.col("value") - line).drop("__slope", "__t", "__v")


def smoothed(df: DataFrame, keys: Sequence[str], months: int = 5) -> DataFrame:
    """Centred running means over an odd number of months, where all of them are there."""
    if months % 2 == 0:
        raise ValueError("a centred mean needs an odd number of months")
    half = months // 2
    w = Window.partitionBy(*keys).orderBy("time").rangeBetween(-half, half)
    rows = _known(df).withColumns({"__m": F.avg("value").over(w), "__n": F.count("value").over(w)})
    return rows.where(F.col("__n") == months).withColumn("value", F.col("__m")).drop("__m", "__n")


def events(df: DataFrame, keys: Sequence[str], threshold: float = THRESHOLD, least: int = LEAST_MONTHS) -> DataFrame:
    """keys, kind, start, end, months, peak_time, peak: runs of consecutive months at or beyond a threshold.

    ``kind`` is warm above and cold below. Runs shorter than ``least`` months are none. The
    peak is the value farthest from 0, the first of equal ones. A time has one value.
    """
    kind = F.when(F.col("value") >= threshold, "warm").when(F.col("value") <= -threshold, "cold")
    beyond = _known(df).withColumn("kind", kind).where("kind is not null")
    run = F.col("time") - F.row_number().over(Window.partitionBy(*keys, "kind").orderBy("time"))
    rows = beyond.withColumn("__run", run)
    found = rows.groupBy(*keys, "kind", "__run").agg(
        F.min("time").alias("start"), F.max("time").alias("end"), F.count("*").alias("months"), F.max_by(F.struct("time", "value"), F.struct(F.abs("value"), -F.col("time"))).alias("p")
    )
    return found.where(F.col("months") >= least).select(*keys, "kind", "start", "end", "months", F.col("p.time").alias("peak_time"), F.col("p.value").alias("peak"))


def composites(df: DataFrame, found: DataFrame, keys: Sequence[str], before: int = 12, after: int = 12, place: Sequence[str] = ()) -> DataFrame:
    """keys, kind, lag, place, value, n: means over all events of a kind, by months from their peak.

    ``df`` may be the index or a field (``place``: lat, lon). Months that an event lacks do not count.
    """
    lags = F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("lag")
    wanted = found.select(*keys, "kind", "peak_time", lags).withColumn("time", F.col("peak_time") + F.col("lag"))
    rows = _known(df).join(wanted, [*keys, "time"])
    return rows.groupBy(*keys, "kind", "lag", *place).agg(F.avg("value").alias("value"), F.count("*").alias("n"))


def zonal_profile(df: DataFrame, keys: Sequence[str], box: Mapping[str, tuple[float, float]] = PACIFIC) -> DataFrame:
    """keys, lon, value: means along the equator, over the latitudes of a box by their cosine."""
    rows = df.where(F.col("lat").between(*box["lat"]) & F.col("lon").between(*box["lon"]))
    return rows.groupBy(*keys, "lon").agg(weighted_mean(F.col("value"), cos_lat()).alias("value"))


def meridional_profile(df: DataFrame, keys: Sequence[str], box: Mapping[str, tuple[float, float]] = PACIFIC_NORTH_SOUTH) -> DataFrame:
    """keys, lat, value: means over the longitudes of a box."""
    rows = df.where(F.col("lat").between(*box["lat"]) & F.col("lon").between(*box["lon"]))
    return rows.groupBy(*keys, "lat").agg(F.avg(F.nanvl("value", F.lit(None).cast("double"))).alias("value"))


def profile_error(model: DataFrame, reference: DataFrame, keys: Sequence[str], axis: str) -> DataFrame:
    """keys, value: the root mean square difference of two profiles over the places that both have."""
    rows = model.join(reference.select(axis, F.col("value").alias("__r")), axis)
    return rows.groupBy(*keys).agg(F.sqrt(F.avg(F.pow(F.col("value") - F.col("__r"), 2))).alias("value"))


def index_metrics(df: DataFrame, keys: Sequence[str], threshold: float = THRESHOLD, least: int = LEAST_MONTHS) -> DataFrame:
    """keys, metric, value of an index whose ``time`` counts months from a January.

    ``amplitude``: its spread. ``asymmetry``: its skewness. ``seasonality``: the spread of
    November to January over that of March to May. ``persistence``: its correlation with
    the month before. ``warm_events``, ``cold_events``, and ``duration``: months of an event on average.
    """
    month = F.pmod(F.col("time"), F.lit(12))
    w = Window.partitionBy(*keys).orderBy("time").rangeBetween(-1, -1)
    rows = _known(df).withColumns({"__before": F.first("value").over(w), "__winter": F.when(month.isin(10, 11, 0), F.col("value")), "__spring": F.when(month.isin(2, 3, 4), F.col("value"))})
    spread = lambda c: F.stddev_pop(c)
    base = rows.groupBy(*keys).agg(
        spread("value").alias("amplitude"), F.skewness("value").alias("asymmetry"), (spread("__winter") / F.nullif(spread("__spring"), F.lit(0.0))).alias("seasonality"), F.corr("value", "__before").alias("persistence"),
    )
    counts = events(df, keys, threshold, least).groupBy(*keys).agg(F.count(F.when(F.col("kind") == "warm", 1)).alias("warm_events"), F.count(F.when(F.col("kind") == "cold", 1)).alias("cold_events"), F.avg("months").alias("duration"))
    both = base.join(counts, list(keys), "left") if keys else base.join(F.broadcast(counts), F.lit(True), "left")  # one row
    both = both.fillna(0, ["warm_events", "cold_events"])
    names = ("amplitude", "asymmetry", "seasonality", "persistence", "warm_events", "cold_events", "duration")
    return both.select(*keys, F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))).alias("m")).select(*keys, "m.*")


def metric_matrix(model: DataFrame, reference: DataFrame, keys: Sequence[str], lifecycle: int = 12) -> DataFrame:
    """keys, metric, model, reference, error: every metric of models against those of a reference, which has no keys.

    The error is the difference over the reference's size, in percent, where that is not 0.
    ``lifecycle`` is the root mean square difference of the composites of warm events, by lag.
    """
    a = index_metrics(model, keys).withColumnRenamed("value", "model")
    b = index_metrics(reference, []).withColumnRenamed("value", "reference")
    rows = a.join(b, "metric").withColumn("error", F.when(F.col("reference") != 0, 100 * (F.col("model") - F.col("reference")) / F.abs("reference")))
    own = composites(model, events(model, keys), keys, lifecycle, lifecycle).where("kind = 'warm'").select(*keys, "lag", "value")
    other = composites(reference, events(reference, []), [], lifecycle, lifecycle).where("kind = 'warm'").select("lag", "value")
    cycle = profile_error(own, other, keys, "lag").select(*keys, F.lit("lifecycle").alias("metric"), F.lit(None).cast("double").alias("model"), F.lit(None).cast("double").alias("reference"), F.col("value").alias("error"))
    return rows.select(*keys, "metric", "model", "reference", "error").unionByName(cycle)


def month_number(year: Column, month: Column) -> Column:
    """Months since January of year 0."""
    return year * 12 + month - 1
