"""Modes of variability: leading patterns of a field, and how strongly others show them.

The field is anomalies in long form (keys, lat, lon, time, value; area or else the cosine of
latitude weighs a cell). Its covariance over time, a matrix of times by times, is a sum
over cells: parts of the cells are multiplied where they are, only sums of products meet,
and the matrix of one key, of at most ``MAX_TIMES`` squared numbers, is decomposed in one
task. Patterns come back as one product per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.gridded import cos_lat
from meridian.sources.shared import written

#: Times of one field; a matrix of so many squared is some 70 MB.
MAX_TIMES = 3000
#: Values that are multiplied at a time.
VALUES = 2_000_000


def weight(df: DataFrame) -> Column:
    return F.coalesce("area", cos_lat()) if "area" in df.columns else cos_lat()


def deseasonalised(df: DataFrame, keys: Sequence[str], months: Sequence[int] = ()) -> DataFrame:
    """Monthly anomalies: each cell's values minus their mean of the same month over all years; only some months if named.

    ``time`` counts months from year 0.
    """
    rows = df.where(F.col("value").isNotNull() & ~F.isnan("value"))
    rows = rows.where(F.col("month").isin(*months)) if months else rows
    own = [*keys, "lat", "lon", "month"]
    usual = rows.groupBy(*own).agg(F.avg("value").alias("__usual"))
    return rows.join(usual, own).withColumns({"value": F.col("value") - F.col("__usual"), "time": F.col("year") * 12 + F.col("month") - 1}).drop("__usual")


def _series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, lat, lon, w, x: each cell's values in the order of time; only cells with a value at every time of their key, and some area."""
    points = F.sort_array(F.collect_list(F.struct("time", "value")))  # MAX_TIMES at most, see below
    cells = df.withColumn("__w", weight(df)).groupBy(*keys, "lat", "lon").agg(F.first("__w").alias("w"), points.alias("p"))
    times = df.select(*keys, "time").distinct().groupBy(*keys).agg(F.count("*").alias("__times"))
    times = times.withColumn("__times", F.when(F.col("__times") <= MAX_TIMES, F.col("__times")).otherwise(F.raise_error(F.lit(f"more than {MAX_TIMES} times")).cast("long")))
    rows = cells.join(F.broadcast(times), list(keys)) if keys else cells.join(F.broadcast(times), F.lit(True))  # one row per key
    return rows.where((F.size("p") == F.col("__times")) & (F.col("w") > 0)).select(*keys, "lat", "lon", "w", "__times", F.transform("p", lambda v: v["value"]).alias("x"))


def _products(keys: Sequence[str]):
    """The sums of products of one part of a key's cells, above the diagonal."""

    def multiply(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["x"].to_numpy()) * np.sqrt(part["w"].to_numpy())[:, None]
        gram = x.T @ x
        i, j = np.triu_indices(len(gram))
        return pd.DataFrame({**{k: [part[k].iloc[0]] * len(i) for k in keys}, "i": i, "j": j, "g": gram[i, j]})

    return multiply


def _decomposed(keys: Sequence[str], k: int):
    def solve(gram: pd.DataFrame) -> pd.DataFrame:
        n = int(gram["j"].max()) + 1
        full = np.zeros((n, n))
        full[gram["i"], gram["j"]] = gram["g"]
        full += np.triu(full, 1).T
        values, vectors = np.linalg.eigh(full)
        order = np.argsort(values)[::-1][: min(k, n)]
        total = values.sum()
        rows = [(m + 1, float(values[o]), float(values[o] / total) if total > 0 else None, vectors[:, o].tolist()) for m, o in enumerate(order)]
        out = pd.DataFrame(rows, columns=["mode", "eigenvalue", "share", "pc"])
        for c in keys:
            out[c] = gram[c].iloc[0]
        return out[[*keys, "mode", "eigenvalue", "share", "pc"]]

    return solve


def modes(df: DataFrame, keys: Sequence[str], k: int = 1, reference: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The leading ``k`` modes of each key: patterns (keys, mode, lat, lon, value) and series (keys, mode, share, time, value).

    A series has spread 1, and a pattern is what the field does with it in its own unit.
    The sign is the one with which a pattern goes along with ``reference`` (mode, lat, lon,
    value), or without one that of a positive sum over the area. Keys must not be null.
    """
    keys = list(keys)
    cells = written(_series(df, keys), "cell-series")
    head = cells.agg(F.count("*").alias("n"), F.max("__times").alias("times")).first()
    parts = max(1, -(-(head["n"] * (head["times"] or 0)) // VALUES))
    kinds = dict(df.dtypes)
    own = "".join(f"{c} {kinds[c]}, " for c in keys)
    salted = cells.withColumn("__part", F.pmod(F.xxhash64("lat", "lon"), F.lit(parts)))
    products = salted.groupBy(*keys, "__part").applyInPandas(_products(keys), f"{own}i int, j int, g double")
    gram = products.groupBy(*keys, "i", "j").agg(F.sum("g").alias("g"))
    found = written(gram.groupBy(*keys).applyInPandas(_decomposed(keys, k), f"{own}mode int, eigenvalue double, share double, pc array<double>"), "modes")  # k rows per key
    n = F.size("pc")
    scaled = found.withColumn("pc", F.transform("pc", lambda v: v * F.sqrt(n)))
    both = cells.drop("__times").join(F.broadcast(scaled), keys) if keys else cells.drop("__times").join(F.broadcast(scaled), F.lit(True))
    loaded = both.select(*keys, "mode", "lat", "lon", "w", (F.aggregate(F.zip_with("x", "pc", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v) / n).alias("value"))
    loaded = written(loaded, "patterns")
    if reference is None:
        along = loaded.groupBy(*keys, "mode").agg(F.sum(F.col("value") * F.col("w")).alias("__along"))
    else:
        other = reference.select("mode", "lat", "lon", F.col("value").alias("__r"))
        along = loaded.join(other, ["mode", "lat", "lon"]).groupBy(*keys, "mode").agg(F.sum(F.col("value") * F.col("__r") * F.col("w")).alias("__along"))
    sign = along.select(*keys, "mode", F.when(F.col("__along") < 0, -1.0).otherwise(1.0).alias("__sign"))
    patterns = loaded.join(sign, [*keys, "mode"], "left").select(*keys, "mode", "lat", "lon", (F.col("value") * F.coalesce("__sign", F.lit(1.0))).alias("value"))
    signed = scaled.join(sign, [*keys, "mode"], "left").withColumn("pc", F.transform("pc", lambda v: v * F.coalesce("__sign", F.lit(1.0))))
    times = df.select(*keys, "time").distinct().groupBy(*keys).agg(F.sort_array(F.collect_list("time")).alias("__t"))  # MAX_TIMES at most
    rows = signed.join(times, keys) if keys else signed.join(F.broadcast(times), F.lit(True))  # one row
    series = rows.select(*keys, "mode", "share", F.posexplode("pc").alias("__k", "value"), "__t").select(*keys, "mode", "share", F.get("__t", F.col("__k")).alias("time"), "value")
    return patterns, series


def projected(df: DataFrame, pattern: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How strongly a field shows a pattern (mode, lat, lon, value) at each time: keys, mode, time, value.

    The least-squares multiple of the pattern over the cells that have both, weighted by area.
    """
    w = weight(df)
    other = pattern.select("mode", "lat", "lon", F.col("value").alias("__e"))
    rows = df.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("__w", w).join(other, ["lat", "lon"])
    sums = rows.groupBy(*keys, "mode", "time").agg(F.sum(F.col("__w") * F.col("value") * F.col("__e")).alias("__ae"), F.sum(F.col("__w") * F.col("__e") * F.col("__e")).alias("__ee"))
    return sums.where("__ee > 0").select(*keys, "mode", "time", (F.col("__ae") / F.col("__ee")).alias("value"))


def mode_statistics(df: DataFrame, pattern: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, mode, amplitude, share, correlation, rmse: a model's own form of an observed pattern.

    The model's field is projected onto the pattern; what each cell does with that series,
    brought to spread 1, is the model's pattern, held against the observed one over the area.
    ``share`` is the part of the field's variance that goes with the series.
    """
    series = written(projected(df, pattern, keys), "projected")
    spread = series.groupBy(*keys, "mode").agg(F.stddev_pop("value").alias("amplitude"), F.avg("value").alias("__mean"))
    unit = series.join(spread, [*keys, "mode"]).where("amplitude > 0").select(*keys, "mode", "time", ((F.col("value") - F.col("__mean")) / F.col("amplitude")).alias("__s"), "amplitude")
    w = weight(df)
    rows = df.withColumn("__w", w).join(unit, [*keys, "time"])
    cells = rows.groupBy(*keys, "mode", "lat", "lon").agg(F.avg(F.col("value") * F.col("__s")).alias("m"), F.var_pop("value").alias("v"), F.first("__w").alias("w"), F.first("amplitude").alias("amplitude"))
    both = cells.join(pattern.select("mode", "lat", "lon", F.col("value").alias("o")), ["mode", "lat", "lon"], "left")
    c = lambda x: F.sum(F.when(F.col("o").isNotNull(), F.col("w") * x))
    m, o = F.col("m"), F.col("o")
    total = c(F.lit(1.0))
    found = both.groupBy(*keys, "mode").agg(
        F.first("amplitude").alias("amplitude"), (F.sum(F.col("w") * m * m) / F.nullif(F.sum(F.col("w") * F.col("v")), F.lit(0.0))).alias("share"),
        (c(m) / total).alias("__m"), (c(o) / total).alias("__o"), (c(m * m) / total).alias("__mm"), (c(o * o) / total).alias("__oo"), (c(m * o) / total).alias("__mo"), F.sqrt(c((m - o) * (m - o)) / total).alias("rmse"),
    )
    spread_m, spread_o = F.col("__mm") - F.col("__m") * F.col("__m"), F.col("__oo") - F.col("__o") * F.col("__o")
    r = F.when((spread_m > 0) & (spread_o > 0), (F.col("__mo") - F.col("__m") * F.col("__o")) / F.sqrt(spread_m * spread_o))
    return found.select(*keys, "mode", "amplitude", "share", r.alias("correlation"), "rmse")
