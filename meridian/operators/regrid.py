"""Conservative regridding: cells of one grid as areas of another.

A rectangular grid is two axes, so the share of a cell in another is the product of two
overlaps: of sines of latitude and of longitudes. Each axis' overlaps are an interval
join over bins, a small table of (from, to, weight) pairs; applying them is one join per
axis and one pre-aggregated sum. Longitudes go round: 359.5 and -0.5 are one place.

Data are in long form: keys, lat, lon, value. Where a cell has no value (null or NaN) its
area does not count; ``cover`` is the share of a target cell's area that had values. Only
cells with some cover are given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.sources.shared import written

#: Degrees of a bin of the interval join.
BIN = 2.0
#: A gap between longitudes that is so many times as wide as the others is no part of the grid.
OPEN = 1.5


def circular(lon: Column) -> Column:
    """A longitude from 0 to 360."""
    return F.pmod(lon, F.lit(360.0))


def _same(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    found = F.lit(True)
    for k in keys:
        found &= left[k].eqNullSafe(right[k])
    return found


def cell_borders(df: DataFrame, axis: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, axis, low, high: the cells of the distinct places of an axis, halfway to their neighbours.

    The first and the last reach as far beyond their place as to the neighbour inside,
    latitudes not beyond a pole. Longitudes meet halfway all round the globe, unless one gap is wider than
    ``OPEN`` times the mean of the others: there the grid ends, as at the border of a region.
    A single place is a cell of the whole axis.
    """
    places = df.select(*keys, (circular(F.col(axis)) if axis == "lon" else F.col(axis)).alias(axis)).where(F.col(axis).isNotNull()).distinct()
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # the places of an axis
    line = whole.orderBy(axis)
    x = F.col(axis)
    steps = places.withColumns({"__before": x - F.lag(axis).over(line), "__after": F.lead(axis).over(line) - x}).withColumns({
        "__first": F.min(axis).over(whole), "__last": F.max(axis).over(whole), "__n": F.count("*").over(whole),
    })
    if axis == "lon":
        round_before = F.coalesce("__before", x + 360.0 - F.col("__last"))
        round_after = F.coalesce("__after", F.col("__first") + 360.0 - x)
        steps = steps.withColumns({"__before": round_before, "__after": round_after}).withColumn("__widest", F.max("__after").over(whole))
        border = F.when(F.col("__widest") > OPEN * (360.0 - F.col("__widest")) / F.greatest(F.col("__n") - 1, F.lit(1)), F.col("__widest")).otherwise(F.lit(float("inf")))
        before = F.when(F.col("__before") >= border, F.col("__after")).otherwise(F.col("__before"))
        after = F.when(F.col("__after") >= border, F.col("__before")).otherwise(F.col("__after"))
        alone = (F.lit(0.0), F.lit(360.0))
    else:
        before, after = F.coalesce("__before", "__after"), F.coalesce("__after", "__before")
        alone = (F.lit(-90.0), F.lit(90.0))
    low, high = x - before / 2, x + after / 2
    if axis == "lat":
        low, high = F.greatest(low, F.lit(-90.0)), F.least(high, F.lit(90.0))
    one = F.col("__n") == 1
    return steps.select(*keys, axis, F.when(one, alone[0]).otherwise(low).alias("low"), F.when(one, alone[1]).otherwise(high).alias("high"))


def _binned(cells: DataFrame, axis: str, keys: Sequence[str], prefix: str) -> DataFrame:
    """The parts of cells between 0 and 360 (or the poles), once for each bin that they touch."""
    low, high = F.col("low"), F.col("high")
    if axis == "lon":
        turns = F.filter(F.array(*(F.struct(F.greatest(low + t, F.lit(0.0)).alias("low"), F.least(high + t, F.lit(360.0)).alias("high")) for t in (-360.0, 0.0, 360.0))), lambda p: p["high"] > p["low"])
    else:
        turns = F.array(F.struct(low.alias("low"), high.alias("high")))
    parts = cells.select(*(F.col(k).alias(f"{prefix}{k}") for k in keys), F.col(axis).alias(f"{prefix}{axis}"), F.explode(turns).alias("p"))
    parts = parts.select(*(c for c in parts.columns if c != "p"), F.col("p.low").alias(f"{prefix}low"), F.col("p.high").alias(f"{prefix}high"))
    bins = F.sequence(F.floor(F.col(f"{prefix}low") / BIN), F.floor(F.col(f"{prefix}high") / BIN))
    return parts.withColumn("__bin", F.explode(bins))


def measure(low: Column, high: Column, axis: str) -> Column:
    """The share of the globe between two borders of an axis, times a constant: sines of latitude, or radians."""
    return F.sin(F.radians(high)) - F.sin(F.radians(low)) if axis == "lat" else F.radians(high - low)


def overlaps(source: DataFrame, target: DataFrame, axis: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, axis, to, weight: how much of each target cell a source cell covers, in ``measure``.

    Both are tables of cells (axis, low, high), the source's with the keys of its grids.
    """
    a, b = _binned(source, axis, keys, "__a_"), _binned(target, axis, (), "__b_")
    low, high = F.greatest("__a_low", "__b_low"), F.least("__a_high", "__b_high")
    pairs = a.join(b, "__bin").where((high > low) & (F.col("__bin") == F.floor(low / BIN)))  # once, in the first bin they share
    weights = pairs.groupBy(*(F.col(f"__a_{k}").alias(k) for k in keys), F.col(f"__a_{axis}").alias(axis), F.col(f"__b_{axis}").alias("to")).agg(F.sum(measure(low, high, axis)).alias("weight"))
    return weights.where("weight > 0")


def regrid(df: DataFrame, target: DataFrame, keys: Sequence[str], grid: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Values on the grid of ``target`` (lat, lon), conserved in area: keys, lat, lon, value, area, cover.

    ``keys`` include the time; ``grid`` are those of them that grids may differ by.
    ``area`` is that of the covered part of a cell on the unit sphere, so that the sum of
    value times area over all cells is that of the source.
    """
    extra = [k for k in grid if k not in keys]
    if extra:
        raise ValueError(f"grids by columns that are no keys: {extra}")
    rows = df.select(*keys, "lat", circular(F.col("lon")).alias("lon"), F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("__v")).where("__v is not null")
    tables = {}
    for axis in ("lat", "lon"):
        cells = cell_borders(target, axis)
        found = overlaps(cell_borders(df, axis, grid), cells, axis, grid).join(cells.select(F.col(axis).alias("to"), measure(F.col("low"), F.col("high"), axis).alias("size")), "to")
        names = {"to": f"__{axis}", "weight": f"__w_{axis}", "size": f"__s_{axis}", **{k: f"__{axis}_{k}" for k in grid}}
        tables[axis] = written(found, f"overlaps-{axis}").withColumnsRenamed(names)  # some pairs per place of an axis
    for axis, weights in tables.items():
        on = rows[axis] == weights[axis]
        for k in grid:
            on &= rows[k].eqNullSafe(weights[f"__{axis}_{k}"])
        rows = rows.join(weights, on).drop(weights[axis], *(f"__{axis}_{k}" for k in grid))
    w = F.col("__w_lat") * F.col("__w_lon")
    sums = rows.groupBy(*keys, F.col("__lat").alias("lat"), F.col("__lon").alias("lon")).agg(F.sum(F.col("__v") * w).alias("__sum"), F.sum(w).alias("area"), F.first(F.col("__s_lat") * F.col("__s_lon")).alias("__size"))
    return sums.select(*keys, "lat", "lon", (F.col("__sum") / F.col("area")).alias("value"), "area", F.least(F.col("area") / F.col("__size"), F.lit(1.0)).alias("cover"))


def on_common_grid(model: DataFrame, reference: DataFrame, keys: Sequence[str], target: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Both on one grid: the given one, else the reference's. ``model`` has keys, year, month; ``reference`` year, month."""
    target = reference.select("lat", "lon").distinct() if target is None else target
    time = ["year", "month"]
    return regrid(model, target, [*keys, *time], keys), regrid(reference, target, time)
