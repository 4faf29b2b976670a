"""Named regions on grids: how much of each cell lies in a polygon, and reductions by region.

The share of a cell is exact for edges that are straight in latitude and longitude. What a
polygon has in common with a cell is a sum over its edges: the area between the edge and
the cell's western border, clamped to the cell, counted up for edges that go north and
down for those that go south. So cover is one interval join of edges with cells, over
bins of latitude and only inside a region's bounds, and one pre-aggregated sum; holes
are rings of the other direction. No point is tested and no shape is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators import gridded
from meridian.operators.regrid import BIN, cell_borders, circular
from meridian.sources.shared import written

#: Shares below this are rounding.
LEAST = 1e-9


def edges(polygons: DataFrame) -> DataFrame:
    """region, x1, y1, x2, y2 of ``polygons`` (region, ring: array of struct lat, lon), one row per ring; the last point joins the first.

    Longitudes go on without a jump: a step of more than 180 degrees goes the other way
    round. Edges along a latitude enclose nothing and are left out.
    """
    step = lambda a, b: F.when(b - a > 180, b - 360).when(b - a < -180, b + 360).otherwise(b)
    point = "struct<lat:double,lon:double>"
    start = F.array().cast(f"array<{point}>")
    rings = polygons.select("region", F.expr("transform(ring, p -> struct(double(p.lat) as lat, double(p.lon) as lon))").alias("r")).where("size(r) >= 3")
    ring = F.aggregate("r", start, lambda done, p: F.concat(done, F.array(F.struct(p["lat"].alias("lat"), F.when(F.size(done) == 0, p["lon"]).otherwise(step(F.element_at(done, -1)["lon"], p["lon"])).alias("lon")))))
    rows = rings.select("region", ring.alias("r")).withColumn("k", F.explode(F.sequence(F.lit(0), F.size("r") - 1)))
    a, b = F.get("r", F.col("k")), F.get("r", (F.col("k") + 1) % F.size("r"))
    return rows.select("region", a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")).where("y1 <> y2")


def _beyond(border: Column, a: Column, b: Column, low: Column, high: Column) -> Column:
    """The area east of ``border`` under the line lon = a + b * lat, between two latitudes (radians), on the unit sphere."""
    whole = lambda y: (a - border + b * y) * F.sin(y) + b * F.cos(y)
    cut = F.least(F.greatest((border - a) / F.nullif(b, F.lit(0.0)), low), high)
    return F.when(F.abs(b) < 1e-12, F.greatest(a - border, F.lit(0.0)) * (F.sin(high) - F.sin(low))).when(b > 0, whole(high) - whole(cut)).otherwise(whole(cut) - whole(low))


def grid_cells(df: DataFrame) -> DataFrame:
    """lat, lon, south, north, west, east of the distinct cells of one grid; longitudes from 0 to 360."""
    places = df.select("lat", circular(F.col("lon")).alias("lon")).distinct()
    lats = cell_borders(df, "lat").select("lat", F.col("low").alias("south"), F.col("high").alias("north"))
    lons = cell_borders(df, "lon").select("lon", F.col("low").alias("west"), F.col("high").alias("east"))
    return places.join(lats, "lat").join(lons, "lon").select("lat", "lon", "south", "north", "west", "east")


def region_cover(cells: DataFrame, polygons: DataFrame) -> DataFrame:
    """lat, lon, region, cover: the share of each of ``cells`` (see ``grid_cells``) in each region, where it has one."""
    lines = written(edges(polygons), "edges")
    bounds = lines.groupBy("region").agg(F.min(F.least("x1", "x2")).alias("r_west"), F.max(F.greatest("x1", "x2")).alias("r_east"), F.min(F.least("y1", "y2")).alias("r_south"), F.max(F.greatest("y1", "y2")).alias("r_north"))
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / BIN), F.floor(high / BIN)))
    # cells that a region may touch, each at the turns of the globe at which it may
    turned = cells.withColumn("turn", F.explode(F.array(*(F.lit(t) for t in (-720.0, -360.0, 0.0, 360.0, 720.0)))))
    turned = turned.select("lat", "lon", "south", "north", (F.col("west") + F.col("turn")).alias("west"), (F.col("east") + F.col("turn")).alias("east"), bins(F.col("south"), F.col("north")).alias("bin"))
    touched = turned.join(written(bounds.withColumn("bin", bins(F.col("r_south"), F.col("r_north"))), "bounds"), "bin")
    touched = touched.where("east > r_west and west < r_east and north > r_south and south < r_north").drop("r_west", "r_east", "r_south", "r_north")
    parts = lines.withColumns({"e_south": F.least("y1", "y2"), "e_north": F.greatest("y1", "y2")}).withColumn("bin", bins(F.col("e_south"), F.col("e_north")))
    pairs = touched.join(parts, ["region", "bin"])
    low, high = F.greatest("south", "e_south"), F.least("north", "e_north")
    pairs = pairs.where((high > low) & (F.col("bin") == F.floor(low / BIN)))  # once, in the first bin they share
    slope = (F.col("x2") - F.col("x1")) / F.radians(F.col("y2") - F.col("y1"))
    line = pairs.select("region", "lat", "lon", "south", "north", "west", "east", F.radians(low).alias("l"), F.radians(high).alias("h"), slope.alias("b"), (F.col("x1") - slope * F.radians("y1")).alias("a"), F.signum(F.col("y2") - F.col("y1")).alias("s"))
    between = F.col("s") * (_beyond(F.col("west"), F.col("a"), F.col("b"), F.col("l"), F.col("h")) - _beyond(F.col("east"), F.col("a"), F.col("b"), F.col("l"), F.col("h")))
    size = (F.col("east") - F.col("west")) * (F.sin(F.radians("north")) - F.sin(F.radians("south")))
    found = line.groupBy("region", "lat", "lon", "west").agg(F.sum(between / size).alias("cover"))
    found = found.groupBy("region", "lat", "lon").agg(F.abs(F.sum("cover")).alias("cover"))
    return found.where(F.col("cover") > LEAST).select("lat", "lon", "region", F.least("cover", F.lit(1.0)).alias("cover"))


def with_rest(cover: DataFrame, cells: DataFrame, name: str = "ocean") -> DataFrame:
    """The shares and, as a region of its own, what none of them holds of a cell."""
    held = cover.groupBy("lat", "lon").agg(F.sum("cover").alias("held"))
    rest = cells.select("lat", "lon").join(held, ["lat", "lon"], "left").select("lat", "lon", F.lit(name).alias("region"), (1 - F.coalesce("held", F.lit(0.0))).alias("cover"))
    return cover.unionByName(rest.where(F.col("cover") > LEAST))


def mask(cover: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """lat, lon, fraction: how much of each cell some regions hold together, as ``gridded.masked`` takes it."""
    rows = cover if regions is None else cover.where(F.col("region").isin(*regions))
    return rows.groupBy("lat", "lon").agg(F.least(F.sum("cover"), F.lit(1.0)).alias("fraction"))


def regional_means(df: DataFrame, cover: DataFrame, keys: Sequence[str], time: Sequence[str] = ("year", "month")) -> DataFrame:
    """The mean over each region at each time, cells weighted by their area (the cosine of latitude without one) and by their share."""
    area = F.coalesce("area", gridded.cos_lat()) if "area" in df.columns else gridded.cos_lat()
    rows = df.withColumn("lon", circular(F.col("lon"))).join(cover, ["lat", "lon"])
    return rows.groupBy(*keys, "region", *time).agg(gridded.weighted_mean(F.col("value"), area * F.col("cover")).alias("value"))


def regional_cycle(df: DataFrame, cover: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The annual cycle of each region."""
    return gridded.monthly_climatology(regional_means(df, cover, keys), [*keys, "region"])


def regional_trends(df: DataFrame, cover: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The linear trend of each region's yearly means, months counting alike."""
    yearly = regional_means(df, cover, keys).groupBy(*keys, "region", "year").agg(F.avg("value").alias("value"))
    return gridded.trend(yearly, [*keys, "region"])


def regional_anomalies(df: DataFrame, cover: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Yearly means of each region and their departure from the base years."""
    yearly = regional_means(df, cover, keys).groupBy(*keys, "region", "year").agg(F.avg("value").alias("value"))
    return gridded.anomalies(yearly, [*keys, "region"], first, last)
