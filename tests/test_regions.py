"""Cover of cells by polygons against many points, tilings, holes, the date line, and reductions by region."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meridian.operators import gridded, regions

RING = "region string, ring array<struct<lat:double,lon:double>>"


def polygons(spark, given):
    return spark.createDataFrame([(n, [(float(a), float(o)) for a, o in ring]) for n, ring in given], RING)


def grid(spark, n, m, first=0.0):
    return spark.createDataFrame([(-90 + 180 * (i + 0.5) / n, first + 360 * (j + 0.5) / m) for i in range(n) for j in range(m)], "lat double, lon double")


def covers(spark, cells, given):
    return {(r["region"], round(r["lat"], 6), round(r["lon"], 6)): r["cover"] for r in regions.region_cover(regions.grid_cells(cells), polygons(spark, given)).collect()}


def inside(ring, lat, lon):
    odd = False
    for (a, o), (c, p) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (a > lat) != (c > lat) and lon < o + (p - o) * (lat - a) / (c - a):
            odd = not odd
    return odd


def test_cover_of_a_crooked_polygon_by_points(spark):
    """Equal-area points of every cell, tested one by one."""
    ring = [(-50, 20), (-10, 75), (35, 60), (60, 100), (20, 130), (5, 110), (-45, 140)]
    found = covers(spark, grid(spark, 9, 18), [("r", ring)])
    assert len(found) > 20
    for i in range(9):
        for j in range(18):
            low, high = math.sin(math.radians(-90 + 20 * i)), math.sin(math.radians(-70 + 20 * i))
            hits = sum(inside(ring, math.degrees(math.asin(low + (high - low) * (u + 0.5) / 60)), 20 * j + 20 * (v + 0.5) / 60) for u in range(60) for v in range(60))
            assert found.get(("r", -80.0 + 20 * i, 10.0 + 20 * j), 0.0) == pytest.approx(hits / 3600, abs=0.012)


def test_total_area_whichever_way_round_and_holes(spark):
    """A box over the date line, given in both directions and with either longitudes; and with a hole."""
    box = [(10, 170), (10, -160), (40, -160), (40, 170)]
    hole = [(20, -175), (30, -175), (30, -165), (20, -165)]
    cells = grid(spark, 12, 24, -180.0)
    both = polygons(spark, [("a", box), ("b", box[::-1]), ("c", [(a, o % 360) for a, o in box]), ("d", box), ("d", [*hole])])
    found = regions.region_cover(regions.grid_cells(cells), both)
    area = F.radians(F.lit(15.0)) * (F.sin(F.radians(F.col("lat") + 7.5)) - F.sin(F.radians(F.col("lat") - 7.5)))
    sums = {r["region"]: r["a"] for r in found.groupBy("region").agg(F.sum(F.col("cover") * area).alias("a")).collect()}
    whole = math.radians(30) * (math.sin(math.radians(40)) - math.sin(math.radians(10)))
    gap = math.radians(10) * (math.sin(math.radians(30)) - math.sin(math.radians(20)))
    assert [sums[k] for k in "abc"] == [pytest.approx(whole, rel=1e-9)] * 3 and sums["d"] == pytest.approx(whole - gap, rel=1e-9)


def tiling(n=4, m=5, slant=25.0):
    return [(f"t{i}.{j}", [(-90 + 180 / n * i, 360 / m * j), (-90 + 180 / n * i, 360 / m * (j + 1)), (-90 + 180 / n * (i + 1), 360 / m * (j + 1) + slant), (-90 + 180 / n * (i + 1), 360 / m * j + slant)]) for i in range(n) for j in range(m)]


@pytest.mark.parametrize("shape", [(7, 11, 0.0), (24, 36, -180.0)])
def test_shares_of_a_tiling_sum_to_one(spark, shape):
    cells = regions.grid_cells(grid(spark, *shape))
    cover = regions.region_cover(cells, polygons(spark, tiling()))
    sums = cover.groupBy("lat", "lon").agg(F.sum("cover").alias("s")).collect()
    assert len(sums) == shape[0] * shape[1] and all(r["s"] == pytest.approx(1.0, abs=1e-9) for r in sums)
    some = regions.with_rest(cover.where("region <> 't1.2'"), cells)
    sums = some.groupBy("lat", "lon").agg(F.sum("cover").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0, abs=1e-9) for r in sums)
    rest = {(r["lat"], r["lon"]): r["cover"] for r in some.where("region = 'ocean'").collect()}
    assert rest == {(r["lat"], r["lon"]): pytest.approx(r["cover"], abs=1e-9) for r in cover.where("region = 't1.2'").collect()}
    assert regions.region_cover(cells, polygons(spark, [("point", [(0, 0), (1, 1)])])).count() == 0


def test_reductions_by_region(spark):
    """Means weigh cells by share; a trend and a cycle come out as they were put in."""
    rng = random.Random(1)
    noise = {}
    rows = []
    for i in range(6):
        for j in range(8):
            lat, lon = -75.0 + 30 * i, 22.5 + 45 * j
            noise[lat, lon] = rng.uniform(0, 10)
            rows += [("k", y, m, lat, lon, noise[lat, lon] + 0.25 * (y - 2000) + 3 * math.cos(m)) for y in range(2000, 2004) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "k string, year int, month int, lat double, lon double, value double")
    cells = regions.grid_cells(df)
    cover = regions.region_cover(cells, polygons(spark, tiling()))
    trends = regions.regional_trends(df, cover, ["k"]).collect()
    assert len(trends) == 20 and all(r["slope"] == pytest.approx(0.25) and r["n"] == 4 for r in trends)
    shares = {}
    for r in cover.collect():
        shares.setdefault(r["region"], []).append((noise[r["lat"], r["lon"]], r["cover"] * math.cos(math.radians(r["lat"]))))
    base = {g: sum(v * w for v, w in xs) / sum(w for _, w in xs) for g, xs in shares.items()}
    for r in regions.regional_cycle(df, cover, ["k"]).collect():
        assert r["value"] == pytest.approx(base[r["region"]] + 0.375 + 3 * math.cos(r["month"]))
    off = regions.regional_anomalies(df, cover, ["k"], 2000, 2001).where("year = 2003").collect()
    assert all(r["anomaly"] == pytest.approx(0.625) for r in off) and len(off) == 20
    land = regions.mask(cover, ["t0.0", "t0.1"])
    assert {r["fraction"] > 0.5 for r in land.join(gridded.masked(df, land, 0.5).select("lat", "lon").distinct(), ["lat", "lon"]).collect()} == {True}
