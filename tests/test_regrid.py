"""Conservative regridding: borders, overlaps, conservation, gaps, and scores between grids."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meridian.operators import gridded, regrid


def grid(spark, lats, lons, value, keys=("k",), year=2000):
    rows = [(*keys, year, 1, float(a), float(o), value(a, o)) for a in lats for o in lons]
    return spark.createDataFrame(rows, f"{', '.join(f'k{i} string' for i in range(len(keys)))}, year int, month int, lat double, lon double, value double")


def axis(n, low, high):
    step = (high - low) / n
    return [low + step * (k + 0.5) for k in range(n)]


def borders(spark, values, name):
    df = spark.createDataFrame([(float(v),) for v in values], f"{name} double")
    return sorted((r[name], round(r["low"], 9), round(r["high"], 9)) for r in regrid.cell_borders(df, name).collect())


def test_borders(spark):
    assert borders(spark, [-89, 0, 80], "lat") == [(-89.0, -90.0, -44.5), (0.0, -44.5, 40.0), (80.0, 40.0, 90.0)]
    assert borders(spark, [10], "lat") == [(10.0, -90.0, 90.0)] and borders(spark, [10], "lon") == [(10.0, 0.0, 360.0)]
    assert borders(spark, [0, 90, 180, 270], "lon") == [(0.0, -45.0, 45.0), (90.0, 45.0, 135.0), (180.0, 135.0, 225.0), (270.0, 225.0, 315.0)]
    assert borders(spark, [-90, 0, 90, 180], "lon")[0] == (0.0, -45.0, 45.0)  # the same places
    assert borders(spark, [10, 20, 30], "lon") == [(10.0, 5.0, 15.0), (20.0, 15.0, 25.0), (30.0, 25.0, 35.0)]


@pytest.mark.parametrize("there", [((9, 18), 0.0), ((36, 72), 0.0), ((17, 23), 0.0), ((12, 10), -180.0)])
def test_area_sums_are_conserved(spark, there):
    rng = random.Random(4)
    (n, m), first = there
    source = grid(spark, axis(18, -90, 90), axis(30, 0, 360), lambda a, o: rng.uniform(200, 300))
    target = grid(spark, axis(n, -90, 90), axis(m, first, first + 360), lambda a, o: 0.0)
    cells = regrid.cell_borders(source, "lat").select("lat", regrid.measure(F.col("low"), F.col("high"), "lat").alias("s"))
    before = source.join(cells, "lat").agg(F.sum(F.col("value") * F.col("s") * F.lit(2 * math.pi / 30)), F.sum(F.col("s") * F.lit(2 * math.pi / 30))).first()
    found = regrid.regrid(source, target, ["k0", "year", "month"], ["k0"])
    after = found.agg(F.sum(F.col("value") * F.col("area")), F.sum("area"), F.count("*"), F.min("cover")).first()
    assert after[0] == pytest.approx(before[0], rel=1e-12) and after[1] == pytest.approx(4 * math.pi, rel=1e-12) and before[1] == pytest.approx(4 * math.pi, rel=1e-12)
    assert after[2] == n * m and after[3] == pytest.approx(1.0)


def test_same_grid_stays(spark):
    source = grid(spark, axis(6, -90, 90), axis(8, 0, 360), lambda a, o: a * 2 + o)
    found = {(r["lat"], r["lon"]): r["value"] for r in regrid.regrid(source, source, ["year"]).collect()}
    assert len(found) == 48 and all(v == pytest.approx(a * 2 + o) for (a, o), v in found.items())


def test_gaps_count_for_nothing(spark):
    source = grid(spark, [-45, 45], [90, 270], lambda a, o: None if a < 0 and o == 90 else float("nan") if a < 0 else float(a + o))
    target = grid(spark, [-60, 0, 60], [180], lambda a, o: 0.0)
    found = {r["lat"]: (r["value"], r["cover"]) for r in regrid.regrid(source, target, ["year"]).collect()}
    assert set(found) == {0.0, 60.0} and found[60.0] == pytest.approx((225.0, 1.0)) and found[0.0][0] == pytest.approx(225.0) and found[0.0][1] == pytest.approx(0.5)
    assert regrid.regrid(source.limit(0), target, ["year"]).count() == 0


def test_several_grids_and_regions_of_a_grid(spark):
    one = grid(spark, axis(6, -90, 90), axis(12, 0, 360), lambda a, o: 1.0, ("a",))
    two = grid(spark, axis(9, -90, 90), axis(5, -180, 180), lambda a, o: 2.0, ("b",))
    part = grid(spark, [20, 30], [350, 0, 10], lambda a, o: 3.0, ("c",))
    target = grid(spark, axis(18, -90, 90), axis(36, 0, 360), lambda a, o: 0.0)
    found = regrid.regrid(one.unionByName(two).unionByName(part), target, ["k0", "year"], ["k0"])
    by = {r["k0"]: r for r in found.groupBy("k0").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"), F.sum("area").alias("area")).collect()}
    assert [(by[k]["low"], by[k]["high"]) for k in "abc"] == [pytest.approx((v, v)) for v in (1.0, 2.0, 3.0)]
    assert by["a"]["n"] == by["b"]["n"] == 648 and by["a"]["area"] == pytest.approx(4 * math.pi)
    assert by["c"]["n"] == 3 * 4 and by["c"]["area"] == pytest.approx((math.sin(math.radians(35)) - math.sin(math.radians(15))) * math.radians(30))
    with pytest.raises(ValueError, match="no keys"):
        regrid.regrid(one, target, ["year"], ["k0"])


def test_scores_between_grids(spark):
    def field(a, o):
        return 250 + 30 * math.cos(math.radians(a)) + math.sin(math.radians(o))

    def months(lats, lons, shift):
        rows = [("m", y, m, float(a), float(o), field(a, o) + shift + 5 * math.cos(2 * math.pi * (m - 7) / 12) + (y - 2000)) for y in (2000, 2001, 2002) for m in range(1, 13) for a in lats for o in lons]
        return spark.createDataFrame(rows, "k string, year int, month int, lat double, lon double, value double")

    reference = months(axis(6, -90, 90), axis(12, 0, 360), 0.0).drop("k")
    same = gridded.scores(*regrid.on_common_grid(months(axis(18, -90, 90), axis(24, 0, 360), 0.0), reference, ["k"]), ["k"]).first()
    far = gridded.scores(*regrid.on_common_grid(months(axis(18, -90, 90), axis(24, 0, 360), 9.0), reference, ["k"]), ["k"]).first()
    assert abs(same["bias"]) < 1.5 and same["bias_score"] > 0.7 > far["bias_score"] and far["bias"] == pytest.approx(same["bias"] + 9.0)
    assert same["season_score"] == far["season_score"] == pytest.approx(1.0) and same["interannual_score"] > 0.95 and same["spatial_score"] > 0.95


def test_benchmarks_solve(spark):
    """A land benchmark with a relationship and a reference, one from a registry, and one of the ocean."""
    from meridian.plans import benchmarks
    from meridian.plans.requirement import solve

    assert len(benchmarks.benchmarks()) == 13 and len({d.slug for d in benchmarks.benchmarks()}) == 13
    columns = "instance_id string, source_id string, member_id string, experiment_id string, grid_label string, variable_id string, table_id string, frequency string, version string"

    def row(source, variable, table="Lmon", frequency="mon", experiment="historical"):
        return (f"{source}.{variable}", source, "r1", experiment, "gn", variable, table, frequency, "v1")

    fixed = [row("M", v, "fx", "fx") for v in ("areacella", "sftlf", "volcello", "areacello", "sftof")]
    models = spark.createDataFrame([row("M", "gpp"), row("M", "pr", "Amon"), row("M", "tas", "Amon"), row("N", "gpp"), row("M", "mrsos"), row("M", "tos", "Omon"), *fixed], columns).withColumn("row_id", F.monotonically_increasing_id())
    observed = spark.createDataFrame([("o1", "WECANN-1-0", "gpp", "gn", "v20250902"), ("o2", "WOA-23", "thetao", "gn", "v20251024")], "instance_id string, source_id string, variable_id string, grid_label string, version string").withColumn("row_id", F.monotonically_increasing_id())
    found = {(r["diagnostic"], tuple(sorted(r["slugs"]["cmip6"]))) for r in solve(benchmarks.benchmarks(), {"cmip6": models, "obs4mips": observed}).collect()}
    assert found == {
        ("gpp-wecann", ("M.areacella", "M.gpp", "M.pr", "M.sftlf", "M.tas")), ("gpp-fluxnet2015", ("M.areacella", "M.gpp", "M.sftlf")), ("gpp-fluxnet2015", ("N.gpp",)),
        ("mrsos-wangmao", ("M.areacella", "M.mrsos", "M.sftlf")), ("thetao-woa2023-surface", ("M.areacello", "M.sftof", "M.tos", "M.volcello")),
    }
