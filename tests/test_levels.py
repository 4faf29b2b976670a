"""Levels, seasons, and annual cycles against references."""

import math

import pytest

from meridian.operators import levels
from meridian.plans import annual_cycle
from meridian.plans.requirement import solve


def test_interpolation_is_linear_in_log_pressure(spark):
    rows = [("a", p, 10 * math.log(p)) for p in (100.0, 300.0, 500.0, 1000.0)] + [("b", 500.0, 7.0), ("c", 400.0, None), ("c", 600.0, 1.0), ("d", 850.0, float("nan")), ("d", 900.0, 3.0), ("e", None, 1.0), ("e", -5.0, 1.0)]
    found = {(r["k"], r["lev"]): r["value"] for r in levels.at_levels(spark.createDataFrame(rows, "k string, lev double, value double"), ["k"], [850.0, 500.0, 50.0]).collect()}
    assert found["a", 850.0] == pytest.approx(10 * math.log(850)) and found["a", 500.0] == pytest.approx(10 * math.log(500)) and found["a", 50.0] is None
    assert found["b", 500.0] == 7.0 and found["b", 850.0] is None and found["c", 500.0] is None and found["d", 850.0] is None
    assert ("e", 500.0) not in found or found["e", 500.0] is None


def test_seasons_weigh_months_by_length(spark):
    df = spark.createDataFrame([("k", m, float(m)) for m in range(1, 13)] + [("gap", m, 1.0) for m in range(1, 12)], "k string, month int, value double")
    found = {(r["k"], r["season"]): r["value"] for r in levels.seasonal(df, ["k"], "noleap").collect()}
    assert found["k", "DJF"] == pytest.approx((12 * 31 + 31 + 2 * 28) / 90) and found["k", "JJA"] == pytest.approx((6 * 30 + 7 * 31 + 8 * 31) / 92)
    assert found["k", "AC"] == pytest.approx(sum(m * d for m, d in zip(range(1, 13), levels.MONTH_DAYS["noleap"], strict=True)) / 365)
    assert found["gap", "DJF"] is None and found["gap", "AC"] is None and found["gap", "MAM"] == 1.0
    even = {r["season"]: r["value"] for r in levels.seasonal(df.where("k = 'k'"), ["k"], "360_day").collect()}
    assert even["DJF"] == pytest.approx(5.0)


def test_sixteen_variables_solve_in_two_eras(spark):
    d = annual_cycle.annual_cycle()
    assert len(d.requirements) == 32
    six = spark.createDataFrame([("m1", "M", "r1", "historical", "gn", "ta", "mon", 1), ("m2", "M", "r1", "piControl", "gn", "ta", "mon", 2), ("m3", "M", "r1", "amip", "gn", "pr", "mon", 3)], "instance_id string, source_id string, member_id string, experiment_id string, grid_label string, variable_id string, frequency string, row_id long")
    clim = spark.createDataFrame([("c1", "ERA-5", "ta", 1), ("c2", "GPCP-3-3", "pr", 2), ("c3", "GPCP-3-3", "ta", 3)], "instance_id string, source_id string, variable_id string, row_id long")
    found = [(tuple(r["slugs"]["pmp_climatology"]), tuple(r["slugs"]["cmip6"])) for r in solve([d], {"cmip6": six, "pmp_climatology": clim}).collect()]
    assert sorted(found) == [(("c1",), ("m1",)), (("c2",), ("m3",))]


def test_statistics_of_a_known_difference(spark):
    """A model that is 2 warmer everywhere, on a finer grid and on other levels."""
    def field(lat, month, p):
        return lat + month + math.log(p)

    def made(n, m, levs, shift, key):
        return [(*key, 2000, mo, -90 + 180 * (i + 0.5) / n, 360 * (j + 0.5) / m, p, (math.log(p) + mo + (0 if i < n / 2 else 10)) + shift) for i in range(n) for j in range(m) for mo in range(1, 13) for p in levs]

    schema = "year int, month int, lat double, lon double, lev double, value double"
    model = spark.createDataFrame(made(12, 8, (10000.0, 30000.0, 100000.0), 2.0, ("M",)), "k string, " + schema)
    reference = spark.createDataFrame(made(6, 4, (15000.0, 60000.0, 90000.0), 0.0, ()), schema)
    found = {(r["level"], r["region"], r["season"], r["statistic"]): r["value"] for r in annual_cycle.annual_cycle_statistics(model, reference, ["k"], "ta").collect()}
    assert len(found) == 2 * 4 * 5 * 9
    for level in (20000.0, 85000.0):
        for region in annual_cycle.BANDS:
            assert found[level, region, "DJF", "bias_xy"] == pytest.approx(2.0) and found[level, region, "AC", "rms_xy"] == pytest.approx(2.0) and found[level, region, "JJA", "rmsc_xy"] == pytest.approx(0.0, abs=1e-5)
        assert found[level, "global", "AC", "cor_xy"] == pytest.approx(1.0) and found[level, "NHEX", "AC", "cor_xy"] is None
        assert found[level, "global", "AC", "std_xy"] == pytest.approx(5.0)
    assert found[20000.0, "SHEX", "JJA", "mean-obs_xy"] == pytest.approx(math.log(20000.0) + (6 * 30 + 7 * 31 + 8 * 31) / 92) and field(0, 0, 1.0) == 0
