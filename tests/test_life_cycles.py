"""Events with ties and gaps, smoothing, metrics; branch windows; CMIP7 names; the runner's queries have their own file."""

import pytest
from pyspark.sql import functions as F

from meridian.operators import enso
from meridian.plans import branches
from meridian.sources.paths import cmip7_from_name


def series(spark, values, k="a"):
    return spark.createDataFrame([(k, t, v) for t, v in values], "k string, time long, value double")


def test_events_with_gaps_and_ties(spark):
    values = [(t, 0.6) for t in range(5)] + [(t, 0.9) for t in (6, 7)] + [(t, -0.5) for t in range(10, 16)] + [(16, None), (17, float("nan"))] + [(t, 1.0) for t in (20, 21, 22, 23)] + [(24, 0.4), (25, 1.0)]
    found = sorted(tuple(r) for r in enso.events(series(spark, values), ["k"]).collect())
    assert found == [("a", "cold", 10, 15, 6, 10, -0.5), ("a", "warm", 0, 4, 5, 0, 0.6)]  # equal values: the first is the peak
    assert enso.events(series(spark, values), ["k"], least=4).count() == 3 and enso.events(series(spark, []), ["k"]).count() == 0
    course = {(r["kind"], r["lag"]): (r["value"], r["n"]) for r in enso.composites(series(spark, values), enso.events(series(spark, values), ["k"]), ["k"], 1, 6).collect()}
    assert course["warm", 0] == (0.6, 1) and ("warm", 5) not in course and course["warm", 6] == (0.9, 1) and ("cold", 6) not in course and ("cold", -1) not in course


def test_smoothing_and_trends(spark):
    line = series(spark, [(t, 3.0 * t + 1) for t in range(12)] + [(20, 61.0)])
    assert all(abs(r["value"]) < 1e-9 for r in enso.detrended(line, ["k"]).collect())
    means = {r["time"]: r["value"] for r in enso.smoothed(line, ["k"], 5).collect()}
    assert set(means) == set(range(2, 10)) and means[4] == pytest.approx(13.0)
    with pytest.raises(ValueError, match="odd"):
        enso.smoothed(line, ["k"], 4)
    assert [r["value"] for r in enso.detrended(series(spark, [(3, 5.0)]), ["k"]).collect()] == [0.0]


def test_metrics_against_a_reference(spark):
    course = [(t, (1.0 if t % 40 < 8 else -0.2) + 0.01 * (t % 12)) for t in range(240)]
    model = series(spark, [(t, 2 * v) for t, v in course], "m")
    found = {r["metric"]: r for r in enso.metric_matrix(model, series(spark, course).drop("k"), ["k"]).collect()}
    assert found["amplitude"]["error"] == pytest.approx(100.0) and found["asymmetry"]["error"] == pytest.approx(0.0, abs=1e-6) and found["warm_events"]["model"] == 6.0
    assert found["seasonality"]["error"] == pytest.approx(0.0, abs=1e-6) and found["lifecycle"]["error"] > 0
    same = {r["metric"]: r["error"] for r in enso.metric_matrix(series(spark, course), series(spark, course).drop("k"), ["k"]).collect()}
    assert same["lifecycle"] == 0.0


def test_windows_of_a_branch(spark):
    """A parent that lasts on: the run's start in 1850 is year 101 of the parent; an offset reaches back."""
    children = spark.createDataFrame([("r", 36500.0, 0.0, "days since 1850-01-01", "noleap", "1850-01-01"), ("lost", None, 0.0, "days since 1850-01-01", "noleap", "1850-01-01")], "k string, branch_time_in_parent double, branch_time_in_child double, time_units string, calendar string, start_time string")
    parents = spark.createDataFrame([("r", "days since 0001-01-01", "noleap"), ("lost", "days since 0001-01-01", "noleap")], "k string, time_units string, calendar string")
    assert [tuple(r) for r in branches.branch_windows(children, parents, ["k"], *branches.WINDOWS["ecs"]).collect()] == [("r", 1850, 1999, 101, 250)]
    (zec,) = branches.branch_windows(children, parents, ["k"], *branches.WINDOWS["zec"]).collect()
    assert tuple(zec) == ("r", 1850, 1949, 91, 110)
    windows = branches.branch_windows(children, parents, ["k"], *branches.WINDOWS["tcr"])
    run = spark.createDataFrame([("r", 1850 + n, 14.0 + 0.01 * n + 0.02 * n) for n in range(145)], "k string, year int, value double")
    control = spark.createDataFrame([("r", 101 + n, 14.0 + 0.01 * n) for n in range(-15, 150)], "k string, year int, value double")
    assert branches.transient(run, control, windows, ["k"]).first()["tcr"] == pytest.approx(0.02 * 69.5)
    assert branches.departures(run, control, windows, ["k"]).count() == 140
    warm, ten = run.withColumn("value", F.lit(15.0)), run.withColumn("value", F.lit(10.0))
    assert branches.per_emissions(warm, control.withColumn("value", F.lit(14.0)), ten, windows, ["k"]).first()["tcre"] == pytest.approx(1.0 / 1400)
    twenty = branches.branch_windows(children, parents, ["k"], *branches.WINDOWS["zec"])
    assert branches.commitment(run, control, twenty, ["k"]).first()["zec"] == pytest.approx(14 + 0.03 * 49.5 - (14 + 0.01 * -0.5))


def test_names_of_eight_and_nine_parts(spark):
    head, folder = "tas_tavg-u_mon_glb_gn_SRC_hist_r1i1p1f1", "/d/CMIP7/CMIP/INST/SRC/hist/r1i1p1f1/glb/mon/tas/tavg-u/gn/v2"
    names = [f"{folder}/{head}.nc", f"{folder}/{head}_200001-200012.nc", f"{folder}/{head}_x_y.nc", f"/SRC/{head}.nc", f"{head}.nc", f"{folder}/a_b.nc"]
    rows = cmip7_from_name(spark.createDataFrame([(n,) for n in names], "path string")).collect()
    assert [r["invalid_asset"] is None for r in rows] == [True, True, False, False, False, False]
    assert rows[0]["instance_id"] == rows[1]["instance_id"] == "CMIP7.CMIP.INST.SRC.hist.r1i1p1f1.glb.mon.tas.tavg-u.gn.v2" and rows[0]["start_time"] is None and rows[1]["start_time"] == "2000-01-01"
