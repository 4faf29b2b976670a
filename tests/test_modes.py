"""Modes of variability against a dense decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.operators import modes

LATS, LONS, TIMES = np.linspace(-75, 75, 6), np.arange(0, 360, 45.0), 40


def field(seed):
    rng = np.random.default_rng(seed)
    a = np.outer(np.cos(np.radians(LATS)), np.cos(np.radians(LONS))).ravel()
    b = np.outer(np.sin(np.radians(2 * LATS)), np.ones(len(LONS))).ravel()
    x = np.outer(rng.normal(size=TIMES) * 5, a) + np.outer(rng.normal(size=TIMES) * 2, b) + rng.normal(size=(TIMES, len(a))) * 0.3
    return x - x.mean(axis=0)


def frame(spark, fields):
    rows = [(k, float(la), float(lo), t, float(x[t, i * len(LONS) + j])) for k, x in fields.items() for t in range(TIMES) for i, la in enumerate(LATS) for j, lo in enumerate(LONS)]
    return spark.createDataFrame(rows, "k string, lat double, lon double, time int, value double").repartition(5)


def dense(x, k):
    w = np.repeat(np.cos(np.radians(LATS)), len(LONS))
    _, s, v = np.linalg.svd(x * np.sqrt(w), full_matrices=False)
    share = s**2 / (s**2).sum()
    out = []
    for m in range(k):
        pc = (x * np.sqrt(w)) @ v[m] / s[m] * np.sqrt(TIMES)
        pattern = x.T @ pc / TIMES
        sign = 1 if (pattern * w).sum() >= 0 else -1
        out.append((share[m], pattern * sign, pc * sign))
    return out


@pytest.mark.parametrize("parts", [modes.VALUES, 500])
def test_equal_to_a_dense_decomposition(spark, monkeypatch, parts):
    """Whether the cells are multiplied at once or in parts."""
    monkeypatch.setattr(modes, "VALUES", parts)
    fields = {"a": field(1), "b": field(2)}
    patterns, series = modes.modes(frame(spark, fields), ["k"], 2)
    found = {(r["k"], r["mode"], r["lat"], r["lon"]): r["value"] for r in patterns.collect()}
    rows = series.collect()
    for key, x in fields.items():
        for m, (share, pattern, pc) in enumerate(dense(x, 2), 1):
            got = np.array([found[key, m, la, lo] for la in LATS for lo in LONS])
            assert np.abs(got - pattern).max() < 1e-8 * np.abs(pattern).max()
            own = sorted((r["time"], r["value"], r["share"]) for r in rows if r["k"] == key and r["mode"] == m)
            assert len(own) == TIMES and own[0][2] == pytest.approx(share, rel=1e-9) and np.abs(np.array([v for _, v, _ in own]) - pc).max() < 1e-7


def test_sign_of_a_reference_and_cells_with_gaps(spark):
    x = field(3)
    df = frame(spark, {"a": x}).drop("k")
    (_, pattern, _), *_ = dense(x, 1)
    reference = spark.createDataFrame([(1, float(la), float(lo), -float(pattern[i * len(LONS) + j])) for i, la in enumerate(LATS) for j, lo in enumerate(LONS)], "mode int, lat double, lon double, value double")
    patterns, _ = modes.modes(df, [], 1, reference)
    both = patterns.withColumnRenamed("value", "v").join(reference, ["mode", "lat", "lon"]).collect()
    assert sum(r["v"] * r["value"] for r in both) > 0 and all(r["v"] == pytest.approx(r["value"], abs=1e-6) for r in both)
    gappy, _ = modes.modes(df.where(~((F.col("lat") == float(LATS[0])) & (F.col("lon") == 45) & (F.col("time") == 7))), [], 1)
    assert gappy.count() == len(LATS) * len(LONS) - 1


def test_projection_gives_back_a_series_and_statistics(spark):
    x = field(4)
    df = frame(spark, {"a": x})
    (share, pattern, pc), *_ = dense(x, 1)
    given = spark.createDataFrame([(1, float(la), float(lo), float(pattern[i * len(LONS) + j])) for i, la in enumerate(LATS) for j, lo in enumerate(LONS)], "mode int, lat double, lon double, value double")
    got = {r["time"]: r["value"] for r in modes.projected(df, given, ["k"]).collect()}
    assert np.abs(np.array([got[t] for t in range(TIMES)]) - pc).max() < 1e-8
    found = modes.mode_statistics(df, given, ["k"]).first()
    assert found["amplitude"] == pytest.approx(1.0) and found["share"] == pytest.approx(share, rel=1e-6) and found["correlation"] == pytest.approx(1.0) and found["rmse"] == pytest.approx(0.0, abs=1e-7)


def test_too_many_times_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(modes, "MAX_TIMES", 10)
    with pytest.raises(Exception, match="more than"):
        modes.modes(frame(spark, {"a": field(1)}), ["k"], 1)


def test_anomalies_of_months(spark):
    rows = [("k", y, m, 0.0, 0.0, 10.0 * m + y) for y in (2000, 2001, 2002) for m in (1, 2)] + [("k", 2003, 1, 0.0, 0.0, float("nan"))]
    df = spark.createDataFrame(rows, "k string, year int, month int, lat double, lon double, value double")
    assert sorted((r["time"], r["value"]) for r in modes.deseasonalised(df, ["k"], [2]).collect()) == [(24001, -1.0), (24013, 0.0), (24025, 1.0)]
    assert modes.deseasonalised(df, ["k"]).count() == 6
