"""Sinks, digests, providers and failures of checks."""

import hashlib

from pyspark.sql import functions as F

from meridian.operators import aggregates, bundles
from meridian.plans import doctor, regression, requirement
from meridian.sources import catalogs, paths


def test_bundle_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 1.5), ("a", "y", None), ("b", "x", 2.0)], "metric string, region string, value double")
    catalogs.write_bundle(bundles.nest(rows, ["metric", "region"]), f"{tmp_path}/bundle", ["metric", "region"])
    read = catalogs.read_bundle(spark, f"{tmp_path}/bundle/part-*.txt")
    assert read.first()["json_structure"] == ["metric", "region"]
    back = {(r.metric, r.region): r.value for r in bundles.flatten(read, "results", ["metric", "region"]).collect()}
    assert back[("a", "x")] == 1.5 and back[("b", "x")] == 2.0 and back[("a", "y")] != back[("a", "y")]


def test_outputs_round_trip(spark, tmp_path):
    rows = [("plot", "one", "1.png", "One", "first"), ("html", "index", "i.html", "Index", "start")]
    outputs = spark.createDataFrame(rows, "output_type string, short_name string, filename string, long_name string, description string")
    catalogs.write_outputs(outputs, f"{tmp_path}/outputs")
    back = catalogs.read_outputs(spark, f"{tmp_path}/outputs/part-*.txt")
    assert {(r.output_type, r.short_name, r.filename, r.long_name) for r in back.collect()} == {r[:4] for r in rows}


def test_digests(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.txt").write_text("no")
    found = regression.digests(spark, str(tmp_path), ["a.json", "missing.json"]).collect()
    assert [tuple(r) for r in found] == [("a.json", hashlib.sha256(b"{}").hexdigest())]


def test_no_provider_installed():
    assert requirement.installed_providers() == {}


def test_a_failing_check_ends_no_other(spark):
    def broken(tables):
        return tables["registry"].select(F.lit("broken").alias("check"), F.lit("info").alias("severity"), F.raise_error(F.lit("no")).cast("string").alias("subject"), F.lit("m").alias("message"))

    doctor.CHECKS["broken"] = broken
    try:
        registry = spark.createDataFrame([("a", "s"), ("b", "s")], "registry string, source_id string")
        found = doctor.run_checks({"registry": registry}, names=["broken", "overlapping-registries"]).collect()
    finally:
        del doctor.CHECKS["broken"]
    assert sorted((r.check, r.severity) for r in found) == [("broken", "error"), ("overlapping-registries", "warning")]


def test_numbered_in_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert [r.n for r in aggregates.numbered(df, ["x"], "n").orderBy("x").collect()] == list(range(1000))
    assert aggregates.numbered(df.where("x < 0"), ["x"], "n").count() == 0


def test_vertical_levels_and_times(spark):
    row = spark.createDataFrame([({"lev": 7, "plev": 19}, [0.0, 31.0]), ({"lat": 3}, None)], "d map<string,int>, t array<double>")
    bounds = paths.time_bounds(F.col("t"), F.lit("days since 2000-01-01"), F.lit("360_day"))
    got = row.select(paths.vertical_levels(F.col("d")).alias("n"), bounds["end_time"]["mo"].alias("m"), bounds["end_time"]["d"].alias("d")).collect()
    assert [tuple(r) for r in got] == [(7, 2, 2), (1, None, None)]
