"""Functions, results, ledger, bundles, grids, sources and streaming on small tables."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from meridian.functions import calendars as cal
from meridian.functions import catalog as fn
from meridian.operators import aggregates, bundles, gridded
from meridian.operators.outliers import OutlierPolicy, detect
from meridian.plans import diagnostics, doctor, ledger, upsert
from meridian.plans.results import Results, ValueFilter, datasets, values_frame
from meridian.sources import catalogs, files, paths
from meridian.streaming import ingest


def column(spark, kind, values, make):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}")
    return [r.y for r in df.select("k", make(F.col("x")).alias("y")).orderBy("k").collect()]


# ------------------------------------------------------------------ functions


def test_versions(spark):
    assert column(spark, "string", ["v2", "v10", "latest", "v1x", None], fn.version_key) == [2, 10, -1, -1, -1]
    assert column(spark, "string", ["/a/v1/b/v20200101/x.nc", "/a/b.nc"], fn.version_from_path) == ["v20200101", "v0"]
    assert column(spark, "string", ["ab abcd abc", "x"], lambda x: fn.longest_match(x, "a[a-z]+")) == ["abcd", None]


@pytest.mark.parametrize("calendar, text, back", [
    ("360_day", "2000-02-30 01:02:03", "2000-02-30 01:02:03"), ("standard", "2000-02-30", None), ("noleap", "2000-02-29", None), ("standard", "2000-02-29", "2000-02-29 00:00:00"), ("all_leap", "2001-02-29", "2001-02-29 00:00:00"),
    ("julian", "1900-02-29", "1900-02-29 00:00:00"), ("standard", "1900-02-29", None), ("standard", "2000-12-31 23:59:59", "2000-12-31 23:59:59"), ("noleap", "1850-12-31", "1850-12-31 00:00:00"), ("standard", "nonsense", None),
])
def test_calendars_round_trip(spark, calendar, text, back):
    def there_and_back(x):
        return cal.time_text(cal.from_ordinal(cal.ordinal(cal.parse_time(x, F.lit(calendar)), F.lit(calendar)), F.lit(calendar)))

    assert column(spark, "string", [text], there_and_back) == [back]


def test_ordinals_agree_with_dates(spark):
    days = [dt.date(1, 1, 1) + dt.timedelta(days=97 * k) for k in range(7000)]
    got = column(spark, "string", [d.strftime("%Y-%m-%d").zfill(10) for d in days], lambda x: cal.day_number(cal.parse_time(x, F.lit("standard")), F.lit("standard")))
    assert got == [d.toordinal() - 1 for d in days]


def test_decoding_and_shifting(spark):
    day = lambda units, calendar: column(spark, "double", [59.5], lambda x: cal.time_text(cal.decode_time(x, F.lit(units), F.lit(calendar))))
    assert day("days since 2000-01-01", "standard") == ["2000-02-29 12:00:00"] and day("days since 2000-01-01", "noleap") == ["2000-03-01 12:00:00"] and day("hours since 2000-01-01 06:00", "360_day") == ["2000-01-03 17:30:00"]
    moved = lambda months: column(spark, "string", ["2001-01-31"], lambda x: cal.time_text(cal.shift_months(cal.parse_time(x, F.lit("standard")), months, F.lit("standard"))))
    assert moved(1) == ["2001-02-28 00:00:00"] and moved(-13) == ["1999-12-31 00:00:00"]
    with pytest.raises(TypeError):
        cal.at_or_after(F.col("x"), decade=1)


def test_date_ranges(spark):
    got = column(spark, "string", ["2000-2001", "200001-200112", "20000105-20010203", "200001050600-200102030600", "2000-200112", "x"], cal.parse_date_range)
    assert [(r.start_time, r.end_time) for r in got] == [("2000-01-01", "2001-12-30"), ("2000-01-01", "2001-12-30"), ("2000-01-05", "2001-02-03"), ("2000-01-05", "2001-02-03"), (None, None), (None, None)]


def test_small_functions(spark):
    assert column(spark, "string", ["12D", "1.5", "x", None], fn.branch_time) == [12.0, 1.5, None, None]
    assert column(spark, "double", [1234567.89, 0.000123456789, -2.0], fn.seven_figures) == [1234568.0, 0.0001234568, -2.0]
    assert column(spark, "double", [float("nan"), float("inf"), 1.0], fn.finite_or_null) == [None, None, 1.0]
    assert column(spark, "string", ["r1i2p3f4", "r1"], lambda x: fn.variant_indices(x)["p"]) == [3, None]
    assert column(spark, "string", ["7", "r7", "x"], lambda x: fn.variant_part(x, "r")) == ["r7", "r7", None]
    assert column(spark, "string", ["tas [K]", "tas"], fn.without_units) == ["tas", "tas"]
    assert column(spark, "string", ["bias_global_land", "bias"], fn.name_and_region) == [("bias", "global_land"), ("bias", None)]
    assert column(spark, "string", ["Amon", "fx", "6hrLev", "zzz"], fn.guessed_frequency) == ["mon", "fx", "6hr", "mon"]
    assert column(spark, "string", ["/a/b/c"], lambda x: fn.rewritten_path(x, {"/a": "<A>", "/a/b": "<B>"})) == ["<B>/c"]
    assert column(spark, "string", [" kg  m**-2 ", "unitless"], fn.clean_units) == ["kg m-2", "1"]
    with pytest.raises(Exception, match="unknown table"):
        column(spark, "string", ["zzz"], fn.table_frequency)
    assert fn.wildcard(["a_1_x.nc", "a_22_x.nc"]) == "a_*_x.nc" and fn.wildcard([]) == "" and fn.size_text(2048) == "2.0 KB" and [fn.duration_text(x) for x in (89, 3661, 5400)] == ["89s", "61m", "1.5h"]
    assert fn.since("2h", dt.datetime(2024, 1, 2)) == dt.datetime(2024, 1, 1, 22) and fn.pruned({"a": None, "b": [None, 1], "c": {}}) == {"b": [1], "c": {}}
    assert column(spark, "string", ["E1hrClimMon", "Odec", "IfxGre", "Ofx", "3hr", "AERhr"], fn.guessed_frequency) == ["mon", "mon", "mon", "fx", "3hr", "1hr"]
    assert column(spark, "string", ["mon", "IyrGre", "zzz", None], fn.known_frequency) == ["mon", "yr", None, None]
    assert column(spark, "string", ["kg / meter ** 2 / second", "W m-2", "1/day", "furlong", None], fn.canonical_units) == ["kg m-2 s-1", "W m-2", "1/day", "furlong", None]


def test_folder_names(spark):
    pairs = "array<struct<k:string,v:string>>"
    given = [
        (3, 1, {"cmip6": [("source_id", "a b"), ("member_id", "r1")]}), (3, 1, {"cmip6": [("source_id", "a-b"), ("member_id", "r1")]}), (4, 2, {"b": [("x", "é//ü z_")], "a": [("y", "_"), ("x", "q")]}),
        (5, 1, {"a": [("x", "word_" * 60)]}), (6, 1, {"a": [("x", "w" * 200)]}), (7, 1, {}), (7, 1, {"a": []}), (123456789012, 1, {"a": [("x", "k" * 40 + "_" + "m" * 22 + "_n")]}),
    ]
    df = spark.createDataFrame([(k, *g) for k, g in enumerate(given)], f"k int, g long, v int, s map<string,{pairs}>")
    names = [r.n for r in df.select("k", fn.folder_name(F.col("s"), F.col("g"), F.col("v")).alias("n")).orderBy("k").collect()]
    heads = [n[:-9] for n in names]
    assert heads == ["r1_a_b_g3_v1", "r1_a-b_g3_v1", "q_z_g4_v2", "_".join(["word"] * 12) + "_g5_v1", "w" * 64 + "_g6_v1", "g7_v1", "g7_v1", "k" * 40 + "_" + "m" * 22 + "_g123456789012_v1"]
    assert len(set(names)) == len(names) and all(len(n) <= 96 and n[-9] == "_" and int(n[-8:], 16) >= 0 for n in names)


# -------------------------------------------------------------------- results

VALUES = "id long, execution_id long, type string, value double, values array<double>, index array<string>, kind string, reference_id string, statistic string, metric string, source_id string"


def results(spark):
    models = [(k, 1, "scalar", v, None, None, None, None, "rmse", "m", s) for k, (s, v) in enumerate([("A", 9.5), ("B", 9.8), ("C", 10.0), ("D", 10.2), ("E", 10.5), ("WILD", 1000.0), ("Reference", 99999.0)])]
    rest = [(7, 1, "scalar", float("nan"), None, None, None, None, "rmse", "broken", "A"), (8, 2, "scalar", 1.0, None, None, None, None, None, "m", "A"), (9, 1, "series", None, [1.0, 2.0, 3.0], ["0", "1"], "reference", "r", "rmse", "m", "A")]
    values = spark.createDataFrame([*models, *rest], VALUES)
    executions = spark.createDataFrame([(1, 1, "h", True, dt.datetime(2024, 1, 1), False), (2, 2, "h", None, dt.datetime(2024, 1, 2), True)], "id long, group_id long, dataset_hash string, successful boolean, created_at timestamp_ntz, retracted boolean")
    groups = spark.createDataFrame([(1, 1, "k", 2, False, {"cmip6": [("source_id", "A")]}), (2, 1, "k", 1, True, {"cmip6": [("source_id", "B")]}), (3, 1, "z", 2, None, {})], "id long, diagnostic_id long, key string, diagnostic_version int, dirty boolean, selectors map<string,array<struct<k:string,v:string>>>")
    return Results(values, executions, groups, spark.createDataFrame([(1, "ecs", "prov", 2)], "id long, slug string, provider string, promoted_version int"), dimensions=("statistic", "metric", "source_id"))


def test_outliers_are_hidden_before_counting(spark):
    r = results(spark)
    page = r.scalar_values()
    assert page.total == 6 and {x.source_id for x in page.rows.collect()} == {"A", "B", "C", "D", "E", "Reference"}
    every = r.scalar_values(include_unverified=True, limit=3, offset=5)
    assert every.total == 8 and [(x.id, x.is_outlier, x.verification_status) for x in every.rows.collect()] == [(5, True, "unverified"), (6, False, "verified"), (7, True, "unverified")]
    assert ("source_id", "WILD") in {tuple(x) for x in page.facets.collect()}
    off = r.scalar_values(policy=OutlierPolicy("off"))
    assert off.total == 8 and "is_outlier" not in off.rows.columns
    assert values_frame(off.rows, r.dimensions).columns == ["statistic", "metric", "source_id", "id", "execution_id", "kind", "value"]


def test_filters_of_values(spark):
    r = results(spark)
    ids = lambda **f: sorted(x.id for x in r.select("scalar", ValueFilter(**f)).collect())
    assert ids() == list(range(8)) and ids(promoted_only=False, include_retracted=True) == list(range(9)) and ids(diagnostic="other") == []
    assert ids(isolate_ids=[1, 2], exclude_ids=[1]) == [1, 2] and ids(exclude_ids=[0]) == list(range(1, 8)) and ids(provider_contains=["PRO"], dimensions={"source_id": ["A", "B"]}) == [0, 1, 7]
    with pytest.raises(KeyError):
        ids(dimensions={"absent": "x"})


def test_series_points_fall_back_to_positions(spark):
    rows = results(spark).series_values(references=True, explode=True).rows.orderBy("position").collect()
    assert [(r.index_value, r.value) for r in rows] == [("0", 1.0), ("1", 2.0), ("2", 3.0)]
    assert results(spark).series_values(references=False).total == 0


def test_groups_without_runs_stay(spark):
    r = results(spark)
    rows = r.execution_groups().collect()
    assert [(x.id, x.execution_id) for x in rows] == [(1, 1), (3, None)]
    assert [x.id for x in r.execution_groups(promoted_only=False, facets={"cmip6.source_id": ["B"]}).collect()] == [2]
    assert [x.id for x in r.execution_groups(dirty=False, promoted_only=False).collect()] == [1, 3]


def test_null_keys_are_never_outliers(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", float("inf")), (None, float("nan"))], "metric string, value double")
    assert [r.is_outlier for r in detect(df).orderBy(F.col("metric").isNull(), "value").collect()] == [True, False, False]
    with pytest.raises(ValueError):
        OutlierPolicy(min_n=1)


def test_datasets_reader(spark):
    d = spark.createDataFrame([(1, "M", 2, True, None), (2, "M", 10, False, None), (3, "M", 10, True, dt.datetime(2024, 1, 1))], "dataset_id long, source_id string, version_key long, finalised boolean, retracted_at timestamp_ntz")
    assert [r.dataset_id for r in datasets(d, latest=["source_id"]).collect()] == [2]
    assert [r.dataset_id for r in datasets(d, finalised=True, latest=["source_id"]).collect()] == [1]


def test_resource_profile_golden(spark):
    gib = 1 << 30
    rows = [("p", "d", 1.0, 2.0, k * gib, 16 * gib, "cgroup", True, True, dt.datetime(2024, 1, k), k) for k in range(1, 11)]
    rows += [("p", "d", 1.0, 2.0, 99 * gib, None, "cgroup", False, True, dt.datetime(2024, 1, 1), 11), ("p", "d", 1.0, None, gib, None, "cgroup", True, True, dt.datetime(2024, 1, 1), 12), ("p", "d", None, None, None, None, None, None, False, dt.datetime(2024, 1, 1), 13)]
    df = spark.createDataFrame(rows, "provider string, diagnostic string, wall_seconds double, cpu_seconds double, peak_memory_bytes long, memory_limit_bytes long, memory_source string, resources_exclusive boolean, successful boolean, created_at timestamp_ntz, id long")
    r = aggregates.recommendations(aggregates.resource_profile(df)).first()
    assert (r.peak_p50, r.peak_p95, r.n_samples, r.n_failed, r.n_excluded) == (int(5.5 * gib), round(9.55 * gib), 10, 1, 2)
    assert r.recommended_memory_gib == math.ceil(9.55 * 1.2) and r.recommended_cpus == 2 and r.confidence == "good" and not r.over_limit
    assert aggregates.provider_profile(aggregates.resource_profile(df)).first().n_samples == 10


# --------------------------------------------------------------------- ledger


@pytest.mark.parametrize("ran, same, ok, dirty, rerun, old, expected", [
    (False, False, None, False, False, False, True), (True, False, True, False, False, False, True), (True, True, None, True, False, False, False), (True, True, None, True, False, True, True), (True, True, True, True, False, False, True),
    (True, True, False, False, False, False, False), (True, True, False, False, True, False, True), (True, True, None, False, True, True, True), (True, True, True, False, True, False, False), (True, True, True, None, False, False, False),
])
def test_should_run(spark, ran, same, ok, dirty, rerun, old, expected):
    row = spark.createDataFrame([("h", "h" if same else "g", ok, dt.datetime(2020 if old else 2024, 1, 1), dirty, ran)], "h string, last string, ok boolean, at timestamp_ntz, dirty boolean, ran boolean")
    cols = [F.col(c) for c in ("h", "last", "ok", "at", "dirty", "ran")]
    assert row.select(ledger.should_run(*cols, rerun, F.lit("2022-01-01").cast("timestamp_ntz"))).first()[0] is expected


def test_outcomes(spark):
    flags = [(False, True, True, True, True), (True, False, True, True, True), (True, False, False, True, True), (True, True, False, False, True), (True, True, False, True, False), (True, True, False, True, True)]
    df = spark.createDataFrame([(k, *f) for k, f in enumerate(flags)], "k int, log boolean, ok boolean, retry boolean, copied boolean, ingested boolean")
    rows = df.select("k", ledger.outcome(*(F.col(c) for c in ("log", "ok", "retry", "copied", "ingested"))).alias("o")).orderBy("k").collect()
    assert [tuple(r.o) for r in rows] == [(False, True), (False, True), (False, False), (False, False), (False, False), (True, False)]


def test_delete_cascades_and_needs_a_filter(spark):
    g = spark.createDataFrame([(1, "a"), (2, "b")], "id long, key string")
    e = spark.createDataFrame([(10, 1), (20, 2)], "id long, group_id long")
    v = spark.createDataFrame([(10,), (20,)], "execution_id long")
    left = ledger.delete_groups(g, {"values": v}, e, F.col("key") == "a")
    assert {n: [r["execution_id" if n == "values" else "id"] for r in df.collect()] for n, df in left.items()} == {"values": [20], "executions": [20], "groups": [2]}
    with pytest.raises(ValueError):
        ledger.delete_groups(g, {}, e, None)


def test_measured_block():
    with ledger.measured() as found:
        sum(range(1000))
    assert found["wall_seconds"] > 0 and found["peak_memory_bytes"] > 0


# --------------------------------------------------------------------- upsert


def test_upsert_never_downgrades(spark):
    kind = "slug string, finalised boolean, levels int, calendar string"
    old = spark.createDataFrame([("a", True, 1, "std"), ("b", False, 1, "std"), ("c", True, 1, "std"), ("d", True, 1, None)], kind)
    new = spark.createDataFrame([("a", False, 9, "x"), ("b", True, 2, None), ("c", True, 1, None), ("e", False, 5, None)], kind)
    rows = {r.slug: r for r in upsert.upsert_datasets(old, new).collect()}
    assert {k: r.state for k, r in rows.items()} == {"a": "unchanged", "b": "updated", "c": "unchanged", "d": "kept", "e": "created"}
    assert rows["a"].levels == 1 and rows["b"].levels == 2 and rows["b"].calendar == "std"


def test_validation(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", None)], "slug string, units string")
    assert [r.slug for r in upsert.validate(df, "slug", ["units"], ["units"], True).collect()] == ["b", "b"]
    with pytest.raises(ValueError, match="inconsistent"):
        upsert.validate(df, "slug", ["units"], ["units"])
    with pytest.raises(ValueError, match="missing"):
        upsert.validate(df, "slug", ["absent"], [])


def test_finalise_and_retract(spark):
    c = spark.createDataFrame([("p", False, None, 1, None), ("q", True, "old", 1, None), ("r", False, None, 2, None)], "path string, finalised boolean, units string, dataset_id long, retracted_at timestamp_ntz")
    parsed = spark.createDataFrame([("p", "K"), ("q", "C")], "path string, units string")
    assert [(r.path, r.finalised, r.units) for r in upsert.finalise(c, parsed).orderBy("path").collect()] == [("p", True, "K"), ("q", True, "old"), ("r", False, None)]
    assert tuple(upsert.unfinalised(c).first()) == (2, 2)
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    gone = upsert.retract(c, F.col("dataset_id") == 1, at)
    assert gone.where("retracted_at is not null").count() == 2 and upsert.unretract(gone, F.col("path") == "p").where("retracted_at is not null").count() == 1


# -------------------------------------------------------------------- bundles

CUBE = {"M1": {"global": {"rmse": 1.5, "bias": None, "attributes": {"unit": "K"}}, "land": {"rmse": 2, "bias": 3.0}}, "M2": {"global": {"rmse": 4.0}}}


def test_flatten(spark):
    df = spark.createDataFrame([(1, json.dumps(CUBE))], "execution_id long, results string")
    rows = {(r.model, r.region, r.metric): r for r in bundles.flatten(df, "results", ["model", "region", "metric"]).collect()}
    assert len(rows) == 5 and rows["M1", "land", "rmse"].value == 2.0 and math.isnan(rows["M1", "global", "bias"].value)
    assert rows["M1", "global", "rmse"].attributes == {"unit": "K"} and rows["M2", "global", "rmse"].attributes is None


def test_nest_is_the_inverse(spark):
    flat = spark.createDataFrame([("M1", "g", 1.5), ("M1", "l", 2.0), ("M2", "g", 4.0)], "model string, region string, value double")
    assert json.loads(bundles.nest(flat, ["model", "region"]).first().results) == {"M1": {"g": 1.5, "l": 2.0}, "M2": {"g": 4.0}}


def test_bundle_algebra(spark):
    flat = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, value double")
    with pytest.raises(ValueError):
        bundles.prepend_dimensions(flat, {"model": "x"})
    with pytest.raises(ValueError):
        bundles.remove_dimension(flat, ["region", "model"], "model")
    with pytest.raises(Exception, match="several values"):
        bundles.remove_dimension(flat, ["model"], "model").collect()
    other = spark.createDataFrame([("a", 1.000001), ("b", 2.1), ("c", 1.0)], "model string, value double")
    assert sorted((r.model, r.difference) for r in bundles.compare(flat, other, ["model"]).collect()) == [("b", "differs"), ("c", "extra")]
    kinds = spark.createDataFrame([(None,), ("other",)], "kind string")
    with pytest.raises(Exception, match="unknown kind"):
        bundles.validated_kind(kinds).collect()


# ----------------------------------------------------------------------- grid


def small_grid(spark):
    rows = [("M", y, m, lat, lon, float(y - 2000 + m + lat), 2.0 if lat else None) for y in (2000, 2001) for m in range(1, 13) for lat in (0.0, 10.0) for lon in (0.0, 1.0, 2.0)]
    rows[0] = (*rows[0][:5], None, 2.0)
    return spark.createDataFrame(rows, "source_id string, year int, month int, lat double, lon double, value double, area double")


def test_order_of_means(spark):
    g = small_grid(spark)
    a = {r.year: r.value for r in gridded.annual_then_global(g, ["source_id"]).collect()}
    b = {r.year: r.value for r in gridded.global_then_annual(g, ["source_id"]).collect()}
    assert a[2001] == pytest.approx(17.5) and b[2001] == pytest.approx(17.5) and a[2000] != pytest.approx(b[2000])


def test_bias_on_common_years(spark):
    model = spark.createDataFrame([("M", 2000, 1.0), ("M", 2001, 3.0), ("M", 2002, 9.0)], "source_id string, year int, value double")
    reference = spark.createDataFrame([(2000, 0.0), (2001, 0.0), (1999, 0.0)], "year int, value double")
    r = gridded.bias_statistics(gridded.bias(model, reference, ["source_id"]), ["source_id"]).first()
    assert (r.mean_bias, r.years) == (2.0, 2) and r.rmse == pytest.approx(math.sqrt(5))


def test_valid_times_and_concatenation(spark):
    g = small_grid(spark).withColumn("value", F.when(F.col("month") != 5, F.col("value"))).withColumn("file", F.lit(2))
    assert g.count() - gridded.valid_times(g, ["source_id"]).count() == 12
    twice = g.unionByName(g.withColumn("file", F.lit(1)).withColumn("value", F.lit(0.0)))
    assert {r.file for r in gridded.concatenated(twice, ["source_id"], "file").select("file").distinct().collect()} == {1}


def test_sensitivity_and_response(spark):
    years = range(1, 101)
    t = spark.createDataFrame([("M", y, y / 10) for y in years], "source_id string, year int, anomaly double")
    n = spark.createDataFrame([("M", y, 8.0 - 2.0 * y / 10) for y in years], "source_id string, year int, anomaly double")
    r = diagnostics.climate_sensitivity(n, t, ["source_id"]).first()
    assert r["lambda"] == pytest.approx(-2.0) and r.ecs == pytest.approx(2.0)
    run = spark.createDataFrame([("M", y, 10 + 0.02 * y + 0.01 * y) for y in years], "source_id string, year int, value double")
    control = spark.createDataFrame([("M", y, 10 + 0.01 * y) for y in years], "source_id string, year int, value double")
    assert diagnostics.transient_response(run, control, ["source_id"]).first().tcr == pytest.approx(0.02 * 69.5)
    levels = {x.level: x.year for x in diagnostics.warming_level_years(t, [1.45, 1.95, 99.0], ["source_id"]).collect()}
    assert levels == {1.45: 15, 1.95: 20}
    one = spark.createDataFrame([("M", y, 1.0) for y in years], "source_id string, year int, value double")
    assert diagnostics.response_to_emissions(t, one, ["source_id"]).first().tcre == pytest.approx(0.1)
    assert diagnostics.zero_emission_commitment(run, control, ["source_id"], 100, 100).first().zec == pytest.approx(13 - 10.505)


def test_regions_and_patterns(spark):
    g = small_grid(spark)
    boxes = spark.createDataFrame([("low", -5.0, 5.0, 0.0, 3.0), ("none", 50.0, 60.0, 0.0, 3.0)], "region string, lat_min double, lat_max double, lon_min double, lon_max double")
    rows = diagnostics.regional_timeseries(g.withColumn("area", F.lit(1.0)), boxes, ["source_id"], 2000, 2000).collect()
    assert {(r.region, r.year) for r in rows} == {("low", 2000), ("low", 2001)}
    clim = g.groupBy("source_id", "lat", "lon", "month").agg(F.avg("value").alias("value"))
    same = diagnostics.pattern_statistics(clim, clim, ["source_id"]).first()
    assert same.bias == 0 and same.rmse == 0 and same.correlation == pytest.approx(1.0)
    index = g.groupBy("source_id", "year", "month").agg(F.avg("value").alias("value"))
    assert diagnostics.index_statistics(index, ["source_id"]).first().amplitude > 0


# -------------------------------------------------------------------- sources


def test_paths(spark):
    root = "/d/CMIP6/ScenarioMIP/INST/MODEL/ssp585/r1i1p1f1/Amon/tas/gn/v20200101"
    df = spark.createDataFrame([(f"{root}/tas_Amon_MODEL_ssp585_r1i1p1f1_gn_201501-210012.nc",), (f"{root}/odd.nc",)], "path string")
    good, bad = paths.cmip6_from_path(df).orderBy("path").collect()[::-1]
    assert good.instance_id == "CMIP6.ScenarioMIP.INST.MODEL.ssp585.r1i1p1f1.Amon.tas.gn.v20200101" and (good.start_time, good.end_time, good.frequency, good.finalised) == ("2015-01-01", "2100-12-30", "mon", False)
    assert bad.invalid_asset and bad.instance_id is None
    dcpp = paths.cmip6_from_path(spark.createDataFrame([(f"{root}/tas_Amon_MODEL_dcpp_s1960-r2i1p1f1_gn.nc",)], "path string")).first()
    assert (dcpp.sub_experiment_id, dcpp.variant_label, dcpp.start_time) == ("s1960", "r2i1p1f1", None)
    obs = paths.reference_from_path(spark.createDataFrame([("/x/OBS/Tier2/SRC/OBS_SRC_sat_v1_Amon_tos_2000-2001.nc",), ("/x/native6/Tier3/ERA5/v1/tas.nc",), ("/x/y.nc",)], "path string")).orderBy("path").collect()
    assert [(r.project, r.source_id, r.version, r.variable_id) for r in obs] == [("OBS", "SRC", "v1", "tos"), ("native6", "ERA5", "v1", "tas"), (None, None, None, None)]


def test_discovery_and_parsing(spark, tmp_path):
    for name in ("a/x.nc", "a/b/y.nc", "a/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    found = files.discover(spark, [str(tmp_path), str(tmp_path / "a")])
    assert found.count() == 2 and files.discover(spark, [str(tmp_path / "a")], depth=0).count() == 1
    good, bad = files.split_invalid(files.parse(found, lambda p: {"n": len(p)} if p.endswith("x.nc") else 1 / 0, "n long"))
    assert good.count() == 1 and "ZeroDivisionError" in bad.first().invalid_asset


def test_catalogue_round_trip(spark, tmp_path):
    d = spark.createDataFrame([(1, "M", "v2", None), (2, "M", "v10", None)], "dataset_id long, source_id string, version string, retracted_at string")
    f = spark.createDataFrame([(2, "p", "2000-01-01", "2000-02-30", "360_day"), (2, "q", None, "bad", "360_day")], "dataset_id long, path string, start_time string, end_time string, calendar string")
    rows = catalogs.load_catalog(d, f, ["source_id"])
    assert rows.count() == 2
    catalogs.write_catalog(rows, f"{tmp_path}/cmip6.parquet")
    back = catalogs.read_catalogs(spark, str(tmp_path), ["cmip6"])["cmip6"].orderBy("path").collect()
    assert tuple(back[0].end_time)[:3] == (2000, 2, 30) and back[1].end_time is None
    joined = catalogs.union_catalogs([f, f.drop("calendar")], {"p": "root/p"})
    assert joined.count() == 4 and joined.where("path = 'root/p'").count() == 2


def test_json_sources(spark, tmp_path):
    (tmp_path / "series.json").write_text(json.dumps([{"dimensions": {"source_id": "A"}, "index": ["0", "1"], "index_name": "time", "values": [1.0, None], "attributes": {}}]))
    row = catalogs.read_series(spark, f"{tmp_path}/series.json").first()
    assert row.kind == "model" and math.isnan(row["values"][1])
    (tmp_path / "diagnostic.json").write_text(json.dumps({"DIMENSIONS": {"json_structure": ["model", "region", "metric"]}, "RESULTS": CUBE}))
    b = catalogs.read_bundle(spark, f"{tmp_path}/diagnostic.json")
    assert bundles.flatten(b, "results", b.first().json_structure).count() == 5
    (tmp_path / "output.json").write_text(json.dumps({"plots": {"p": {"filename": "a.png", "dimensions": {"source_id": "A"}}}, "data": {}}))
    assert [(r.output_type, r.filename) for r in catalogs.read_outputs(spark, f"{tmp_path}/output.json").collect()] == [("plot", "a.png")]
    for n, v in (("a", "1"), ("b", "2")):
        (tmp_path / f"{n}.csv").write_text(f"source,region,analysis,name,value\nM,,x,y,{v}\nM,NaN,x,y,3\n")
    table = catalogs.read_metric_tables(spark, f"{tmp_path}/*.csv").collect()
    assert sorted((r.region is None, r.value) for r in table) == [(False, "1"), (True, "3")]


def test_sql_pass_through(spark):
    rows, more = catalogs.run_sql(spark, "SELECT id FROM t ORDER BY id", {"t": spark.range(10)}, 3)
    assert rows.count() == 3 and more == 7


def test_search_results_are_deduplicated(spark):
    df = spark.createDataFrame([(0, "k", "2000", "2001"), (1, "k", "1990", "2005"), (2, "l", "1", "2")], "row_id long, key string, time_start string, time_end string")
    assert sorted(tuple(r) for r in catalogs.deduplicated(df).collect()) == [(0, "k", "1990", "2005"), (2, "l", "1", "2")]


# --------------------------------------------------------- streaming, checks


def test_incremental_ingest_is_idempotent(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "dataset_id long, path string, version string"

    def arrive(name, rows):
        (source / name).write_text("\n".join(json.dumps(dict(zip(("dataset_id", "path", "version"), r, strict=True))) for r in rows))
        q = ingest.ingest_stream(spark, str(source), schema, f"{tmp_path}/table", f"{tmp_path}/ck")
        q.awaitTermination(120)
        return sorted(tuple(r) for r in ingest.current(spark, f"{tmp_path}/table").select("dataset_id", "path", "version").collect())

    assert arrive("a.json", [(1, "p", "v1"), (2, "q", "v1")]) == [(1, "p", "v1"), (2, "q", "v1")]
    assert arrive("b.json", [(1, "p", "v2")]) == [(1, "p", "v2"), (2, "q", "v1")]


def test_changed_groups(spark):
    a = spark.createDataFrame([("k", "1"), ("l", "1")], "dataset_key string, dataset_hash string")
    b = spark.createDataFrame([("k", "2"), ("l", "1"), ("m", "1")], "dataset_key string, dataset_hash string")
    assert sorted(r.dataset_key for r in ingest.changed_groups(a, b).collect()) == ["k", "m"]


def test_doctor(spark):
    f = spark.createDataFrame([(1, "a", 0, 10), (1, "b", 2, 3), (1, "c", 5, 20), (2, "d", 0, 1), (2, "e", None, 5)], "dataset_id long, path string, start_ord long, end_ord long")
    have = spark.createDataFrame([("cmip6", "M"), ("odd", "X")], "source_type string, source_id string")
    need = spark.createDataFrame([("cmip6", "M"), ("obs", "R")], "source_type string, source_id string")
    found = doctor.run_checks({"files": f, "datasets": have, "required": need})
    rows = {(r.check, r.severity, r.subject) for r in found.collect()}
    assert rows == {("duplicate-coverage", "warning", "1"), ("missing-reference", "error", "R"), ("unreachable-type", "info", "odd"), ("overlapping-registries", "error", "registry")}
    assert {r.severity: r.n for r in doctor.severity_counts(found).collect()} == {"warning": 2, "error": 2, "info": 1}
    assert doctor.run_checks({"files": f, "datasets": have, "required": need}, "error").count() == 2


@pytest.mark.parametrize("partitions", ["4", "200"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbered_keeps_every_row_of_wide_tables(spark, partitions, adaptive):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.col("id").cast("string").alias("text"), F.lit("x" * 40).alias("wide"), (F.col("id") % 3).alias("g"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        found = aggregates.numbered(rows, ["k"], "n").collect()
        totals = aggregates.running_total(rows, ["k"], F.col("k"), ["g"]).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [r["k"] for r in sorted(found, key=lambda r: r["n"])] == sorted(i * 7919 % 20_011 for i in range(20_000))
    assert sorted(r["n"] for r in found) == list(range(20_000))
    for g in range(3):
        seen = 0
        for r in sorted((r for r in totals if r["g"] == g), key=lambda r: r["k"]):
            assert r["before"] == seen
            seen += r["k"]


@pytest.mark.parametrize("accuracy", [70, 10_000])
def test_exact_percentiles_of_large_groups(spark, accuracy):
    """Narrowed brackets give what sorting gives, with values that fill half a group, gaps, ties, infinities, nulls and tiny groups."""
    import random

    import numpy as np

    from meridian.operators.quantiles import exact_percentiles

    rng = random.Random(2)
    made = {
        "wide": [rng.gauss(0, 1e6) for _ in range(6000)], "heavy": [5.0] * 2500 + [rng.random() * 10 for _ in range(2500)], "two": [1.0] * 2000 + [2.0] * 2000, "steps": [float(k // 100) for k in range(4000)],
        "far": [10.0 ** rng.uniform(-300, 300) for _ in range(3000)], "few": [3.0, 1.0], "one": [7.0], None: [float(k) for k in range(500)],
    }
    rows = [(g, x) for g, xs in made.items() for x in xs] + [("wide", None)] * 50 + [("empty", None)] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    shares = {"p0": 0.0, "p05": 0.05, "p50": 0.5, "p731": 0.731, "p95": 0.95, "p100": 1.0}
    found = {r["g"]: r for r in exact_percentiles(df, ["g"], {n: (F.col("x"), p) for n, p in shares.items()}, accuracy, 70).collect()}
    assert set(found) == {*made, "empty"} and found["empty"]["p50"] is None
    for g, xs in made.items():
        for n, p in shares.items():
            assert found[g][n] == pytest.approx(float(np.percentile(xs, 100 * p)), rel=1e-12), (g, n)
    whole = exact_percentiles(df, [], {"m": (F.col("x"), 0.5)}, accuracy, 70).collect()
    assert len(whole) == 1 and whole[0]["m"] == pytest.approx(float(np.percentile([x for _, x in rows if x is not None], 50)), rel=1e-12)


def test_date_ranges_of_long_years(spark):
    got = column(spark, "string", ["12000-12001", "1200001-1200112", "120000105-120010203", "1200001050600-1200102030600"], cal.parse_date_range)
    assert [tuple(x) for x in got] == [("12000-01-01", "12001-12-30"), ("12000-01-01", "12001-12-30"), ("12000-01-05", "12001-02-03"), ("12000-01-05", "12001-02-03")]


def test_rounding_keeps_the_sign_of_zero(spark):
    from meridian.functions.catalog import rounded

    got = column(spark, "double", [-0.000001, 0.000001, -0.0, -0.015625, 1.5, float("inf"), None], lambda x: rounded(x, 4))
    assert [repr(x) for x in got] == ["-0.0", "0.0", "-0.0", "-0.0156", "1.5", "inf", "None"]
