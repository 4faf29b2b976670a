"""Running solved executions: isolation, all or nothing, states, usage."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from meridian.operators import aggregates
from meridian.plans import runner, usage
from meridian.plans.requirement import DataRequirement, Diagnostic

NONE = "id long, provider string, diagnostic string, diagnostic_version int, dataset_key string, dirty boolean"
RUNS = "id long, group_id long, dataset_hash string, successful boolean, created_at timestamp_ntz"


def now():
    return F.lit("2001-01-01").cast("timestamp_ntz")


def catalog(spark, n=4):
    return spark.createDataFrame([(f"i{k}", f"s{k % n}", float(k)) for k in range(3 * n)], "instance_id string, source_id string, x double")


def go(spark, execute, n=4, **options):
    need = ((DataRequirement("cmip6", (), ("source_id",)),),)
    d = [Diagnostic("p", "d", need, execute=execute, facets=("statistic",))]
    return runner.solve_and_run(d, {"cmip6": catalog(spark, n)}, spark.createDataFrame([], NONE), spark.createDataFrame([], RUNS), now(), ["statistic"], **options)


def sums(inputs, _):
    return runner.Findings(scalars=inputs["cmip6"].groupBy("execution_id").agg(F.sum("x").alias("value"), F.lit("sum").alias("statistic")))


def test_everything_an_execution_leaves_is_taken_in(spark):
    def execute(inputs, part):
        rows = inputs["cmip6"]
        bundles = rows.groupBy("execution_id").agg(F.to_json(F.create_map(F.lit("mean"), F.avg("x"))).alias("results"))
        series = rows.groupBy("execution_id").agg(F.sort_array(F.collect_list("x")).alias("values"), F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("index"), F.lit("t").alias("index_name"), F.lit("model").alias("kind"), F.lit("line").alias("statistic"))
        outputs = rows.groupBy("execution_id").agg(F.lit("plot").alias("output_type"), F.lit("p").alias("short_name"), F.lit("a/p.png").alias("filename"))
        return runner.Findings(bundles, sums(inputs, part).scalars, series, outputs)

    vocabulary = spark.createDataFrame([("statistic", "sum")], "dimension string, value string")
    done, marked, store = go(spark, execute, vocabulary=vocabulary)
    assert [(r["successful"], r["group_id"] is not None) for r in done.collect()] == [(True, True)] * 4
    assert {r["dirty"] for r in marked.collect()} == {False}
    values = {(r["statistic"], r["value"]) for r in store.read("values").collect()}
    assert values == {("sum", 3.0 * k + 12) for k in range(4)} | {("mean", k + 4.0) for k in range(4)}
    assert store.read("series").count() == 4 and store.read("axes").count() == 1 and store.read("outputs").count() == 4
    assert [tuple(r) for r in store.read("violations").distinct().collect()] == [("statistic", "mean")]
    used = store.read("usage").collect()
    assert len(used) == 4 and all(r["wall_seconds"] > 0 and r["cpu_seconds"] > 0 and r["memory_source"] == "tasks" for r in used)
    assert len(store.units()) == 1


@pytest.mark.parametrize("how", ["row", "path", "driver"])
def test_one_that_fails_ends_only_itself(spark, how):
    """Whether its rows, its outputs or the driver's code raise; nothing of it is left, not even what came before."""
    def execute(inputs, part):
        found = sums(inputs, part)
        if how == "row":
            bad = F.when(F.col("value") == 15, F.raise_error(F.lit("bad")).cast("double")).otherwise(F.col("value"))
            return runner.Findings(scalars=found.scalars.withColumn("value", bad))
        if how == "path":
            return runner.Findings(scalars=found.scalars, outputs=inputs["cmip6"].groupBy("execution_id").agg(F.lit("data").alias("output_type"), F.lit("o").alias("short_name"), F.when(F.min("x") == 1, "../up").otherwise("in/side").alias("filename")))
        if part.where(F.to_json("slugs").contains('"i1"')).count():
            raise ValueError("bad")
        return found

    done, marked, store = go(spark, execute)
    assert sorted(str(r["successful"]) for r in done.collect()) == ["False", "True", "True", "True"]
    assert {r["dirty"] for r in marked.collect()} == {False}
    assert {r["value"] for r in store.read("values").collect()} == {12.0, 18.0, 21.0}
    (failure,) = store.read("failures").collect()
    assert ("outside" if how == "path" else "bad") in failure["error"] and not failure["retryable"]


def test_a_failure_worth_another_try_leaves_its_group_dirty(spark):
    def execute(inputs, part):
        raise TimeoutError("storage")

    done, marked, _ = go(spark, execute, 1)
    assert [r["successful"] for r in done.collect()] == [False] and [r["dirty"] for r in marked.collect()] == [True]


def test_without_a_function_an_execution_fails(spark):
    done, _, store = go(spark, None, 1)
    assert [r["successful"] for r in done.collect()] == [False] and "nothing to execute" in store.read("failures").first()["error"]


def test_what_takes_too_long_is_cancelled(spark):
    def slow(inputs, part):
        size = spark.range(1 << 40).where("sqrt(id) * sqrt(id + 1) < 0").count()
        return runner.Findings(scalars=inputs["cmip6"].select("execution_id", F.lit("x").alias("statistic"), F.lit(float(size)).alias("value")))

    began = time.time()
    done, marked, _ = go(spark, slow, 1, timeout=6.0)
    assert time.time() - began < 60 and [r["successful"] for r in done.collect()] == [False] and [r["dirty"] for r in marked.collect()] == [True]


def test_a_unit_that_broke_off_is_never_read(spark, tmp_path):
    store = runner.Store(spark, str(tmp_path), ("statistic",))
    rows = spark.createDataFrame([(1, "s", 2.0)], "execution_id long, statistic string, value double")
    store.write("values", rows, "half")
    assert store.read("values").count() == 0
    runs = spark.createDataFrame([(1, 1, "h", None)], "id long, group_id long, dataset_hash string, successful boolean")
    groups = spark.createDataFrame([(1, True)], "id long, dirty boolean")
    done, marked = runner.finished(runs, groups, store)
    assert done.first()["successful"] is None and marked.first()["dirty"]
    store.write("executions", rows, "half")
    assert [tuple(r) for r in store.read("values").select("execution_id", "kind", "value").collect()] == [(1, None, 2.0)]
    done, marked = runner.finished(runs, groups, store)
    assert done.first()["successful"] and not marked.first()["dirty"]


def test_jobs_at_once_are_told_apart_and_make_a_profile(spark):
    sizes = {"usage-a": 1_000, "usage-b": 3_000_000}
    found = {}

    def work(group):
        spark.sparkContext.setJobGroup(group, group)
        spark.range(sizes[group]).groupBy(F.col("id") % 7).agg(F.sum(F.sqrt("id"))).collect()
        found[group] = usage.job_usage(spark, group)

    from pyspark import inheritable_thread_target

    threads = [threading.Thread(target=inheritable_thread_target(spark)(work), args=(g,)) for g in sizes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found["usage-b"]["cpu_seconds"] > found["usage-a"]["cpu_seconds"] > 0 and found["usage-a"]["stages"] >= 1
    assert usage.job_usage(spark, "nobody") == {"cpu_seconds": 0.0, "run_seconds": 0.0, "peak_memory_bytes": 0, "read_bytes": 0, "shuffled_bytes": 0, "stages": 0, "memory_source": "tasks"}
    rows = [(k, "p", g, True, 2.0, u["cpu_seconds"], u["peak_memory_bytes"], None, u["memory_source"], True, None) for k, (g, u) in enumerate(found.items())]
    df = spark.createDataFrame(rows, "id long, provider string, diagnostic string, successful boolean, wall_seconds double, cpu_seconds double, peak_memory_bytes long, memory_limit_bytes long, memory_source string, resources_exclusive boolean, created_at timestamp_ntz")
    profile = {r["diagnostic"]: r for r in aggregates.resource_profile(df).collect()}
    assert profile["usage-b"]["cpu_p95"] > profile["usage-a"]["cpu_p95"] and profile["usage-a"]["memory_source"] == "tasks"


def test_readings_in_order_of_precedence(tmp_path):
    assert usage.preferred({"rusage": 3, "cgroup": None, "proc_tree": 2}) == ("proc_tree", 2)
    assert usage.preferred({"tasks": 9, "rusage": None}) == ("tasks", 9) and usage.preferred({}) == (None, None)
    (tmp_path / "memory.peak").write_text("4096\n")
    (tmp_path / "memory.max").write_text("max\n")
    assert usage.cgroup_peak(str(tmp_path)) == (4096, None) and usage.cgroup_peak(str(tmp_path / "none")) == (None, None)
    for pid, parent, size in ((10, 1, 5), (11, 10, 7), (12, 11, 1), (13, 1, 100)):
        (tmp_path / str(pid)).mkdir()
        (tmp_path / str(pid) / "status").write_text(f"Name:\tx\nPPid:\t{parent}\nVmRSS:\t{size} kB\n")
    assert usage.proc_tree_peak(10, str(tmp_path)) == 13 * 1024 and usage.proc_tree_peak(99, str(tmp_path)) is None
    assert usage.rusage_peak() > 0
