"""Running what was solved: each diagnostic's executions as jobs of their own, whose results are taken in whole or not at all.

A unit is some executions of one diagnostic. It runs as one Spark job under its own job
group and fair-scheduler pool, and first holds all that the diagnostic has to do. If it
fails, it is halved by a hash of the execution, until the executions that fail stand
alone: n executions of which f fail take some f * log2(n) units, and no list of
executions ever comes to the driver.

Tables of a unit lie below ``unit=<name>`` in the store. They count from the moment the
unit's last table, ``executions``, is complete; what a broken unit has left behind is never
read. So a value, series or output is there with its whole execution or not at all.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Timer

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators.bundles import undeclared
from meridian.plans import ledger
from meridian.plans.ingest import output_rows, scalar_values, series_values
from meridian.plans.requirement import Diagnostic, solve
from meridian.plans.usage import job_usage
from meridian.sources.shared import complete_parts, fresh_folder, read_parts, written

#: An execution may take so long. Fixed value.
TIMEOUT_SECONDS = 6 * 3600
#: The last digits of a hash by which units are halved.
SPLIT_BITS = 30


@dataclass(frozen=True)
class Findings:
    """What a diagnostic gives for its executions; every table has ``execution_id``.

    ``bundles``: results (JSON nested by the diagnostic's facets). ``scalars``: flat values.
    ``series``: as ``plans.ingest.series_values`` takes them. ``outputs``: as ``output_rows`` does.
    """

    bundles: DataFrame | None = None
    scalars: DataFrame | None = None
    series: DataFrame | None = None
    outputs: DataFrame | None = None


@dataclass(frozen=True)
class Store:
    """The tables of all units in one folder of the shared file system."""

    spark: SparkSession
    folder: str
    dimensions: tuple[str, ...] = ()

    @property
    def schemas(self) -> Mapping[str, str]:
        own = "".join(f"{d} string, " for d in self.dimensions)
        return {
            "executions": "execution_id long", "values": f"execution_id long, {own}kind string, value double, attributes map<string,string>",
            "series": f"execution_id long, {own}kind string, values array<double>, axis string, reference_id string", "axes": "hash string, index_name string, index array<string>",
            "outputs": "execution_id long, output_type string, short_name string, filename string, long_name string, description string",
            "failures": "execution_id long, error string, retryable boolean", "violations": "dimension string, value string",
            "usage": "id long, wall_seconds double, cpu_seconds double, peak_memory_bytes long, memory_source string, resources_exclusive boolean",
        }

    def write(self, table: str, df: DataFrame, unit: str) -> None:
        """``df`` in the columns of the table; those that it lacks are null."""
        wanted = self.spark.createDataFrame([], self.schemas[table])
        rows = df.select(*(F.col(c).cast(kind).alias(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in wanted.dtypes))
        rows.write.mode("overwrite").parquet(f"{self.folder}/{table}/unit={unit}")

    def units(self) -> list[str]:
        """The units that are complete."""
        return complete_parts(self.spark, f"{self.folder}/executions", "unit")

    def read(self, table: str) -> DataFrame:
        """All rows of complete units."""
        rows = read_parts(self.spark, [f"{self.folder}/{table}/unit={u}" for u in self.units()], self.schemas[table])
        return rows.dropDuplicates(["hash"]) if table == "axes" else rows  # two units at once may both find an axis new


def members(wanted: DataFrame, catalogs: Mapping[str, DataFrame], slug: str = "instance_id") -> dict[str, DataFrame]:
    """The catalogue rows of some executions (id, slugs) by source type, each with its ``execution_id``."""
    pairs = wanted.select(F.col("id").alias("execution_id"), F.explode("slugs").alias("__type", "__slugs")).select("execution_id", "__type", F.explode("__slugs").alias(slug))
    return {t: c.join(pairs.where(F.col("__type") == t).drop("__type"), slug) for t, c in catalogs.items()}


def is_retryable(error: BaseException) -> bool:
    """Whether another try may go well: time-outs, lost machines and unreachable storage, not what a diagnostic says itself."""
    text = f"{type(error).__name__}: {error}"
    return isinstance(error, (TimeoutError, OSError)) or any(x in text for x in ("cancelled", "ExecutorLostFailure", "FetchFailed", "OutOfMemory", "java.io.IOException"))


@dataclass
class Runner:
    """Runs the executions of several diagnostics side by side.

    ``parallel`` is how many diagnostics run at once; Spark shares its executors between
    their pools. ``vocabulary`` (dimension, value) lists what values may be; others are
    taken in and listed in ``violations``.
    """

    store: Store
    diagnostics: Sequence[Diagnostic]
    catalogs: Mapping[str, DataFrame]
    parallel: int = 4
    timeout: float = TIMEOUT_SECONDS
    vocabulary: DataFrame | None = None
    retryable: Callable[[BaseException], bool] = is_retryable
    tried: list[tuple[str, str]] = field(default_factory=list)

    def run(self, wanted: DataFrame) -> None:
        """``wanted``: id, provider, diagnostic, slugs. Returns once every execution has ended in one way or the other."""
        spark = self.store.spark
        split = F.pmod(F.xxhash64("id"), F.lit(1 << SPLIT_BITS))
        wanted = written(wanted.select("id", "provider", "diagnostic", "slugs", split.alias("split")), "wanted")
        with ThreadPoolExecutor(self.parallel) as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(self._all_of), d, wanted.where((F.col("provider") == d.provider) & (F.col("diagnostic") == d.slug))) for d in self.diagnostics]
        for j in jobs:
            j.result()

    def _all_of(self, d: Diagnostic, wanted: DataFrame) -> None:
        open_units = [(0, 1 << SPLIT_BITS)]
        while open_units:
            low, high = open_units.pop()
            part = wanted.where(F.col("split").between(low, high - 1))
            n = part.count()
            if not n:
                continue
            error = self._attempt(d, part, n)
            if error is None:
                continue
            if n == 1 or high - low == 1:  # one execution, or some of one hash
                self._failed(part, error)
                continue
            middle = max(low + 1, part.agg(F.percentile_approx("split", 0.5)).first()[0] + (0 if n > 2 else 1))
            middle = min(middle, high - 1)
            open_units += [(middle, high), (low, middle)]

    def _attempt(self, d: Diagnostic, part: DataFrame, n: int) -> BaseException | None:
        spark = self.store.spark
        context, unit = spark.sparkContext, uuid.uuid4().hex
        context.setJobGroup(unit, f"{d.provider}/{d.slug}: {n} executions", interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", f"{d.provider}.{d.slug}")
        timer = Timer(self.timeout, context.cancelJobGroup, [unit])
        timer.daemon = True
        began = time.perf_counter()
        self.tried.append((d.slug, unit))
        try:
            timer.start()
            if d.execute is None:
                raise ValueError(f"{d.provider}/{d.slug} has nothing to execute")
            self._take_in(d, d.execute(members(part, self.catalogs), part), part, unit)
            usage = job_usage(spark, unit)
            each = {"wall_seconds": time.perf_counter() - began, "cpu_seconds": usage["cpu_seconds"], "peak_memory_bytes": usage["peak_memory_bytes"]}
            shares = {k: F.lit(v / n if k != "peak_memory_bytes" else v) for k, v in each.items()}
            self.store.write("usage", part.select("id", *(v.alias(k) for k, v in shares.items()), F.lit(usage["memory_source"]).alias("memory_source"), F.lit(n == 1).alias("resources_exclusive")), unit)
            self.store.write("executions", part.select(F.col("id").alias("execution_id")), unit)  # from here on the unit counts
        except Exception as e:  # noqa: BLE001  a diagnostic that fails ends only itself
            return e
        finally:
            timer.cancel()
        return None

    def _take_in(self, d: Diagnostic, found: Findings, part: DataFrame, unit: str) -> None:
        ids = part.select(F.col("id").alias("execution_id"))
        parts = []
        if found.bundles is not None:
            parts.append(scalar_values(found.bundles, d.facets)[0])
        if found.scalars is not None:
            parts.append(found.scalars if "kind" in found.scalars.columns else found.scalars.withColumn("kind", F.lit("model")))
        if parts:
            values = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            self.store.write("values", values.join(ids, "execution_id", "left_semi"), unit)
            if self.vocabulary is not None:
                own = self.store.spark.read.schema(self.store.schemas["values"]).parquet(f"{self.store.folder}/values/unit={unit}")
                self.store.write("violations", undeclared(own, self.vocabulary, self.store.dimensions), unit)
        if found.series is not None:
            named = found.series if "kind" in found.series.columns else found.series.withColumn("kind", F.lit("model"))
            rows, axes = series_values(named, self.store.read("axes"), [c for c in self.store.dimensions if c in named.columns])
            self.store.write("series", rows.join(ids, "execution_id", "left_semi"), unit)
            self.store.write("axes", axes.withColumn("index", F.col("index").cast("array<string>")), unit)
        if found.outputs is not None:
            inside = ~F.col("filename").startswith("/") & ~F.col("filename").rlike(r"(^|/)\.\.(/|$)")
            checked = output_rows(found.outputs).withColumn("filename", F.when(F.coalesce(inside, F.lit(True)), F.col("filename")).otherwise(F.raise_error(F.concat(F.lit("output outside of its folder: "), "filename")).cast("string")))
            self.store.write("outputs", checked.join(ids, "execution_id", "left_semi"), unit)

    def _failed(self, part: DataFrame, error: BaseException) -> None:
        unit = uuid.uuid4().hex
        text = f"{type(error).__name__}: {error}".split("\n== ")[0].split("\n\tat ")[0][:2000]
        self.store.write("failures", part.select(F.col("id").alias("execution_id"), F.lit(text).alias("error"), F.lit(self.retryable(error)).alias("retryable")), unit)
        self.store.write("executions", part.select(F.col("id").alias("execution_id")), unit)


def finished(executions: DataFrame, groups: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """Executions and groups after their units have ended: success, and whether a group is dirty.

    Executions that no complete unit names go on running.
    """
    ended = store.read("executions").distinct()
    failed = store.read("failures").groupBy("execution_id").agg(F.bool_or("retryable").alias("retryable"))
    known = ended.join(failed, "execution_id", "left").withColumn("ok", F.col("retryable").isNull())
    state = ledger.outcome(F.lit(True), F.col("ok"), F.coalesce("retryable", F.lit(False)), F.lit(True), F.lit(True))
    states = written(known.select("execution_id", state.alias("state")), "states")
    rows = executions.join(states, executions["id"] == states["execution_id"], "left")
    done = rows.withColumn("successful", F.coalesce("successful", F.col("state.successful"))).select(*executions.columns)
    last = rows.where(F.col("state").isNotNull() & executions["successful"].isNull()).groupBy("group_id").agg(F.bool_or("state.dirty").alias("__dirty"))
    marked = groups.join(last.withColumnRenamed("group_id", "id"), "id", "left").withColumn("dirty", F.coalesce("__dirty", "dirty")).select(*groups.columns)
    return done, marked


def solve_and_run(diagnostics: Sequence[Diagnostic], catalogs: Mapping[str, DataFrame], groups: DataFrame, executions: DataFrame, now: Column, dimensions: Sequence[str], folder: str | None = None, slug: str = "instance_id", **options) -> tuple[DataFrame, DataFrame, Store]:
    """Solve, start what has to run, run it, and end it: the next executions and groups, and the store with what they gave.

    ``options`` go to the ``Runner`` (parallel, timeout, vocabulary, retryable) and to ``ledger.solved`` (rerun_failed, stale_before, limit, per).
    """
    spark = groups.sparkSession
    own = {k: options.pop(k) for k in ("rerun_failed", "stale_before", "limit", "per") if k in options}
    candidates = written(solve(diagnostics, catalogs), "candidates")
    every, runs = ledger.solved(candidates, groups, executions, now, **own)
    every, runs = written(every, "groups"), written(runs, "runs")
    started = runs.join(executions.select("id"), "id", "left_anti")
    key = ["provider", "diagnostic", "diagnostic_version", "dataset_key"]
    wanted = started.join(every.select(F.col("id").alias("group_id"), *key), "group_id").join(candidates.select(*key, "slugs"), key)
    store = Store(spark, folder or fresh_folder(spark, "results"), tuple(dimensions))
    Runner(store, diagnostics, catalogs, **options).run(wanted)
    done, marked = finished(runs, every, store)
    return done, marked, store
