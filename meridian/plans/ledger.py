"""The execution ledger: what has run, what has to run again, and how states change.

Tables are DataFrames; a change is the next state of a table, which the caller writes.
"""

from __future__ import annotations

import resource
import time
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.windows import latest_per_group, oldest_per_group, one_per
from meridian.sources.shared import written

STALE_SECONDS = 6 * 3600
#: Rows of results that one task joins with their executions, some tens of MB.
TASK_ROWS = 500_000


def latest_executions(executions: DataFrame, before: Column | None = None, after: Column | None = None) -> DataFrame:
    return latest_per_group(executions, ["group_id"], "created_at", "id", before, after)


def should_run(dataset_hash: Column, last_hash: Column, successful: Column, created_at: Column, dirty: Column, ran: Column, rerun_failed: bool = False, stale_before: Column | None = None) -> Column:
    """Whether a candidate has to run: its first run, new data, a dirty group, or on request after a failure.

    An execution in progress waits, unless it began before ``stale_before``.
    """
    stale = successful.isNull() & (created_at < stale_before) if stale_before is not None else F.lit(False)
    stale = F.coalesce(stale, F.lit(False))
    failed = F.coalesce(~successful, F.lit(False)) | stale
    return (
        F.when(~ran, True).when(~last_hash.eqNullSafe(dataset_hash), True).when(successful.isNull() & ~stale, False)
        .when(F.coalesce(dirty, F.lit(False)), True).otherwise(failed & F.lit(rerun_failed))
    )


def required_executions(candidates: DataFrame, groups: DataFrame, executions: DataFrame, rerun_failed: bool = False, stale_before: Column | None = None, limit: int | None = None, per: Sequence[str] = ()) -> DataFrame:
    """The candidates that have to run, in the order provider, diagnostic, key.

    ``per`` keeps one for each combination of some columns, ``limit`` so many in all.
    """
    key = ["provider", "diagnostic", "diagnostic_version", "dataset_key"]
    known = groups.select(*key, F.col("id").alias("group_id"), "dirty")
    last = latest_executions(executions).select("group_id", F.col("dataset_hash").alias("last_hash"), "successful", "created_at", F.lit(True).alias("ran"))
    rows = candidates.join(known, key, "left").join(last, "group_id", "left")
    wanted = should_run(F.col("dataset_hash"), F.col("last_hash"), F.col("successful"), F.col("created_at"), F.col("dirty"), F.col("ran").isNotNull(), rerun_failed, stale_before)
    rows = rows.where(wanted).drop("last_hash", "successful", "created_at", "ran", "dirty")
    order = ["provider", "diagnostic", "dataset_key"]
    if per:
        rows = one_per(rows, per, order)
    rows = rows.orderBy(*order)
    return rows if limit is None else rows.limit(limit)


def solved(candidates: DataFrame, groups: DataFrame, executions: DataFrame, now: Column, rerun_failed: bool = False, stale_before: Column | None = None, limit: int | None = None, per: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The groups and executions after a solve: a group for each key that is new, a running execution for each that has to run.

    ``candidates``: provider, diagnostic, diagnostic_version, dataset_key, dataset_hash.
    New rows are named by a hash of what they are, so that a solve can be run again.
    """
    key = ["provider", "diagnostic", "diagnostic_version", "dataset_key"]
    named = F.xxhash64(*key)
    fresh = candidates.select(*key).distinct().join(groups.select(*key), key, "left_anti").withColumns({"id": named, "dirty": F.lit(True)})
    every = groups.select("id", *key, "dirty").unionByName(fresh.select("id", *key, "dirty"))
    wanted = required_executions(candidates, groups, executions, rerun_failed, stale_before, limit, per)
    group_id = F.coalesce("group_id", named)
    started = wanted.select(F.xxhash64(group_id, "dataset_hash", now).alias("id"), group_id.alias("group_id"), "dataset_hash", F.lit(None).cast("boolean").alias("successful"), now.alias("created_at"))
    return every, executions.select("id", "group_id", "dataset_hash", "successful", "created_at").unionByName(started)


def fail_stale(executions: DataFrame, groups: DataFrame, now: Column, seconds: int = STALE_SECONDS) -> tuple[DataFrame, DataFrame]:
    """Executions in progress for too long have failed, and their groups are dirty."""
    stale = F.coalesce(F.col("successful").isNull() & (F.col("created_at") < now - F.make_dt_interval(secs=F.lit(seconds))), F.lit(False))
    gone = executions.where(stale).select(F.col("group_id").alias("id")).distinct().withColumn("stale", F.lit(True))
    done = executions.withColumn("successful", F.when(stale, False).otherwise(F.col("successful")))
    marked = groups.join(gone, "id", "left").withColumn("dirty", F.col("dirty") | F.coalesce("stale", F.lit(False))).drop("stale")
    return done, marked


def fail_running(executions: DataFrame) -> DataFrame:
    return executions.withColumn("successful", F.coalesce("successful", F.lit(False)))


def flag_dirty(groups: DataFrame, where: Column) -> DataFrame:
    return groups.withColumn("dirty", F.col("dirty") | F.coalesce(where, F.lit(False)))


def outcome(log_found: Column, succeeded: Column, retryable: Column, copied: Column, ingested: Column) -> Column:
    """How an execution ends: its success and whether its group is dirty afterwards.

    A missing log or a failure worth another try leaves the group dirty; any other
    failure, and success, leave it clean.
    """
    def state(ok: bool, dirty: bool) -> Column:
        return F.struct(F.lit(ok).alias("successful"), F.lit(dirty).alias("dirty"))

    return F.when(~log_found, state(False, True)).when(~succeeded & retryable, state(False, True)).when(~succeeded | ~copied | ~ingested, state(False, False)).otherwise(state(True, False))


def for_reingest(executions: DataFrame, include_failed: bool = False) -> DataFrame:
    """The first execution of each group, as long as the first and the latest succeeded."""
    first = oldest_per_group(executions, ["group_id"], "created_at", "id")
    if include_failed:
        return first
    good = latest_executions(executions, after=F.coalesce("successful", F.lit(False))).select("group_id")
    return first.where(F.coalesce("successful", F.lit(False))).join(good, "group_id", "left_semi")


def reconstructed(executions: DataFrame, links: DataFrame, datasets: DataFrame, files: DataFrame, include_failed: bool = False) -> DataFrame:
    """The files that the executions to be ingested again were made from: execution_id, group_id, source_type, slug, path."""
    runs = for_reingest(executions, include_failed).select(F.col("id").alias("execution_id"), "group_id")
    rows = runs.join(links.select("execution_id", "dataset_id").distinct(), "execution_id").join(datasets.select("dataset_id", "source_type", "slug"), "dataset_id")
    return rows.join(files.select("dataset_id", "path"), "dataset_id").select("execution_id", "group_id", "source_type", "slug", "path")


def reingested(executions: DataFrame, results: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Executions and results after results were built again, each under a new execution of its group.

    ``results``: execution_id (of the run built from), whole (all of its parts were read),
    and the values' columns. Where a part is missing, or the run is not known, nothing of it
    is taken; whether its group is dirty does not change. Which runs are taken is worked out
    when this is called, so that no task sorts for that and for the values at once; values are
    dealt by execution over tasks of some ``TASK_ROWS``, more tasks the more there are.
    """
    good = results.groupBy("execution_id").agg(F.min("whole").alias("whole")).where("whole").drop("whole")
    good = written(good.join(executions.select(F.col("id").alias("execution_id")), "execution_id", "left_semi"), "whole-runs")
    runs = executions.join(good, executions["id"] == good["execution_id"]).drop("execution_id")
    new_id = F.xxhash64("id", now)
    made = runs.withColumns({"id": new_id, "created_at": now, "successful": F.lit(True)}).select(*executions.columns)
    tasks = max(int(results.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-results.count() // TASK_ROWS))
    taken = results.repartition(tasks, "execution_id").join(good, "execution_id", "left_semi").withColumn("execution_id", F.xxhash64("execution_id", now)).drop("whole")
    taken = taken.repartition(tasks, "execution_id")  # as the joins with their executions need them
    return executions.unionByName(made), taken


def execution_datasets(members: DataFrame) -> DataFrame:
    """Links between executions and datasets; a dataset of several files is linked once."""
    return members.select("execution_id", "dataset_id").distinct()


def delete_groups(groups: DataFrame, tables: dict[str, DataFrame], executions: DataFrame, where: Column | None) -> dict[str, DataFrame]:
    """All tables without some groups and what hangs on them. A filter is required."""
    if where is None:
        raise ValueError("deleting needs a filter")
    gone = groups.where(where).select(F.col("id").alias("group_id"))
    runs = executions.join(gone, "group_id", "left_semi").select(F.col("id").alias("execution_id"))
    out = {name: df.join(runs, "execution_id", "left_anti") for name, df in tables.items()}
    return out | {"executions": executions.join(gone, "group_id", "left_anti"), "groups": groups.join(gone.withColumnRenamed("group_id", "id"), "id", "left_anti")}


def with_usage(executions: DataFrame, usage: DataFrame) -> DataFrame:
    """Measurements written to their executions; a missing one leaves the column as it is."""
    names = [c for c in usage.columns if c != "id"]
    new = usage.select("id", *(F.col(c).alias(f"__{c}") for c in names))
    return executions.join(new, "id", "left").withColumns({c: F.coalesce(f"__{c}", c) for c in names}).drop(*(f"__{c}" for c in names))


@contextmanager
def measured():
    """Wall and CPU seconds and peak memory of a block of driver code, filled in at its end."""
    found: dict[str, float | str] = {}
    began, cpu = time.perf_counter(), time.process_time()
    try:
        yield found
    finally:
        found |= {
            "wall_seconds": time.perf_counter() - began, "cpu_seconds": time.process_time() - cpu,
            "peak_memory_bytes": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024, "memory_source": "rusage",
        }
