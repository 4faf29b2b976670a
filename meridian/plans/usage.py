"""What jobs have used: Spark's own task metrics by job group, and readings of the machine in order of precedence."""

from __future__ import annotations

import resource
from collections.abc import Mapping
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from meridian.operators.aggregates import SOURCE_ORDER


def job_usage(spark: SparkSession, group: str) -> dict:
    """CPU seconds and the largest task memory of all tasks of a job group, on whatever executors they ran.

    Jobs that run at the same time under other groups are not in it. ``memory_source`` is ``tasks``.
    """
    context = spark.sparkContext
    jvm_context = context._jsc.sc()
    jvm_context.listenerBus().waitUntilEmpty(30_000)
    tracker, store = context.statusTracker(), jvm_context.statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) if (job := tracker.getJobInfo(j)) for s in job.stageIds}
    found = {"cpu_seconds": 0.0, "run_seconds": 0.0, "peak_memory_bytes": 0, "read_bytes": 0, "shuffled_bytes": 0, "stages": 0, "memory_source": "tasks"}
    for s in sorted(stages):
        try:
            data = store.lastStageAttempt(s)
        except Py4JJavaError:  # never submitted, or no longer kept
            continue
        found["cpu_seconds"] += data.executorCpuTime() / 1e9
        found["run_seconds"] += data.executorRunTime() / 1e3
        found["peak_memory_bytes"] = max(found["peak_memory_bytes"], data.peakExecutionMemory())
        found["read_bytes"] += data.inputBytes()
        found["shuffled_bytes"] += data.shuffleWriteBytes()
        found["stages"] += 1
    return found


def cgroup_peak(root: str = "/sys/fs/cgroup") -> tuple[int | None, int | None]:
    """The peak and the limit of the control group, each None where there is no reading."""
    def read(*names: str) -> int | None:
        for n in names:
            try:
                text = Path(root, n).read_text().strip()
            except OSError:
                continue
            return int(text) if text.isdigit() else None
        return None

    return read("memory.peak", "memory/memory.max_usage_in_bytes"), read("memory.max", "memory/memory.limit_in_bytes")


def proc_tree_peak(pid: int, proc: str = "/proc") -> int | None:
    """The resident bytes of a process and all below it."""
    parents: dict[int, list[int]] = {}
    sizes: dict[int, int] = {}
    for p in Path(proc).glob("[0-9]*"):
        try:
            fields = {k: v for k, _, v in (line.partition(":") for line in (p / "status").read_text().splitlines())}
        except OSError:
            continue
        parents.setdefault(int(fields["PPid"]), []).append(int(p.name))
        sizes[int(p.name)] = int(fields.get("VmRSS", "0 kB").split()[0]) * 1024
    if pid not in sizes:
        return None
    total, todo = 0, [pid]
    while todo:
        x = todo.pop()
        total += sizes.get(x, 0)
        todo += parents.get(x, [])
    return total


def rusage_peak() -> int:
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024


def preferred(readings: Mapping[str, int | None]) -> tuple[str | None, int | None]:
    """The reading of the best source there is: cgroup, then proc_tree, then rusage, then any other."""
    for name in (*SOURCE_ORDER, *sorted(set(readings) - set(SOURCE_ORDER))):
        if readings.get(name) is not None:
            return name, readings[name]
    return None, None
