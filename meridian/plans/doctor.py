"""Checks of a catalogue and its configuration. Each gives findings: check, severity, subject, message."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.aggregates import missing_references, registries_per_source, unreachable_types
from meridian.operators.windows import overlaps

SEVERITIES = ("info", "warning", "error")
Check = Callable[[Mapping[str, DataFrame]], DataFrame]
CHECKS: dict[str, Check] = {}


def check(name: str) -> Callable[[Check], Check]:
    """Register a check; the tables it needs come by name."""

    def add(f: Check) -> Check:
        CHECKS[name] = f
        return f

    return add


def findings(df: DataFrame, name: str, severity: str, subject: Column, message: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"), message.alias("message"))


@check("duplicate-coverage")
def duplicate_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Files of one dataset that cover the same time."""
    found = overlaps(tables["files"].where("start_ord is not null and end_ord is not null"), ["dataset_id"], "start_ord", "end_ord", "path")
    return findings(found, "duplicate-coverage", "warning", F.col("dataset_id"), F.concat(F.lit("covered twice: "), "path"))


@check("missing-reference")
def missing_reference(tables: Mapping[str, DataFrame]) -> DataFrame:
    found = missing_references(tables["required"], tables["datasets"])
    return findings(found, "missing-reference", "error", F.col("source_id"), F.concat(F.lit("not in the catalogue, of type "), "source_type"))


@check("unreachable-type")
def unreachable_type(tables: Mapping[str, DataFrame]) -> DataFrame:
    return findings(unreachable_types(tables["datasets"], tables["required"]), "unreachable-type", "info", F.col("source_type"), F.lit("no requirement asks for it"))


@check("overlapping-registries")
def overlapping_registries(tables: Mapping[str, DataFrame]) -> DataFrame:
    found = registries_per_source(tables["registry"]).where("size(registries) > 1")
    return findings(found, "overlapping-registries", "warning", F.col("source_id"), F.concat(F.lit("in "), F.array_join("registries", ", ")))


def run_checks(tables: Mapping[str, DataFrame], least: str = "info", names: list[str] | None = None) -> DataFrame:
    """Findings of all checks of at least some severity.

    A check that fails, for want of its tables or when its first rows are read, is a
    finding itself and keeps no other from running.
    """
    every = []
    for name, f in CHECKS.items():
        if names is not None and name not in names:
            continue
        try:
            own = f(tables)
            own.take(1)
            every.append(own)
        except Exception as e:  # noqa: BLE001  whatever ends one check must not end the others
            spark = next(iter(tables.values())).sparkSession
            subject = str(e.args[0]) if isinstance(e, KeyError) else type(e).__name__
            every.append(spark.createDataFrame([(name, "error", subject, "the check could not run")], "check string, severity string, subject string, message string"))
    wanted = SEVERITIES[SEVERITIES.index(least) :]
    return reduce(DataFrame.unionByName, every).where(F.col("severity").isin(*wanted))


def severity_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("n"))
