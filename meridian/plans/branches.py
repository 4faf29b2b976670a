"""Runs beside the parents they branched from: windows of years that start together, and what they give.

A window is so many years of a run from its start, and so many of its parent from the moment
that stands for that start, moved by an offset. Years are then counted from the windows'
starts, so that year n of a run meets year n of its parent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators import gridded
from meridian.plans.diagnostics import branch_aligned, climate_sensitivity, response_to_emissions

#: Years of the run, the parent's offset and years, by what is calculated.
WINDOWS = {"ecs": (150, 0, 150), "tcr": (140, 0, 140), "tcre": (65, 0, 65), "tcre-flat10": (110, 0, 110), "zec": (100, -10, 20)}
#: The twenty years around the doubling of carbon dioxide, and around the fiftieth year without emissions.
TCR_YEARS, ZEC_YEARS = (60, 79), (40, 59)


def branch_windows(children: DataFrame, parents: DataFrame, keys: Sequence[str], child_years: int, parent_offset: int, parent_years: int) -> DataFrame:
    """keys, child_first, child_last, parent_first, parent_last: years, the last ones included.

    ``children`` and ``parents`` are as ``diagnostics.branch_aligned`` takes them. A run
    without its start or branch times has no window.
    """
    rows = branch_aligned(children, parents, keys).where("child_start is not null and parent_start is not null")
    first, other = F.col("child_start.y"), F.col("parent_start.y") + parent_offset
    return rows.select(*keys, first.alias("child_first"), (first + child_years - 1).alias("child_last"), other.alias("parent_first"), (other + parent_years - 1).alias("parent_last"))


def in_window(df: DataFrame, windows: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """keys, year, value of a series (keys, year, value) inside its window, ``year`` counted from the window's start; ``side`` is child or parent."""
    rows = df.join(windows.select(*keys, F.col(f"{side}_first").alias("__first"), F.col(f"{side}_last").alias("__last")), list(keys))
    return rows.where(F.col("year").between(F.col("__first"), F.col("__last"))).select(*keys, (F.col("year") - F.col("__first")).alias("year"), "value")


def departures(child: DataFrame, parent: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, year, anomaly: each year of a run minus the same year of its parent."""
    a, b = in_window(child, windows, keys, "child"), in_window(parent, windows, keys, "parent").withColumnRenamed("value", "__parent")
    return a.join(b, [*keys, "year"]).select(*keys, "year", (F.col("value") - F.col("__parent")).alias("anomaly"))


def sensitivity(radiation: tuple[DataFrame, DataFrame], temperature: tuple[DataFrame, DataFrame], windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, lambda, ecs from yearly means of run and parent, of the radiation balance and of temperature."""
    return climate_sensitivity(departures(*radiation, windows, keys), departures(*temperature, windows, keys), keys)


def transient(child: DataFrame, parent: DataFrame, windows: DataFrame, keys: Sequence[str], years: tuple[int, int] = TCR_YEARS) -> DataFrame:
    """keys, tcr: a run's mean over some years beyond the line fitted to its parent's window."""
    line = gridded.trend(in_window(parent, windows, keys, "parent"), keys).select(*keys, "slope", "intercept")
    rows = in_window(child, windows, keys, "child").where(F.col("year").between(*years)).join(line, list(keys))
    return rows.groupBy(*keys).agg(F.avg(F.col("value") - F.col("slope") * F.col("year") - F.col("intercept")).alias("tcr"))


def per_emissions(child: DataFrame, parent: DataFrame, emissions: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, tcre: warming against the parent per unit of emissions summed since the start, in the last year."""
    return response_to_emissions(departures(child, parent, windows, keys), in_window(emissions, windows, keys, "child"), keys)


def commitment(child: DataFrame, parent: DataFrame, windows: DataFrame, keys: Sequence[str], years: tuple[int, int] = ZEC_YEARS) -> DataFrame:
    """keys, zec: a run's mean over some years without emissions minus the parent's mean around the branch."""
    base = in_window(parent, windows, keys, "parent").groupBy(*keys).agg(F.avg("value").alias("__base"))
    after = in_window(child, windows, keys, "child").where(F.col("year").between(*years)).groupBy(*keys).agg(F.avg("value").alias("value"))
    return after.join(base, list(keys)).select(*keys, (F.col("value") - F.col("__base")).alias("zec"))
