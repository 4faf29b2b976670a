"""Vertical interpolation and seasons of gridded data in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of the months by calendar; the standard one's February is that of the mean year.
MONTH_DAYS: Mapping[str, tuple[float, ...]] = {
    "standard": (31, 28.25, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), "noleap": (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31),
    "all_leap": (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), "360_day": (30,) * 12,
}
#: Seasons and their months.
SEASONS: Mapping[str, tuple[int, ...]] = {"DJF": (12, 1, 2), "MAM": (3, 4, 5), "JJA": (6, 7, 8), "SON": (9, 10, 11), "AC": tuple(range(1, 13))}


def at_levels(df: DataFrame, keys: Sequence[str], targets: Sequence[float], lev: str = "lev", value: str = "value") -> DataFrame:
    """Values at some pressures, linear in the logarithm of pressure between the two nearest levels: keys, ``lev``, ``value``.

    ``keys`` name a column of air: everything but the level. Each target's neighbours are
    a maximum and a minimum, so no column of air is gathered. Beyond the outermost levels
    of a column, and next to a missing value, the result is null; a level that is there
    gives its own value. Levels that are null or not positive are left out.
    """
    rows = df.where((F.col(lev) > 0) & F.col(value).isNotNull() & ~F.isnan(value) | F.col(lev).isNotNull() & (F.col(lev) > 0))
    pair = F.struct(F.col(lev).cast("double").alias("p"), F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("v"))
    sides = []
    for k, t in enumerate(targets):
        sides += [F.max_by(pair, F.when(F.col(lev) <= t, F.col(lev))).alias(f"__low{k}"), F.min_by(pair, F.when(F.col(lev) >= t, F.col(lev))).alias(f"__high{k}")]
    wide = rows.groupBy(*keys).agg(*sides)
    found = []
    for k, t in enumerate(targets):
        low, high = F.col(f"__low{k}"), F.col(f"__high{k}")
        share = (F.log(F.lit(float(t))) - F.log(low["p"])) / F.nullif(F.log(high["p"]) - F.log(low["p"]), F.lit(0.0))
        found.append(F.struct(F.lit(float(t)).alias(lev), F.when(low["p"] == high["p"], low["v"]).otherwise(low["v"] + share * (high["v"] - low["v"])).alias(value)))
    return wide.select(*keys, F.explode(F.array(*found)).alias("__x")).select(*keys, f"__x.{lev}", f"__x.{value}")


def month_days(month: Column, calendar: str = "standard") -> Column:
    return F.get(F.array(*map(F.lit, MONTH_DAYS[calendar])), month - 1).cast("double")


def seasonal(df: DataFrame, keys: Sequence[str], calendar: str = "standard", value: str = "value") -> DataFrame:
    """Seasonal means of a monthly climatology, months weighted by their length: keys, season, value.

    ``keys`` include the place. A season of which a month is missing is null.
    """
    member = F.filter(F.array(*(F.struct(F.lit(s).alias("season"), F.array(*map(F.lit, m)).alias("months")) for s, m in SEASONS.items())), lambda s: F.array_contains(s["months"], F.col("month")))
    days = month_days(F.col("month"), calendar)
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("__d", days).withColumn("__s", F.explode(member))
    sums = rows.groupBy(*keys, F.col("__s.season").alias("season")).agg(F.sum(F.col(value) * F.col("__d")).alias("__v"), F.sum("__d").alias("__d"), F.count_distinct("month").alias("__n"), F.first(F.size("__s.months")).alias("__all"))
    return sums.select(*keys, "season", F.when(F.col("__n") == F.col("__all"), F.col("__v") / F.col("__d")).alias(value))
