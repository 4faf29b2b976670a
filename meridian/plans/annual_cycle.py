"""Annual cycles against reference climatologies: requirements, levels, seasons, and statistics by region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.gridded import cos_lat, monthly_climatology
from meridian.operators.levels import at_levels, seasonal
from meridian.operators.regrid import regrid
from meridian.plans.requirement import DataRequirement, Diagnostic

#: Variable, its branded name, and the climatology that it is held against.
PAIRS = (
    ("ts", "ts_tavg-u-hxy-u", "ERA-5"), ("uas", "uas_tavg-h10m-hxy-u", "ERA-5"), ("vas", "vas_tavg-h10m-hxy-u", "ERA-5"), ("psl", "psl_tavg-u-hxy-u", "ERA-5"),
    ("ta", "ta_tavg-p19-hxy-air", "ERA-5"), ("ua", "ua_tavg-p19-hxy-air", "ERA-5"), ("va", "va_tavg-p19-hxy-air", "ERA-5"), ("zg", "zg_tavg-p19-hxy-air", "ERA-5"), ("pr", "pr_tavg-u-hxy-u", "GPCP-3-3"),
    ("rlds", "rlds_tavg-u-hxy-u", "CERES-EBAF-4-2"), ("rlus", "rlus_tavg-u-hxy-u", "CERES-EBAF-4-2"), ("rlut", "rlut_tavg-u-hxy-u", "CERES-EBAF-4-2"), ("rsds", "rsds_tavg-u-hxy-u", "CERES-EBAF-4-2"),
    ("rsdt", "rsdt_tavg-u-hxy-u", "CERES-EBAF-4-2"), ("rsus", "rsus_tavg-u-hxy-u", "CERES-EBAF-4-2"), ("rsut", "rsut_tavg-u-hxy-u", "CERES-EBAF-4-2"),
)
#: Levels in pascal of variables that have them.
LEVELS = {"ta": (20000.0, 85000.0), "ua": (20000.0, 85000.0), "va": (20000.0, 85000.0), "zg": (50000.0,)}
EXPERIMENTS = ("amip", "historical", "hist-GHG")
#: Regions as bands of latitude, from and below.
BANDS = {"global": (-90.0, 90.1), "NHEX": (30.0, 90.1), "SHEX": (-90.0, -30.0), "TROPICS": (-30.0, 30.0)}
FACETS = ("kind", "mip_id", "source_id", "member_id", "experiment_id", "variable_id", "reference_source_id", "level", "region", "statistic", "season")


def annual_cycle() -> Diagnostic:
    """Sixteen variables, each for two eras: the climatology and the run."""
    alternatives = []
    for variable, branded, source in PAIRS:
        reference = DataRequirement("pmp_climatology", ({"source_id": (source,), "variable_id": (variable,)},), ("variable_id", "source_id"))
        six = {"frequency": ("mon",), "experiment_id": EXPERIMENTS, "variable_id": (variable,)}
        seven = {"branded_variable": (branded,), "experiment_id": EXPERIMENTS, "frequency": ("mon",), "region": ("glb",)}
        alternatives += [
            (reference, DataRequirement("cmip6", (six,), ("variable_id", "source_id", "experiment_id", "member_id", "grid_label"))),
            (reference, DataRequirement("cmip7", (seven,), ("variable_id", "source_id", "experiment_id", "variant_label", "grid_label"))),
        ]
    return Diagnostic("pmp", "annual-cycle", tuple(alternatives), facets=FACETS)


def climatology(df: DataFrame, keys: Sequence[str], variable: str) -> DataFrame:
    """Means of each month at the levels of a variable: keys, level (0 where it has none), month, lat, lon, value."""
    months = monthly_climatology(df, [*keys, "lat", "lon", *(["lev"] if variable in LEVELS else [])])
    if variable not in LEVELS:
        return months.withColumn("level", F.lit(0.0))
    return at_levels(months, [*keys, "lat", "lon", "month"], LEVELS[variable]).withColumnRenamed("lev", "level")


def _mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.nullif(F.sum(w), F.lit(0.0))


def statistics(model: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics of the differences over each region and season: keys, level, region, season, statistic, value.

    Both are climatologies on one grid: level, month, lat, lon, value, the model's with keys.
    Cells count by the cosine of latitude; only cells and seasons that both have.
    """
    place = ["level", "lat", "lon"]
    other = seasonal(reference, place).select(*place, "season", F.col("value").alias("o"))
    rows = seasonal(model, [*keys, *place]).withColumnRenamed("value", "m").join(other, [*place, "season"]).where("m is not null and o is not null")
    bands = F.array(*(F.when((F.col("lat") >= low) & (F.col("lat") < high), F.lit(name)) for name, (low, high) in BANDS.items()))
    rows = rows.withColumn("w", cos_lat()).withColumn("region", F.explode(F.filter(bands, lambda b: b.isNotNull())))
    m, o, w = F.col("m"), F.col("o"), F.col("w")
    means = rows.groupBy(*keys, "level", "region", "season").agg(
        _mean(m - o, w).alias("bias_xy"), _mean(F.abs(m - o), w).alias("mae_xy"), F.sqrt(_mean((m - o) * (m - o), w)).alias("rms_xy"), _mean(m, w).alias("mean_xy"), _mean(o, w).alias("mean-obs_xy"),
        _mean(m * m, w).alias("__mm"), _mean(o * o, w).alias("__oo"), _mean(m * o, w).alias("__mo"),
    )
    a, b = F.col("mean_xy"), F.col("`mean-obs_xy`")
    root = lambda square, mean: F.sqrt(F.when(square - mean * mean > 1e-12 * square, square - mean * mean).otherwise(0.0))  # noqa: E731  what is less is rounding
    spread = {"std_xy": root(F.col("__mm"), a), "std-obs_xy": root(F.col("__oo"), b)}
    found = means.withColumns(spread | {"rmsc_xy": F.sqrt(F.greatest(F.col("rms_xy") * F.col("rms_xy") - F.col("bias_xy") * F.col("bias_xy"), F.lit(0.0)))})
    found = found.withColumn("cor_xy", (F.col("__mo") - a * b) / F.nullif(F.col("std_xy") * F.col("`std-obs_xy`"), F.lit(0.0)))
    names = ("bias_xy", "mae_xy", "rms_xy", "rmsc_xy", "cor_xy", "mean_xy", "mean-obs_xy", "std_xy", "std-obs_xy")
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("statistic"), F.col(f"`{n}`").alias("value")) for n in names))).alias("x")
    return found.select(*keys, "level", "region", "season", pairs).select(*keys, "level", "region", "season", "x.*")


def annual_cycle_statistics(model: DataFrame, reference: DataFrame, keys: Sequence[str], variable: str, target: DataFrame | None = None) -> DataFrame:
    """From monthly fields on any two grids to statistics; ``target`` (lat, lon) is by default the reference's grid."""
    a, b = climatology(model, keys, variable), climatology(reference, [], variable)
    target = reference.select("lat", "lon").distinct() if target is None else target
    return statistics(regrid(a, target, [*keys, "level", "month"], keys), regrid(b, target, ["level", "month"]), keys)
