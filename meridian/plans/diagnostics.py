"""Shipped diagnostics: their requirements, and their reductions over gridded data in long form.

Requirements are data: ``cmip(...)`` puts together the usual chain of constraints.
Reductions take rows of one variable (keys, year, month, lat, lon, value, area).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.calendars import decode_time, from_ordinal, ordinal, parse_time
from meridian.operators import gridded
from meridian.operators.constraints import (
    PER_INSTANCE, AddParentDataset, AddSupplementaryDataset, Constraint, RequireContiguousTimerange, RequireFacets, RequireOverlappingTimerange, RequireTimerange, SelectFirstMember,
)
from meridian.plans.requirement import DataRequirement, Diagnostic

#: What makes a group of one model run in each era.
RUN = {"cmip6": ("source_id", "member_id", "grid_label"), "cmip7": ("source_id", "variant_label", "grid_label")}


def months(first: int, last: int, source_type: str = "") -> RequireTimerange:
    return RequireTimerange(PER_INSTANCE, {"year": first, "month": 1}, {"year": last, "month": 12})


def cmip(source_type: str, facets: Mapping[str, Sequence[str]] | Sequence[Mapping[str, Sequence[str]]], *constraints: Constraint, group_by: tuple[str, ...] | None = None) -> DataRequirement:
    filters = (facets,) if isinstance(facets, Mapping) else tuple(facets)
    return DataRequirement(source_type, filters, group_by or RUN[source_type], constraints)


CONTIGUOUS, OVERLAPPING = RequireContiguousTimerange(PER_INSTANCE), RequireOverlappingTimerange(PER_INSTANCE)


def area(source_type: str, variable: str = "areacella") -> AddSupplementaryDataset:
    return AddSupplementaryDataset.of(variable, source_type)


def _cmip6(experiment: str, table: str, *variables: str) -> dict[str, tuple[str, ...]]:
    return {"variable_id": variables, "experiment_id": (experiment,), "table_id": (table,)}


_RADIATION = ("rlut", "rsdt", "rsut", "tas")
_CLOUDS = ("rlut", "rlutcs", "rsut", "rsutcs")

#: Provider, name -> the CMIP6 form of its requirement.
CMIP6_REQUIREMENTS: dict[tuple[str, str], tuple[DataRequirement, ...]] = {
    ("example", "global-mean-timeseries"): (cmip("cmip6", {"variable_id": ("tas", "rsut")}, CONTIGUOUS, area("cmip6"), group_by=("source_id", "variable_id", "experiment_id", "variant_label")),),
    ("example", "global-sst-bias"): (
        cmip("cmip6", {"variable_id": ("tos",), "experiment_id": ("historical",)}, CONTIGUOUS, area("cmip6", "areacello"), group_by=("source_id", "variable_id", "experiment_id", "variant_label")),
        DataRequirement("obs4mips", ({"source_id": ("HadISST-1-1",), "variable_id": ("ts",)},), ("source_id", "variable_id")),
    ),
    ("esmvaltool", "equilibrium-climate-sensitivity"): (
        cmip("cmip6", _cmip6("abrupt-4xCO2", "Amon", *_RADIATION), OVERLAPPING, AddParentDataset.of("cmip6"), CONTIGUOUS, RequireFacets("variable_id", _RADIATION, group_by=(*RUN["cmip6"], "experiment_id")), area("cmip6")),
    ),
    ("esmvaltool", "transient-climate-response"): (cmip("cmip6", _cmip6("1pctCO2", "Amon", "tas"), AddParentDataset.of("cmip6"), CONTIGUOUS, area("cmip6")),),
    ("esmvaltool", "zero-emission-commitment"): (cmip("cmip6", _cmip6("esm-1pct-brch-1000PgC", "Amon", "tas"), AddParentDataset.of("cmip6"), CONTIGUOUS, area("cmip6")),),
    ("esmvaltool", "transient-climate-response-emissions"): (
        cmip(
            "cmip6", _cmip6("esm-1pctCO2", "Amon", "tas"), AddParentDataset.of("cmip6"),
            AddSupplementaryDataset({"variable_id": ("fco2antt",), "experiment_id": ("esm-1pctCO2",)}, ("source_id", "member_id", "table_id", "grid_label"), ("version",)),
            CONTIGUOUS, RequireFacets("variable_id", ("tas", "fco2antt")), area("cmip6"),
        ),
    ),
    ("esmvaltool", "sea-ice-sensitivity"): (
        cmip(
            "cmip6", (_cmip6("historical", "SImon", "siconc"), _cmip6("historical", "Amon", "tas")), months(1979, 2014), RequireFacets("variable_id", ("siconc", "tas"), group_by=RUN["cmip6"]),
            SelectFirstMember("member_id", ("source_id",)), area("cmip6"), area("cmip6", "areacello"), RequireFacets("variable_id", ("areacello",), group_by=("source_id", "grid_label")), group_by=("experiment_id",),
        ),
    ),
    ("esmvaltool", "sea-ice-area-basic"): (cmip("cmip6", _cmip6("historical", "SImon", "siconc"), months(1979, 2014), area("cmip6", "areacello"), RequireFacets("variable_id", ("siconc", "areacello"))),),
    ("esmvaltool", "cloud-radiative-effects"): (cmip("cmip6", _cmip6("historical", "Amon", *_CLOUDS), months(1996, 2014), OVERLAPPING, RequireFacets("variable_id", _CLOUDS), area("cmip6")),),
    ("esmvaltool", "enso-basic-climatology"): (cmip("cmip6", (_cmip6("historical", "Amon", "pr", "tauu"), _cmip6("historical", "Omon", "tos")), CONTIGUOUS, OVERLAPPING, RequireFacets("variable_id", ("pr", "tauu", "tos"))),),
    ("esmvaltool", "enso-characteristics"): (cmip("cmip6", _cmip6("historical", "Omon", "tos"), CONTIGUOUS, OVERLAPPING, area("cmip6", "areacello"), RequireFacets("variable_id", ("tos", "areacello"))),),
    ("esmvaltool", "ozone"): (cmip("cmip6", _cmip6("historical", "AERmon", "toz"), months(1996, 2014), CONTIGUOUS, area("cmip6")),),
    ("esmvaltool", "ozone-zonal-mean"): (cmip("cmip6", _cmip6("historical", "Amon", "o3"), months(2005, 2014), CONTIGUOUS),),
    ("esmvaltool", "regional-annual-cycle"): (cmip("cmip6", _cmip6("historical", "Amon", "hus", "pr", "psl", "tas", "ua"), months(1980, 2009), area("cmip6")),),
    ("esmvaltool", "regional-timeseries"): (cmip("cmip6", _cmip6("historical", "Amon", "hus", "pr", "psl", "tas", "ua"), months(1980, 2014), area("cmip6")),),
    ("esmvaltool", "climate-drivers-for-fire"): (
        cmip(
            "cmip6", (_cmip6("historical", "Amon", "hurs", "pr", "tas", "tasmax"), _cmip6("historical", "Lmon", "cVeg", "treeFrac"), _cmip6("historical", "Emon", "vegFrac")), months(1995, 2014), area("cmip6", "sftlf"),
            RequireFacets("variable_id", ("cVeg", "hurs", "pr", "tas", "tasmax", "sftlf", "treeFrac", "vegFrac")),
        ),
    ),
}


def _cmip7(experiment: str, *branded: str, region: str | None = "glb") -> dict[str, tuple[str, ...]]:
    return {"branded_variable": branded, "experiment_id": (experiment,), "frequency": ("mon",)} | ({"region": (region,)} if region else {})


def _observed(*variables: str, first: int, last: int, source: str = "ERA-5", group_by: tuple[str, ...] = ("source_id",)) -> DataRequirement:
    return DataRequirement("obs4mips", ({"variable_id": variables, "source_id": (source,), "frequency": ("mon",)},), group_by, (months(first, last),))


def _scatter(era: str, *variables: str) -> DataRequirement:
    facets = _cmip6("historical", "Amon", *variables) if era == "cmip6" else _cmip7("historical", *variables)
    member = RUN[era][1]
    plain = tuple(v.split("_")[0] for v in variables)
    return cmip(era, facets, months(1996, 2014), RequireFacets("variable_id", plain), area(era), group_by=("source_id", "experiment_id", member, "frequency", "grid_label"))


_EXAMPLE = ("source_id", "variable_id", "experiment_id", "variant_label")
_TAS, _TOS = "tas_tavg-h2m-hxy-u", "tos_tavg-u-hxy-sea"
_REGIONAL = ("hus_tavg-p19-hxy-u", "pr_tavg-u-hxy-u", "psl_tavg-u-hxy-u", _TAS, "ua_tavg-p19-hxy-air")
_HADISST = DataRequirement("obs4mips", ({"source_id": ("HadISST-1-1",), "variable_id": ("ts",)},), ("source_id", "variable_id"))
_GWL = ("source_id", "member_id", "grid_label", "table_id")

#: Provider, name -> further alternatives of its requirement, beside the CMIP6 form where there is one.
ALTERNATIVES: dict[tuple[str, str], tuple[tuple[DataRequirement, ...], ...]] = {
    ("example", "global-mean-timeseries"): ((cmip("cmip7", {"variable_id": ("tas", "rsut")}, CONTIGUOUS, area("cmip7"), group_by=_EXAMPLE),),),
    ("example", "global-sst-bias"): ((cmip("cmip7", {"variable_id": ("tos",), "experiment_id": ("historical",)}, CONTIGUOUS, area("cmip7", "areacello"), group_by=_EXAMPLE), _HADISST),),
    ("esmvaltool", "equilibrium-climate-sensitivity"): ((
        cmip("cmip7", _cmip7("abrupt-4xCO2", "rlut_tavg-u-hxy-u", "rsdt_tavg-u-hxy-u", "rsut_tavg-u-hxy-u", _TAS), OVERLAPPING, AddParentDataset.of("cmip7"), CONTIGUOUS, RequireFacets("variable_id", _RADIATION, group_by=(*RUN["cmip7"], "experiment_id")), area("cmip7")),
    ),),
    ("esmvaltool", "transient-climate-response"): ((cmip("cmip7", _cmip7("1pctCO2", _TAS), AddParentDataset.of("cmip7"), CONTIGUOUS, area("cmip7")),),),
    ("esmvaltool", "transient-climate-response-emissions"): ((
        cmip(
            "cmip7", _cmip7("esm-flat10", _TAS), AddParentDataset.of("cmip7"), AddSupplementaryDataset(_cmip7("esm-flat10", "fco2antt_tavg-u-hxy-u"), RUN["cmip7"], ("version",)),
            CONTIGUOUS, RequireFacets("variable_id", ("tas", "fco2antt")), area("cmip7"),
        ),
    ),),
    ("esmvaltool", "zero-emission-commitment"): ((cmip("cmip7", _cmip7("esm-flat10-zec", _TAS), AddParentDataset.of("cmip7"), CONTIGUOUS, area("cmip7")),),),
    ("esmvaltool", "sea-ice-sensitivity"): ((
        cmip(
            "cmip7", (_cmip7("historical", "siconc_tavg-u-hxy-u"), _cmip7("historical", _TAS)), months(1979, 2014), RequireFacets("variable_id", ("siconc", "tas"), group_by=RUN["cmip7"]),
            SelectFirstMember("variant_label", ("source_id",)), area("cmip7"), area("cmip7", "areacello"), RequireFacets("variable_id", ("areacello",), group_by=("source_id", "grid_label")), group_by=("experiment_id",),
        ),
    ),),
    ("esmvaltool", "sea-ice-area-basic"): ((cmip("cmip7", _cmip7("historical", "siconc_tavg-u-hxy-u"), months(1979, 2014), area("cmip7", "areacello"), RequireFacets("variable_id", ("siconc", "areacello"))),),),
    ("esmvaltool", "enso-basic-climatology"): ((cmip("cmip7", (_cmip7("historical", "pr_tavg-u-hxy-u", "tauu_tavg-u-hxy-u"), _cmip7("historical", _TOS)), CONTIGUOUS, OVERLAPPING, RequireFacets("variable_id", ("pr", "tauu", "tos"))),),),
    ("esmvaltool", "enso-characteristics"): ((cmip("cmip7", _cmip7("historical", _TOS), CONTIGUOUS, OVERLAPPING, area("cmip7", "areacello"), RequireFacets("variable_id", ("tos", "areacello"))),),),
    ("esmvaltool", "climate-drivers-for-fire"): ((
        cmip(
            "cmip7", (_cmip7("historical", "hurs_tavg-h2m-hxy-u", "pr_tavg-u-hxy-u", _TAS, "tas_tmaxavg-h2m-hxy-u"), _cmip7("historical", "cVeg_tavg-u-hxy-lnd", "treeFrac_tavg-u-hxy-u", "vegFrac_tavg-u-hxy-u")), months(2002, 2021), area("cmip7", "sftlf"),
            RequireFacets("branded_variable", ("cVeg_tavg-u-hxy-lnd", "hurs_tavg-h2m-hxy-u", "pr_tavg-u-hxy-u", "sftlf_ti-u-hxy-u", _TAS, "tas_tmaxavg-h2m-hxy-u", "treeFrac_tavg-u-hxy-u", "vegFrac_tavg-u-hxy-u")),
        ),
    ),),
    ("esmvaltool", "regional-annual-cycle"): ((cmip("cmip7", _cmip7("historical", *_REGIONAL, region=None), months(1980, 2009), area("cmip7")),), (_observed("psl", "ua", first=1980, last=2009),)),
    ("esmvaltool", "regional-timeseries"): ((cmip("cmip7", _cmip7("historical", *_REGIONAL), months(1980, 2014), area("cmip7")),), (_observed("psl", "ua", first=1980, last=2014),)),
    ("esmvaltool", "regional-historical-trend"): (
        (cmip("cmip6", _cmip6("historical", "Amon", "hus", "pr", "psl", "tas", "ua"), months(1980, 2009), area("cmip6")),), (cmip("cmip7", _cmip7("historical", *_REGIONAL, region=None), months(1980, 2009), area("cmip7")),),
        (_observed("psl", "tas", "ua", first=1980, last=2009),),
    ),
    ("esmvaltool", "global-mean-timeseries"): (
        (cmip("cmip6", {"variable_id": ("tas",)}, CONTIGUOUS, area("cmip6"), group_by=("source_id", "experiment_id", "member_id", "table_id", "variable_id", "grid_label")),),
        (cmip("cmip7", {"branded_variable": (_TAS,), "region": ("glb",)}, CONTIGUOUS, area("cmip7"), group_by=("source_id", "experiment_id", "variant_label", "variable_id", "grid_label")),),
    ),
    ("esmvaltool", "climate-at-global-warming-levels"): ((
        cmip(
            "cmip6", {"variable_id": ("pr", "tas"), "experiment_id": ("ssp126", "ssp245", "ssp370", "ssp585"), "table_id": ("Amon",)}, AddSupplementaryDataset({"experiment_id": ("historical",)}, _GWL, ()),
            RequireTimerange(_GWL, {"year": 1850, "month": 1}, {"year": 2100, "month": 12}), RequireFacets("experiment_id", ("historical",), group_by=_GWL), RequireFacets("variable_id", ("pr", "tas"), group_by=("experiment_id", *_GWL)), area("cmip6"),
            group_by=("experiment_id",),
        ),
    ),),
    ("esmvaltool", "cloud-scatterplots-clt-swcre"): ((_scatter("cmip6", "clt", "rsut", "rsutcs"),), (_scatter("cmip7", "clt_tavg-u-hxy-u", "rsut_tavg-u-hxy-u", "rsutcs_tavg-u-hxy-u"),)),
    ("esmvaltool", "cloud-scatterplots-clwvi-pr"): ((_scatter("cmip6", "clwvi", "pr"),), (_scatter("cmip7", "clwvi_tavg-u-hxy-u", "pr_tavg-u-hxy-u"),)),
    ("esmvaltool", "cloud-scatterplots-clivi-lwcre"): ((_scatter("cmip6", "clivi", "rlut", "rlutcs"),), (_scatter("cmip7", "clivi_tavg-u-hxy-u", "rlut_tavg-u-hxy-u", "rlutcs_tavg-u-hxy-u"),)),
    ("esmvaltool", "cloud-scatterplots-cli-ta"): ((_scatter("cmip6", "cli", "ta"),), (_scatter("cmip7", "cli_tavg-al-hxy-u", "ta_tavg-p19-hxy-air"),)),
    ("esmvaltool", "cloud-scatterplots-reference"): ((DataRequirement("obs4mips", ({"source_id": ("ERA-5",), "variable_id": ("ta",)},), ("instance_id",), (months(2007, 2014),)),),),
}


def shipped() -> list[Diagnostic]:
    """All diagnostics, each with its alternatives: the CMIP6 form first."""
    names = [*CMIP6_REQUIREMENTS, *(k for k in ALTERNATIVES if k not in CMIP6_REQUIREMENTS)]
    return [Diagnostic(p, slug, (*((CMIP6_REQUIREMENTS[p, slug],) if (p, slug) in CMIP6_REQUIREMENTS else ()), *ALTERNATIVES.get((p, slug), ()))) for p, slug in names]


# ----------------------------------------------------------------- reductions


def global_mean_timeseries(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return gridded.annual_then_global(df, keys)


def sst_bias(model: DataFrame, reference: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Yearly series of model, reference and bias, and their statistics; the reference is weighted by the cosine of latitude."""
    a = gridded.global_then_annual(model, keys)
    b = gridded.global_then_annual(reference, [], gridded.cos_lat())
    rows = gridded.bias(a, b, keys)
    return rows, gridded.bias_statistics(rows, keys)


def climate_sensitivity(radiation: DataFrame, temperature: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Regression of radiation anomalies on temperature anomalies: ``lambda`` is the slope, ``ecs`` half the zero crossing.

    Both inputs are yearly: keys, year, anomaly.
    """
    both = radiation.select(*keys, "year", F.col("anomaly").alias("n")).join(temperature.select(*keys, "year", F.col("anomaly").alias("t")), [*keys, "year"])
    fit = both.groupBy(*keys).agg(F.regr_slope("n", "t").alias("lambda"), F.regr_intercept("n", "t").alias("forcing"))
    return fit.select(*keys, "lambda", (-F.col("forcing") / F.col("lambda") / 2).alias("ecs"))


def transient_response(run: DataFrame, control: DataFrame, keys: Sequence[str], first: int = 60, last: int = 79) -> DataFrame:
    """Mean warming over years ``first`` to ``last`` of a run beyond the control's linear fit."""
    fit = gridded.trend(control, keys)
    rows = run.join(fit.select(*keys, "slope", "intercept"), list(keys)).where(F.col("year").between(first, last))
    return rows.groupBy(*keys).agg(F.avg(F.col("value") - F.col("slope") * F.col("year") - F.col("intercept")).alias("tcr"))


def response_to_emissions(warming: DataFrame, emissions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Warming per unit of emissions summed so far, in the last year."""
    so_far = Window.partitionBy(*keys).orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    total = emissions.withColumn("total", F.sum("value").over(so_far)).select(*keys, "year", "total")
    rows = warming.join(total, [*keys, "year"]).where("total <> 0")
    return rows.groupBy(*keys).agg(F.max_by(F.col("anomaly") / F.col("total"), "year").alias("tcre"))


def zero_emission_commitment(run: DataFrame, base: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Mean temperature over some years of a run without emissions minus the mean of the base period."""
    before = base.groupBy(*keys).agg(F.avg("value").alias("base"))
    after = run.where(F.col("year").between(first, last)).groupBy(*keys).agg(F.avg("value").alias("value"))
    return after.join(before, list(keys)).select(*keys, (F.col("value") - F.col("base")).alias("zec"))


def sea_ice_area(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Concentration (percent) times cell area, summed per month."""
    return df.where("value is not null and area is not null").groupBy(*keys, "year", "month").agg(F.sum(F.col("value") / 100 * F.col("area")).alias("value"))


def warming_level_years(yearly: DataFrame, levels: Sequence[float], keys: Sequence[str], window: int = 21) -> DataFrame:
    """For each level the first year whose centred running mean of anomalies reaches it."""
    half = window // 2
    w = Window.partitionBy(*keys).orderBy("year").rowsBetween(-half, half)
    rows = yearly.withColumns({"mean": F.avg("anomaly").over(w), "n": F.count("anomaly").over(w)}).where(F.col("n") == window)
    levels_col = F.explode(F.array(*map(F.lit, levels))).alias("level")
    return rows.select(*keys, "year", "mean", levels_col).where("mean >= level").groupBy(*keys, "level").agg(F.min("year").alias("year"))


def annual_cycle(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return gridded.monthly_climatology(df, keys)


def regional_timeseries(df: DataFrame, regions: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Yearly means and anomalies of named boxes (region, lat_min, lat_max, lon_min, lon_max)."""
    inside = (F.col("lat") >= F.col("lat_min")) & (F.col("lat") < F.col("lat_max")) & (F.col("lon") >= F.col("lon_min")) & (F.col("lon") < F.col("lon_max"))
    cells = df.select("lat", "lon").distinct().join(regions, inside).select("lat", "lon", "region")  # cells of the grid, not values
    return gridded.anomalies(gridded.global_then_annual(df.join(cells, ["lat", "lon"]), [*keys, "region"]), [*keys, "region"], first, last)


def polar_cap(df: DataFrame, keys: Sequence[str], month: int, lat_min: float, lat_max: float) -> DataFrame:
    """Weighted mean over a latitude band in one month of each year."""
    band = df.where((F.col("month") == month) & F.col("lat").between(lat_min, lat_max))
    return band.groupBy(*keys, "year").agg(gridded.weighted_mean(F.col("value"), F.coalesce("area", gridded.cos_lat())).alias("value"))


def cloud_effects(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Zonal means of the shortwave and longwave cloud effects, from columns rsut, rsutcs, rlut and rlutcs."""
    rows = df.withColumns({"swcre": F.col("rsutcs") - F.col("rsut"), "lwcre": F.col("rlutcs") - F.col("rlut")})
    return rows.groupBy(*keys, "lat").agg(F.avg("swcre").alias("swcre"), F.avg("lwcre").alias("lwcre"))


def pattern_statistics(model: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bias, error and correlation of climatologies over all cells and months."""
    other = reference.select("lat", "lon", "month", F.col("value").alias("reference"))
    rows = model.join(other, ["lat", "lon", "month"])
    d = F.col("value") - F.col("reference")
    return rows.groupBy(*keys).agg(F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"), F.corr("value", "reference").alias("correlation"), F.stddev_pop("value").alias("spread"))


def index_statistics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amplitude, skewness and one-step persistence of a monthly index."""
    w = Window.partitionBy(*keys).orderBy("year", "month")
    rows = df.withColumn("before", F.lag("value").over(w))
    return rows.groupBy(*keys).agg(F.stddev_pop("value").alias("amplitude"), F.skewness("value").alias("skewness"), F.corr("value", "before").alias("persistence"))


def principal_patterns(df: DataFrame, keys: Sequence[str], k: int = 1):
    """Leading patterns of variability: PCA of anomaly fields, one row per time step with a vector ``field``."""
    from pyspark.ml.feature import PCA

    return PCA(k=k, inputCol="field", outputCol="components").fit(df)


def branch_aligned(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Where in its parent a run branched off: the parent's time that stands for the child's first.

    Both have the keys, branch times, time_units and calendar; children also start_time (a
    text). The offset between the branch times, each decoded by its own units and
    calendar, is added to the child's start.
    """
    def seconds(value: str, units: str, calendar: str) -> Column:
        return ordinal(decode_time(F.col(value), F.col(units), F.col(calendar)), F.col(calendar))

    other = parents.select(*keys, F.col("time_units").alias("parent_units"), F.col("calendar").alias("parent_calendar"))
    rows = children.join(other, list(keys)).withColumns({
        "in_parent": seconds("branch_time_in_parent", "parent_units", "parent_calendar"), "in_child": seconds("branch_time_in_child", "time_units", "calendar"),
        "child_start": parse_time(F.col("start_time"), F.col("calendar")),
    })
    start = from_ordinal(ordinal(F.col("child_start"), F.col("calendar")) + F.col("in_parent") - F.col("in_child"), F.col("calendar"))
    return rows.withColumn("parent_start", start).drop("in_parent", "in_child")


#: The box of the Pacific whose temperature is the index, in degrees.
NINO_34 = ((-5.0, 5.0), (190.0, 240.0))


def enso_teleconnection(temperature: DataFrame, field: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each cell's regression on the index of the Pacific's temperature."""
    return gridded.regressed_on(field, gridded.nino_index(temperature, keys, *NINO_34), keys)


def standard_scores(model: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Land and ocean benchmark: bias, error and seasonal scores, and their mean."""
    found = gridded.scores(model, reference, keys)
    return found.withColumn("overall", (F.col("bias_score") + 2 * F.col("rmse_score") + F.col("season_score")) / 4)
