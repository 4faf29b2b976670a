"""Land and ocean benchmarks: what each needs, and its scores wherever the grids lie."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators import gridded, regrid
from meridian.operators.constraints import AddSupplementaryDataset, RequireFacets
from meridian.plans.requirement import DataRequirement, Diagnostic


@dataclass(frozen=True)
class Benchmark:
    """One variable against one reference.

    ``observed`` are the facets of the reference in the catalogue; without any it comes
    from a registry. Any of ``variable``, ``instead`` and ``related`` will do, all of
    ``relationships`` must be there.
    """

    name: str
    variable: str
    observed: Mapping[str, str] = field(default_factory=dict)
    instead: tuple[str, ...] = ()
    related: tuple[str, ...] = ()
    relationships: tuple[str, ...] = ()
    land: bool = True
    version: int = 1


def _obs(source: str, variable: str, version: str | None = None, grid: str = "gn") -> dict[str, str]:
    return {"source_id": source, "variable_id": variable, "grid_label": grid} | ({"version": version} if version else {})


#: The benchmarks as configured.
BENCHMARKS = (
    Benchmark("gpp-WECANN", "gpp", _obs("WECANN-1-0", "gpp", "v20250902"), relationships=("pr", "tas"), version=3),
    Benchmark("gpp-FLUXNET2015", "gpp", version=4),
    Benchmark("mrro-LORA", "mrro", _obs("LORA-1-0", "mrro", "v20250902"), version=3),
    Benchmark("mrsos-WangMao", "mrsol", instead=("mrsos",)),
    Benchmark("cSoil-HWSD2", "cSoil", _obs("HWSD-2-0", "cSoil", "v20250903"), version=3),
    Benchmark("lai-AVH15C1", "lai", _obs("NOAA-NCEI-LAI-AVHRR-5-0", "lai"), version=4),
    Benchmark("nbp-Hoffman", "nbp", _obs("Hoffman-1-0", "nbp", "v20251117", "gm"), version=3),
    Benchmark("snc-ESACCI", "snc", _obs("CCI-CryoClim-FSC-1", "snc", "v20250519"), version=3),
    Benchmark("burntFractionAll-GFED", "burntFractionAll", _obs("GFED-5-0", "burntFractionAll", "v20260128", "gr"), version=3),
    Benchmark("emp-GLEAMGPCP2.3", "emp", instead=("evspsbl",)),
    Benchmark("thetao-WOA2023-surface", "thetao", _obs("WOA-23", "thetao", "v20251024"), instead=("tos",), land=False, version=3),
    Benchmark("so-WOA2023-surface", "so", _obs("WOA-23", "so", "v20251024"), instead=("sos",), land=False, version=3),
    Benchmark("amoc-RAPID", "amoc", _obs("RAPID-2023-1a", "msftmz", "v20250902", "gm"), related=("msftmz",), land=False, version=4),
)
TABLES = ("AERmonZ", "Amon", "CFmon", "Emon", "EmonZ", "LImon", "Lmon", "Omon", "SImon")
FACETS = ("experiment_id", "source_id", "member_id", "grid_label", "region", "metric", "statistic")


def requirement(b: Benchmark) -> tuple[DataRequirement, ...]:
    """The CMIP6 run, with the cells' areas and land or sea shares, and the reference where the catalogue has it."""
    primary = (b.variable, *b.instead, *b.related)
    more = ("areacella", "sftlf") if b.land else ("volcello", "areacello", "sftof")
    facets = {"variable_id": (*primary, *b.relationships), "frequency": ("mon",), "experiment_id": ("historical", "land-hist"), "table_id": TABLES}
    chain = [RequireFacets("variable_id", primary, operator="any"), *([RequireFacets("variable_id", b.relationships)] if b.relationships else []), *(AddSupplementaryDataset.of(v, "cmip6") for v in more)]
    run = DataRequirement("cmip6", (facets,), ("experiment_id", "source_id", "member_id", "grid_label"), tuple(chain))
    if not b.observed:
        return (run,)
    return run, DataRequirement("obs4mips", ({k: (v,) for k, v in b.observed.items()},), tuple(b.observed))


def benchmarks() -> list[Diagnostic]:
    return [Diagnostic("ilamb", b.name.lower(), (requirement(b),), b.version, FACETS) for b in BENCHMARKS]


def benchmark_scores(model: DataFrame, reference: DataFrame, keys: Sequence[str], target: DataFrame | None = None, cover: float = 0.5) -> DataFrame:
    """Scores of models against a reference of another grid, and their mean.

    Both come to ``target`` (lat, lon), by default the reference's grid; cells of which
    less than ``cover`` had values are left out, and the others count by the cosine of
    their latitude. A score that cannot be had does not count in the mean.
    """
    a, b = (df.where(F.col("cover") >= cover).drop("cover", "area") for df in regrid.on_common_grid(model, reference, keys, target))
    found = gridded.scores(a, b, keys)
    shares = {"bias_score": 1, "rmse_score": 2, "season_score": 1, "interannual_score": 1, "spatial_score": 1}
    total = sum((F.coalesce(n * F.col(c), F.lit(0.0)) for c, n in shares.items()), F.lit(0.0))
    weight = sum((F.when(F.col(c).isNotNull(), n).otherwise(0) for c, n in shares.items()), F.lit(0))
    return found.withColumn("overall", total / F.nullif(weight, F.lit(0)))
