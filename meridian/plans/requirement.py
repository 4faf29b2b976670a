"""Data requirements and their solution into execution groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from importlib.metadata import entry_points

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.catalog import selector, selector_text, stable_hash
from meridian.operators.constraints import Constraint, IgnoreFacets, require_columns
from meridian.operators.filters import facet_filter, known_facets


@dataclass(frozen=True)
class DataRequirement:
    """What one input of a diagnostic must be.

    ``filters`` are alternatives of facet -> values, ``group_by`` the facets of a group
    (None: all rows are one group), ``constraints`` are applied in order.
    """

    source_type: str
    filters: tuple[Mapping[str, Sequence[str]], ...] = ()
    group_by: tuple[str, ...] | None = None
    constraints: tuple[Constraint, ...] = ()

    def validate(self, catalog: DataFrame, unfinished: Sequence[str] = ()) -> None:
        """Reject filters or groupings on columns that are filled in only later."""
        used = {k for f in self.filters for k in f} | set(self.group_by or ())
        late = sorted(used & set(unfinished))
        if late:
            raise ValueError(f"columns that are not final yet: {late}")

    def groups(self, catalog: DataFrame) -> DataFrame:
        """Members of all groups that satisfy the constraints: the catalogue's columns, ``gk`` and ``selector``.

        Rows with a null in a grouping facet are in no group.
        """
        rows = facet_filter(catalog, self.filters)
        require_columns(catalog, self.group_by or ())
        for f in self.group_by or ():
            rows = rows.where(F.col(f).isNotNull())
        pairs = selector(*self.group_by) if self.group_by else F.array().cast("array<struct<k:string,v:string>>")
        rows = rows.withColumn("selector", pairs).withColumn("gk", F.to_json("selector"))
        names = rows.select("gk", "selector").distinct()
        rows = rows.drop("selector")
        for c in self.constraints:
            rows = c.apply(rows, catalog)
        return rows.join(names, "gk")


@dataclass(frozen=True)
class Diagnostic:
    """A calculation: its requirements, and how to run it on the members of an execution.

    ``requirements`` is a list of alternatives, each a list of inputs that must all be there.
    """

    provider: str
    slug: str
    requirements: tuple[tuple[DataRequirement, ...], ...]
    version: int = 1
    facets: tuple[str, ...] = ()
    execute: object = field(default=None, compare=False)


def solve_inputs(requirements: Sequence[DataRequirement], catalogs: Mapping[str, DataFrame], slug: str = "instance_id") -> DataFrame:
    """One row per combination of one group of each requirement: ``dataset_key``, ``dataset_hash``, ``selectors``, ``slugs``.

    The product is of groups, one row each, never of catalogue rows. A requirement
    without groups leaves nothing.
    """
    types = [r.source_type for r in requirements]
    if len(set(types)) < len(types):
        raise ValueError(f"two requirements of one source type: {types}")
    sides = []
    for r in requirements:
        t = r.source_type
        groups = r.groups(catalogs[t]).select("gk", "selector", slug).groupBy("gk", "selector").agg(F.collect_list(slug).alias("slugs"))
        sides.append(groups.select(selector_text(t, F.col("selector")).alias(f"key_{t}"), stable_hash(F.col("slugs")).alias(f"hash_{t}"), F.col("selector").alias(f"selector_{t}"), F.sort_array(F.array_distinct("slugs")).alias(f"slugs_{t}")))
    joined = reduce(lambda a, b: a.crossJoin(b), sides)
    order = sorted(types)
    total = F.sha1(F.concat_ws("\n", *(F.concat(F.lit(f"{t}:"), F.col(f"hash_{t}")) for t in order)).cast("binary"))
    return joined.select(
        F.concat_ws("__", *(f"key_{t}" for t in order)).alias("dataset_key"), total.alias("dataset_hash"),
        F.map_from_arrays(F.array(*map(F.lit, order)), F.array(*(f"selector_{t}" for t in order))).alias("selectors"),
        F.map_from_arrays(F.array(*map(F.lit, order)), F.array(*(f"slugs_{t}" for t in order))).alias("slugs"),
    )


def with_ignored(diagnostics: Sequence[Diagnostic], ignored: Mapping[str, Mapping[str, Mapping[str, Sequence[Mapping[str, Sequence[str]]]]]]) -> list[Diagnostic]:
    """Diagnostics that leave out listed datasets before anything else.

    ``ignored``: provider -> diagnostic -> source type -> facets of what to leave out.
    """
    def of(d: Diagnostic, r: DataRequirement) -> DataRequirement:
        listed = ignored.get(d.provider, {}).get(d.slug, {}).get(r.source_type, ())
        return replace(r, constraints=(*(IgnoreFacets({k: tuple(v) for k, v in f.items()}) for f in listed), *r.constraints))

    return [replace(d, requirements=tuple(tuple(of(d, r) for r in inputs) for inputs in d.requirements)) for d in diagnostics]


def solve(diagnostics: Sequence[Diagnostic], catalogs: Mapping[str, DataFrame], facets: Mapping[str, Sequence[str]] | None = None, unfinished: Sequence[str] = ()) -> DataFrame:
    """Executions that the catalogues allow, of all diagnostics and alternatives.

    Requirements on ``unfinished`` columns, which are filled in only later, are an error.
    """
    for d in diagnostics:
        for inputs in d.requirements:
            for r in inputs:
                if r.source_type in catalogs:
                    r.validate(catalogs[r.source_type], unfinished)
    catalogs = {t: known_facets(c, facets or {}) for t, c in catalogs.items()}
    found = []
    for d in diagnostics:
        for inputs in d.requirements:
            if all(r.source_type in catalogs for r in inputs):
                rows = solve_inputs(inputs, catalogs)
                found.append(rows.select(F.lit(d.provider).alias("provider"), F.lit(d.slug).alias("diagnostic"), F.lit(d.version).alias("diagnostic_version"), "*"))
    if not found:
        raise ValueError("no diagnostic can be solved with these catalogues")
    every = reduce(DataFrame.unionByName, found)
    return every.dropDuplicates(["provider", "diagnostic", "diagnostic_version", "dataset_key"]).orderBy("provider", "diagnostic", "dataset_key")


def installed_providers(group: str = "meridian.providers") -> dict[str, list[Diagnostic]]:
    """The diagnostics of every installed package that registers a function for them under an entry point."""
    return {e.name: list(e.load()()) for e in entry_points(group=group)}
