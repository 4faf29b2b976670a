"""Constraints on groups of catalogue rows, each one transformation of all groups at once.

``rows`` are the members of all groups: the catalogue's columns, ``row_id`` (the
catalogue's order) and the group's key ``gk``. A constraint keeps, drops or adds
members; a group that ends without members is gone. Sub-groups are ``gk`` plus the
constraint's own facets. A null facet puts a row in no sub-group: such rows are not
tested, and stay unless a constraint says otherwise.

Verdicts come from aggregates that are joined back, so a group of any size is
pre-aggregated before it moves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.catalog import member_order, version_key
from meridian.functions.calendars import at_or_after, at_or_before

GAP_SECONDS = 45 * 86400


@runtime_checkable
class Constraint(Protocol):
    """Anything with this method can stand in a requirement."""

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame: ...


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"no such columns: {missing}")


def _known(names: Sequence[str]) -> Column:
    return reduce(and_, (F.col(n).isNotNull() for n in names), F.lit(True))


def keep_by_verdict(rows: DataFrame, verdict: DataFrame, keys: Sequence[str], untested: bool = True) -> DataFrame:
    """``rows`` whose sub-group has a true ``ok`` in ``verdict``; what has no verdict stays if ``untested``."""
    joined = rows.join(verdict.select(*keys, "ok"), list(keys), "left")
    return joined.where(F.coalesce("ok", F.lit(untested))).select(*rows.columns)


@dataclass(frozen=True)
class RequireFacets:
    """Keep a sub-group only if all (or any) of some values occur in a facet."""

    dimension: str
    required: tuple[str, ...]
    operator: str = "all"
    group_by: tuple[str, ...] = ()

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        require_columns(rows, [self.dimension, *self.group_by])
        keys = ["gk", *self.group_by]
        has = [F.coalesce(F.max(F.col(self.dimension) == v), F.lit(False)) for v in self.required]
        met = sum((h.cast("int") for h in has), F.lit(0))
        ok = met == len(has) if self.operator == "all" else met > 0
        verdict = rows.where(_known(self.group_by)).groupBy(*keys).agg(ok.alias("ok"))
        return keep_by_verdict(rows, verdict, keys)


@dataclass(frozen=True)
class IgnoreFacets:
    """Drop rows that match all of some facets."""

    facets: dict[str, tuple[str, ...]]

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        require_columns(rows, list(self.facets))
        hit = reduce(and_, (F.coalesce(F.col(k).isin(*v), F.lit(False)) for k, v in self.facets.items()), F.lit(True))
        return rows.where(~hit)


@dataclass(frozen=True)
class AddSupplementaryDataset:
    """Add the catalogue rows that go best with each distinct combination of a group's facets.

    Candidates carry the supplementary facets and equal the group's row in all matching
    facets. Of them the ones with the most equal optional facets win, then the latest
    version, then the combination that comes first in the catalogue. A group without
    candidates stays as it is.
    """

    supplementary: dict[str, tuple[str, ...]]
    matching: tuple[str, ...]
    optional: tuple[str, ...] = ()

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        facets = [*self.matching, *self.optional]
        require_columns(catalog, [*self.supplementary, *facets, "row_id"])
        wanted = reduce(and_, (F.col(k).isin(*v) for k, v in self.supplementary.items()), F.lit(True))
        version = version_key(F.col("version")) if "version" in catalog.columns else F.lit(-1)
        found = catalog.where(wanted).select("row_id", version.alias("vkey"), *(F.col(f).alias(f"c_{f}") for f in facets))
        want = rows.select("gk", *facets).distinct().withColumn("want", F.xxhash64(*facets, *(F.col(f).isNull() for f in facets)))
        pairs = want.join(found, [F.col(f) == F.col(f"c_{f}") for f in self.matching] if self.matching else F.lit(True))
        score = sum((F.coalesce(F.col(f) == F.col(f"c_{f}"), F.lit(False)).cast("int") for f in self.optional), F.lit(0))
        best = Window.partitionBy("gk", "want").orderBy(F.desc("score"), F.desc("vkey"))
        pairs = pairs.withColumn("score", score).withColumn("place", F.rank().over(best)).where("place = 1")
        same = Window.partitionBy("gk", "want", *(f"c_{f}" for f in facets))
        pairs = pairs.withColumn("first", F.min("row_id").over(same))
        pairs = pairs.withColumn("place", F.rank().over(Window.partitionBy("gk", "want").orderBy("first"))).where("place = 1")
        added = catalog.join(pairs.select("gk", "row_id").distinct(), "row_id")
        return rows.unionByName(added, allowMissingColumns=True).dropDuplicates(["gk", "row_id"])

    @classmethod
    def of(cls, variable: str, source_type: str, facet: str = "variable_id") -> AddSupplementaryDataset:
        """The usual companions, such as cell areas, of a variable."""
        optional = {
            "cmip6": ("table_id", "experiment_id", "member_id", "version"), "cmip7": ("experiment_id", "variant_label", "version"),
        }
        return cls({facet: (variable,)}, ("source_id", "grid_label"), optional[source_type])


def _dated(rows: DataFrame, group_by: Sequence[str]) -> DataFrame:
    return rows.where(F.col("start_ord").isNotNull() & F.col("end_ord").isNotNull() & _known(group_by))


@dataclass(frozen=True)
class RequireContiguousTimerange:
    """Keep a sub-group unless a file starts over ``gap`` seconds after the end of the one before.

    Files follow each other by start; overlaps are allowed. Several calendars in one
    sub-group reject it. ``start_ord`` and ``end_ord`` are seconds.
    """

    group_by: tuple[str, ...]
    gap: int = GAP_SECONDS

    def verdict(self, rows: DataFrame) -> DataFrame:
        keys = ["gk", *self.group_by]
        order = Window.partitionBy(*keys).orderBy("start_ord", "row_id")
        dated = _dated(rows, self.group_by).withColumn("after", F.col("start_ord") - F.lag("end_ord").over(order))
        one = F.min("calendar").eqNullSafe(F.max("calendar")) if "calendar" in rows.columns else F.lit(True)
        return dated.groupBy(*keys).agg((one & ~F.coalesce(F.max("after") > self.gap, F.lit(False))).alias("ok"), F.min("start_ord").alias("low"), F.max("end_ord").alias("high"))

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        require_columns(rows, ["start_ord", "end_ord", *self.group_by])
        # a dated row of a failed sub-group goes; its undated rows stay, as they were not tested
        return _keep_dated(rows, self.verdict(rows), self.group_by)


def _keep_dated(rows: DataFrame, verdict: DataFrame, group_by: Sequence[str]) -> DataFrame:
    keys = ["gk", *group_by]
    joined = rows.join(verdict.select(*keys, "ok"), keys, "left")
    undated = F.col("start_ord").isNull() | F.col("end_ord").isNull()
    return joined.where(undated | F.coalesce("ok", F.lit(True))).select(*rows.columns)


@dataclass(frozen=True)
class RequireTimerange:
    """Keep a sub-group that covers a time range without gaps.

    ``start`` and ``end`` are partial times such as ``{"year": 1980, "month": 1}``,
    compared with the ``start_time`` and ``end_time`` structs, or numbers, compared with
    ``start_ord`` and ``end_ord``.
    """

    group_by: tuple[str, ...]
    start: dict[str, int] | int | None = None
    end: dict[str, int] | int | None = None
    gap: int = GAP_SECONDS

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        keys = ["gk", *self.group_by]
        ok = RequireContiguousTimerange(self.group_by, self.gap).verdict(rows)
        partial = isinstance(self.start, dict) or isinstance(self.end, dict)
        if partial:
            low, high = F.min("start_time").alias("first"), F.max("end_time").alias("last")
        else:
            low, high = F.min("start_ord").alias("first"), F.max("end_ord").alias("last")
        ends = _dated(rows, self.group_by).groupBy(*keys).agg(low, high)

        def met(column: str, bound, holds: Callable, compare: Callable) -> Column:
            if bound is None:
                return F.lit(True)
            return holds(F.col(column), **bound) if isinstance(bound, dict) else compare(F.col(column), bound)

        within = met("first", self.start, at_or_before, lambda c, b: c <= b) & met("last", self.end, at_or_after, lambda c, b: c >= b)
        verdict = ends.join(ok.select(*keys, F.col("ok").alias("whole")), keys).withColumn("ok", F.col("whole") & within)
        return _keep_dated(rows, verdict, self.group_by)


@dataclass(frozen=True)
class RequireOverlappingTimerange:
    """Keep a group whose sub-groups all share some time: the latest start lies before the earliest end."""

    group_by: tuple[str, ...]

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        every = rows.where(F.col("start_ord").isNotNull() & F.col("end_ord").isNotNull())
        sub = every.withColumn("known", _known(self.group_by)).groupBy("gk", "known", *self.group_by)
        sub = sub.agg(F.min("start_ord").alias("low"), F.max("end_ord").alias("high"), F.count("*").alias("n"))
        low, high = F.max(F.when(F.col("known"), F.col("low"))), F.min(F.when(F.col("known"), F.col("high")))
        verdict = sub.groupBy("gk").agg(((F.sum("n") < 2) | F.coalesce(low < high, F.lit(False))).alias("ok"))
        return keep_by_verdict(rows, verdict, ["gk"])


@dataclass(frozen=True)
class AddParentDataset:
    """Replace each group by its members that have a parent, and those parents' latest versions.

    ``parent_facets`` maps a facet of the parent to the facet of the child that names
    it. All catalogue rows of a selected dataset belong to the result.
    """

    parent_facets: dict[str, str]

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        facets = sorted({*self.parent_facets, *self.parent_facets.values()})
        require_columns(catalog, [*facets, "row_id"])
        children = rows.where(_known(facets)).select("gk", "row_id", "dataset_id", F.struct(*facets).alias("child"), *(F.col(c).alias(f"p_{p}") for p, c in self.parent_facets.items()))
        version = version_key(F.col("version")) if "version" in catalog.columns else F.lit(-1)
        parents = catalog.select(F.col("dataset_id").alias("parent_id"), version.alias("vkey"), *(F.col(p).alias(f"p_{p}") for p in self.parent_facets))
        # datasets, not files, meet here
        kin = children.drop("row_id").distinct().join(parents.distinct(), [f"p_{p}" for p in self.parent_facets])
        kin = kin.withColumn("latest", F.max("vkey").over(Window.partitionBy("gk", "child"))).where("vkey = latest")
        chosen = kin.select("gk", "dataset_id").unionByName(kin.select("gk", F.col("parent_id").alias("dataset_id"))).distinct()
        return catalog.join(chosen, "dataset_id").select(*rows.columns)

    @classmethod
    def of(cls, source_type: str) -> AddParentDataset:
        own = ("variable_id", "grid_label") if source_type == "cmip7" else ("table_id", "variable_id", "grid_label")
        named = {f: f"parent_{f}" for f in ("source_id", "experiment_id", "variant_label")}
        return cls(named | {f: f for f in own})


@dataclass(frozen=True)
class SelectFirstMember:
    """Keep the rows of the first ensemble member of each sub-group; without any member, all."""

    member: str = "member_id"
    group_by: tuple[str, ...] = ("source_id",)

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        if self.member not in rows.columns:
            return rows
        keys = ["gk", *self.group_by]
        known = rows.where(_known(self.group_by))
        label = F.col(self.member)
        first = known.groupBy(*keys).agg(F.min(F.when(label.isNotNull(), member_order(label)))["label"].alias("first"))
        joined = known.join(first, keys)
        return joined.where(F.col("first").isNull() | (label == F.col("first"))).select(*rows.columns)


@dataclass(frozen=True)
class ByGroup:
    """A constraint of one's own written for one group in pandas; every group is one call."""

    function: Callable
    schema: str | None = field(default=None)

    def apply(self, rows: DataFrame, catalog: DataFrame) -> DataFrame:
        return rows.groupBy("gk").applyInPandas(self.function, self.schema or rows.schema)


#: The facets of a single dataset, for constraints "per instance".
PER_INSTANCE = ("instance_id",)
