"""Reading results: metric values, series, executions, outputs, datasets and resources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.operators.aggregates import execution_statistics, facet_values, provider_profile, recommendations, resource_profile
from meridian.operators.bundles import series_points
from meridian.operators.filters import contains_any, dimension_filter, ids_filter, measured, reference_filter, selector_matches, successful
from meridian.operators.outliers import OutlierPolicy, detect
from meridian.operators.windows import latest_per_group, page, ranked_latest
from meridian.sources.shared import written


@dataclass(frozen=True)
class ValueFilter:
    """Which metric values are meant; empty members filter nothing."""

    execution_ids: Sequence[int] = ()
    group_ids: Sequence[int] = ()
    diagnostic: str | None = None
    provider: str | None = None
    diagnostic_contains: Sequence[str] = ()
    provider_contains: Sequence[str] = ()
    dimensions: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    isolate_ids: Sequence[int] = ()
    exclude_ids: Sequence[int] = ()
    promoted_only: bool = True
    include_retracted: bool = False


@dataclass(frozen=True)
class Page:
    """One page of rows, how many there are in all, and the facets of all of them."""

    rows: DataFrame
    total: int
    facets: DataFrame


@dataclass(frozen=True)
class Results:
    """The tables that results are read from.

    ``values``: id, execution_id, type, value, values, index, kind, reference_id, attributes and the dimensions.
    ``executions``: id, group_id, dataset_hash, successful, created_at, retracted.
    ``groups``: id, diagnostic_id, key, diagnostic_version, dirty, selectors.
    ``diagnostics``: id, slug, provider, promoted_version. ``outputs``: id, execution_id, output_type, and more.
    """

    values: DataFrame
    executions: DataFrame
    groups: DataFrame
    diagnostics: DataFrame
    outputs: DataFrame | None = None
    dimensions: tuple[str, ...] = ()

    def select(self, kind: str, f: ValueFilter = ValueFilter()) -> DataFrame:
        """Values of one type; joins come in only for the predicates that need them."""
        df = self.values.where(F.col("type") == kind)
        df = ids_filter(df, "execution_id", f.execution_ids)
        df = dimension_filter(df, f.dimensions)
        df = ids_filter(df, "id", f.isolate_ids, f.exclude_ids)
        named = f.diagnostic or f.provider or f.diagnostic_contains or f.provider_contains or f.promoted_only
        if named or f.group_ids or not f.include_retracted:
            runs = self.executions if f.include_retracted else self.executions.where(~F.coalesce("retracted", F.lit(False)))
            runs = ids_filter(runs, "group_id", f.group_ids)
            if named:
                d = self.diagnostics
                d = d if f.diagnostic is None else d.where(F.col("slug") == f.diagnostic)
                d = d if f.provider is None else d.where(F.col("provider") == f.provider)
                d = d.where(contains_any(F.col("slug"), f.diagnostic_contains) & contains_any(F.col("provider"), f.provider_contains))
                g = self.groups.join(d.select(F.col("id").alias("diagnostic_id"), "promoted_version"), "diagnostic_id")
                g = g.where("diagnostic_version = promoted_version") if f.promoted_only else g
                runs = runs.join(g.select(F.col("id").alias("group_id")), "group_id", "left_semi")
            df = df.join(runs.select(F.col("id").alias("execution_id")), "execution_id", "left_semi")
        return df

    def scalar_values(self, f: ValueFilter = ValueFilter(), policy: OutlierPolicy = OutlierPolicy(), include_unverified: bool = False, offset: int = 0, limit: int | None = None) -> Page:
        """Screened over all that the filter means, then hidden, counted and paged."""
        found = self.select("scalar", f)
        shown = found
        if policy.method != "off":
            found = written(found, "found")  # screening reads them many times; their joins and shuffles are done once
            shown = detect(found, policy)
            shown = shown if include_unverified else shown.where(~F.col("is_outlier"))
        return Page(page(shown, ["id"], offset, limit), shown.count(), facet_values(found, self.dimensions))

    def series_values(self, f: ValueFilter = ValueFilter(), references: bool | None = None, explode: bool = False, offset: int = 0, limit: int | None = None) -> Page:
        found = reference_filter(self.select("series", f), references)
        rows = page(found, ["id"], offset, limit)
        return Page(series_points(rows) if explode else rows, found.count(), facet_values(found, self.dimensions))

    def execution_groups(self, promoted_only: bool = True, dirty: bool | None = None, succeeded: bool | None = None, facets: Mapping[str, Sequence[str]] | None = None, offset: int = 0, limit: int | None = None) -> DataFrame:
        """Groups beside their latest execution; groups that never ran stay."""
        last = latest_per_group(self.executions, ["group_id"], "created_at", "id")
        last = last.select("group_id", F.col("id").alias("execution_id"), "successful", "created_at", "dataset_hash")
        g = self.groups.join(self.diagnostics.select(F.col("id").alias("diagnostic_id"), "slug", "provider", "promoted_version"), "diagnostic_id")
        g = g.where("diagnostic_version = promoted_version") if promoted_only else g
        rows = g.join(last, g["id"] == last["group_id"], "left").drop("group_id")
        rows = rows if dirty is None else rows.where(successful(F.col("dirty"), dirty))
        rows = rows if succeeded is None else rows.where(successful(F.col("successful"), succeeded))
        for name, wanted in (facets or {}).items():
            rows = rows.where(selector_matches(F.col("selectors"), name, wanted))
        return page(rows, ["id"], offset, limit)

    def diagnostic_statistics(self, diagnostic_contains: Sequence[str] = (), provider_contains: Sequence[str] = ()) -> DataFrame:
        """Counts of states of the groups of each diagnostic's promoted version."""
        d = self.diagnostics.where(contains_any(F.col("slug"), diagnostic_contains) & contains_any(F.col("provider"), provider_contains))
        g = self.groups.join(d.select(F.col("id").alias("diagnostic_id"), F.col("slug").alias("diagnostic"), "provider", "promoted_version"), "diagnostic_id")
        g = g.where("diagnostic_version = promoted_version").withColumn("group_id", F.col("id"))
        return execution_statistics(g, latest_per_group(self.executions, ["group_id"], "created_at", "id"))

    def list_diagnostics(self, diagnostic_contains: Sequence[str] = (), provider_contains: Sequence[str] = (), offset: int = 0, limit: int | None = None) -> DataFrame:
        """One page of diagnostics, by provider, slug and id, with their number of groups and the states of the promoted ones; zeros without any."""
        d = self.diagnostics.where(contains_any(F.col("slug"), diagnostic_contains) & contains_any(F.col("provider"), provider_contains))
        own = self.groups.groupBy("diagnostic_id").agg(F.count("*").alias("execution_group_count"))
        stats = self.diagnostic_statistics(diagnostic_contains, provider_contains).select("provider", F.col("diagnostic").alias("slug"), "successful", F.col("running").alias("inflight"), "total")
        rows = page(d.join(own, d["id"] == own["diagnostic_id"], "left").drop("diagnostic_id"), ["provider", "slug", "id"], offset, limit)
        counts = ("execution_group_count", "successful", "inflight", "total")
        return rows.join(stats, ["provider", "slug"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}).select("id", "provider", "slug", "promoted_version", *counts).orderBy("provider", "slug", "id")

    def values_of_group(self, group_id: int, execution_id: int | None = None) -> DataFrame:
        """All values of a group's latest execution or of a given one, whatever is promoted or retracted."""
        runs = self.executions.where(F.col("group_id") == group_id)
        runs = latest_per_group(runs, ["group_id"], "created_at", "id") if execution_id is None else runs.where(F.col("id") == execution_id)
        return self.values.join(runs.select(F.col("id").alias("execution_id")), "execution_id", "left_semi")

    def outputs_of(self, execution_id: int) -> DataFrame:
        return self.outputs.where(F.col("execution_id") == execution_id).orderBy("output_type", "id")


def values_frame(df: DataFrame, dimensions: Sequence[str], slugs: bool = False) -> DataFrame:
    """The columns in which scalar values are handed out; outlier columns only after screening."""
    names = [*dimensions, "id", "execution_id", "kind", "value", *(c for c in ("is_outlier", "verification_status") if c in df.columns), *(("provider", "diagnostic") if slugs else ())]
    return df.select(*(F.coalesce("kind", F.lit("model")).alias("kind") if n == "kind" else n for n in names))


def datasets_page(catalog: DataFrame, offset: int = 0, limit: int | None = None) -> DataFrame:
    """One page of datasets, by slug and id."""
    return page(catalog, ["slug", "id"], offset, limit)


def measurements_page(executions: DataFrame, offset: int = 0, limit: int | None = None) -> DataFrame:
    """One page of measured executions, by time and id."""
    return page(measured(executions), ["created_at", "id"], offset, limit)


def datasets(catalog: DataFrame, files: DataFrame | None = None, facets: Mapping[str, Sequence[str]] | None = None, finalised: bool | None = None, include_retracted: bool = False, latest: Sequence[str] | None = None) -> DataFrame:
    """Datasets that match some facets; ``latest`` names the facets that versions belong to. Filters apply before ranking."""
    df = dimension_filter(catalog, {k: list(v) for k, v in (facets or {}).items()})
    df = df if include_retracted else df.where("retracted_at is null")
    df = df if finalised is None else df.where(F.col("finalised") == finalised)
    df = ranked_latest(df, latest, "version_key") if latest else df
    if files is None:
        return df
    own = files.groupBy("dataset_id").agg(F.sort_array(F.collect_list(F.struct("path", "start_time", "end_time"))).alias("files"))
    return df.join(own, "dataset_id", "left")


def resources(executions: DataFrame, by_provider: bool = False, exclusive_only: bool = True, since=None) -> DataFrame:
    profile = resource_profile(measured(executions, since), exclusive_only=exclusive_only)
    return recommendations(provider_profile(profile) if by_provider else profile)
