"""Filters: facets, states, dimensions and texts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Facets = Mapping[str, Sequence[str]]


def all_facets(facets: Facets) -> Column:
    """In each facet one of its values; no facet at all holds for every row, an empty list of values for none."""
    return reduce(and_, (F.col(k).isin(*v) for k, v in facets.items()), F.lit(True))


def facet_filter(df: DataFrame, filters: Sequence[Facets]) -> DataFrame:
    """Rows that match one of some filters, each a conjunction of facets.

    No filters, or one among them without facets, let all rows through. Unknown facets
    are an error.
    """
    unknown = sorted({k for f in filters for k in f} - set(df.columns))
    if unknown:
        raise KeyError(f"no such facets: {unknown}")
    if not filters or not all(filters):
        return df
    return df.where(reduce(or_, map(all_facets, filters)))


def known_facets(df: DataFrame, facets: Facets) -> DataFrame:
    """Rows that match the facets that this catalogue has; the others are skipped."""
    return df.where(all_facets({k: v for k, v in facets.items() if k in df.columns}))


def successful(state: Column, wanted: bool) -> Column:
    """Tri-state success: not wanted means failed or still running."""
    return F.coalesce(state, F.lit(False)) == F.lit(wanted)


def dimension_filter(df: DataFrame, dimensions: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Equality for one value, membership for several; unknown dimensions are an error."""
    unknown = sorted(set(dimensions) - set(df.columns))
    if unknown:
        raise KeyError(f"no such dimensions: {unknown}")
    for name, value in dimensions.items():
        values = [value] if isinstance(value, str) else list(value)
        df = df.where(F.col(name) == values[0] if len(values) == 1 else F.col(name).isin(*values))
    return df


def reference_filter(df: DataFrame, only: bool | None) -> DataFrame:
    """Series with a reference, without one, or all."""
    return df if only is None else df.where(F.col("reference_id").isNotNull() if only else F.col("reference_id").isNull())


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """Case-insensitive containment of one of some texts, in which % and _ are wildcards; no texts hold for all."""
    return reduce(or_, (text.ilike(f"%{n}%") for n in needles)) if needles else F.lit(True)


def ids_filter(df: DataFrame, column: str, isolate: Sequence[int] | None = None, exclude: Sequence[int] | None = None) -> DataFrame:
    """Only some ids; or, when none are isolated, all but some. Empty lists mean no filter."""
    if isolate:
        return df.where(F.col(column).isin(*isolate))
    return df.where(~F.coalesce(F.col(column).isin(*exclude), F.lit(False))) if exclude else df


def selector_matches(selectors: Column, facet: str, values: Sequence[str]) -> Column:
    """Whether a map of source type to (k, v) pairs has a facet with one of some values.

    ``type.facet`` looks only at that type.
    """
    kind, dot, name = facet.partition(".")
    pairs = F.flatten(F.map_values(selectors)) if not dot else F.coalesce(F.try_element_at(selectors, F.lit(kind)), F.array().cast("array<struct<k:string,v:string>>"))
    key = name if dot else facet
    return F.exists(pairs, lambda p: (p["k"] == key) & p["v"].isin(*values))


def parse_facets(arguments: Sequence[str]) -> dict[str, list[str]]:
    """``key=value`` arguments; a repeated key collects values."""
    found: dict[str, list[str]] = {}
    for a in arguments:
        key, sign, value = a.partition("=")
        if not sign or not key.strip() or not value.strip():
            raise ValueError(f"not of the form key=value: {a!r}")
        found.setdefault(key.strip(), []).append(value.strip())
    return found


def measured(df: DataFrame, since: Column | None = None) -> DataFrame:
    """Executions with a measurement, or that failed; created since some time."""
    any_value = F.coalesce("wall_seconds", "cpu_seconds", F.col("peak_memory_bytes").cast("double")).isNotNull()
    df = df.where(any_value | F.coalesce(~F.col("successful"), F.lit(False)))
    return df if since is None else df.where(F.col("created_at") >= since)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; maps, which Spark cannot compare, count as their JSON."""
    maps = [c for c, kind in df.dtypes if "map<" in kind]
    named = df.withColumns({f"__{c}": F.to_json(c) for c in maps})
    return named.dropDuplicates([c for c in df.columns if c not in maps] + [f"__{c}" for c in maps]).select(*df.columns)


def diagnostic_matches(provider: str, slug: str, diagnostic: Sequence[str] = (), providers: Sequence[str] = (), excluded: Sequence[str] = ()) -> bool:
    """Whether a diagnostic is chosen by substrings of its or its provider's name, and not excluded by name."""
    own = {slug.lower(), f"{provider}/{slug}".lower()}
    chosen = (not diagnostic or any(d.lower() in slug.lower() for d in diagnostic)) and (not providers or any(p.lower() in provider.lower() for p in providers))
    return chosen and not own & {e.lower() for e in excluded}


def matches_facets(metadata: Column, facets: Facets) -> Column:
    """Whether a map of metadata has each facet with one of its values; a missing facet is a mismatch."""
    return reduce(and_, (F.coalesce(F.try_element_at(metadata, F.lit(k)).isin(*v), F.lit(False)) for k, v in facets.items()), F.lit(True))


def subset_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that name a dataset, and its version last."""
    return df.select(*(c for c in columns if c != "version"), "version")


def routed(df: DataFrame, rules: Sequence[tuple[str, str, str]], provider_queues: Mapping[str, str] | None = None, default: str | None = None) -> DataFrame:
    """``df`` (provider, diagnostic) with the queue of each task.

    ``rules`` are (provider pattern, diagnostic pattern, queue); in patterns ``*`` and ``?``
    stand for any text and any character. The first that fits decides, then the provider's
    queue, then the default, then the provider's own name.
    """
    queue = F.coalesce(*([F.try_element_at(F.create_map(*(F.lit(x) for kv in provider_queues.items() for x in kv)), F.col("provider"))] if provider_queues else []), F.lit(default).cast("string"), F.col("provider"))
    for provider, diagnostic, name in reversed(rules):
        fits = F.col("provider").rlike(_pattern(provider)) & F.col("diagnostic").rlike(_pattern(diagnostic))
        queue = F.when(fits, name).otherwise(queue)
    return df.withColumn("queue", queue)


def _pattern(text: str) -> str:
    return "^" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in text) + "$"


def touches(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """The paths that lie in or are one of some roots (column root): their own and each folder above is looked up."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    rows = paths.select("path", F.explode(above).alias("root"))
    return rows.join(roots.select(F.rtrim(F.col("root"), F.lit("/")).alias("root")).distinct(), "root").select("path").distinct()
