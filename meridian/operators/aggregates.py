"""Statistics over executions, datasets, metrics and resources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.quantiles import exact_percentiles
from meridian.sources.shared import written

GIB = 1 << 30
#: How measurements are ranked when equally many speak for several sources.
SOURCE_ORDER = ("cgroup", "proc_tree", "rusage")


def count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def execution_statistics(groups: DataFrame, latest: DataFrame) -> DataFrame:
    """Counts by state per provider and diagnostic, over the latest execution of each group.

    ``groups``: group_id, provider, diagnostic, dirty. ``latest``: group_id, successful.
    """
    rows = groups.join(latest.select("group_id", "successful", F.lit(True).alias("ran")), "group_id", "left")
    ran = F.col("ran").isNotNull()
    return rows.groupBy("provider", "diagnostic").agg(
        F.count("*").alias("total"), count_where(ran & F.col("successful").isNull()).alias("running"), count_where(~F.col("successful")).alias("failed"),
        count_where(F.col("successful")).alias("successful"), count_where(~ran).alias("not_started"), count_where(F.col("dirty")).alias("dirty"),
    )


def with_totals(df: DataFrame, group: str, item: str, counts: Sequence[str]) -> DataFrame:
    """Rows and one subtotal per group, named ``(total)``."""
    total = df.groupBy(group).agg(*(F.sum(c).alias(c) for c in counts)).withColumn(item, F.lit("(total)"))
    return df.select(group, item, *counts).unionByName(total)


def dataset_statistics(datasets: DataFrame, files: DataFrame, by: Sequence[str] = ("source_type",)) -> DataFrame:
    """Datasets, files and finalised datasets by type; datasets without files count too.

    ``datasets``: dataset_id, finalised and ``by``; ``files``: dataset_id.
    """
    own = files.groupBy("dataset_id").agg(F.count("*").alias("n"))
    rows = datasets.join(own, "dataset_id", "left")
    return rows.groupBy(*by).agg(
        F.count("*").alias("datasets"), F.sum(F.coalesce("n", F.lit(0))).alias("files"), count_where(F.col("finalised")).alias("finalised"), count_where(~F.col("finalised")).alias("unfinalised")
    )


def facet_values(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """(dimension, value): the distinct values of each dimension, in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions)))
    return df.select(pairs.alias("p")).select("p.*").where("value is not null").distinct()


def promoted_version(groups: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """The highest version among a diagnostic's groups, 1 without any."""
    top = groups.groupBy("diagnostic_id").agg(F.max("diagnostic_version").alias("top"))
    return diagnostics.join(top, "diagnostic_id", "left").withColumn("promoted_version", F.coalesce("top", F.lit(1))).drop("top")


def group_counts(diagnostics: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups of all versions per diagnostic, 0 without any."""
    own = groups.groupBy("diagnostic_id").agg(F.count("*").alias("n_groups"))
    return diagnostics.join(own, "diagnostic_id", "left").withColumn("n_groups", F.coalesce("n_groups", F.lit(0)))


def inconsistent(df: DataFrame, slug: str, columns: Sequence[str]) -> DataFrame:
    """Slugs whose rows disagree in a column, nulls aside, with the columns that do."""
    counts = df.groupBy(slug).agg(*(F.min(c).alias(f"low_{c}") for c in columns), *(F.max(c).alias(f"high_{c}") for c in columns))
    wrong = F.filter(F.array(*(F.when(F.col(f"low_{c}") != F.col(f"high_{c}"), F.lit(c)) for c in columns)), lambda x: x.isNotNull())
    return counts.select(slug, wrong.alias("columns")).where(F.size("columns") > 0)


def group_facets(df: DataFrame, keys: Sequence[str], facets: Sequence[str]) -> DataFrame:
    """The distinct values of some facets in each group, sorted."""
    return df.groupBy(*keys).agg(*(F.sort_array(F.collect_set(f)).alias(f) for f in facets))


def time_range(df: DataFrame, keys: Sequence[str], start: str = "start_time", end: str = "end_time") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(start).alias("start"), F.max(end).alias("end"))


def common_time_range(df: DataFrame, keys: Sequence[str], part: str, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """The time that all parts of a group cover: the latest start and the earliest end."""
    return time_range(df, [*keys, part], start, end).groupBy(*keys).agg(F.max("start").alias("start"), F.min("end").alias("end"))


# ------------------------------------------------------------------ resources


def candidates(df: DataFrame, exclusive_only: bool = True) -> DataFrame:
    """Executions with all measurements; shared control groups measure their neighbours too and may be left out."""
    full = (F.col("wall_seconds") > 0) & F.col("cpu_seconds").isNotNull() & F.col("peak_memory_bytes").isNotNull()
    shared = (F.col("memory_source") == "cgroup") & ~F.coalesce("resources_exclusive", F.lit(False))
    return df.where(full & ~F.coalesce(shared, F.lit(False)) if exclusive_only else full)


def _precedence(source: Column) -> Column:
    order = F.lit(-len(SOURCE_ORDER))
    for k, name in enumerate(SOURCE_ORDER):
        order = F.when(source == name, -k).otherwise(order)
    return order


def dominant_source(df: DataFrame, keys: Sequence[str], weight: Column | None = None) -> DataFrame:
    """The memory source that most rows (or most weight) of a group come from."""
    counts = df.groupBy(*keys, "memory_source").agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))
    return counts.groupBy(*keys).agg(F.max_by("memory_source", F.struct(F.col("n"), _precedence(F.col("memory_source")))).alias("memory_source"))


def resource_profile(df: DataFrame, keys: Sequence[str] = ("provider", "diagnostic"), exclusive_only: bool = True) -> DataFrame:
    """What an execution of each diagnostic takes, over the samples of its dominant source."""
    keys = list(keys)
    any_value = F.coalesce("wall_seconds", "cpu_seconds", F.col("peak_memory_bytes").cast("double")).isNotNull()
    base = df.groupBy(*keys).agg(count_where(F.coalesce(~F.col("successful"), F.lit(False))).alias("n_failed"), count_where(any_value).alias("n_measured"))
    found = candidates(df, exclusive_only)
    samples = found.join(dominant_source(found, keys), [*keys, "memory_source"])
    stats = samples.groupBy(*keys).agg(
        F.first("memory_source").alias("memory_source"), F.count("*").alias("n_samples"), F.max("peak_memory_bytes").alias("peak_max"),
        F.max_by("memory_limit_bytes", F.when(F.col("memory_limit_bytes").isNotNull(), F.struct("created_at", "id"))).alias("memory_limit_bytes"),
    )
    peak, wall, cpu = F.col("peak_memory_bytes"), F.col("wall_seconds"), F.col("cpu_seconds")
    shares = exact_percentiles(samples, keys, {"peak_p50": (peak, 0.5), "peak_p95": (peak, 0.95), "wall_p95": (wall, 0.95), "cpu_p95": (cpu, 0.95), "parallelism_p95": (cpu / wall, 0.95)})
    shares = shares.withColumns({c: F.bround(c).cast("long") for c in ("peak_p50", "peak_p95")})
    stats = stats.join(shares, keys)
    rows = base.join(stats, keys, "left").withColumn("n_samples", F.coalesce("n_samples", F.lit(0)))
    return rows.withColumn("n_excluded", F.col("n_measured") - F.col("n_samples")).withColumn("headroom", F.when(F.col("peak_p95") > 0, F.col("memory_limit_bytes") / F.col("peak_p95")))


def recommendations(profile: DataFrame, safety: float = 1.2) -> DataFrame:
    """Memory in GiB, CPUs and how far the samples can be trusted."""
    memory = F.greatest(F.ceil(F.col("peak_p95") * safety / GIB), F.lit(1))
    return profile.withColumns({
        "recommended_memory_gib": memory, "recommended_cpus": F.greatest(F.lit(1), F.ceil("parallelism_p95")),
        "confidence": F.when(F.col("n_samples") == 0, "none").when(F.col("n_samples") < 10, "thin").otherwise("good"),
        "over_limit": F.coalesce(F.col("headroom") < 1, F.lit(False)),
    })


def provider_profile(profile: DataFrame, provider: str = "provider") -> DataFrame:
    """The profiles of a provider's diagnostics in one: the largest needs, counts summed.

    Only diagnostics of the source with most samples count. The limit and the headroom
    are those of the diagnostic with the largest p95.
    """
    known = profile.where("n_samples > 0")
    top = dominant_source(known, [provider], F.col("n_samples"))
    rows = known.join(top, [provider, "memory_source"])
    largest = F.max_by(F.struct("memory_limit_bytes", "headroom"), "peak_p95")
    return rows.groupBy(provider).agg(
        F.first("memory_source").alias("memory_source"), F.sum("n_samples").alias("n_samples"), F.sum("n_failed").alias("n_failed"), F.sum("n_excluded").alias("n_excluded"),
        F.max("peak_p50").alias("peak_p50"), F.max("peak_p95").alias("peak_p95"), F.max("peak_max").alias("peak_max"), F.max("wall_p95").alias("wall_p95"), F.max("cpu_p95").alias("cpu_p95"),
        F.percentile("parallelism_p95", F.lit(0.95)).alias("parallelism_p95"), largest["memory_limit_bytes"].alias("memory_limit_bytes"), largest["headroom"].alias("headroom"),
    )


# ------------------------------------------------------------------- summaries


def variables_by_experiment(requirements: DataFrame) -> DataFrame:
    """Variables that each experiment needs; requirements without one count for ``*``."""
    rows = requirements.select(F.explode_outer("experiments").alias("experiment"), "variables").select(F.coalesce("experiment", F.lit("*")).alias("experiment"), F.explode("variables").alias("variable"))
    return rows.groupBy("experiment").agg(F.sort_array(F.collect_set("variable")).alias("variables"))


def diagnostics_by_variable(requirements: DataFrame) -> DataFrame:
    """Source type -> experiment -> variable -> diagnostics, as nested sorted lists."""
    rows = requirements.select("source_type", "diagnostic", F.explode_outer("experiments").alias("experiment"), "variables")
    rows = rows.select("source_type", "diagnostic", F.coalesce("experiment", F.lit("*")).alias("experiment"), F.explode("variables").alias("variable"))
    inner = rows.groupBy("source_type", "experiment", "variable").agg(F.sort_array(F.collect_set("diagnostic")).alias("diagnostics"))
    middle = inner.groupBy("source_type", "experiment").agg(F.sort_array(F.collect_list(F.struct("variable", "diagnostics"))).alias("variables"))
    return middle.groupBy("source_type").agg(F.sort_array(F.collect_list(F.struct("experiment", "variables"))).alias("experiments"))


def required_references(requirements: DataFrame) -> DataFrame:
    """Variables and diagnostics that need each reference source."""
    rows = requirements.select("source_type", F.explode("sources").alias("source_id"), "variables", "diagnostic")
    return rows.groupBy("source_type", "source_id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("variables")))).alias("variables"), F.sort_array(F.collect_set("diagnostic")).alias("diagnostics"))


def registries_per_source(entries: DataFrame) -> DataFrame:
    return entries.groupBy("source_id").agg(F.sort_array(F.collect_set("registry")).alias("registries"))


def missing_references(required: DataFrame, ingested: DataFrame) -> DataFrame:
    """Required sources that are not in the catalogue."""
    return required.join(ingested.select("source_type", "source_id").distinct(), ["source_type", "source_id"], "left_anti")


def unreachable_types(ingested: DataFrame, requested: DataFrame) -> DataFrame:
    """Source types in the catalogue that no requirement asks for."""
    return ingested.select("source_type").distinct().join(requested.select("source_type").distinct(), "source_type", "left_anti")


def running_total(df: DataFrame, order: Sequence[str], amount: Column | None = None, by: Sequence[str] = (), name: str = "before") -> DataFrame:
    """The sum of ``amount`` (by default 1) over all rows before a row, in a total order within ``by``.

    Rows are dealt to ranges of the order and written once with the number of their range,
    so that the sums of whole ranges and the rows behind them are of the same division.
    Each range is summed up on its own behind what the ranges before it hold; only one
    sum per range (and group in it) meets others. Ties of the order must be equal rows.
    """
    by, order = list(by), list(order)
    part, own, start = (f"__{name}_{x}" for x in ("part", "own", "start"))
    ranges = written(df.withColumn(own, F.lit(1) if amount is None else amount).repartitionByRange(*by, *order).withColumn(part, F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # one row per range
    starts = ranges.groupBy(*by, part).agg(F.sum(own).alias("__n"))
    starts = starts.select(*(F.col(c).alias(f"__by_{c}") for c in by), F.col(part).alias("__p"), F.coalesce(F.sum("__n").over(earlier.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(start))
    inside = Window.partitionBy(part, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(starts, "range-starts") if by else F.broadcast(starts)  # without groups one row per range; else the planner sees the size of a table
    rows = ranges.withColumn(own, F.coalesce(F.sum(own).over(inside), F.lit(0)))
    same = F.col(part) == F.col("__p")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    return rows.join(starts, same).select(*df.columns, (F.col(start) + F.col(own)).alias(name))


def numbered(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """A running number from 0 in a total order; see ``running_total``."""
    return running_total(df, order, name=name)


def queue_counts(submitted: DataFrame) -> DataFrame:
    """How many tasks went to each queue."""
    return submitted.groupBy("queue").agg(F.count("*").alias("n"))
