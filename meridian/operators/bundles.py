"""Metric bundles: nested result cubes and their flat form.

The flat form is canonical: one row per value with its dimensions as a map. A
bundle is JSON whose RESULTS nest one level per dimension of ``json_structure``;
leaves are numbers or null, and ``attributes`` may stand beside them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTRIBUTES = "attributes"
KINDS = ("model", "reference")
#: Names that no dimension may have. Fixed values.
RESERVED = ("attributes", "json_structure", "created_at", "updated_at", "value", "id")
LEVEL = "map<string,string>"


def flatten(df: DataFrame, json: str, dimensions: Sequence[str]) -> DataFrame:
    """One row per leaf of the nested JSON in a column: its dimensions, ``value``, ``attributes`` and ``kind``.

    A null leaf is NaN. A leaf has the attributes that stand beside it. A dimension
    ``kind`` becomes the kind, which is ``model`` otherwise.
    """
    keep = [c for c in df.columns if c != json]
    rows = df.select(*keep, F.from_json(json, LEVEL).alias("__node"))
    for k, name in enumerate(dimensions):
        last = k == len(dimensions) - 1
        extra = [F.from_json(F.try_element_at("__node", F.lit(ATTRIBUTES)), LEVEL).alias("__attributes")] if last else []
        done = [F.col(d) for d in dimensions[:k]]
        rows = rows.select(*keep, *done, *extra, F.explode(F.map_filter("__node", lambda key, _: key != ATTRIBUTES)).alias(name, "__text"))
        if not last:
            rows = rows.select(*keep, *done, name, F.from_json("__text", LEVEL).alias("__node"))
    value = F.coalesce(F.col("__text").try_cast("double"), F.lit(float("nan")))
    kind = F.coalesce(F.col("kind"), F.lit("model")) if "kind" in dimensions else F.lit("model")
    return rows.select(*keep, *(d for d in dimensions if d != "kind"), value.alias("value"), F.col("__attributes").alias("attributes"), kind.alias("kind"))


def nest(df: DataFrame, dimensions: Sequence[str], value: str = "value") -> DataFrame:
    """One row with the nested JSON of flat rows; of rows with equal dimensions the smallest value stays.

    Built from the last dimension upwards, each level one aggregation.
    """
    level = df.groupBy(*dimensions).agg(F.min(value).alias("__json"))
    for k in range(len(dimensions) - 1, -1, -1):
        pairs = F.collect_list(F.struct(F.col(dimensions[k]).cast("string").alias("k"), F.col("__json").alias("v")))
        entries = F.map_from_entries(F.array_sort(pairs, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)))
        level = level.groupBy(*dimensions[:k]).agg(entries.alias("__json")) if k else level.agg(entries.alias("__json"))
    return level.select(F.to_json("__json", {"ignoreNullFields": "false"}).alias("results"))


def merge(left: DataFrame, right: DataFrame, dimensions: Sequence[str], value: str = "value") -> DataFrame:
    """Both bundles' values; where both have one, the right's."""
    a, b = left.select(*dimensions, F.col(value).alias("__a"), F.lit(True).alias("__ina")), right.select(*(F.col(d).alias(f"__{d}") for d in dimensions), F.col(value).alias("__b"), F.lit(True).alias("__inb"))
    on = reduce(lambda x, y: x & y, (F.col(d).eqNullSafe(F.col(f"__{d}")) for d in dimensions))
    names = (F.when(F.col("__inb").isNotNull(), F.col(f"__{d}")).otherwise(F.col(d)).alias(d) for d in dimensions)
    return a.join(b, on, "full").select(*names, F.when(F.col("__inb").isNotNull(), F.col("__b")).otherwise(F.col("__a")).alias(value))


def prepend_dimensions(df: DataFrame, new: Mapping[str, str]) -> DataFrame:
    """Constant leading dimensions."""
    taken = [d for d in new if d in df.columns]
    if taken:
        raise ValueError(f"dimensions exist: {taken}")
    return df.select(*(F.lit(v).alias(k) for k, v in new.items()), "*")


def remove_dimension(df: DataFrame, dimensions: Sequence[str], name: str) -> DataFrame:
    """Drop the leading dimension, which must have one value; another value raises when rows are read."""
    if not dimensions or dimensions[0] != name:
        raise ValueError(f"{name} is not the leading dimension")
    counts = df.agg(F.min(name).alias("__low"), F.max(name).alias("__high"))
    single = df.join(F.broadcast(counts), F.lit(True))  # one row
    ok = F.col("__low").eqNullSafe(F.col("__high"))
    others = [c for c in df.columns if c != name]
    return single.where(F.when(ok, True).otherwise(F.raise_error(F.lit(f"{name} has several values")).cast("boolean"))).select(*others)


def stack(bundles: Mapping[str, DataFrame], level: str) -> DataFrame:
    """Several flat bundles under a new axis."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (prepend_dimensions(df, {level: name}) for name, df in bundles.items()))


def undeclared(df: DataFrame, declared: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """(dimension, value) pairs in use that ``declared`` (dimension, value) does not list."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions)))
    used = df.select(pairs.alias("p")).select("p.*").where("value is not null").distinct()
    return used.join(declared, ["dimension", "value"], "left_anti")


def shape_problems(df: DataFrame, json: str, dimensions: Sequence[str], declared: Mapping[str, Sequence[str]]) -> DataFrame:
    """(level, problem, key) of the nested JSON in a column where it departs from the declared values.

    Above the last level every declared value must be there and no other; at the last
    level values may be missing.
    """
    rows, found = df.select(F.from_json(json, LEVEL).alias("__node")), []
    for k, name in enumerate(dimensions):
        keys = F.filter(F.map_keys("__node"), lambda x: x != ATTRIBUTES)
        known = F.array(*map(F.lit, declared[name]))
        found.append(rows.select(F.lit(name).alias("level"), F.lit("undeclared").alias("problem"), F.explode(F.array_except(keys, known)).alias("key")))
        if k < len(dimensions) - 1:
            found.append(rows.select(F.lit(name).alias("level"), F.lit("missing").alias("problem"), F.explode(F.array_except(known, keys)).alias("key")))
            rows = rows.select(F.explode(F.map_filter("__node", lambda key, _: key != ATTRIBUTES)).alias("key", "text")).select(F.from_json("text", LEVEL).alias("__node"))
    return reduce(DataFrame.unionByName, found).distinct()


def merged_dimensions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Declared values (dimension, value, attributes) of both bundles; where both describe one, the left's description stays."""
    both = left.withColumn("__side", F.lit(0)).unionByName(right.withColumn("__side", F.lit(1)))
    return both.groupBy("dimension", "value").agg(F.min_by("attributes", "__side").alias("attributes"))


def seasons_only(df: DataFrame, drop: Sequence[str] = (), season: str = "season") -> DataFrame:
    """Flat seasonal results without some axes and without the single months that stand among the seasons."""
    return df.where(F.col(season) != "CalendarMonths").drop(*drop)


def from_runs(df: DataFrame, json: str) -> DataFrame:
    """Results by model, run and metric, each with values by reference, in flat form: model, realization, metric, reference_source_id, value.

    In the JSON a run holds ``value``, a metric ``metric`` and a reference ``value``. A
    value that is no number is NaN.
    """
    kind = "map<string,map<string,struct<value:map<string,struct<metric:map<string,struct<value:double>>>>>>>"
    rows = df.select(F.explode(F.from_json(json, kind)).alias("model", "runs")).select("model", F.explode("runs").alias("realization", "run"))
    rows = rows.select("model", "realization", F.explode("run.value").alias("metric", "m"))
    return rows.select("model", "realization", "metric", F.explode("m.metric").alias("reference_source_id", "v")).withColumn("value", F.coalesce("v.value", F.lit(float("nan")))).drop("v")


def close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Whether two numbers are equal within a tolerance; NaN equals NaN, null equals null."""
    near = F.abs(a - b) <= F.greatest(rtol * F.greatest(F.abs(a), F.abs(b)), F.lit(atol))
    return a.eqNullSafe(b) | F.coalesce(~F.isnan(a) & ~F.isnan(b) & near, F.lit(False))


def compare(expected: DataFrame, actual: DataFrame, dimensions: Sequence[str], rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """The rows in which two flat bundles differ: missing, extra or of another value."""
    a = expected.select(*dimensions, F.col("value").alias("expected"), F.lit(True).alias("in_expected"))
    b = actual.select(*dimensions, F.col("value").alias("actual"), F.lit(True).alias("in_actual"))
    both = a.join(b, list(dimensions), "full")
    what = F.when(F.col("in_actual").isNull(), "missing").when(F.col("in_expected").isNull(), "extra").when(~close(F.col("expected"), F.col("actual"), rtol, atol), "differs")
    return both.withColumn("difference", what).where("difference is not null").select(*dimensions, "expected", "actual", "difference")


def compare_json(expected: Column, actual: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Whether two JSON scalars agree: numbers within the tolerance, whole or not; truth values, texts and nulls only exactly.

    A truth value never equals a number.
    """
    a, b = F.trim(expected), F.trim(actual)
    number = r"^(-?\d+(\.\d+)?([eE][+-]?\d+)?|NaN|-?Infinity)$"
    numbers = a.rlike(number) & b.rlike(number)
    return F.coalesce(F.when(numbers, close(a.try_cast("double"), b.try_cast("double"), rtol, atol)).otherwise(a.eqNullSafe(b)), a.isNull() & b.isNull())


def validated_kind(df: DataFrame) -> DataFrame:
    """Kinds are model or reference, model where none is given; others are an error."""
    kind = F.coalesce(F.col("kind"), F.lit("model"))
    return df.withColumn("kind", F.when(kind.isin(*KINDS), kind).otherwise(F.raise_error(F.concat(F.lit("unknown kind "), kind)).cast("string")))


def series_points(df: DataFrame, values: str = "values", index: str = "index") -> DataFrame:
    """Long form: one row per value, with its index value, or its position where the index is short or missing.

    Columns named position, index_value or value give way to those of the points.
    """
    keep = [c for c in df.columns if c not in (values, index, "position", "index_value", "value")]
    rows = df.select(*keep, F.col(index).alias("__index"), F.posexplode(values).alias("position", "value"))
    named = F.coalesce(F.get("__index", F.col("position")).cast("string"), F.col("position").cast("string"))
    return rows.select(*keep, "position", named.alias("index_value"), "value")


def gather_series(df: DataFrame, keys: Sequence[str], index: str, value: str) -> DataFrame:
    """One row per series: its values in the order of its index."""
    points = F.sort_array(F.collect_list(F.struct(F.col(index).alias("i"), F.col(value).alias("v"))))
    rows = df.groupBy(*keys).agg(points.alias("p"))
    return rows.select(*keys, F.transform("p", lambda x: x["i"]).alias("index"), F.transform("p", lambda x: x["v"]).alias("values"))
