"""JSON documents of any shape as rows, compared path by path.

A document is parsed once, as a variant, and opened level by level; what is left at the end
is a row per leaf: its path (names and places), its type and its value. Containers without
members are leaves too, so that nothing of a document is lost.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from meridian.operators.bundles import close
from meridian.sources.shared import written

#: How a variant holds numbers: whole ones of 64 bits, or longer ones, which no fraction is in; and others.
WHOLE = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\((19|[2-3]\d),0\))$"
NUMBER = r"^(FLOAT|DOUBLE|DECIMAL)"


def _kind(v: Column) -> Column:
    """object, array, whole, number (one written with a fraction or an exponent), boolean, string or null."""
    kind = F.schema_of_variant(v)
    name = F.regexp_extract(kind, "^[A-Z]+", 0)
    return F.when(name == "OBJECT", "object").when(name == "ARRAY", "array").when(kind.rlike(WHOLE), "whole").when(kind.rlike(NUMBER), "number").when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").otherwise("string")


def leaves(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys, path, kind, number, value: a row per leaf of the JSON in a column.

    ``path`` is a list of names, and of places in arrays as ``[k]``; ``value`` is the leaf as
    text. A text that is null, or no JSON, is one leaf at the empty path, of kind
    ``missing`` or ``invalid``. NaN and the infinities, which JSON has not, are strings.
    """
    keys = list(keys)
    quoted = F.regexp_replace(F.col(text), r'(?<=[:\[,])\s*(NaN|-?Infinity)\s*(?=[,\]}])', '"$1"')
    rows = df.select(*keys, F.array().cast("array<string>").alias("path"), F.col(text).alias("__text"), F.try_parse_json(quoted).alias("v"))
    bad = rows.where("v is null").select(*keys, "path", F.when(F.col("__text").isNull(), "missing").otherwise("invalid").alias("kind"), F.lit(None).cast("double").alias("number"), F.col("__text").alias("value"))
    level = rows.where("v is not null").select(*keys, "path", "v").withColumn("kind", _kind(F.col("v")))
    found = [bad]
    while True:
        level = written(level, "document-level")
        inside = F.col("kind").isin("object", "array")
        simple = level.where(~inside)
        found.append(simple.select(*keys, "path", "kind", F.when(F.col("kind").isin("whole", "number"), F.try_variant_get("v", "$", "double")).alias("number"), F.try_variant_get("v", "$", "string").alias("value")))
        containers = level.where(inside)
        if containers.isEmpty():
            return reduce(DataFrame.unionByName, found)
        members = F.when(F.col("kind") == "object", F.map_values(F.try_variant_get("v", "$", "map<string,variant>"))).otherwise(F.try_variant_get("v", "$", "array<variant>"))
        names = F.when(F.col("kind") == "object", F.map_keys(F.try_variant_get("v", "$", "map<string,variant>"))).otherwise(F.transform(members, lambda _, k: F.concat(F.lit("["), k, F.lit("]"))))
        opened = containers.select(*keys, "path", "kind", names.alias("__names"), members.alias("__members"))
        found.append(opened.where(F.size("__members") == 0).select(*keys, "path", "kind", F.lit(None).cast("double").alias("number"), F.lit(None).cast("string").alias("value")))
        each = opened.select(*keys, "path", "__names", F.posexplode("__members").alias("__k", "v"))
        level = each.select(*keys, F.concat("path", F.array(F.get("__names", F.col("__k")))).alias("path"), "v").withColumn("kind", _kind(F.col("v")))


def shown_path(path: Column) -> Column:
    """A path as it is read: a.b[0].c."""
    return F.regexp_replace(F.array_join(path, "."), r"\.\[", "[")


def compare_documents(expected: DataFrame, actual: DataFrame, keys: Sequence[str], text: str, rtol: float = 1e-5, atol: float = 1e-8, ignored: Sequence[str] = ()) -> DataFrame:
    """Where documents differ: keys, path (as text), difference, expected, actual.

    ``difference`` is missing (only expected), extra (only actual), retyped, or differs.
    Two whole numbers must be equal, other numbers agree within the tolerance, NaN and
    infinities with themselves; everything else must be equal, and a truth value never equals a number. ``ignored``
    are regular expressions of paths that are left out. A key in one table only has its
    document missing or extra as a whole.
    """
    keys = list(keys)
    a = leaves(expected, keys, text).select(*keys, "path", F.col("kind").alias("__ka"), F.col("number").alias("__na"), F.col("value").alias("expected"))
    b = leaves(actual, keys, text).select(*keys, "path", F.col("kind").alias("__kb"), F.col("number").alias("__nb"), F.col("value").alias("actual"))
    both = a.join(b, [*keys, "path"], "full").withColumn("path", shown_path(F.col("path")))
    for pattern in ignored:
        both = both.where(~F.col("path").rlike(pattern))
    number = lambda kind: kind.isin("whole", "number")
    numbers = number(F.col("__ka")) & number(F.col("__kb")) & ~((F.col("__ka") == "whole") & (F.col("__kb") == "whole"))
    equal = F.when(numbers, close(F.col("__na"), F.col("__nb"), rtol, atol)).otherwise(F.col("expected").eqNullSafe(F.col("actual")))
    what = F.when(F.col("__kb").isNull(), "missing").when(F.col("__ka").isNull(), "extra").when((F.col("__ka") != F.col("__kb")) & ~numbers, "retyped").when(~equal, "differs")
    return both.withColumn("difference", what).where("difference is not null").select(*keys, "path", "difference", "expected", "actual")


def _rewritten(change: Callable):
    """A JSON text after ``change`` of what it holds; no JSON stays as it is."""

    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return None if text is None else json.dumps(change(json.loads(text)), ensure_ascii=False)
            except ValueError:
                return text

        return texts.map(one)

    return F.pandas_udf(run, StringType())


def rounded(text: Column, figures: int = 7) -> Column:
    """A JSON text with every number that is not whole rounded to some figures, however deep it is."""
    def change(x):
        if isinstance(x, dict):
            return {k: change(v) for k, v in x.items()}
        if isinstance(x, list):
            return [change(v) for v in x]
        return float(f"{x:.{figures}g}") if isinstance(x, float) else x

    return _rewritten(change)(text)


def without_nulls(text: Column) -> Column:
    """A JSON text without members that are null, however deep; containers that become empty stay."""
    def change(x):
        if isinstance(x, dict):
            return {k: change(v) for k, v in x.items() if v is not None}
        return [change(v) for v in x if v is not None] if isinstance(x, list) else x

    return _rewritten(change)(text)
