"""Finding files and reading their metadata."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INVALID = "invalid_asset"


def discover(spark: SparkSession, paths: Sequence[str], pattern: str = "*.nc", depth: int | None = None) -> DataFrame:
    """The distinct files below some folders whose names match, as a column ``path``.

    ``depth`` is the number of folders below a root that are looked into. Contents are
    not read.
    """
    found = []
    for root in paths:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path")
        if depth is not None:
            inside = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", root.rstrip("/"))  # file:///a is found as file:/a
            below = F.substring_index(F.col("path"), inside, -1)
            df = df.where(F.size(F.split(F.ltrim(below, F.lit("/")), "/")) - 1 <= depth)
        found.append(df)
    return reduce(DataFrame.unionByName, found).distinct()


def parse(files: DataFrame, function: Callable[[str], dict], schema: str) -> DataFrame:
    """Metadata of each file by a function of one's own, such as a header reader.

    A file on which it fails has its error in ``invalid_asset`` and nulls elsewhere.
    ``schema`` names the metadata columns.
    """
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    found = function(path)
                    rows.append([path, *(found.get(n) for n in names), None])
                except Exception as e:  # noqa: BLE001  a bad file must not end the scan
                    rows.append([path, *(None for _ in names), f"{type(e).__name__}: {e}"])
            yield pd.DataFrame(rows, columns=["path", *names, INVALID])

    return files.select("path").mapInPandas(run, f"path string, {schema}, {INVALID} string")


def split_invalid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and the invalid ones with their errors."""
    return df.where(F.col(INVALID).isNull()).drop(INVALID), df.where(F.col(INVALID).isNotNull()).select("path", INVALID)
