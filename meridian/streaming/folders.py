"""Catalogues that grow by whole folders: validated, merged and compared batch by batch.

A batch reads only what earlier batches have left, writes its own tables under its number,
and counts once its last table, ``done``, is complete. So a batch that is run again,
wherever it broke off, replaces what it had written and changes nothing else.

``datasets`` holds the rows that a batch created or updated, ``files`` those that it added
or updated, ``invalid`` the files that were left out with the reason, ``statistics`` the
number of rows by state. ``Catalog.datasets`` and ``Catalog.files`` give the latest of each.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators.aggregates import inconsistent
from meridian.plans.upsert import diff_files, upsert_datasets
from meridian.sources.folders import FolderSource
from meridian.sources.files import INVALID
from meridian.sources.shared import complete_parts, read_parts

FILES = ("path", "start_time", "end_time")


@dataclass(frozen=True)
class Catalog:
    """A catalogue in one folder of the shared file system.

    ``columns`` are those that all files of a dataset (``slug``) must agree in; they and
    ``finalised`` make a dataset's row. A file's row is its path and its times.
    """

    spark: SparkSession
    folder: str
    columns: tuple[str, ...]
    slug: str = "instance_id"

    @property
    def schemas(self) -> dict[str, str]:
        facets = ", ".join(f"{c} string" for c in self.columns)
        return {
            "datasets": f"{self.slug} string, {facets}, finalised boolean, state string", "files": f"{self.slug} string, path string, start_time string, end_time string, state string",
            "invalid": f"path string, {INVALID} string", "statistics": "kind string, state string, n long", "done": "batch long", "raw": f"path string, {self.slug} string, {facets}, start_time string, end_time string, finalised boolean, {INVALID} string",
        }

    def batches(self, below: int | None = None) -> list[int]:
        return [n for n in map(int, complete_parts(self.spark, f"{self.folder}/done", "batch")) if below is None or n < below]

    def path(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch={batch:09d}"

    def rows(self, table: str, below: int | None = None) -> DataFrame:
        """All rows of complete batches, with the number of their batch."""
        at = F.regexp_extract(F.input_file_name(), r"batch=(\d+)", 1).cast("long")
        return read_parts(self.spark, [self.path(table, n) for n in self.batches(below)], self.schemas[table]).withColumn("batch", at)

    def _latest(self, table: str, key: Sequence[str], below: int | None) -> DataFrame:
        rows = self.rows(table, below).drop("state")
        rest = [c for c in rows.columns if c not in (*key, "batch")]
        return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("row")).select(*key, "row.*")

    def datasets(self, below: int | None = None) -> DataFrame:
        return self._latest("datasets", [self.slug], below)

    def files(self, below: int | None = None) -> DataFrame:
        return self._latest("files", [self.slug, "path"], below)

    def _write(self, table: str, df: DataFrame, batch: int) -> DataFrame:
        wanted = self.spark.createDataFrame([], self.schemas[table])
        df.select(*(F.col(c).cast(kind).alias(c) for c, kind in wanted.dtypes)).write.mode("overwrite").parquet(self.path(table, batch))
        return self.spark.read.schema(self.schemas[table]).parquet(self.path(table, batch))

    def take_in(self, rows: DataFrame, batch: int) -> None:
        """``rows``: path, the slug, ``columns``, start_time, end_time, finalised and perhaps invalid_asset."""
        if INVALID not in rows.columns:
            rows = rows.withColumn(INVALID, F.lit(None).cast("string"))
        raw = self._write("raw", rows, batch)
        readable = raw.where(F.col(INVALID).isNull())
        wrong = inconsistent(readable, self.slug, self.columns)
        torn = readable.join(wrong, self.slug).select("path", F.concat(F.lit("its dataset disagrees in "), F.array_join("columns", ", ")).alias(INVALID))
        self._write("invalid", raw.where(F.col(INVALID).isNotNull()).select("path", INVALID).unionByName(torn), batch)
        valid = readable.join(wrong, self.slug, "left_anti")
        fresh = valid.groupBy(self.slug).agg(*(F.max(c).alias(c) for c in self.columns), F.bool_and("finalised").alias("finalised"))
        touched = fresh.select(self.slug)
        datasets = upsert_datasets(self.datasets(batch).join(touched, self.slug, "left_semi"), fresh, self.slug)
        states = self._write("datasets", datasets.where("state in ('created', 'updated')"), batch)
        old = self.files(batch).join(touched, self.slug, "left_semi")
        files = diff_files(old, valid.select(self.slug, *FILES).dropDuplicates([self.slug, "path"]), (self.slug, "path"))
        changes = self._write("files", files.where("state in ('added', 'updated')"), batch)
        counted = [
            d.groupBy("state").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "state", "n")
            for kind, d in (("dataset", states), ("file", changes), ("invalid", self.spark.read.schema(self.schemas["invalid"]).parquet(self.path("invalid", batch)).withColumn("state", F.lit("left out"))))
        ]
        self._write("statistics", reduce(DataFrame.unionByName, counted), batch)
        self._write("done", self.spark.range(1).select(F.lit(batch).alias("batch")), batch)


def ingest_folders(catalog: Catalog, root: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], max_folders: int = 1000, **options: str) -> int:
    """Take in the folders below ``root`` that are new, in batches of ``max_folders``, and give the number of batches so far.

    ``prepare`` makes catalogue rows of (folder, path, size, modified), such as
    ``sources.paths.cmip6_from_path``. No folder at all is an error; none that is new is none.
    """
    spark = catalog.spark
    spark.dataSource.register(FolderSource)
    source = spark.readStream.format("folders").option("path", root).option("log", f"{checkpoint}/folders").option("maxfolders", max_folders).options(**options).load()
    if not catalog.batches():
        spark.read.format("folders").option("path", root).options(**options).load().isEmpty()

    def take_in(batch: DataFrame, number: int) -> None:
        catalog.take_in(prepare(batch), number)

    stream = source.writeStream.foreachBatch(take_in).option("checkpointLocation", f"{checkpoint}/stream").start()
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
        while stream.isActive:
            time.sleep(0.1)
    return len(catalog.batches())
