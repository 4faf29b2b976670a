"""Catalogue changes: validation, upserts, finalisation, retraction. Each gives the next state of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.aggregates import inconsistent


def validate(df: DataFrame, slug: str, required: Sequence[str], dataset_columns: Sequence[str], skip_invalid: bool = False) -> DataFrame:
    """Rows of datasets that agree with themselves; others are dropped, or an error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    wrong = inconsistent(df, slug, dataset_columns)
    if not skip_invalid:
        first = wrong.orderBy(slug).first()
        if first is not None:
            raise ValueError(f"{first[slug]} is inconsistent in {first['columns']}")
    return df.join(wrong, slug, "left_anti")


def changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)


def upsert_datasets(old: DataFrame, new: DataFrame, slug: str = "slug") -> DataFrame:
    """Datasets after an ingest, with ``state``: created, updated, unchanged or kept.

    A null never overwrites. Metadata read from paths only never overwrites that of a
    finalised dataset.
    """
    columns = [c for c in old.columns if c != slug]
    a = old.withColumn("__old", F.lit(True))
    b = new.select(slug, *(F.col(c).alias(f"__{c}") for c in columns if c in new.columns), F.lit(True).alias("__new"))
    rows = a.join(b, slug, "full")
    known, fresh = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    weaker = F.coalesce(F.col("finalised"), F.lit(False)) & ~F.coalesce(F.col("__finalised"), F.lit(False)) if "finalised" in new.columns and "finalised" in columns else F.lit(False)
    merged = {c: F.when(known & weaker, F.col(c)).otherwise(F.coalesce(f"__{c}", c)) for c in columns if c in new.columns}
    differs = F.lit(False)
    for c, value in merged.items():
        differs = differs | changed(F.col(c), value)
    state = F.when(~fresh, "kept").when(~known, "created").when(differs, "updated").otherwise("unchanged")
    return rows.select(slug, *(merged.get(c, F.col(c)).alias(c) for c in columns), state.alias("state"))


def diff_files(old: DataFrame, new: DataFrame, key: Sequence[str] = ("dataset_id", "path"), compare: Sequence[str] = ("start_time", "end_time")) -> DataFrame:
    """Files after an ingest with ``state``: added, updated, unchanged, or removed ones, which are kept."""
    a = old.select(*key, *compare, F.lit(True).alias("__old"))
    b = new.select(*key, *(F.col(c).alias(f"__{c}") for c in compare), F.lit(True).alias("__new"))
    rows = a.join(b, list(key), "full")
    differs = F.lit(False)
    for c in compare:
        differs = differs | changed(F.col(c), F.col(f"__{c}"))
    state = F.when(F.col("__new").isNull(), "removed").when(F.col("__old").isNull(), "added").when(differs, "updated").otherwise("unchanged")
    return rows.select(*key, *(F.when(F.col("__new").isNull(), F.col(c)).otherwise(F.col(f"__{c}")).alias(c) for c in compare), state.alias("state"))


def ingestion_statistics(states: DataFrame) -> DataFrame:
    return states.groupBy("state").agg(F.count("*").alias("n"))


def finalise(catalog: DataFrame, parsed: DataFrame, key: str = "path") -> DataFrame:
    """Unfinalised rows with what their headers gave; rows without a header stay as they are."""
    names = [c for c in parsed.columns if c != key]
    b = parsed.select(key, *(F.col(c).alias(f"__{c}") for c in names), F.lit(True).alias("__found"))
    rows = catalog.join(b, key, "left")
    done = F.col("__found").isNotNull() & ~F.col("finalised")
    new = {c: F.when(done, F.coalesce(f"__{c}", c)).otherwise(F.col(c)) for c in names if c in catalog.columns}
    return rows.withColumns(new | {"finalised": F.col("finalised") | done}).select(*catalog.columns)


def unfinalised(catalog: DataFrame) -> DataFrame:
    """How many datasets and files still lack what their headers say."""
    rows = catalog.where(~F.col("finalised"))
    return rows.groupBy("dataset_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("datasets"), F.coalesce(F.sum("n"), F.lit(0)).alias("files"))


def retract(catalog: DataFrame, where: Column, at: Column) -> DataFrame:
    """A soft delete; what is retracted already keeps its time."""
    return catalog.withColumn("retracted_at", F.when(F.coalesce(where, F.lit(False)), F.coalesce("retracted_at", at)).otherwise(F.col("retracted_at")))


def unretract(catalog: DataFrame, where: Column) -> DataFrame:
    return catalog.withColumn("retracted_at", F.when(F.coalesce(where, F.lit(False)), None).otherwise(F.col("retracted_at")))


def new_by_hash(old: DataFrame, new: DataFrame, key: str = "hash") -> DataFrame:
    """Content-addressed rows that are not there yet, each once."""
    return new.dropDuplicates([key]).join(old.select(key), key, "left_anti")
