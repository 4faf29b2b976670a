"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector keeps its exact dot product with each centroid, so that its squared
distance is |v|^2 - 2 v.c + |c|^2 without reading a centroid. When centroids move, the
dot products change by the moved components alone: the next state of a vector is its
last one plus v[i] * change[i] over the components i with a change other than 0, and the
nearest centroid is taken anew from the row of the matrix. The first state starts from
centroids at the origin, so that the start is a change like any other.

A round is one pass over the state, which is written to the shared folder, and one
pre-aggregated sum of k rows. The state before is removed once the next one is written,
and no job reads a state that is gone. When no centroid has moved, later rounds would
change nothing and are left out.

Edge cases: a vector counts if it has exactly ``size`` components, none null, NaN or
infinite; others, and null vectors, give no row. Components become floor(scale * x), an
error beyond 2^26 in size, where distances could pass 64 bits. Of equally near centroids
the one with the smaller number wins. Repeated vec_ids are vectors of their own; among
the starts they, like null vec_ids, which come last, are told apart by their components,
and equal vectors with one vec_id give equal starts, of which the later stays empty. Of fewer
than ``k`` vectors each is a start. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import discard, fresh_path

#: Components of this size at most: then 64-bit sums of 1024 products are exact.
LARGEST = 1 << 26
STATE = "vec_id long, v array<int>, dots array<long>, cluster int, distance long"
FOUND = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Lists of one length as a matrix; the values are not copied where they have that type already."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width, dtype="i4"), values.reshape(-1))


def _integers(size: int, scale: float):
    """The vectors that count, as integers."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            length = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            rows = batch.filter(pa.array(length == size))
            if not rows.num_rows:
                continue
            x = rows.column(1).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
            good = np.isfinite(x).all(axis=1)
            whole = np.floor(scale * x[good])
            if (np.abs(whole) > LARGEST).any():
                raise ValueError(f"a component is beyond {LARGEST} in size")
            yield pa.RecordBatch.from_pydict({"vec_id": rows.column(0).filter(pa.array(good)).cast(pa.int64()), "v": _lists(whole.astype("i4"))})

    return convert


def vectors(df: DataFrame, size: int, scale: float) -> DataFrame:
    """vec_id, v (integers) of the rows of ``df`` (vec_id, embedding) that count."""
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_integers(size, scale), "vec_id long, v array<int>")


def starts(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of salt and vec_id, in that order."""
    mark = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    return np.array([r["v"] for r in kept.orderBy(mark.isNull(), mark, "v").limit(k).collect()], "i8")  # k rows


def _moved(centroids: np.ndarray, change: np.ndarray):
    """The state of vectors after a change of the centroids to ``centroids``."""
    parts = [(j, np.flatnonzero(row), row[np.flatnonzero(row)]) for j, row in enumerate(change) if row.any()]
    norms = (centroids * centroids).sum(axis=1)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), "i8")
            dots = _matrix(batch.column(2), "i8").copy() if batch.num_columns > 2 else np.zeros((len(v), len(norms)), "i8")
            for j, at, by in parts:
                dots[:, j] += v[:, at] @ by
            distances = (v * v).sum(axis=1)[:, None] - 2 * dots + norms
            nearest = distances.argmin(axis=1)  # the first of equal ones
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0), "v": batch.column(1), "dots": _lists(dots), "cluster": pa.array(nearest.astype("i4")), "distance": pa.array(distances[np.arange(len(v)), nearest]),
            })

    return move


def _summed(k: int, size: int):
    """Each task's sums by centroid and component, and behind the components the number of its vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size + 1), "i8")
        for batch in batches:
            if not batch.num_rows:
                continue
            v, cluster = _matrix(batch.column(0), "i8"), batch.column(1).to_numpy(zero_copy_only=False)
            for j in np.unique(cluster):
                own = v[cluster == j]
                sums[j, :-1] += own.sum(axis=0)
                sums[j, -1] += len(own)
        j, i = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict({"j": pa.array(j.astype("i4")), "i": pa.array(i.astype("i4")), "total": pa.array(sums[j, i])})

    return add


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's exact floor of the mean of its vectors; an empty one stays."""
    k, size = centroids.shape
    parts = state.select("v", "cluster").mapInArrow(_summed(k, size), "j int, i int, total long")
    totals = [[0] * (size + 1) for _ in range(k)]
    for r in parts.groupBy("j", "i").agg(F.sum("total").alias("total")).collect():  # k rows of components
        totals[r["j"]][r["i"]] = r["total"]
    return np.array([[x // t[-1] for x in t[:-1]] if t[-1] else c for t, c in zip(totals, centroids.tolist(), strict=True)], "i8")


def clusters(df: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: float = 1024.0, salt: str = "3:") -> tuple[DataFrame, np.ndarray]:
    """Every vector's cluster and squared distance after ``rounds`` rounds, and the centroids.

    ``df``: vec_id, embedding. The frame has vec_id, v, dots (with every centroid), cluster, distance.
    """
    spark = df.sparkSession
    kept_path = fresh_path(spark, "vectors")
    vectors(df, size, scale).write.parquet(kept_path)
    rows = spark.read.schema("vec_id long, v array<int>").parquet(kept_path)
    centroids = starts(rows, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], STATE), np.zeros((0, size), "i8")
    change, last = centroids, kept_path
    for n in range(rounds + 1):
        path = fresh_path(spark, f"distances-{n}")
        rows.mapInArrow(_moved(centroids, change), STATE).write.parquet(path)
        discard(spark, last)
        rows, last = spark.read.schema(STATE).parquet(path), path
        if n == rounds:
            break
        following = _means(rows, centroids)
        change, centroids = following - centroids, following
        if not change.any():
            break
    return rows, centroids


def centroid_digest(components: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in components).encode()).hexdigest()


def cluster_vectors(df: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: float = 1024.0, salt: str = "3:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that counts."""
    spark = df.sparkSession
    rows, centroids = clusters(df, k, rounds, size, scale, salt)
    sums = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # a row for each centroid
    known = [(j, sums.get(j, 0), sum(sums.values()), centroid_digest(c)) for j, c in enumerate(centroids)]
    known = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.select("vec_id", "cluster", "distance").join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the clusters of all embeddings."""
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def _sql(k: int = 8, rounds: int = 10) -> str:
    """Each round as two tables: nearest centroids, then means."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT vec_id, arg_min(j, (d, j)) AS j, min(d) AS d FROM (SELECT vec_id, j, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN c{n} USING (i) GROUP BY vec_id, j) GROUP BY vec_id)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT j, i, coalesce(m, c) AS c FROM c{n} LEFT JOIN (SELECT j, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM a{n} JOIN x USING (vec_id) GROUP BY j, i) USING (j, i))""")
    rest = ",\n".join(steps)
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS i FROM v),
s AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j FROM v QUALIFY j < {k}),
c0 AS MATERIALIZED (SELECT j, i, x AS c FROM s JOIN x USING (vec_id)),
{rest},
h AS (SELECT j, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN h USING (j)
"""


SQL = _sql()
