"""Centroid clustering against a plain version, and on awkward rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from meridian.llm.centroids import LARGEST, _moved, _lists, centroid_digest, cluster_vectors, clusters

SCHEMA = "vec_id long, embedding array<float>, cluster string, v int, dots string, distance double"


def plain(rows, k, rounds, size):
    """One row of numbers at a time, distances from the components."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min(((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o)] if o else c for o, c in zip(own, centres)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    total = {}
    for _, j, d in found:
        total[j] = total.get(j, 0) + d
    return sorted(((i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, j, d in found), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, "d", 0.5) for i, v in rows], SCHEMA)


def awkward():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 3, 0.6) for _ in range(6)]) for i in range(120)]
    rows += [(7, [0.25] * 6), (7, [0.25] * 6), (None, [1.0] * 6), (None, [0.5] * 6)]  # repeated and null ids, ties
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0] * 7), (204, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (205, [float("nan")] * 6), (206, [float("inf")] + [0.0] * 5)]
    return rows


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 1), (1, 2), (5, 0)])
def test_equal_to_a_plain_version(spark, k, rounds):
    rows = awkward()
    found = cluster_vectors(frame(spark, rows).repartition(5), k, rounds, 6)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows, k, rounds, 6)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-4.0, 2.0])]
    assert sorted(map(tuple, cluster_vectors(frame(spark, rows), 8, 3, 2).collect()), key=repr) == plain(rows, 8, 3, 2)
    assert cluster_vectors(frame(spark, []), 8, 3, 2).collect() == []
    assert cluster_vectors(frame(spark, [(1, [1.0])]), 8, 3, 2).collect() == []


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        cluster_vectors(frame(spark, [(1, [1e9, 0.0])]), 2, 1, 2).collect()
    assert LARGEST == 1 << 26


def test_dot_products_are_those_of_the_last_centroids(spark):
    """The matrix carried from round to round equals one computed afresh."""
    state, centres = clusters(frame(spark, awkward()), 4, 6, 6)
    for r in state.collect():
        assert r["dots"] == [int(np.dot(np.array(r["v"]), c)) for c in centres]


def test_only_moved_components_are_read():
    """A component that no centroid moves in may hold anything."""
    import pyarrow as pa

    v = np.array([[3, 5, 7]], "i4")
    batch = pa.RecordBatch.from_pydict({"vec_id": pa.array([1]), "v": _lists(v), "dots": _lists(np.array([[10, 20]], "i8"))})
    change = np.array([[0, 2, 0], [0, 0, 0]])
    (out,) = _moved(np.array([[0, 2, 0], [1, 1, 1]]), change)(iter([batch]))
    assert out.column(2).to_pylist() == [[20, 20]]
    assert centroid_digest([1, -2]) == hashlib.sha256(b"1,-2").hexdigest()
