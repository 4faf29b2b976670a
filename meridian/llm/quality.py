"""Quality: ordinal cumulative-link regression on graded ratings over hashed text.

P(grade <= k) is the logistic function of ``cut[k] - score``: all grades share one
set of weights, and the cuts are ordered by construction. The score adds the mean
weight of a text's hashed words, word pairs, word shapes and repetitions. It is
fitted on at most ``max_rated`` rated rows, those with the smallest hashes of their
doc_id, and in that order on no more than hold ``max_features`` distinct features, never
on rows whose crc32(doc_id as text) mod 5 is 0.

Edge cases: a null text counts as empty and is scored like any other; of several
ratings of a doc_id the lowest counts; null ratings and null doc_ids teach nothing;
with fewer than two grades to learn from, every text gets the one grade (0 without
any) for certain; null and repeated doc_ids are scored as rows of their own; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import documents, hash_sample, materialise, slices, text_bytes
from meridian.llm.shingles import _powers, mix

MAX_RATED = 5_000
#: Distinct features of all rated texts together, 32 MB.
MAX_FEATURES = 4_000_000
BITS = 18
KEEP = 0.5
SCALE = 20.0

_rng = np.random.default_rng(42)
_BYTE = _rng.integers(0, 1 << 64, 256, "u8")
#: Classes of bytes: 0 space, 1 letter, digit or beyond ASCII, 2 mark.
_CLASS = np.full(256, 2, "u1")
_CLASS[:0x21] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = 1
_CAPITAL = np.zeros(256, "i8")
_CAPITAL[65:91] = 1
_DIGIT = np.zeros(256, "i8")
_DIGIT[48:58] = 1


def hashed(text: bytes) -> np.ndarray:
    """Feature numbers of a text, one for each occurrence."""
    raw = np.frombuffer(text, "u1")
    kind = _CLASS[raw]
    edge = np.flatnonzero(np.diff(kind, prepend=255))
    if not len(edge):
        return np.zeros(0, "u4")
    size = np.diff(np.append(edge, len(raw)))
    of = kind[edge]
    place = np.arange(len(raw)) - np.repeat(edge, size)
    token = mix(np.add.reduceat(_BYTE[raw] * _powers(int(size.max()))[place], edge))
    capital, digit = np.add.reduceat(_CAPITAL[raw], edge), np.add.reduceat(_DIGIT[raw], edge)
    solid = of > 0
    token, size, of, capital, digit = token[solid], size[solid], of[solid].astype("i8"), capital[solid], digit[solid]
    if not len(token):
        return np.zeros(0, "u4")
    shape = of * 1000 + np.minimum(size, 12) * 10 + np.where(capital == size, 3, np.minimum(capital, 2)) + 5 * (digit > 0)
    pair = token[1:] * np.uint64(3) + token[:-1]
    again = (token[1:] == token[:-1]).astype("u8")
    variety = np.uint64(len(np.unique(token)) * 10 // len(token))
    extra = mix(np.concatenate([shape.astype("u8") + np.uint64(1 << 20), again + np.uint64(1 << 30), np.full(len(token), variety + np.uint64(1 << 40))]), 5)
    return (np.concatenate([token, mix(pair, 4), extra]) >> np.uint64(64 - BITS)).astype("u4")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the hashed features and ordered cuts between ``grades``."""

    grades: list[int]
    weights: np.ndarray
    cuts: np.ndarray

    def score(self, numbers: list[np.ndarray]) -> np.ndarray:
        return np.array([SCALE * self.weights[x].sum() / max(len(x), 1) for x in numbers], "f8").reshape(-1)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each grade but the lowest."""
        return _sigmoid(scores[:, None] - self.cuts[None, :])


def minimise(value_and_slope, start: np.ndarray, steps: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with a backtracking line search."""
    x, (f, g) = start, value_and_slope(start)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, used = -g, []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            d = d - a * y
            used.append(a)
        if past:
            s, y = past[-1]
            d = d * (s @ y / (y @ y))
        for (s, y), a in zip(past, reversed(used), strict=True):
            d = d + s * (a - y @ d / (s @ y))
        step = 1.0 if past else min(1.0, 1.0 / max(np.abs(g).sum(), 1e-12))
        while True:
            new = x + step * d
            fn, gn = value_and_slope(new)
            if fn <= f + 1e-4 * step * (g @ d):
                break
            step /= 2
            if step < 1e-10:
                return x
        if (s := new - x) @ (y := gn - g) > 1e-12:
            past = [*past, (s, y)][-memory:]
        if f - fn <= 1e-7 * max(abs(f), 1.0):
            return new
        x, f, g = new, fn, gn
    return x


def fit(numbers: list[np.ndarray], shares: list[np.ndarray], ratings: list[int], penalty: float = 1e-5) -> OrdinalModel:
    """``numbers`` are a text's distinct features, ``shares`` their shares of its occurrences."""
    grades = sorted(set(ratings))
    width = 1 << BITS
    if len(grades) < 2:
        return OrdinalModel(grades or [0], np.zeros(width), np.zeros(0))
    flat = np.concatenate(numbers).astype("i4")
    row = np.repeat(np.arange(len(numbers), dtype="i4"), [len(x) for x in numbers])
    share = np.concatenate(shares).astype("f4") * np.float32(SCALE)
    level = np.searchsorted(grades, ratings)
    k, n = len(grades), len(ratings)

    def cuts(free: np.ndarray) -> np.ndarray:
        return free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])

    def value_and_slope(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, free = p[:width], p[width:]
        s = np.bincount(row, w.astype("f4")[flat] * share, minlength=n)
        bounds = np.concatenate([[-np.inf], cuts(free), [np.inf]])
        upper, lower = _sigmoid(bounds[level + 1] - s), _sigmoid(bounds[level] - s)
        likely = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        slope_s = (du - dl) / n
        slope_c = np.bincount(level, -du, minlength=k)[: k - 1] / n + np.bincount(level, dl, minlength=k)[1:] / n
        slope_f = np.concatenate([[slope_c.sum()], np.exp(free[1:]) * np.cumsum(slope_c[::-1])[::-1][1:]])
        slope_w = np.bincount(flat, slope_s.astype("f4")[row] * share, minlength=width) + 2 * penalty * w
        return float(-np.log(likely).mean() + penalty * (w @ w)), np.concatenate([slope_w, slope_f])

    p = minimise(value_and_slope, np.concatenate([np.zeros(width), [-1.0], np.zeros(k - 2)]))
    return OrdinalModel(grades, p[:width].astype("f4"), cuts(p[width:]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        own = [np.unique(hashed(x), return_counts=True) for x in batch.column(0).to_pylist()]
        shares = [(c / max(c.sum(), 1)).astype("<f4").tobytes() for _, c in own]
        yield pa.RecordBatch.from_pydict({"numbers": pa.array([k.tobytes() for k, _ in own], pa.binary()), "shares": pa.array(shares, pa.binary()), "rating": batch.column(1), "place": batch.column(2)})


def learn(docs: DataFrame, labels: DataFrame, max_rated: int = MAX_RATED, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on a bounded sample of the ratings in ``labels`` (doc_id, quality)."""
    rated = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("long").alias("rating"))
    rated = rated.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    rated = hash_sample(rated, max_rated, "doc_id").withColumn("place", F.xxhash64("doc_id"))
    rows = docs.join(F.broadcast(materialise(rated, "rated")), "doc_id").select(text_bytes().alias("text"), "rating", "place")
    found = materialise(rows.mapInArrow(_features, "numbers binary, shares binary, rating long, place long"), "rated-features")
    size = F.octet_length("numbers") / 4
    so_far = Window.orderBy("place", "mark").rowsBetween(Window.unboundedPreceding, 0)  # over max_rated numbers
    last = found.select("place", F.xxhash64("numbers").alias("mark"), size.alias("size")).withColumn("total", F.sum("size").over(so_far)).where(F.col("total") <= max_features).agg(F.max("place")).first()[0]
    found = found.where(F.col("place") <= F.lit(last).cast("long")).collect()  # max_features bounds its bytes
    return fit([np.frombuffer(r["numbers"], "<u4") for r in found], [np.frombuffer(r["shares"], "<f4") for r in found], [r["rating"] for r in found])


def grade(docs: DataFrame, model: OrdinalModel, keep: float = KEEP) -> DataFrame:
    """doc_id, expected_grade, tail_probabilities, keep for every row of ``docs`` (doc_id, text).

    ``tail_probabilities`` holds P(grade >= g) for each grade but the lowest; ``keep``
    says whether the upper half of the grades is reached with probability ``keep``.
    """
    grades = np.array(model.grades, "f8")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tails = model.tails(model.score([hashed(x) for x in batch.column(1).to_pylist()]))
            expected = grades[0] + tails @ np.diff(grades)
            half = tails[:, len(grades) // 2 - 1] if len(grades) > 1 else np.ones(len(tails))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "expected_grade": pa.array(expected),
                "tail_probabilities": pa.array(tails.tolist(), pa.list_(pa.float64())), "keep": pa.array(half >= keep),
            })

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(rows, "doc_id long, expected_grade double, tail_probabilities array<double>, keep boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: expected grade and tail probabilities of all documents."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return grade(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
