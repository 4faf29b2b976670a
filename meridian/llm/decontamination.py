"""Benchmark decontamination by greedy string tiling.

1. The benchmark's seeds, runs of ``least`` words, set the bits of a filter sized by
   their number. Documents are scanned once; those with a seed in the filter go on.
2. Shared seeds join documents to items; pairs that could not reach the threshold
   even if each place of a shared seed in the item covered ``least`` words of its own
   are left out. A tile of n words holds n - least + 1 places, so none is lost.
3. Each pair is tiled: the longest match that overlaps no tile so far is marked, again
   and again, found with running Karp-Rabin hashes of shrinking window lengths.
   An item counts as leaked when tiles cover ``threshold`` of its words, in
   whatever order they stand in the document.

Words are runs of letters and digits in lower case. An item of fewer than ``least``
words is leaked by a document of just these words; inside longer texts so few words
are no evidence.

Edge cases: null texts count as empty and match nothing; null or repeated doc_ids are
rows of their own; repeated items each give their rows; an empty table on either
side gives no rows; further columns are ignored by ``find_leaks`` and kept by
``drop_leaks``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import TEXT_HASH, documents, drop_rows, materialise, slices, with_text_hash
from meridian.llm.shingles import ALPHANUMERIC, mix, words

LEAST = 5
THRESHOLD = 0.5
#: The seed filter has 2**bits bits, 256 for each seed within these bounds (1 to 16 MB): a document of
#: hundreds of seeds passes by chance only if one of them does. Of more than half a million seeds it lets
#: more documents through; the join by seeds stays exact.
FEWEST_BITS, MOST_BITS = 23, 27
#: Punctuation and spaces beyond ASCII.
_MARKS = re.compile("[\u0080-¿×÷ -⁯　-〿﻿]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)

ITEMS = "item_id long, item_words binary, seeds array<long>, places array<long>"
HITS = f"doc_id long, {TEXT_HASH} long, part int, nth int, words binary, seeds array<long>"
TILED = f"doc_id long, {TEXT_HASH} long, item_id long, coverage double, n_tiles int, longest_tile int, item_words int"


def plain(text: str | None) -> bytes:
    text = (text or "").lower()
    return (text if text.isascii() else _MARKS.sub(" ", text)).encode()


def seeds(hashes: np.ndarray, least: int) -> np.ndarray:
    """A hash for each run of ``least`` words."""
    n = len(hashes) - least + 1
    out = np.zeros(max(n, 0), "u8")
    for j in range(least if n > 0 else 0):
        out = out * _STEP + hashes[j : n + j]
    return mix(out, 3)


def text_seeds(hashes: np.ndarray, least: int) -> np.ndarray:
    """The seeds of one text; of fewer than ``least`` words one for all of them, of none nothing."""
    if len(hashes) >= least or not len(hashes):
        return seeds(hashes, least)
    return mix(seeds(hashes, len(hashes)) + np.uint64(len(hashes)), 4)


# ------------------------------------------------------------------ tiling


def _running(values: np.ndarray, size: int, powers: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of all windows: differences of one running sum, moved to a common power."""
    total = np.concatenate([np.zeros(1, "u8"), np.cumsum(values * powers[: len(values)], dtype="u8")])
    n = len(values) - size + 1
    return (total[size:] - total[:n]) * inverse[:n]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    back = np.uint64(pow(int(_STEP), -1, 1 << 64))
    out = []
    for step in (_STEP, back):
        steps = np.full(n, step)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _places(item, text, free_item, free_text, size, tables) -> dict[int, np.ndarray]:
    """For each free window of the item, where free windows of the text repeat it."""
    if len(item) < size or len(text) < size:
        return {}
    gap_i, gap_t = (np.concatenate([[0], np.cumsum(~f)]) for f in (free_item, free_text))
    open_i = np.flatnonzero(gap_i[size:] == gap_i[:-size])
    open_t = np.flatnonzero(gap_t[size:] == gap_t[:-size])
    own = _running(item, size, *tables)[open_i]
    other = _running(text, size, *tables)[open_t]
    met = np.isin(other, own)
    other, open_t = other[met], open_t[met]
    found = {}
    for start, h in zip(open_i.tolist(), own, strict=True):
        at = open_t[other == h]
        at = at[(text[at[:, None] + np.arange(size)] == item[start : start + size]).all(axis=1)] if len(at) else at
        if len(at):
            found[start] = at
    return found


def _longest(item, text, free_item, free_text, start, at, size) -> tuple[int, int]:
    """The length of the longest free match from ``start``, ``size`` at least or 0, and the first of its places among ``at``."""
    if not free_item[start : start + size].all():
        return 0, 0
    at = at[free_text[at[:, None] + np.arange(size)].all(axis=1)]
    if not len(at):
        return 0, 0
    length = size
    while start + length < len(item) and free_item[start + length]:
        fits = at[at + length < len(text)]
        fits = fits[(text[fits + length] == item[start + length]) & free_text[fits + length]]
        if not len(fits):
            break
        at, length = fits, length + 1
    return length, int(at[0])


def tile(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (start in item, start in text, length).

    Always the longest free match is marked, of equal ones the first in the item and then
    in the text. The window begins at half the item and is halved when nothing that long is
    left, or jumps up to the longest match when that is more than twice as long. Within a
    window matches wait in a heap; one that tiles have partly covered goes back with what
    is left of it.
    """
    least = min(least, max(len(item), 1))
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tables = _tables(max(len(item), len(text)))
    tiles, size = [], max(least, len(item) // 2)
    while True:
        places = _places(item, text, free_item, free_text, size, tables)
        heap = []
        for i, at in places.items():
            length, t = _longest(item, text, free_item, free_text, i, at, size)
            heap.append((-length, i, t))
        heapify(heap)
        if heap and -heap[0][0] > 2 * size:
            size = -heap[0][0]
            continue
        while heap:
            length, i, t = heappop(heap)
            length = -length
            if free_item[i : i + length].all() and free_text[t : t + length].all():
                free_item[i : i + length] = free_text[t : t + length] = False
                tiles.append((i, t, length))
            else:
                length, t = _longest(item, text, free_item, free_text, i, places[i], size)
                if length:
                    heappush(heap, (-length, i, t))
        if size <= least:
            return tiles
        size = max(least, size // 2)


# ------------------------------------------------------------------ the join


def _seed_rows(least: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, counts = words([plain(x) for x in batch.column(1).to_pylist()], ALPHANUMERIC)
            own = np.split(hashes, np.cumsum(counts)[:-1]) if len(counts) else []
            keep = [k for k, w in enumerate(own) if len(w)]
            found = [np.unique(text_seeds(own[k], least), return_counts=True) for k in keep]
            yield pa.RecordBatch.from_pydict({
                "item_id": batch.column(0).cast(pa.int64()).take(pa.array(keep, pa.int64())),
                "item_words": pa.array([own[k].tobytes() for k in keep], pa.binary()),
                "seeds": pa.array([s.view("i8").tolist() for s, _ in found], pa.list_(pa.int64())),
                "places": pa.array([n.tolist() for _, n in found], pa.list_(pa.int64())),
            })

    return emit


def _bits(bits: int):
    """A task's part of the seed filter, in 64 slots."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros((1 << bits) // 8, "u1")
        for batch in batches:
            for s in batch.column(0):
                at = s.values.to_numpy().view("u8") >> np.uint64(64 - bits)
                np.bitwise_or.at(packed, (at >> np.uint64(3)).astype("i8"), np.uint8(128) >> (at & np.uint64(7)).astype("u1"))
        parts = packed.reshape(64, -1)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(range(64), pa.int32()), "bits": pa.array([p.tobytes() for p in parts], pa.binary())})

    return fill


def _or(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(raw, "u1")
            total[slot] = total[slot] | own if slot in total else own
    yield pa.RecordBatch.from_pydict({"slot": pa.array(list(total), pa.int32()), "bits": pa.array([x.tobytes() for x in total.values()], pa.binary())})


def _is_set(packed: np.ndarray, bits: int, values: np.ndarray) -> np.ndarray:
    at = values >> np.uint64(64 - bits)
    return (packed[(at >> np.uint64(3)).astype("i8")] << (at & np.uint64(7)).astype("u1")) & 128 > 0


def _hits(packed: np.ndarray, bits: int, least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            hashes, counts = words([plain(x) for x in batch.column(1).to_pylist()], ALPHANUMERIC)
            ends = np.cumsum(counts)
            every = seeds(hashes, least)  # some run over the end of a document
            hit = np.flatnonzero(_is_set(packed, bits, every))
            doc = np.searchsorted(ends, hit, side="right")
            inside = hit + least <= ends[doc] if len(hit) else np.zeros(0, bool)
            few = np.flatnonzero((counts > 0) & (counts < least))  # their one seed is their whole text
            own = np.array([text_seeds(hashes[ends[k] - counts[k] : ends[k]], least)[0] for k in few], "u8")
            known = _is_set(packed, bits, own)
            doc, value = np.concatenate([doc[inside], few[known]]), np.concatenate([every[hit[inside]], own[known]])
            order = np.argsort(doc, kind="stable")
            doc, value = doc[order], value[order]
            which = np.unique(doc)
            bounds = np.searchsorted(doc, [which, which + 1]) if len(which) else np.zeros((2, 0), "i8")
            found = [np.unique(value[low:high]).view("i8").tolist() for low, high in bounds.T]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()).take(pa.array(which, pa.int64())), TEXT_HASH: batch.column(2).take(pa.array(which, pa.int64())),
                "part": pa.array([part] * len(which), pa.int32()), "nth": pa.array(nth + which, pa.int32()),
                "words": pa.array([hashes[ends[k] - counts[k] : ends[k]].tobytes() for k in which], pa.binary()), "seeds": pa.array(found, pa.list_(pa.int64())),
            })
            nth += len(counts)

    return scan


def _tiled(least: int, threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text_hash, own, item_id, item in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                item = np.frombuffer(item, "<u8")
                tiles = tile(item, np.frombuffer(own, "<u8"), least)
                covered = sum(t[2] for t in tiles)
                if covered >= threshold * len(item):
                    rows.append((doc_id, text_hash, item_id, covered / len(item), len(tiles), max(t[2] for t in tiles), len(item)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
            names = [c.split()[0] for c in TILED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return verify


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document and item whose words are covered to ``threshold`` or more.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text. Returns doc_id,
    text_hash, item_id, coverage, n_tiles, longest_tile, item_words.
    """
    spark = docs.sparkSession
    items = materialise(benchmark.select("item_id", "text").mapInArrow(_seed_rows(least), ITEMS), "items")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = items.agg(F.sum(F.size("seeds"))).first()[0] or 0
    bits = min(max((256 * n).bit_length(), FEWEST_BITS), MOST_BITS)
    packed = np.zeros((64, (1 << bits) // 512), "u1")
    for row in items.select("seeds").mapInArrow(_bits(bits), "slot int, bits binary").repartition(min(tasks, 64), "slot").mapInArrow(_or, "slot int, bits binary").collect():
        packed[row["slot"]] = np.frombuffer(row["bits"], "u1")  # 64 rows, 2**MOST_BITS bits at most
    packed = packed.reshape(-1)

    scanned = with_text_hash(docs.select("doc_id", "text")).mapInArrow(_hits(packed, bits, least), HITS)
    hits = materialise(scanned, "seed-hits")
    seed = hits.select("part", "nth", F.explode("seeds").alias("seed"))
    item = items.withColumn("item", F.xxhash64("item_id", "item_words"))
    of_item = item.select("item", (F.octet_length("item_words") / 8).alias("n"), F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    of_item = of_item.select("item", "n", F.col("s.seeds").alias("seed"), F.col("s.places").alias("places")).distinct()
    shared = seed.join(of_item, "seed").groupBy("part", "nth", "item", "n").agg(F.sum("places").alias("shared"))
    pairs = shared.where(F.col("shared") * least >= F.col("n") * threshold).select("part", "nth", "item")
    rows = pairs.join(hits.select("part", "nth", "doc_id", TEXT_HASH, "words"), ["part", "nth"]).join(item.select("item", "item_id", "item_words"), "item")
    return rows.select("doc_id", TEXT_HASH, "words", "item_id", "item_words").mapInArrow(_tiled(least, threshold), TILED)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that leak an item, all columns kept."""
    return drop_rows(docs, find_leaks(docs, benchmark, least, threshold))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: leaks of the benchmark in all documents."""
    return find_leaks(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop(TEXT_HASH)
