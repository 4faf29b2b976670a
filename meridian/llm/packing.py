"""Best-fit packing of token sequences by bin completion.

Documents are tokenized in place; only (length, count) pairs, at most one per
length up to the capacity, reach the planner. It fills one sequence at a time
around the longest piece left and applies a filling to as many sequences as the
counts allow. While the plan is above the lower bound, it branches over the
undominated fillings of each longest piece and over how often each is applied, and
undoes a choice once the waste so far leaves nothing to gain. The plan, a list of fillings with ranges of ranks, is as bounded as
the histogram. Each piece finds its place from its rank among the pieces of its
length, which is a running count within its task plus an offset per task.

Edge cases: a null or empty text is a document of the end id alone; null and
repeated doc_ids are packed as rows of their own; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import documents, materialise, release_memory, text_bytes
from meridian.llm.tokens import WordTokenizer, default_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(docs: DataFrame, capacity: int, tokenizer: str, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of each document; ``nth`` counts the pieces of one length within task ``part``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), Counter()
        words = WordTokenizer.of_worker(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = words.encode(text) + end
                for k, low in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[low : low + 4 * capacity]
                    n = len(own) // 4
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(low // 4)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    nth.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        ids.append(own)
            out = {
                "doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "part": pa.array([part] * len(doc), pa.int32()), "nth": pa.array(nth, pa.int64()),
            }
            if with_ids:
                out["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(out)
        release_memory()

    rows = docs.select("doc_id", text_bytes().alias("text"))
    return rows.mapInArrow(pieces, PIECES + (", ids binary" if with_ids else ""))


# ---------------------------------------------------------------- the planner


def dominated(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether filling ``a`` can be swapped into the room of ``b`` (both descending).

    ``b`` dominates ``a`` if the items of ``a`` fit into items of ``b`` used as bins;
    first fit decides, so a True is always right.
    """
    if a == b:
        return False
    room = list(b)
    for x in a:
        k = next((i for i, r in enumerate(room) if r >= x), None)
        if k is None:
            return False
        room[k] -= x
    return True


def fillings(room: int, counts: Counter, lengths: list[int], nodes: int, keep: int = 8) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from pieces of these ``lengths`` (ascending), least waste first.

    Depth first, from the longest piece that fits and as many of it as fit, so best
    fit is the first filling found. The search ends when nothing is wasted or after
    ``nodes`` steps; that bounds its time at one sequence, never which pieces are packed.
    """
    found: list[tuple[int, list[tuple[int, int]]]] = []
    steps = 0

    def descend(below: int, left: int, taken: list[tuple[int, int]]) -> bool:
        nonlocal steps
        leaf, at = True, bisect_right(lengths, min(below, left)) - 1
        while at >= 0:
            n = lengths[at]
            for k in range(min(counts[n], left // n), 0, -1):
                leaf = False
                steps += 1
                if descend(n - 1, left - n * k, [*taken, (n, k)]):
                    return True
            at -= 1
        if leaf:
            found.append((left, taken))
            found.sort(key=lambda x: (x[0], len(x[1])))
            del found[keep:]
        return found[0][0] == 0 or steps >= nodes

    descend(room, room, [])
    flat = [tuple(n for n, k in taken for _ in range(k)) for _, taken in found]
    return [f for f in flat if not any(dominated(f, g) for g in flat)] or flat[:1]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing needs fewer: total length, or pieces over half a sequence plus what cannot join them."""
    total = sum(n * c for n, c in counts.items())
    bound = -(-total // capacity)
    for k in (0, capacity // 4, capacity // 3):
        big = sum(c for n, c in counts.items() if n > capacity - k)
        mid = [(n, c) for n, c in counts.items() if capacity // 2 < n <= capacity - k]
        small = sum(n * c for n, c in counts.items() if k <= n <= capacity // 2)
        room = sum((capacity - n) * c for n, c in mid)
        bound = max(bound, big + sum(c for _, c in mid) + max(0, -(-(small - room) // capacity)))
    return bound


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: fillings and how many sequences get each."""
    return _complete(histogram, capacity, nodes=0, slack=None)


def _complete(histogram: dict[int, int], capacity: int, nodes: int, slack: int | None) -> list[tuple[tuple[int, ...], int]] | None:
    """Fill around the longest piece left until none is left; None once more than ``slack`` is wasted."""
    counts = Counter({n: c for n, c in histogram.items() if c > 0})
    lengths = sorted(counts)
    plan, wasted = [], 0
    while lengths:
        top = lengths[-1]
        counts[top] -= 1
        filling = (top, *fillings(capacity - top, counts, lengths, nodes)[0])
        counts[top] += 1
        need = Counter(filling)
        times = min(counts[n] // k for n, k in need.items())
        for n, k in need.items():
            counts[n] -= k * times
            if not counts[n]:
                del lengths[bisect_left(lengths, n)]
        plan.append((filling, times))
        wasted += (capacity - sum(filling)) * times
        if slack is not None and lengths and wasted > slack:
            return None
    return plan


#: Steps after which the search for a shorter plan ends, and those of one list of fillings.
STEPS, STEPS_OF_ONE = 1_000_000, 20_000
#: Fillings of one list that are compared; the search knows that it is not complete where there are more.
MOST = 200


def _alternatives(room: int, waste: int, counts: Counter, lengths: list[int], steps: int) -> tuple[list[tuple[int, ...]], int, bool]:
    """All undominated fillings of ``room`` that waste at most ``waste``, the steps taken, and whether ``steps`` sufficed."""
    ends = [0]  # what all pieces of the shortest lengths sum up to
    for n in lengths:
        ends.append(ends[-1] + n * counts[n])
    found: list[tuple[int, ...]] = []
    taken = 0
    stack: list[tuple[int, int, tuple[int, ...]]] = [(len(lengths), room, ())]
    while stack and taken < steps:
        taken += 1
        top, left, filling = stack.pop()
        top = bisect_right(lengths, left, 0, top)
        if left - ends[top] > waste:
            continue
        if not top:
            found.append(filling)
            continue
        n = lengths[top - 1]
        for k in range(min(counts[n], left // n) + 1):  # the most pieces are looked at first
            stack.append((top - 1, left - n * k, filling + (n,) * k))
    whole = not stack and len(found) <= MOST
    found = sorted(set(found), key=lambda f: (-sum(f), len(f)))[:MOST]
    return [f for f in found if not any(dominated(f, g) and not (dominated(g, f) and f < g) for g in found)], taken + len(found) ** 2, whole


def _branch(histogram: dict[int, int], capacity: int, used: int, bound: int, steps: int = STEPS) -> list[tuple[tuple[int, ...], int]] | None:
    """The best plan of fewer than ``used`` sequences that the search finds in ``steps`` steps, None if there is none.

    Depth first with undo. A round may leave the first choice only so many times, and
    the next round twice as many: early choices are revised before late ones are used up.
    """
    total = sum(n * c for n, c in histogram.items())
    best, spent, leaves = None, 0, 1
    while spent < steps and used > bound:
        counts = Counter({n: c for n, c in histogram.items() if c > 0})
        cut = False
        path: list[tuple[tuple[int, ...], int]] = []
        wasted, left_first = 0, [0]
        frames: list[Iterator[tuple[int, tuple[int, ...], int]]] = []

        def options(allowed: int, last: tuple[int, ...] | None) -> Iterator[tuple[int, tuple[int, ...], int]]:
            nonlocal spent, cut
            lengths = sorted(n for n, c in counts.items() if c)
            top = lengths[-1]
            counts[top] -= 1
            fillings, taken, whole = _alternatives(capacity - top, allowed, counts, [n for n in lengths if counts[n]], min(STEPS_OF_ONE, steps - spent))
            counts[top] += 1
            spent += taken + len(lengths)
            cut |= not whole
            choices = []
            for f in fillings:
                waste, most = capacity - top - sum(f), min(counts[n] // k for n, k in Counter((top, *f)).items())
                most = min(most, allowed // waste) if waste else most
                if most and (top, *f) != last:
                    choices.append(((top, *f), most))
            rank = 0
            for fewer in range(max((most for _, most in choices), default=0)):  # every filling as often as can be, then less often
                for filling, most in choices:
                    if most > fewer:
                        yield rank, filling, most - fewer
                        rank += 1

        frames.append(options((used - 1) * capacity - total, None))
        while frames and spent < steps:
            if len(path) == len(frames):
                filling, times = path.pop()
                wasted -= (capacity - sum(filling)) * times
                left_first.pop()
                for n in filling:
                    counts[n] += times
            choice = next(frames[-1], None)
            if choice is not None and left_first[-1] + choice[0] > leaves:
                choice, cut = None, True
            if choice is None:
                frames.pop()
                continue
            spent += 1
            rank, filling, times = choice
            waste = (capacity - sum(filling)) * times
            allowed = (used - 1) * capacity - total - wasted - waste
            path.append((filling, times))
            left_first.append(left_first[-1] + rank)
            wasted += waste
            for n in filling:
                counts[n] -= times
            if allowed < 0:
                continue
            if not any(counts.values()):
                best, used = list(path), sum(t for _, t in path)
                if used <= bound:
                    return best
                continue
            frames.append(options(allowed, filling))
        if not cut:
            break
        leaves *= 2
    return best


def plan_packing(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bin completion over a histogram of lengths.

    Best-fit decreasing is the first incumbent. While the incumbent is above the lower
    bound, two wider passes follow, which give up as soon as their waste would need as
    many sequences as the incumbent has, and then the search that undoes choices.
    """
    incumbent = best_fit(histogram, capacity)
    used = sum(t for _, t in incumbent)
    total, bound = sum(n * c for n, c in histogram.items()), lower_bound(histogram, capacity)
    for nodes in (200, 2000):
        if used <= bound:
            break
        found = _complete(histogram, capacity, nodes, slack=(used - 1) * capacity - total)
        if found is not None and sum(t for _, t in found) < used:
            incumbent, used = found, sum(t for _, t in found)
    return incumbent if used <= bound else _branch(histogram, capacity, used, bound) or incumbent


def places(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """The plan as ranges of ranks: for each filling and length, where its pieces begin to land.

    Sorted by (length, first rank): length, first rank, first sequence, pieces of that
    length in a sequence, offset of the first.
    """
    rows, ranks, sequence = [], Counter(), 0
    for filling, times in plan:
        at = 0
        for n, k in Counter(filling).items():  # a Counter keeps the order of first use
            rows.append((n, ranks[n], sequence, k, at))
            ranks[n] += k * times
            at += n * k
        sequence += times
    table = np.array(sorted(rows), "i8").reshape(-1, 5)
    return tuple(table.T)


def pack(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Place every piece of ``docs`` (doc_id, text) in a sequence of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset [, ids].
    """
    pieces = materialise(cut(docs, capacity, tokenizer or default_path(), end_id, with_ids), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # at most one row per length up to the capacity
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    length, rank, sequence, many, offset = places(plan_packing(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = 1 << 50
        keys = length * shift + rank
        for batch in batches:
            own = batch.column("length").to_numpy()
            nth = batch.column("rank").to_numpy()
            k = np.searchsorted(keys, own * shift + nth, side="right") - 1
            past = nth - rank[k]
            out = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            out["sequence_id"] = pa.array(sequence[k] + past // many[k])
            out["offset"] = pa.array(offset[k] + past % many[k] * own)
            if with_ids:
                out["ids"] = batch.column("ids")
            yield pa.RecordBatch.from_pydict(out)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before")).drop("nth", "before", "part")
    return ranked.mapInArrow(place, PLACED + (", ids binary" if with_ids else ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: pack all documents into sequences of at most 4096 tokens."""
    return pack(documents(spark, sf_dir, "doc_id", "text"))
