"""Similarity join on word shingles with several global token orders.

Two sets whose Jaccard similarity is at least t share a token among the first
``n - ceil(t n) + 1`` tokens of each, whatever global order sorts them. The join

1. counts all shingles in a sketch of fixed width and takes the first order from
   it, rare shingles first, so that passages many documents share come last;
2. gathers the prefixes under that order by token. A token of few documents gives
   the pairs that pass the size and position bounds, first those with one of the
   documents and, of the others, those that are not in one component then. A token of
   many gives pairs with a few hubs, and its documents are remembered;
3. writes, for the documents of these pairs, the set and its prefix under each
   further order. The prefixes alone are read first: a pair goes on only if they meet
   under every order. Only the sets of the pairs left are then read and compared;
4. compares, in blocks of documents of like sizes, the remembered documents that are
   not yet in one component: a block drops the pairs whose prefixes do not meet under
   every further order, then counts the intersections of the others at once. No
   pairs are written, and within a component nothing is compared.

Documents are joined as their shingle sets, so any number of copies is one set.

Edge cases: a null or blank text has no shingles and is linked with nothing; a row
with a null doc_id gets a null component_id and links nothing; rows that repeat a
doc_id are rows of their own; an empty table gives no rows; further columns are
ignored by ``near_components`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import TEXT_HASH, discard_tables, documents, drop_rows, join_known, limited_broadcast, materialise, slices, text_bytes
from meridian.llm.components import connected_components
from meridian.llm.shingles import mix, shingle_sets, signature

#: Shingle counters: 2^22 to 2^25, one for some 160 bytes of text. What is sent to tasks is one byte for each.
SKETCH_BITS, MOST_SKETCH_BITS = 22, 25
BYTES_OF_COUNTER = 160
#: A token of more documents than this gives hubs and blocks instead of pairs.
MANY = 32
HUBS = 4
#: Tokens that the sketch puts above this are gathered by several tasks.
HOT = 200_000
BLOCK = 512
#: Seeds of the orders after the first.
ORDERS = (11, 12)
#: Prefix entries that a task packs at a time, and signatures that it remembers so as not to send copies twice.
BATCH = 250_000
SEEN = 100_000
#: Sets that may share 64 bits of their signature; some 70 are expected among 5 * 10**10.
MOST_CLASHES = 100_000

THIN = f"doc_id long, {TEXT_HASH} long, n long, sig long, sig2 long, slot int, part int, counts binary"


def prefix_length(n: np.ndarray | int):
    """Tokens of a set of ``n`` that any set with a Jaccard similarity of 0.75 or more must meet."""
    return n - (3 * n + 3) // 4 + 1


def linked(common, a, b):
    """Whether 100 * intersection >= 75 * union."""
    return 7 * common >= 3 * (a + b)


def name(s: np.ndarray, clashes: frozenset[int]) -> int:
    """A set's name: the first 64 bits of its signature or, where two sets share these, the other 64."""
    one, two = signature(s)
    return two if one in clashes else one


def sketch_bits(size: int) -> int:
    """Bits of a counter's number for ``size`` bytes of text; with fewer, frequent and rare shingles share counters and the first order says little."""
    return min(max(SKETCH_BITS, (size // BYTES_OF_COUNTER).bit_length()), MOST_SKETCH_BITS)


def _summarise(bits: int):
    """Per document its set's size and signature; per task its counts of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _summaries(batches, bits)

    return run


def _summaries(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    import zstandard
    from pyspark import TaskContext

    counts = np.zeros(1 << bits, "u4")
    for batch in slices(batches):
        sets = shingle_sets(batch.column(1).to_pylist())
        sigs = [signature(s) for s in sets]
        n = len(sets)
        slot, times = np.unique(_slot(np.concatenate(sets), bits), return_counts=True)
        counts[slot] += times.astype("u4")
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0).cast(pa.int64()), TEXT_HASH: batch.column(2), "n": pa.array([len(s) for s in sets], pa.int64()), "sig": pa.array([s[0] for s in sigs], pa.int64()),
            "sig2": pa.array([s[1] for s in sigs], pa.int64()), "slot": pa.nulls(n, pa.int32()), "part": pa.nulls(n, pa.int32()), "counts": pa.nulls(n, pa.binary()),
        })
    part = TaskContext.get().partitionId()
    pack = zstandard.ZstdCompressor(level=1)
    parts = counts.astype("<u4").reshape(64, -1)
    slots = [k for k in range(64) if parts[k].any()]
    m = len(slots)
    yield pa.RecordBatch.from_pydict({
        "doc_id": pa.nulls(m, pa.int64()), TEXT_HASH: pa.nulls(m, pa.int64()), "n": pa.nulls(m, pa.int64()), "sig": pa.nulls(m, pa.int64()), "sig2": pa.nulls(m, pa.int64()),
        "slot": pa.array(slots, pa.int32()), "part": pa.array([part] * m, pa.int32()), "counts": pa.array([pack.compress(parts[k].tobytes()) for k in slots], pa.binary()),
    })


def _sum_counts(as_levels: bool):
    """The sums of each slot's counts; holds one array per slot, however many tasks sent some."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        total: dict[int, np.ndarray] = {}
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for slot, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(unpack.decompress(raw), "<u4").astype("u8")
                total[slot] = np.minimum(total.get(slot, 0) + own, 0xFFFFFFFF)  # beyond that a token is as frequent as it gets
        out = [_levels(x).tobytes() if as_levels else pack.compress(x.astype("<u4").tobytes()) for x in total.values()]
        yield pa.RecordBatch.from_pydict({"slot": pa.array(list(total), pa.int32()), "counts": pa.array(out, pa.binary())})

    return add


def _shingle_levels(counts: DataFrame, tasks: int, bits: int) -> np.ndarray:
    """The level of every counter; a slot's counts are summed in groups of tasks first, then over the groups."""
    kinds = "slot int, counts binary"
    partly = counts.repartition(tasks, "slot", F.pmod("part", F.lit(64))).select("slot", "counts").mapInArrow(_sum_counts(False), kinds)
    partly = materialise(partly, "counts")
    summed = partly.repartition(min(tasks, 64), "slot").mapInArrow(_sum_counts(True), kinds)
    levels = np.zeros((64, (1 << bits) // 64), "u1")
    for row in summed.collect():  # 64 rows of fixed size
        levels[row["slot"]] = np.frombuffer(row["counts"], "u1")
    discard_tables(partly)
    return levels.reshape(-1)


def _levels(counts: np.ndarray) -> np.ndarray:
    """Twice the logarithm of each count: a byte for each counter."""
    return (2 * np.log2(np.maximum(counts, 1))).astype("u1")


def _slot(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens >> np.uint64(64 - bits)).astype("i8")


def _level(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return levels[_slot(tokens, len(levels).bit_length() - 1)]


def _rank(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The places of ``tokens`` in the first order: by the logarithm of their count, then scattered."""
    return np.argsort((_level(tokens, levels).astype("u8") << np.uint64(58)) | (mix(tokens, 10) >> np.uint64(6)), kind="stable")


def _index(levels: np.ndarray, buckets: int, clashes: frozenset[int]):
    """Prefix entries of a task's documents, packed by bucket of their token."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate([h[0] for h in held])
            lengths = np.array([len(h[0]) for h in held])
            doc = np.repeat(np.arange(len(held)), lengths)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            sig = np.array([h[1] for h in held], "i8")
            n = np.array([h[2] for h in held], "i4")
            bucket = ((mix(tokens, 20) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype("i8")
            level = _level(tokens, levels)
            hot = np.flatnonzero(level > _levels(np.array(HOT)))
            salts = np.ceil(2.0 ** ((level[hot] + 1) / 2) / HOT).astype("u8")
            salt = mix(sig.view("u8")[doc[hot]], 21) % salts
            bucket[hot] = buckets + ((mix(tokens[hot] + salt, 22) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype("i8")
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            ids, blobs = [], []
            pack = zstandard.ZstdCompressor(level=1)
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                own = order[low:high]
                docs, at = np.unique(doc[own], return_inverse=True)
                head = np.array([len(own), len(docs)], "<i4")
                parts = (head, tokens[own], sig[docs], n[docs], np.diff(at, prepend=0).astype("<i4"), place[own].astype("<i4"))
                ids.append(int(bucket[own[0]]))
                blobs.append(pack.compress(b"".join(p.tobytes() for p in parts)))
            held.clear()
            return pa.RecordBatch.from_pydict({"bucket": pa.array(ids, pa.int32()), "entries": pa.array(blobs, pa.binary())})

        for batch in slices(batches):
            for s in shingle_sets(batch.column(0).to_pylist()):
                if not len(s):
                    continue
                sig = name(s, clashes)
                if sig in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(sig)
                first = s[_rank(s, levels)[: prefix_length(len(s))]]
                held.append((first, sig, len(s)))
                size += len(first)
                if size >= BATCH:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return emit


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    entries, docs = np.frombuffer(raw, "<i4", 2)
    at, out = 8, []
    for kind, count in (("<u8", entries), ("<i8", docs), ("<i4", docs), ("<i4", entries), ("<i4", entries)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    tokens, sig, n, step, place = out
    doc = np.cumsum(step)
    return tokens, sig[doc], n[doc].astype("i8"), place.astype("i8")


def _possible(n1, p1, n2, p2):
    """The size and the position bound for a pair that meets at places p1 and p2."""
    return (4 * np.minimum(n1, n2) >= 3 * np.maximum(n1, n2)) & (7 * np.minimum(n1 - p1, n2 - p2) >= 3 * (n1 + n2))


def _meet(buckets: int):
    """Candidate pairs of a bucket (token null), and the documents of its frequent tokens (b null)."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b) for b in rows["entries"]]
        tokens, sig, n, place = (np.concatenate([p[k] for p in parts]) for k in range(4))
        order = np.lexsort((sig, tokens))
        tokens, sig, n, place = tokens[order], sig[order], n[order], place[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (sig[1:] != sig[:-1])
        tokens, sig, n, place = tokens[new], sig[new], n[new], place[new]
        _, group, size = np.unique(tokens, return_inverse=True, return_counts=True)
        hot = int(rows["bucket"].iloc[0]) >= buckets
        keep = np.ones(len(tokens), bool) if hot else size[group] > 1
        tokens, sig, n, place, group = tokens[keep], sig[keep], n[keep], place[keep], group[keep]
        size = size[group]
        pairs, star = [], []
        few = size <= MANY
        lead = np.ones(len(group), bool)
        lead[1:] = group[1:] != group[:-1]
        for d in range(1, min(MANY, int(size[few].max(initial=1)))):
            k = np.flatnonzero((group[d:] == group[:-d]) & few[d:])
            k = k[_possible(n[k], place[k], n[k + d], place[k + d])]
            pairs.append(np.stack([sig[k], sig[k + d]]))
            star.append(lead[k])
        many = np.flatnonzero(~few)
        scatter = mix(sig[many].view("u8"), 30)
        order = many[np.lexsort((scatter, group[many]))]
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        length = np.diff(np.append(first, len(order)))
        for h in range(HUBS):
            hub = np.repeat(order[first + h] if len(first) else first, length)
            ok = (sig[hub] != sig[order]) & _possible(n[hub], place[hub], n[order], place[order])
            pairs.append(np.stack([sig[hub[ok]], sig[order[ok]]]))
            star.append(np.ones(int(ok.sum()), bool))
        a, b = np.concatenate(pairs, axis=1)
        a, b, star = np.minimum(a, b), np.maximum(a, b), np.concatenate(star)
        order = np.lexsort((~star, b, a))
        a, b, star = a[order], b[order], star[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        members = np.arange(len(tokens)) if hot else many
        return pd.concat([
            pd.DataFrame({"token": pd.array([None] * int(new.sum()), "Int64"), "n": np.zeros(int(new.sum()), "i8"), "a": a[new], "b": pd.array(b[new], "Int64"), "star": star[new]}),
            pd.DataFrame({"token": pd.array(tokens[members].view("i8"), "Int64"), "n": n[members], "a": sig[members], "b": pd.array([None] * len(members), "Int64"), "star": np.zeros(len(members), bool)}),
        ])

    return gather


def _prefix(s: np.ndarray, seed: int) -> np.ndarray:
    """The prefix of a set under the order of ``seed``: the first 32 bits of its scattered tokens, ascending.

    Equal tokens have equal bits, so two prefixes that meet always show it.
    """
    k = int(prefix_length(len(s)))
    first = np.partition(mix(s, seed), k - 1)[:k]
    return np.sort(first >> np.uint64(32)).astype("<u4")


def _sets(clashes: frozenset[int]):
    """Each text's set, and its prefix under every further order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)]
            out = {"sig": pa.array([name(s, clashes) for s in sets], pa.int64()), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())}
            for seed in ORDERS:
                out[f"order{seed}"] = pa.array([_prefix(s, seed).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    return rows


SETS = "sig long, shingles binary, " + ", ".join(f"order{seed} binary" for seed in ORDERS)


def _common(s: np.ndarray, t: np.ndarray) -> int:
    both = np.concatenate([s, t])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _meet_in_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose prefixes (from the fourth column on, two for each order) meet under every order."""
    for batch in slices(batches):
        keep = np.ones(batch.num_rows, bool)
        for k in range(3, batch.num_columns, 2):
            for i in np.flatnonzero(keep).tolist():
                keep[i] = _common(*(np.frombuffer(batch.column(c)[i].as_buffer(), "<u4") for c in (k, k + 1))) > 0
        yield pa.RecordBatch.from_arrays(batch.columns[:3], batch.schema.names[:3]).filter(pa.array(keep))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of similar sets."""
    for batch in slices(batches):
        s, t = ([np.frombuffer(x, "<u8") for x in batch.column(c).to_pylist()] for c in (2, 3))
        keep = [bool(linked(_common(x, y), len(x), len(y))) for x, y in zip(s, t, strict=True)]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each of ``left`` shares with each of ``right``."""
    flat = [np.concatenate(x) for x in (left, right)]
    shared = np.intersect1d(*map(np.unique, flat), assume_unique=True)
    row = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right)]
    total = np.zeros((len(left), len(right)), "f4")
    for k in range(2):
        at = np.searchsorted(shared, flat[k])
        met = shared[np.minimum(at, len(shared) - 1)] == flat[k] if len(shared) else np.zeros(len(at), bool)
        flat[k], row[k] = at[met], row[k][met]
    for low in range(0, len(shared), 4096):
        dense = []
        for k, side in enumerate((left, right)):
            own = (flat[k] >= low) & (flat[k] < low + 4096)
            x = np.zeros((len(side), min(4096, len(shared) - low)), "f4")
            x[row[k][own], flat[k][own] - low] = 1
            dense.append(x)
        total += dense[0] @ dense[1].T
    return total


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of documents, those within one component left out."""
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    if not len(right):
        right = left
    comp, sig, sets = ([x.to_numpy() for x in (left[c], right[c])] for c in ("comp", "sig", "shingles"))
    sets = [[np.frombuffer(x, "<u8") for x in side] for side in sets]
    n = [np.array([len(s) for s in side]) for side in sets]
    wide, narrow = np.maximum(n[0][:, None], n[1]), np.minimum(n[0][:, None], n[1])
    maybe = (comp[0][:, None] != comp[1]) & (4 * narrow >= 3 * wide)
    for seed in ORDERS:
        i, j = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        if not len(i):
            break
        met = _overlaps([_prefix(sets[0][x], seed) for x in i], [_prefix(sets[1][x], seed) for x in j]) > 0
        maybe[np.ix_(i, j)] &= met
    i, j = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
    out: list[tuple[int, int]] = []
    if len(i):
        common = _overlaps([sets[0][x] for x in i], [sets[1][x] for x in j]).astype("i8")
        similar = maybe[np.ix_(i, j)] & linked(common, n[0][i][:, None], n[1][j])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for p, q in zip(*np.nonzero(similar), strict=True):
            x, y = root(int(comp[0][i[p]])), root(int(comp[1][j[q]]))
            if x != y:
                parent[x] = y
                out.append((int(sig[0][i[p]]), int(sig[1][j[q]])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _written_sets(docs: DataFrame, thin: DataFrame, wanted: DataFrame, clashes: frozenset[int]) -> DataFrame:
    """The sets in ``wanted`` (sig) with their prefixes, from one document each; where doc_ids repeat maybe some more, or twice."""
    ids = materialise(thin.groupBy("sig").agg(F.min("doc_id").alias("doc_id")).join(wanted, "sig", "left_semi").select("doc_id").distinct(), "wanted")
    texts = docs.join(limited_broadcast(ids, 1_000_000), "doc_id", "left_semi").select(text_bytes().alias("text"))
    sets = materialise(texts.mapInArrow(_sets(clashes), SETS), "sets")
    discard_tables(ids)
    return sets


#: Pairs of one hub that are compared in one place.
PAIRS_OF_HUB = 1000


def _beside(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` (hub, sig, salt) with these columns of both ends; a hub's are copied to each of its salts."""
    pairs = limited_broadcast(pairs, 400_000)  # three numbers each; beyond that the sets are shuffled to them
    copies = limited_broadcast(materialise(pairs.select("hub", "salt").distinct(), "hubs"), 400_000)
    hubs = sets.join(copies, sets["sig"] == copies["hub"]).select("hub", "salt", *(F.col(c).alias(f"{c}_hub") for c in columns))
    ends = [x for c in columns for x in (c, f"{c}_hub")]
    return pairs.join(sets.select("sig", *columns), "sig").join(hubs, ["hub", "salt"]).select("hub", "sig", "salt", *ends)


def directed(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) as (hub, sig, salt), the end of more pairs first.

    The other end of a pair has at most the square root of twice all pairs.
    """
    ends = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig")))
    degree = materialise(ends.groupBy("sig").agg(F.count("*").alias("n")), "degrees")
    one, two = (degree.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}")) for x in ("a", "b"))
    turned = F.struct("na", "a") >= F.struct("nb", "b")
    known = pairs.join(one, "a").join(two, "b").select(
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(turned, F.col("b")).otherwise(F.col("a")).alias("sig"), F.greatest("na", "nb").alias("n")
    )
    salt = F.pmod(F.xxhash64("sig"), F.floor((F.col("n") - 1) / PAIRS_OF_HUB) + 1)
    return materialise(known.select("hub", "sig", salt.alias("salt")), "directed")


def meeting(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (hub, sig, salt) that meet under all further orders; no set is read."""
    rows = _beside(pairs, sets, *(f"order{seed}" for seed in ORDERS))
    return materialise(rows.mapInArrow(_meet_in_all, "hub long, sig long, salt long").distinct(), "meeting")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) among ``pairs`` (hub, sig, salt)."""
    rows = _beside(pairs, sets, "shingles").select("hub", "sig", "shingles", "shingles_hub")
    return materialise(rows.mapInArrow(_verify, "a long, b long").distinct(), "links")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose ends are not in one component of ``roots`` (node, root)."""
    one, two = (roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b"))
    rows = pairs.join(one, "a", "left").join(two, "b", "left")
    return rows.where(~F.coalesce(F.col("root_a") == F.col("root_b"), F.lit(False))).select("a", "b")


def _blocks(docs: DataFrame, thin: DataFrame, members: DataFrame, roots: DataFrame, clashes: frozenset[int]) -> DataFrame | None:
    """Links between documents of frequent tokens that are in different components."""
    members = members.join(roots, members["sig"] == roots["node"], "left").select("token", "sig", "n", F.coalesce("root", "sig").alias("comp"))
    members = materialise(members, "members")
    mixed = members.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")).where("low <> high")
    mixed = materialise(mixed.select("token", "size"), "mixed")
    members = materialise(members.join(limited_broadcast(mixed, 500_000), "token"), "members")
    if members.isEmpty():
        return None
    # each document goes with the largest of its tokens; tokens then only say which of those clusters meet
    own = members.groupBy("sig", "comp", "n").agg(F.max(F.struct("size", "token"))["token"].alias("cluster"))
    own = materialise(own.withColumn("class", F.floor(F.log("n") / F.log(F.lit(4 / 3)))), "clusters")
    met = members.select("token", "sig").join(own.select("sig", "cluster"), "sig").select("token", "cluster").distinct()
    other = met.select("token", F.col("cluster").alias("cluster2"))
    met = met.join(other, "token").where("cluster <= cluster2").select("cluster", "cluster2").distinct()
    # a unit is a block, of sets of like sizes, of one large component or of small components
    sizes = materialise(own.groupBy("cluster", "class", "comp").agg(F.count("*").alias("m")).withColumn("one", F.when(F.col("m") >= 64, F.col("comp"))), "sizes")
    total = materialise(sizes.groupBy("cluster", "class", "one").agg(F.sum("m").alias("total")), "totals")
    large = sizes.where("one is not null").select("cluster", "class", "comp", "one")
    own = own.join(limited_broadcast(large, 200_000), ["cluster", "class", "comp"], "left")
    none = F.lit("none")
    own = own.withColumn("group", F.concat_ws(".", "cluster", "class", F.coalesce(F.col("one").cast("string"), none)))
    total = total.select(F.concat_ws(".", "cluster", "class", F.coalesce(F.col("one").cast("string"), none)).alias("group"), "total")
    own = own.join(limited_broadcast(total, 200_000), "group")
    key = F.when(F.col("one").isNotNull(), F.xxhash64("sig", F.lit(1))).otherwise(F.xxhash64("comp", F.lit(1)))
    own = own.withColumn("block", F.pmod(key, F.ceil(F.col("total") / BLOCK)))
    own = materialise(own.withColumn("unit", F.xxhash64("group", "block")).select("unit", "cluster", "class", "one", "sig", "comp"), "units")
    units = own.select("unit", "cluster", "class", "one").distinct()
    second = units.select(*(F.col(c).alias(f"{c}2") for c in units.columns))
    pairs = met.join(units, "cluster").join(second, "cluster2").where("abs(class - class2) <= 1 and (cluster < cluster2 or unit <= unit2) and not coalesce(one = one2, false)")
    pairs = materialise(pairs.select(F.xxhash64("unit", "unit2").alias("task"), "unit", "unit2"), "tasks")
    sides = pairs.select("task", "unit", F.lit(0).alias("side")).unionByName(pairs.where("unit <> unit2").select("task", F.col("unit2").alias("unit"), F.lit(1).alias("side")))
    sets = _written_sets(docs, thin, own.select("sig").distinct(), clashes).select("sig", "shingles")
    rows = sides.join(own.select("unit", "sig", "comp"), "unit").join(sets, "sig")
    return rows.select("task", "side", "sig", "comp", "shingles").groupBy("task").applyInPandas(_compare, "a long, b long")


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(thin, roots): each row's doc_id, n and sig, and the component of every linked set.

    ``docs`` needs doc_id and text.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", "text")
    bits = sketch_bits(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    both = docs.select("doc_id", text_bytes().alias("text"), F.xxhash64("text").alias(TEXT_HASH)).mapInArrow(_summarise(bits), THIN)
    both = materialise(both, "sets-summary")
    thin = both.where("slot is null").select("doc_id", TEXT_HASH, "n", "sig", "sig2")
    levels = _shingle_levels(both.where("slot is not null").select("slot", "part", "counts"), tasks, bits)

    # 64 bits name a set; the few that two sets share give way to the other 64
    named = thin.where("n > 0 and doc_id is not null")
    clash = named.groupBy("sig").agg(F.min("sig2").alias("low"), F.max("sig2").alias("high")).where("low <> high")
    clash = [r["sig"] for r in clash.select("sig").limit(MOST_CLASHES + 1).collect()]
    if len(clash) > MOST_CLASHES:
        raise ValueError("too many shingle sets share 64 bits of their signatures")
    clashes = frozenset(clash)
    thin = thin.select("doc_id", TEXT_HASH, "n", F.when(F.col("sig").isin(clash), F.col("sig2")).otherwise(F.col("sig")).alias("sig")) if clash else thin.drop("sig2")

    entries = named.agg(F.sum("n")).first()[0] or 0
    buckets = max(tasks, entries // 8_000_000 + 1)
    index = docs.where("doc_id is not null").select(text_bytes().alias("text")).mapInArrow(_index(levels, buckets, clashes), "bucket int, entries binary")
    found = materialise(index.groupBy("bucket").applyInPandas(_meet(buckets), "token long, n long, a long, b long, star boolean"), "met")

    pairs = found.where("b is not null").groupBy("a", "b").agg(F.max("star").alias("star"))
    pairs = materialise(pairs, "candidates")
    sets = _written_sets(docs, thin, pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct(), clashes)
    # the pairs with one document of each token first: most others then lie within a component
    links = similar(meeting(directed(pairs.where("star")), sets), sets)
    roots = materialise(connected_components(links), "roots")
    rest = materialise(_between(pairs.where("not star"), roots), "rest")
    discard_tables(pairs)
    if not rest.isEmpty():
        links = links.unionByName(similar(meeting(directed(rest), sets), sets))
        roots = materialise(connected_components(links), "roots")
    discard_tables(sets, rest)
    members = found.where("token is not null").select("token", "n", F.col("a").alias("sig"))
    if not members.isEmpty():
        more = _blocks(docs, thin, members, roots, clashes)
        if more is not None:
            more = materialise(more, "links")
            if not more.isEmpty():
                edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
                roots = materialise(connected_components(edges), "roots")
    return thin, roots


def _components(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, sig and, where the row is linked, its component's smallest doc_id (least) and that row's set (first)."""
    thin, roots = near_links(docs)
    sets = thin.where("n > 0 and doc_id is not null").groupBy("sig").agg(F.min("doc_id").alias("low"), F.count("*").alias("rows"))
    sets = materialise(sets.join(roots, sets["sig"] == roots["node"], "left").select("sig", "low", "rows", F.coalesce("root", "sig").alias("comp")), "named-sets")
    comps = sets.groupBy("comp").agg(F.min("low").alias("least"), F.min_by("sig", F.struct("low", "sig")).alias("first"), F.sum("rows").alias("members"), F.count("*").alias("sets"))
    comps = materialise(comps.where("members > 1").drop("members"), "components")
    linked = materialise(join_known(sets, comps, "comp", "sets").where("least is not null").select("sig", "least", "first", "rows"), "linked-sets")
    return join_known(thin.withColumnRenamed("n", "n_shingles"), linked, "sig", "rows")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    own = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(own, F.col("doc_id")).otherwise(F.coalesce("least", "doc_id"))
    return _components(docs).select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id, all its columns kept.

    Rows with a null doc_id or without words all stay. Where a doc_id repeats with several
    texts each row is judged by its own text; rows that share doc_id and text stay or go together.
    """
    found = _components(docs).where("least is not null and doc_id is not null and n_shingles > 0")
    return drop_rows(docs, found.where("doc_id <> least or sig <> first"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: near-duplicate components of all documents."""
    return near_components(documents(spark, sf_dir, "doc_id", "text"))


SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w
), e AS MATERIALIZED (
  SELECT doc_id, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS MATERIALIZED (
  SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * common >= 75 * (len(a.s) + len(b.s) - common)
), both_ways AS MATERIALIZED (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), reach AS (
  SELECT x AS doc_id, x AS other FROM both_ways
  UNION
  SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(least.component_id, s.doc_id) AS component_id FROM s LEFT JOIN least USING (doc_id)
"""
