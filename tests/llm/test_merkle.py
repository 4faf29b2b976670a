"""The Merkle manifest against one built row by row, on awkward ids and groups."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from meridian.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, place long, grp string, leaf string, found string, size int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields):
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(leaves):
    """The root, and each leaf's path: (siblings left, siblings right) level by level."""
    nodes, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place - place % 8
            paths[k].append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 8])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [p // 8 for p in at]
    return (nodes[0] if nodes else None), paths


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in order}
    subs = {g: tree([leaf(r) for r in own[g]]) for g in order}
    root, tops = tree([subs[g][0] for g in order])
    out = []
    for g, top in zip(order, tops, strict=True):
        for r, path in zip(own[g], subs[g][1], strict=True):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            x = leaf((*r[:4], lowered(r[4]))) if bad else leaf(r)
            for left, right in path + top:
                x = h(left, x, right)
            out.append((r[0], leaf(r), subs[g][0], root, h(*(a + b for a, b in path + top)), x, x == root))
    return sorted(out, key=repr)


def run(spark, rows, tmp_path, parts=5):
    spark.createDataFrame([(*r, 1, "g", "l", "f", 2) for r in rows], SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    found = merkle.query(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=repr)


def rows_of(n, ids, langs, seed=1):
    rng = random.Random(seed)
    return [(ids(rng, k), rng.choice(["a", "b", None]), langs(rng, k), rng.choice([None, 5, 77]), rng.choice([None, "", "Some Text", "lower é 日本", f"Row {k}"])) for k in range(n)]


@pytest.mark.parametrize("case", ["dense", "sparse", "negative", "many groups"])
def test_equal_to_a_plain_tree(spark, tmp_path, case):
    shuffled = random.Random(3).sample(range(700), 700)
    rows = {
        "dense": lambda: rows_of(700, lambda r, k: shuffled[k], lambda r, k: "en" if k % 3 else r.choice(["de", None, "", "é"])),
        "sparse": lambda: rows_of(90, lambda r, k: r.randrange(2**62) * r.choice([1, -1]), lambda r, k: r.choice(["en", "fr"])),
        "negative": lambda: rows_of(80, lambda r, k: k * 61 - 2400, lambda r, k: "x"),
        "many groups": lambda: rows_of(75, lambda r, k: k, lambda r, k: f"g{k}"),
    }[case]()
    assert run(spark, rows, tmp_path) == plain(rows)


def test_repeated_and_null_ids(spark, tmp_path):
    """A third of all rows with one id, others without one, and rows that are wholly equal."""
    rows = rows_of(150, lambda r, k: 64 if k % 3 == 0 else r.choice([None, k // 2, 65, 63, 127, 128]), lambda r, k: r.choice(["en", None]))
    rows += [(64, "a", "en", 5, "Same")] * 9 + [(None, None, None, None, None)] * 4
    assert run(spark, rows, tmp_path) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 3, "One")], [(1, "s", None, 3, None), (1, "s", "en", 3, "A"), (3, "s", "en", 3, "b")]])
def test_few_rows(spark, tmp_path, rows):
    assert run(spark, rows, tmp_path, 1) == plain(rows)


def test_long_text_and_block_borders(spark, tmp_path):
    rows = [(k, "s", "en", 1, "Long Text " * (30_000 if k == 5 else 1)) for k in range(513)] + [(k, "s", "de", 1, "T") for k in range(64)] + [(k, "s", "fr", 1, "T") for k in range(65)]
    assert run(spark, rows, tmp_path) == plain(rows)


def test_rank_counts_rows_of_smaller_ids(spark):
    """Ranks from compressed bitmaps of several tasks are places in a sorted list."""
    ids = random.Random(8).sample(range(0, 20_000, 3), 3000)
    rows = spark.createDataFrame([(i, "g", "leaf") for i in ids], "id long, grp string, leaf string").repartition(7)
    found = merkle.placed(merkle.leaf_table(rows)).select("id", "place", "size").collect()
    assert {r["id"]: r["place"] for r in found} == {i: k for k, i in enumerate(sorted(ids))}
    assert {r["size"] for r in found} == {3000}
    chunks = merkle.directory(merkle.bitmap_words(merkle.leaf_table(rows)))
    assert chunks.where(F.size("words") != F.bit_count("mask")).isEmpty() and chunks.agg(F.sum("total")).first()[0] == 3000


def test_other_fields_and_groups(spark):
    docs = spark.createDataFrame([(k, f"s{k % 2}", k * 2) for k in range(20)], "k long, source string, v long")
    found = merkle.manifest(docs, ["k", "v"], "k", "source").collect()
    roots = [tree([leaf((k, k * 2)) for k in range(g, 20, 2)])[0] for g in (0, 1)]
    assert {(r["grp"], r["subroot"], r["root"], r["folded_root"]) for r in found} == {(f"s{g}", roots[g], h(*roots), h(*roots)) for g in (0, 1)}
