"""The similarity join against comparing all pairs."""

import random
import re

import numpy as np

from meridian.llm import near_join
from meridian.llm.components import connected_components
from meridian.llm.shingles import shingle_sets, words


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def plain_components(texts):
    sets = [plain_set(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [len(s) for s in sets], [root(k) for k in range(len(texts))]


def changed(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return w


def run(spark, texts):
    rows = near_join.near_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)).orderBy("doc_id").collect()
    return [r.n_shingles for r in rows], [r.component_id for r in rows]


def corpus(rng):
    """Copies, near copies of every degree around the threshold, chains, shared passages and short texts."""
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(40, 160))]
        texts += [" ".join(changed(rng, base, rng.randrange(0, 6))) for _ in range(rng.randrange(1, 6))] + [" ".join(base).upper()] * rng.randrange(0, 3)
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for _ in range(8):
        chain = changed(rng, chain, 2)
        texts.append("\n".join(chain))
    texts += [" ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randrange(3, 60))]) for _ in range(30)]
    texts += ["a b c", "A  b\tc", "a b", "", None, " ", "a b c d e", "x"]
    return texts


def test_against_all_pairs(spark):
    texts = corpus(random.Random(1))
    assert run(spark, texts) == plain_components(texts)


def test_frequent_tokens_go_through_blocks(spark, monkeypatch):
    """A large group of near copies, most of which are not similar to each other."""
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(changed(rng, base, rng.randrange(0, 7))) for _ in range(150)] + [" ".join(f"u{k}x{j}" for j in range(50)) for k in range(20)]
    monkeypatch.setattr(near_join, "BLOCK", 16)
    sizes, roots = run(spark, texts)
    assert (sizes, roots) == plain_components(texts)
    assert len(set(roots[:150])) > 5


def test_hot_tokens_are_salted(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(80)]
    texts = [" ".join(changed(rng, base, rng.randrange(0, 4))) for _ in range(80)]
    monkeypatch.setattr(near_join, "HOT", 10)
    assert run(spark, texts) == plain_components(texts)


def test_shingle_hashes_follow_words():
    texts = ["a b c d e f g", "A B\tc  d\ne f g", "a b", "", "é ß e"]
    sets = shingle_sets([t.encode() for t in texts])
    assert (sets[0] == sets[1]).all() and [len(s) for s in sets] == [3, 3, 1, 0, 1]
    many = [" ".join(str(x) for x in range(k, k + 9)) for k in range(2000)]
    assert len({s for x in shingle_sets([t.encode() for t in many]) for s in x.tolist()}) == len({s for t in many for s in plain_set(t)})


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    from meridian.llm import shingles

    texts = [("word%d " % k * 50).encode() for k in range(20)] + [b"x" * 500 + b" y", b""]
    whole, counts = words(texts)
    monkeypatch.setattr(shingles, "CHUNK", 100)
    again, counts2 = words(texts)
    assert (whole == again).all() and (counts == counts2).all()


def test_prefixes_must_meet():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = rng.choice(200, n, replace=False)
        b = np.unique(np.concatenate([rng.choice(a, int(np.ceil(n * 0.9)), replace=False), rng.choice(200, int(rng.integers(0, 4)))]))
        common = len(np.intersect1d(a, b))
        if near_join.linked(common, len(a), len(b)):
            order = rng.permutation(200)
            first = [set(sorted(x.tolist(), key=lambda v: order[v])[: near_join.prefix_length(len(x))]) for x in (a, b)]
            assert first[0] & first[1]


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}


def test_orders_filter_before_sets_are_compared(spark):
    """Each filter only removes pairs, some are removed, and no similar pair is."""
    rng = random.Random(5)
    shared = [f"p{k}" for k in range(12)]
    texts = []
    for k in range(120):  # a little in common, few similar
        w = [f"u{k}x{j}" for j in range(60)]
        texts.append(" ".join(shared[: rng.randrange(5, 8)] + w) if k % 3 else " ".join(changed(rng, [f"s{k % 5}x{j}" for j in range(60)], rng.randrange(0, 4))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = shingle_sets([t.encode() for t in texts])
    names = [near_join.name(s, frozenset()) for s in sets]
    every = [(names[i], names[j]) for i in range(len(texts)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) and names[i] != names[j]]
    pairs = spark.createDataFrame([(min(p), max(p)) for p in every], "a long, b long").distinct()
    thin = spark.createDataFrame(list(zip(range(len(texts)), names, strict=True)), "doc_id long, sig long")
    written = near_join._written_sets(docs, thin, thin.select("sig").distinct(), frozenset())
    met = near_join.meeting(near_join.directed(pairs), written)
    links = {frozenset(r) for r in near_join.similar(met, written).collect()}
    of = dict(zip(names, sets, strict=True))
    expected = {frozenset(p) for p in every if near_join.linked(len(np.intersect1d(of[p[0]], of[p[1]])), len(of[p[0]]), len(of[p[1]]))}
    assert links == expected and len(links) <= met.count() < pairs.count()


def test_hubs_of_many_pairs_are_salted(spark, monkeypatch):
    monkeypatch.setattr(near_join, "PAIRS_OF_HUB", 3)
    texts = corpus(random.Random(7))
    assert run(spark, texts) == plain_components(texts)


def test_names_that_clash_give_way(spark, monkeypatch):
    """With signatures cut to a few values many sets share their first half."""
    real = near_join.signature
    monkeypatch.setattr(near_join, "signature", lambda s: (real(s)[0] % 4, real(s)[1]))
    one = np.arange(5, dtype="u8")
    first = near_join.signature(one)
    assert near_join.name(one, frozenset()) == first[0] and near_join.name(one, frozenset({first[0]})) == first[1]


def test_one_row_of_a_repeated_id(spark):
    """Rows of one doc_id are judged by their own texts."""
    near = [f"n{k}" for k in range(60)]
    rows = [(3, " ".join(near)), (7, " ".join(near[:-1] + ["else"])), (7, "quite another text of some words"), (8, " ".join(near))]
    kept = near_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == sorted([rows[0], rows[2]])


def test_sketch_grows_with_the_text():
    assert [near_join.sketch_bits(n) for n in (0, 5 * 10**8, 2 * 10**9, 10**12)] == [22, 22, 24, 25]


def test_tables_go_when_nothing_reads_them(spark):
    import glob

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/meridian"
    before = set(glob.glob(f"{folder}/*"))
    run(spark, corpus(random.Random(5)))
    left = {p.rpartition("/")[2].rpartition("-")[0] for p in set(glob.glob(f"{folder}/*")) - before}
    assert not left & {"counts", "candidates", "rest", "wanted"}
