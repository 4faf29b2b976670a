"""Language identification: the automaton and the parse against plain strings, held-out accuracy, awkward rows."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.llm import language_id as lang

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, mark string, n int, score double, lang_pred string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", "m", 1, 0.5, "p") for i, t, g in rows], DOCS)


def accepts(follow, codes):
    state = 0
    for c in codes:
        if c not in follow[state]:
            return False
        state = follow[state][c]
    return True


def greedy(text, sample):
    """Phrases of ``text``: each the longest that ``sample`` has, or one character."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


@pytest.mark.parametrize("seed", range(4))
def test_automaton_spells_just_the_substrings(seed):
    rng = random.Random(seed)
    text = [rng.randrange(1, 4) for _ in range(60)]
    follow = lang.suffix_automaton(text)
    inside = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(60, i + 6) + 1)}
    for _ in range(400):
        word = tuple(rng.randrange(1, 5) for _ in range(rng.randrange(1, 6)))
        assert accepts(follow, word) == (word in inside)
    assert accepts(follow, text) and len(follow) < 2 * len(text)


@pytest.mark.parametrize("width", [6, 300])
def test_displaced_transitions_are_those_of_the_automaton(width):
    rng = random.Random(width)
    follow = lang.suffix_automaton([rng.randrange(width) for _ in range(900)])
    base, owner, target = lang.displaced(follow, width)
    for s, own in enumerate(follow):
        for c in range(width):
            p = base[s] + c
            assert (int(target[p]) if owner[p] == s else None) == own.get(c)


def test_phrases_equal_a_plain_parse(spark):
    """On pieces, with characters that a language, or all, lack."""
    rng = random.Random(11)
    samples = {"aa": "".join(rng.choice("abcd ") for _ in range(600)), "bb": "".join(rng.choice("cdefé ") for _ in range(500))}
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, samples["aa" if k % 2 else "bb"], "aa" if k % 2 else "bb") for k, i in enumerate(ids)]
    known = lang.learn(frame(spark, rows), sample_chars=16 * 1000)
    assert known.names == ("aa", "bb")
    spelled = {k: "".join(chr(c) if c else " " for c in lang.normalised([t])[0]) + " " for k, t in samples.items()}
    for size in (1, 3, 40, 255, 256, 257, 700):
        text = "".join(rng.choice("abcdefé zß漢") for _ in range(size))
        codes, sizes, _ = lang.normalised([text, "", text])
        found = known.phrases(codes, sizes)
        plain = "".join(chr(c) if c else " " for c in codes[: sizes[0]])
        wanted = [sum(greedy(plain[i : i + lang.PIECE], spelled[k]) for i in range(0, len(plain), lang.PIECE)) for k in known.names]
        assert found.tolist() == [wanted, [0, 0], wanted]


def test_normalised():
    codes, sizes, letters = lang.normalised(["  Ab--1c!", "", "12 . 3", "É́x", "नमस्ते"])
    texts = ["".join(chr(c) if c else " " for c in codes[a : a + n]) for a, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True)]
    assert texts == ["ab c ", "", "", "é́x", "नमस्ते"] and letters.tolist() == [True, False, False, True, True]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_held_out_accuracy(spark):
    found = lang.query(spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    judged = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert len(judged) > 150 and sum(r["lang_pred"] == r["lang"] for r in judged) >= 0.98 * len(judged)


def test_labels_of_the_held_out_fold_and_their_texts_teach_nothing(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "das ist ein haus und " * 9, "de") for i in range(60) if i not in held] + [(i, "zzz qqq xxx", "never") for i in held] + [(None, "zzz", "never")]
    known = lang.learn(frame(spark, rows))
    assert known.names == ("de",) and "z" not in {chr(c) for c in known.alphabet}


LONG = "the house and the garden " * 60_000
AWKWARD = [(1, "the house and the garden are there", None), (2, None, "en"), (3, "", "de"), (4, "12 34 .. !", "en"), (None, "das haus und der garten", "de"), (None, None, None), (5, LONG, "en"), (6, "漢字 \U0001f600", None), (7, "x", "en"), (7, "x", "en")]


def test_awkward_rows(spark):
    ids = [i for i in range(100, 140) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = AWKWARD + [(i, "the house and the garden are over there " + str(i), "en") for i in ids[:12]] + [(i, "das haus und der garten sind dort drüben " + str(i), "de") for i in ids[12:]] + [(i, "77", "digits") for i in ids[:3]]
    docs = frame(spark, rows)
    known = lang.learn(docs)
    assert known.names == ("de", "en")
    found = lang.identify(docs, known).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert by[1][0][0] == "en" and by[5][0][0] == "en" and sorted(p for p, _ in by[None]) == ["de", "und"]
    assert by[2] == by[3] == by[4] == [("und", 0.0)] and by[6][0][0] in ("de", "en") and len(by[7]) == 2
    assert lang.identify(docs.limit(0), known).collect() == []
    nothing = lang.learn(docs.where(F.col("lang") == "digits"))
    assert nothing.names == () and {tuple(r)[1:] for r in lang.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert lang.learn(docs.limit(0)).names == ()
    one = lang.learn(docs.where(F.col("lang") == "en"))
    assert {(r["lang_pred"], r["score"]) for r in lang.identify(docs.where("doc_id in (1, 5, 6)"), one).collect()} == {("en", 1.0)}


def test_chunks_of_a_long_text_count_alike_in_any_company(spark):
    known = lang.learn(frame(spark, [(i, "the house and the garden are over there", "en") for i in range(9)] + [(i, "das haus und der garten", "de") for i in range(9)]))
    alone, _, _ = known.costs([LONG])
    among, _, _ = known.costs(["das", LONG, None, "the", LONG])
    assert np.array_equal(alone[0], among[1]) and np.array_equal(alone[0], among[4])
