"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from meridian.llm import decontamination, exact_dedup, licenses, near_join, packing, pii, quality, secret_scan, token_files, toxicity
from meridian.llm.common import fresh_path

#: Extra columns whose names the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, part int, sig long, shingles string, tokens string, text_hash string, sha string, score double, __id string, __hash string, __sha string"
LABELS = "doc_id long, quality int, toxic int, fold int"
BENCHMARK = "item_id long, text string, seeds string"

LONG = "lorem ipsum dolor sit amet consectetur " * 20_000
ROWS = [
    (1, "the same words stand here twice in the table"), (2, "the same  words stand\nhere twice in the table"), (2, "the same  words stand\nhere twice in the table"),
    (3, None), (4, ""), (5, "   \n\t "), (None, "a row without an id but with a text of some words"), (None, None), (6, LONG), (7, "x" * 100_000), (8, "Zeile mit Ümläuten é 日本語 \U0001f600 you idiot"),
    (9, "short"), (10, "the same words stand here twice in the table"),
]


def make_docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "src", None, 1, 2, "s", "t", "h", "x", 0.5, "i", "j", "k") for i, t in rows], DOCS)


def make_labels(spark, rows=((1, 1, 0, 1), (8, 0, 1, 1), (None, 1, 1, 1), (9, None, None, None), (8, 0, 1, 1))):
    return spark.createDataFrame(list(rows), LABELS)


def make_items(spark, rows=((1, "the same words stand here twice", "s"), (2, None, None), (None, "lorem ipsum dolor sit amet consectetur lorem", None), (3, "too short", None))):
    return spark.createDataFrame(list(rows), BENCHMARK)


OPERATORS = {
    "leaks": lambda s, d: decontamination.find_leaks(d, make_items(s)),
    "drop_leaks": lambda s, d: decontamination.drop_leaks(d, make_items(s)),
    "copies": lambda s, d: exact_dedup.find_copies(d),
    "drop_copies": lambda s, d: exact_dedup.drop_copies(d),
    "toxic": lambda s, d: toxicity.score(d, make_labels(s)),
    "drop_toxic": lambda s, d: toxicity.drop_toxic(d, make_labels(s)),
    "near": lambda s, d: near_join.near_components(d),
    "keep_one": lambda s, d: near_join.keep_one(d),
    "licenses": lambda s, d: licenses.find_licenses(d),
    "pii": lambda s, d: pii.find_pii(d),
    "tokens": lambda s, d: token_files.read_tokens(token_files.write_tokens(d, fresh_path(s, "t"))),
    "quality": lambda s, d: quality.grade(d, quality.learn(d, make_labels(s))),
    "secrets": lambda s, d: secret_scan.find_secrets(d),
    "pack": lambda s, d: packing.pack(d),
}
ONE_PER_ROW = {"copies", "toxic", "near", "pii", "tokens", "quality", "secrets"}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, name):
    found = OPERATORS[name](spark, make_docs(spark, ROWS)).collect()
    if name in ONE_PER_ROW:
        assert len(found) == len(ROWS)
    if name == "copies":
        rows = sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0))
        same = [r for r in rows if r.group_size == 4]
        assert {r.keep_id for r in same} == {1} and sum(r.kept for r in same) == 1
        empty = [r for r in rows if r.doc_id in (3, 4)]
        assert {(r.keep_id, r.group_size) for r in empty} == {(3, 3)}
    if name == "drop_copies":
        assert sorted(r.doc_id for r in found if r.doc_id is not None) == [1, 3, 5, 6, 7, 8, 9]
        assert found[0].asDict().keys() == {c.split()[0] for c in DOCS.split(", ")}
    if name == "near":
        by = {r.doc_id: r for r in found if r.doc_id is not None}
        assert (by[1].component_id, by[2].component_id, by[10].component_id) == (1, 1, 1)
        assert (by[3].n_shingles, by[3].component_id, by[5].n_shingles) == (0, 3, 0)
        assert by[9].n_shingles == 1 and by[6].n_shingles == 6
        assert all(r.component_id is None for r in found if r.doc_id is None)
    if name == "keep_one":
        assert sorted(r.doc_id for r in found if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 9] and sum(r.doc_id is None for r in found) == 2
    if name == "leaks":
        assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (10, 1), (6, None)}
    if name == "drop_leaks":
        assert sorted(r.doc_id for r in found if r.doc_id is not None) == [3, 4, 5, 7, 8, 9] and sum(r.doc_id is None for r in found) == 2
    if name == "pack":
        assert sum(r.doc_id is None for r in found) == 2 and sum(r.length == 1 for r in found) >= 3
        used = {}
        for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
            assert used.get(r.sequence_id, 0) == r.offset
            used[r.sequence_id] = r.offset + r.length
        assert max(used.values()) <= 4096
    by = {r.doc_id: r for r in found if "doc_id" in r and r.doc_id is not None}
    if name == "drop_toxic":
        assert found[0].asDict().keys() == {c.split()[0] for c in DOCS.split(", ")} and {1, 3, 4, 5, 7, 9, 10} <= set(by)
    if name == "licenses":
        assert found == []
    if name in ("pii", "secrets"):
        assert all(r.spans == "" for k, r in by.items() if k in (1, 3, 4, 5, 9)) and by[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    if name == "tokens":
        assert (by[3].n_tokens, by[4].n_tokens, by[5].n_tokens) == (1, 1, 1) and by[1].n_tokens == by[10].n_tokens and by[6].n_tokens > 100_000
        starts = sorted((r.start, r.n_tokens) for r in found)
        assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0
    if name == "quality":
        assert all(0 <= r.expected_grade <= 1 for r in found) and by[3].expected_grade == by[4].expected_grade
    if name == "toxic":
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, make_docs(spark, [])).collect() == []


def test_empty_partners(spark):
    docs = make_docs(spark, ROWS)
    assert decontamination.find_leaks(docs, make_items(spark, [])).count() == 0
    assert {r.score for r in toxicity.score(docs, make_labels(spark, [])).collect()} == {0.0}
    assert {r.expected_grade for r in quality.grade(docs, quality.learn(docs, make_labels(spark, []))).collect()} == {0.0}


def test_rows_all_null(spark):
    docs = make_docs(spark, [(None, None)] * 3)
    kept = exact_dedup.find_copies(docs).collect()
    assert [r.group_size for r in kept] == [3, 3, 3] and sum(r.kept for r in kept) == 1
    assert near_join.near_components(docs).where(F.col("n_shingles") == 0).count() == 3
