"""The whole pipeline over planted documents."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_pipeline_keeps_clean_documents_only(spark, tmp_path):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(2000)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    clean = {k: words(80) for k in range(60)}
    item = words(40)
    texts = {k: " ".join(w) for k, w in clean.items()}
    copies = {100: texts[3], 101: texts[3].replace(" ", "\n", 5)}
    near = {110 + k: " ".join(["changed", *clean[k][1:]]) for k in range(5)}
    leaks = {120: " ".join([*words(50), *item]), 121: " ".join([*item[20:], *words(10), *item[:20]])}
    toxic = {130 + k: " ".join([*words(30), "you", "idiot", "moron", *words(10)]) for k in range(80)}
    every = texts | copies | near | leaks | toxic
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in every.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k >= 130)) for k in every], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert kept == set(clean)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing"]


FIELDS = "doc_id long, text string, lang string, source string, n_chars long, sig string, text_hash string"


def written(spark, folder, docs, labels, items):
    for name, rows, kind in (("documents", docs, FIELDS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, ties and extra columns: each stage keeps the columns and what it must."""
    near = [f"n{k}" for k in range(60)]
    item = " ".join(f"i{k}" for k in range(20))
    texts = [(1, "same text"), (1, "same text"), (2, "same  text"), (3, None), (4, ""), (None, "a text of its own without an id"), (None, None), (5, " ".join(near)), (6, " ".join(near[:-1] + ["x"])), (7, item), (8, "a b"), (9, "w " * 6000)]
    folder = written(spark, tmp_path, [(i, t, None, "s", None, "g", "h") for i, t in texts], [(1, 1, 0), (None, None, None), (8, 1, None)], [(1, item), (2, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == [c.split()[0] for c in FIELDS.split(", ")], name
    left = sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is None, x))
    assert left == [1, 3, 5, 8, 9, None]  # the null text without an id equals the one with doc_id 3
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(left) and max(r.length for r in packed) <= 4096
    assert sum(r.doc_id == 9 for r in packed) == 2


def test_pipeline_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [], [])).collect() == []
