"""JSON documents of any shape: leaves, comparison, rounding."""

import json

import pytest
from pyspark.sql import functions as F

from meridian.operators import documents


def frame(spark, docs):
    return spark.createDataFrame([(k, d if d is None or isinstance(d, str) else json.dumps(d)) for k, d in docs], "k int, doc string")


def test_leaves_of_any_shape(spark):
    doc = {"a": {"b": [1, {"c": None, "d.e": True}, []], "": {}}, "x": 1.5, "s": "1", "deep": [[[["v"]]]], "n": float("nan"), "i": [float("-inf"), 2]}
    rows = documents.leaves(frame(spark, [(1, doc), (2, None), (3, "{broken"), (4, 7), (5, "[]")]), ["k"], "doc").collect()
    found = {(r["k"], tuple(r["path"])): (r["kind"], r["number"] if r["kind"] in ("whole", "number") else r["value"]) for r in rows}
    assert found == {
        (1, ("a", "b", "[0]")): ("whole", 1.0), (1, ("a", "b", "[1]", "c")): ("null", None), (1, ("a", "b", "[1]", "d.e")): ("boolean", "true"), (1, ("a", "b", "[2]")): ("array", None), (1, ("a", "")): ("object", None),
        (1, ("x",)): ("number", 1.5), (1, ("s",)): ("string", "1"), (1, ("deep", "[0]", "[0]", "[0]", "[0]")): ("string", "v"), (1, ("n",)): ("string", "NaN"), (1, ("i", "[0]")): ("string", "-Infinity"), (1, ("i", "[1]")): ("whole", 2.0),
        (2, ()): ("missing", None), (3, ()): ("invalid", "{broken"), (4, ()): ("whole", 7.0), (5, ()): ("array", None),
    }
    assert documents.leaves(frame(spark, []), ["k"], "doc").count() == 0


def test_added_missing_retyped_and_tolerated(spark):
    expected = {"a": {"count": 1000000, "long": 12345678901234567890, "kept": 1, "near": 1.0, "far": 1.0, "gone": 1, "typed": 1, "flag": True, "nan": float("nan"), "list": [1, 2, 3], "at": "2001"}, "same": [{"x": None}]}
    actual = {"a": {"count": 1000001, "long": 12345678901234567891, "kept": 1.0, "near": 1.0 + 5e-6, "far": 1.1, "typed": "1", "flag": 1, "nan": float("nan"), "list": [1, 2], "new": {"z": 0}, "at": "2002"}, "same": [{"x": None}]}
    found = {(r["k"], r["path"]): r["difference"] for r in documents.compare_documents(frame(spark, [(1, expected), (2, {"only": 1})]), frame(spark, [(1, actual), (3, [1])]), ["k"], "doc", ignored=[r"\.at$"]).collect()}
    assert found == {
        (1, "a.far"): "differs", (1, "a.count"): "differs", (1, "a.long"): "differs", (1, "a.gone"): "missing", (1, "a.typed"): "retyped", (1, "a.flag"): "retyped", (1, "a.list[2]"): "missing", (1, "a.new.z"): "extra", (2, "only"): "missing", (3, "[0]"): "extra",
    }
    same = frame(spark, [(1, expected)])
    assert documents.compare_documents(same, same, ["k"], "doc").count() == 0


@pytest.mark.parametrize("figures", [7, 3])
def test_rounding_and_pruning_go_all_the_way_down(spark, figures):
    doc = {"a": [1.23456789, {"b": 123456.789, "c": None, "i": 123456789}], "d": None, "e": [None], "f": True}
    r = frame(spark, [(1, doc), (2, None), (3, "no json")]).select("k", documents.rounded(F.col("doc"), figures).alias("r"), documents.without_nulls(F.col("doc")).alias("p")).collect()
    by = {x["k"]: x for x in r}
    assert json.loads(by[1]["r"]) == {"a": [float(f"{1.23456789:.{figures}g}"), {"b": float(f"{123456.789:.{figures}g}"), "c": None, "i": 123456789}], "d": None, "e": [None], "f": True}
    assert json.loads(by[1]["p"]) == {"a": [1.23456789, {"b": 123456.789, "i": 123456789}], "e": [], "f": True}
    assert by[2]["r"] is None and by[2]["p"] is None and by[3]["r"] == "no json"
