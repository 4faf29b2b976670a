"""Constraints on small catalogues, with nulls, repeated datasets and ties."""

import pytest
from pyspark.sql import functions as F

from meridian.functions.calendars import ordinal, parse_time
from meridian.operators import constraints as c
from meridian.plans.diagnostics import months, shipped
from meridian.plans.requirement import DataRequirement, Diagnostic, solve, solve_inputs

FACETS = "row_id long, dataset_id long, instance_id string, variable_id string, source_id string, grid_label string, table_id string, experiment_id string, member_id string, version string"
AREAS = [
    (0, 0, "a", "tas", "M", "gn", "Amon", "historical", "r1i1p1f1", "v20210316"), (1, 1, "b", "areacella", "M", "gn", "fx", "historical", "r1i1p1f1", "v20220101"),
    (2, 2, "c", "tas", "M", "gn", "Amon", "ssp585", "r2i1p1f1", "v20210316"), (3, 3, "d", "areacella", "M", "gn", "fx", "ssp585", "r1i1p1f1", "v20210316"),
]


def members(df):
    return sorted((r.gk, r.row_id) for r in df.select("gk", "row_id").collect())


def area_rows(spark, rows=AREAS):
    catalog = spark.createDataFrame(rows, FACETS)
    return catalog, catalog.where("variable_id = 'tas'").withColumn("gk", F.lit("g"))


def test_best_match_for_each(spark):
    catalog, rows = area_rows(spark)
    assert members(c.AddSupplementaryDataset.of("areacella", "cmip6").apply(rows, catalog)) == [("g", k) for k in range(4)]


def test_other_source_is_no_companion_and_nothing_found_keeps_the_group(spark):
    other = [(*r[:4], "N", *r[5:]) if r[3] == "areacella" else r for r in AREAS]
    catalog, rows = area_rows(spark, other)
    assert members(c.AddSupplementaryDataset.of("areacella", "cmip6").apply(rows, catalog)) == [("g", 0), ("g", 2)]


def test_latest_version_of_the_best(spark):
    extra = [*AREAS, (4, 4, "e", "areacella", "M", "gn", "fx", "historical", "r1i1p1f1", "v20230101")]
    catalog, rows = area_rows(spark, extra)
    assert ("g", 4) in members(c.AddSupplementaryDataset.of("areacella", "cmip6").apply(rows, catalog))
    assert ("g", 1) not in members(c.AddSupplementaryDataset.of("areacella", "cmip6").apply(rows, catalog))


def facet_rows(spark, rows):
    return spark.createDataFrame([("g", k, *r) for k, r in enumerate(rows)], "gk string, row_id long, variable_id string, source_id string")


def test_require_all_and_any(spark):
    rows = facet_rows(spark, [("tas", "A"), ("pr", "A"), ("tas", "B"), ("pr", None), (None, "B")])
    both = c.RequireFacets("variable_id", ("tas", "pr"), group_by=("source_id",))
    assert [k for _, k in members(both.apply(rows, rows))] == [0, 1, 3]
    either = c.RequireFacets("variable_id", ("pr",), "any", ("source_id",))
    assert [k for _, k in members(either.apply(rows, rows))] == [0, 1, 3]
    assert members(c.RequireFacets("variable_id", ("rsut",)).apply(rows, rows)) == []
    with pytest.raises(KeyError):
        c.RequireFacets("absent", ("x",)).apply(rows, rows)


def test_ignore_keeps_nulls(spark):
    rows = facet_rows(spark, [("tas", "A"), ("pr", "A"), (None, "A"), ("tas", None)])
    assert [k for _, k in members(c.IgnoreFacets({"variable_id": ("tas",), "source_id": ("A",)}).apply(rows, rows))] == [1, 2, 3]


def timed(spark, rows):
    df = spark.createDataFrame([("g", k, *r) for k, r in enumerate(rows)], "gk string, row_id long, variable_id string, start string, end string, calendar string")
    for n in ("start", "end"):
        df = df.withColumn(f"{n}_time", parse_time(F.col(n), F.col("calendar"))).withColumn(f"{n}_ord", ordinal(F.col(f"{n}_time"), F.col("calendar")))
    return df


def kept(spark, constraint, rows):
    df = timed(spark, rows)
    return [k for _, k in members(constraint.apply(df, df))]


def test_contiguous(spark):
    std = "standard"
    rows = [
        ("tas", "2000-01-16", "2000-12-16", std), ("tas", "2001-01-16", "2001-12-16", std), ("pr", "2000-01-16", "2000-12-16", std), ("pr", "2001-03-16", "2001-12-16", std), ("pr", None, None, std),
        ("ts", "2000-01-01", "2000-12-30", "360_day"), ("ts", "2001-01-01", "2001-12-30", std), ("fx", None, None, None), (None, "2000-01-01", "2000-02-01", std),
    ]
    assert kept(spark, c.RequireContiguousTimerange(("variable_id",)), rows) == [0, 1, 4, 7, 8]


def test_gap_uses_the_previous_file_not_the_latest_end(spark):
    rows = [("tas", "2000-01-01", "2009-12-31", "standard"), ("tas", "2001-01-01", "2001-12-31", "standard"), ("tas", "2005-01-01", "2005-12-31", "standard")]
    assert kept(spark, c.RequireContiguousTimerange(("variable_id",)), rows) == []


def test_timerange(spark):
    rows = [("tas", "1979-01-16", "2014-12-16", "standard"), ("pr", "1979-02-16", "2014-12-16", "standard"), ("ts", "1979-01-16", "2014-11-16", "360_day"), ("fx", None, None, None)]
    need = c.RequireTimerange(("variable_id",), {"year": 1979, "month": 1}, {"year": 2014, "month": 12})
    assert kept(spark, need, rows) == [0, 3]
    assert months(1979, 2014).start == {"year": 1979, "month": 1}


def test_overlapping(spark):
    need = c.RequireOverlappingTimerange(("variable_id",))
    yes = [("tas", "2000-01-01", "2005-01-01", "standard"), ("pr", "2004-01-01", "2009-01-01", "standard"), ("fx", None, None, None)]
    no = [("tas", "2000-01-01", "2004-01-01", "standard"), ("pr", "2004-01-01", "2009-01-01", "standard"), ("fx", None, None, None)]
    assert kept(spark, need, yes) == [0, 1, 2] and kept(spark, need, no) == [] and kept(spark, need, yes[:1]) == [0]


PARENTS = "row_id long, dataset_id long, source_id string, experiment_id string, variant_label string, table_id string, variable_id string, grid_label string, version string, parent_source_id string, parent_experiment_id string, parent_variant_label string"


def test_parents_come_with_all_their_files(spark):
    def row(k, d, exp, version="v1", parent=(None, None, None)):
        return (k, d, "M", exp, "r1", "Amon", "tas", "gn", version, *parent)

    catalog = spark.createDataFrame(
        [row(0, 0, "ssp", parent=("M", "hist", "r1")), row(1, 1, "hist", "v1"), row(2, 2, "hist", "v2"), row(3, 2, "hist", "v2"), row(4, 3, "ssp2", parent=("M", "none", "r1")), row(5, 4, "ssp3")], PARENTS
    )
    rows = catalog.where("experiment_id like 'ssp%'").withColumn("gk", F.lit("g"))
    assert members(c.AddParentDataset.of("cmip6").apply(rows, catalog)) == [("g", 0), ("g", 2), ("g", 3)]


@pytest.mark.parametrize("labels, first", [(["r10i1p1f1", "r2i1p1f1"], "r2i1p1f1"), (["abc", "r10i1p1f1"], "r10i1p1f1"), (["b", "a"], "a")])
def test_first_member_is_numeric(spark, labels, first):
    rows = spark.createDataFrame([("g", k, "M", x) for k, x in enumerate([*labels, None])] + [("g", 9, "N", None)], "gk string, row_id long, source_id string, member_id string")
    got = {(r.source_id, r.member_id) for r in c.SelectFirstMember().apply(rows, rows).collect()}
    assert got == {("M", first), ("N", None)}


def test_own_constraint(spark):
    rows = facet_rows(spark, [("tas", "A"), ("pr", "A")])
    only = c.ByGroup(lambda g: g[g.variable_id == "pr"])
    assert isinstance(only, c.Constraint) and members(only.apply(rows, rows)) == [("g", 1)]


# -------------------------------------------------------------------- solving


def test_keys_and_hashes(spark):
    catalog, _ = area_rows(spark)
    obs = spark.createDataFrame([(0, "x", "HadISST-1-1", "ts"), (1, "y", None, "ts")], "row_id long, instance_id string, source_id string, variable_id string")
    need = [
        DataRequirement("cmip6", ({"variable_id": ["tas"], "experiment_id": ["ssp585"]},), ("variable_id", "experiment_id", "source_id"), (c.AddSupplementaryDataset.of("areacella", "cmip6"),)),
        DataRequirement("obs4mips", (), ("variable_id", "source_id")),
    ]
    rows = solve_inputs(need, {"cmip6": catalog, "obs4mips": obs}).collect()
    assert [r.dataset_key for r in rows] == ["cmip6_ssp585_M_tas__obs4mips_HadISST-1-1_ts"]
    assert rows[0].slugs == {"cmip6": ["c", "d"], "obs4mips": ["x"]}
    bare = solve_inputs([DataRequirement("cmip6", need[0].filters, need[0].group_by), need[1]], {"cmip6": catalog, "obs4mips": obs}).first()
    assert bare.dataset_key == rows[0].dataset_key and bare.dataset_hash != rows[0].dataset_hash
    again = solve_inputs(need, {"cmip6": catalog.orderBy(F.desc("row_id")), "obs4mips": obs}).first()
    assert again.dataset_hash == rows[0].dataset_hash


def test_no_group_no_execution(spark):
    catalog, _ = area_rows(spark)
    none = DataRequirement("obs4mips", ({"variable_id": []},), ("variable_id",))
    assert solve_inputs([DataRequirement("cmip6", (), ("variable_id",)), none], {"cmip6": catalog, "obs4mips": catalog}).count() == 0
    with pytest.raises(ValueError):
        solve_inputs([none, none], {"obs4mips": catalog})


def test_alternatives_and_catalogues(spark):
    catalog, _ = area_rows(spark)
    a, b = (DataRequirement(t, ({"variable_id": ["tas"]},), ("experiment_id",)) for t in ("cmip6", "cmip7"))
    found = solve([Diagnostic("p", "d", ((a,), (b,)))], {"cmip6": catalog}, {"experiment_id": ["ssp585"], "absent": ["x"]}).collect()
    assert [(r.provider, r.diagnostic, r.dataset_key) for r in found] == [("p", "d", "cmip6_ssp585")]
    with pytest.raises(ValueError):
        solve([Diagnostic("p", "d", ((b,),))], {"cmip6": catalog})
    with pytest.raises(KeyError):
        DataRequirement("cmip6", ({"absent": ["x"]},), None).groups(catalog)
    with pytest.raises(ValueError):
        a.validate(catalog, ["experiment_id"])


def test_one_group_without_facets(spark):
    catalog, _ = area_rows(spark)
    rows = DataRequirement("cmip6").groups(catalog).collect()
    assert len(rows) == 4 and {r.gk for r in rows} == {"[]"}


def test_shipped_requirements_are_distinct():
    slugs = [(d.provider, d.slug) for d in shipped()]
    assert len(slugs) == len(set(slugs)) >= 15
