"""Queries of results, the ledger, solving, bundles and gridded reductions, each beside equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import calendars
from meridian.operators import bundles, documents, enso, gridded, levels, modes, regions, regrid
from meridian.operators.constraints import ByGroup, IgnoreFacets
from meridian.operators.filters import facet_filter, parse_facets
from meridian.operators.outliers import OutlierPolicy
from meridian.plans import annual_cycle, benchmarks, diagnostics, doctor, ledger, regression, requirement, results, runner
from meridian.plans.requirement import DataRequirement, Diagnostic
from meridian.queries import GRID, GROUPS, MEAN, PARTS, RUNS, executions, grid, groups, measurements, part_datasets, query, table
from meridian.streaming.ingest import changed_groups

NOW = "2001-01-01"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


# ------------------------------------------------------------------------ readers


def reader(spark, sf_dir) -> results.Results:
    """Suppliers' line items as scalar values, embeddings as series, orders as executions of customers' groups."""
    g = groups(spark, sf_dir).select("id", "diagnostic_id", F.col("dataset_key").alias("key"), "diagnostic_version", "dirty", F.create_map(F.lit("cmip6"), F.array(F.struct(F.lit("segment").alias("k"), F.col("provider").alias("v")))).alias("selectors"))
    d = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("d"), "n_nationkey").alias("slug"), F.concat(F.lit("p"), "n_regionkey").alias("provider"), (F.col("n_nationkey") % 3 + 1).alias("promoted_version"))
    runs = executions(spark, sf_dir).withColumn("retracted", F.col("id") % 11 == 0)
    none = F.lit(None).cast("string")
    scalars = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.max("l_extendedprice").alias("value")).select(
        F.xxhash64("l_orderkey", "l_returnflag").alias("id"), F.col("l_orderkey").alias("execution_id"), F.lit("scalar").alias("type"), "value", F.lit(None).cast("array<double>").alias("values"), F.lit(None).cast("array<string>").alias("index"), none.alias("kind"),
        F.when(F.col("l_orderkey") % 2 == 0, "r").alias("reference_id"), F.col("l_returnflag").alias("statistic"), F.lit("m").alias("metric"),
    )
    lines = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("vec_id").alias("execution_id"), F.lit("series").alias("type"), F.lit(None).cast("double").alias("value"), F.slice(F.col("embedding").cast("array<double>"), 1, 3).alias("values"), F.array(F.lit("a"), F.lit("b")).alias("index"), none.alias("kind"),
        F.when(F.col("vec_id") % 2 == 0, "r").alias("reference_id"), F.lit("s").alias("statistic"), F.lit("m").alias("metric"),
    )
    outputs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).alias("execution_id"), F.col("o_orderpriority").alias("output_type"))
    return results.Results(scalars.unionByName(lines), runs, g, d, outputs, ("statistic", "metric"))


OPEN_RUNS = f"(SELECT * FROM {RUNS} WHERE id % 11 <> 0)"
PROMOTED = f"(SELECT g.* FROM {GROUPS} g WHERE diagnostic_version = diagnostic_id % 3 + 1)"
SCALARS = "(SELECT l_orderkey AS execution_id, l_returnflag AS statistic, max(l_extendedprice) AS value FROM lineitem GROUP BY 1, 2)"


@query(f"SELECT v.execution_id, v.statistic, v.value FROM {SCALARS} v JOIN {OPEN_RUNS} r ON v.execution_id = r.id JOIN {PROMOTED} g ON r.group_id = g.group_id JOIN nation ON n_nationkey = g.diagnostic_id WHERE v.statistic IN ('A', 'R') AND 'p' || n_regionkey ILIKE '%P1%'")
def scalar_values_filtered(spark, sf_dir):
    f = results.ValueFilter(dimensions={"statistic": ["A", "R"]}, provider_contains=["P1"])
    return reader(spark, sf_dir).select("scalar", f).select("execution_id", "statistic", "value")


@query(f"""
WITH v AS (SELECT v.* FROM {SCALARS} v JOIN {OPEN_RUNS} r ON v.execution_id = r.id JOIN {PROMOTED} g ON r.group_id = g.group_id),
q AS (SELECT statistic, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, count(*) AS n FROM v GROUP BY 1)
SELECT v.statistic, count(*) AS n FROM v JOIN q USING (statistic) WHERE NOT (n >= 4 AND b > a AND (value < a - 0.2 * (b - a) OR value > b + 0.2 * (b - a))) GROUP BY 1
""")
def scalar_values_screened(spark, sf_dir):
    """What a page shows: outliers hidden after screening all that the filter means."""
    shown = reader(spark, sf_dir).scalar_values(policy=OutlierPolicy(factor=0.2)).rows
    return shown.groupBy("statistic").agg(F.count("*").alias("n"))


@query(f"SELECT execution_id, statistic, 'm' AS metric, 'model' AS kind, value, NOT (value > 50000) AS small FROM {SCALARS}")
def values_handed_out(spark, sf_dir):
    df = reader(spark, sf_dir).select("scalar", results.ValueFilter(promoted_only=False, include_retracted=True))
    return results.values_frame(df, ["statistic", "metric"]).select("execution_id", "statistic", "metric", "kind", "value", (~(F.col("value") > 50000)).alias("small"))


@query("SELECT vec_id AS id, CAST(i - 1 AS INTEGER) AS position, CASE i WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE '2' END AS index_value, round(CAST(embedding[i] AS DOUBLE), 5) AS value FROM (SELECT * FROM embeddings WHERE vec_id % 2 = 0), generate_series(1, 3) t(i)")
def series_page_exploded(spark, sf_dir):
    """Reference series, one row per value; an index that is too short gives way to the position."""
    f = results.ValueFilter(promoted_only=False, include_retracted=True)
    rows = reader(spark, sf_dir).series_values(f, references=True, explode=True).rows
    return rows.select("id", "position", "index_value", F.round("value", 5).alias("value"))


@query(f"""
WITH l AS (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1)
SELECT g.group_id AS id, l.id AS execution_id, l.successful FROM {PROMOTED} g LEFT JOIN l ON g.group_id = l.group_id WHERE NOT g.dirty AND coalesce(l.successful, false) = false AND g.provider = 'BUILDING' ORDER BY 1 LIMIT 60 OFFSET 3
""")
def execution_groups_page(spark, sf_dir):
    rows = reader(spark, sf_dir).execution_groups(dirty=False, succeeded=False, facets={"cmip6.segment": ["BUILDING"]}, offset=3, limit=60)
    return rows.select("id", "execution_id", "successful")


@query("SELECT o_orderkey AS id, o_orderpriority AS output_type FROM orders WHERE o_custkey % 50 = 7")
def outputs_of_execution(spark, sf_dir):
    return reader(spark, sf_dir).outputs_of(7).select("id", "output_type")


DIAGNOSTICS = f"""
WITH l AS (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1),
n AS (SELECT diagnostic_id, count(*) AS n FROM {GROUPS} GROUP BY 1),
s AS (SELECT diagnostic_id, count(*) FILTER (l.successful) AS successful, count(*) FILTER (l.id IS NOT NULL AND l.successful IS NULL) AS inflight, count(*) AS total FROM {PROMOTED} g LEFT JOIN l ON g.group_id = l.group_id GROUP BY 1)
SELECT n_nationkey AS id, 'p' || n_regionkey AS provider, 'd' || n_nationkey AS slug, n_nationkey % 3 + 1 AS promoted_version, coalesce(n, 0) AS execution_group_count, coalesce(successful, 0) AS successful, coalesce(inflight, 0) AS inflight, coalesce(total, 0) AS total
FROM nation LEFT JOIN n ON n.diagnostic_id = n_nationkey LEFT JOIN s ON s.diagnostic_id = n_nationkey WHERE 'd' || n_nationkey ILIKE '%1%'
"""


@query(f"{DIAGNOSTICS} ORDER BY provider, slug, id LIMIT 8 OFFSET 2")
def diagnostics_page(spark, sf_dir):
    return reader(spark, sf_dir).list_diagnostics(["1"], offset=2, limit=8)


@query(f"SELECT provider, slug AS diagnostic, total, successful FROM ({DIAGNOSTICS}) WHERE total > 0")
def diagnostic_statistics(spark, sf_dir):
    return reader(spark, sf_dir).diagnostic_statistics(["1"]).select("provider", "diagnostic", "total", "successful")


@query(f"SELECT v.execution_id, v.statistic, v.value FROM {SCALARS} v WHERE v.execution_id = (SELECT id FROM {RUNS} WHERE group_id = 10 ORDER BY created_at DESC, id DESC LIMIT 1)")
def values_of_group(spark, sf_dir):
    """The latest execution's values, retracted or not, promoted or not."""
    return reader(spark, sf_dir).values_of_group(10).where("type = 'scalar'").select("execution_id", "statistic", "value")


@query(f"SELECT row_id AS id, source_id AS slug FROM {PARTS} ORDER BY source_id, row_id LIMIT 30 OFFSET 12")
def datasets_page(spark, sf_dir):
    return results.datasets_page(part_datasets(spark, sf_dir).select(F.col("row_id").alias("id"), F.col("source_id").alias("slug")), 12, 30)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0 OR o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 25 OFFSET 5")
def measurements_page(spark, sf_dir):
    df = executions(spark, sf_dir).withColumns({"wall_seconds": F.when(F.col("id") % 3 == 0, 1.0), "cpu_seconds": F.lit(None).cast("double"), "peak_memory_bytes": F.lit(None).cast("long")})
    return results.measurements_page(df, 5, 25).select("id")


@query(f"SELECT source_id, row_id FROM (SELECT * FROM {PARTS} WHERE row_id % 4 <> 0 AND row_id % 3 = 0 AND grid_label IN ('SMALL', 'LARGE')) QUALIFY rank() OVER (PARTITION BY source_id ORDER BY size DESC) = 1")
def datasets_latest(spark, sf_dir):
    """Facets, retraction and finalisation apply before versions are ranked."""
    df = part_datasets(spark, sf_dir).withColumns({"retracted_at": F.when(F.col("row_id") % 4 == 0, "x"), "finalised": F.col("row_id") % 3 == 0, "version_key": F.col("size")})
    return results.datasets(df, facets={"grid_label": ["SMALL", "LARGE"]}, finalised=True, latest=["source_id"]).select("source_id", "row_id")


@query("SELECT l_returnflag AS provider, count(*) AS n_measured FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1")
def resources_since(spark, sf_dir):
    found = results.resources(measurements(spark, sf_dir), since=F.lit("1999-01-01").cast("timestamp_ntz"))
    return found.groupBy("provider").agg(F.sum("n_measured").cast("long").alias("n_measured"))


# -------------------------------------------------------------------------- ledger


@query("""
SELECT o_orderkey, o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS successful, o_orderkey % 2 <> 0 OR (o_orderkey % 3 = 0 AND o_orderkey % 11 = 0) AS dirty FROM orders
""")
def execution_outcomes(spark, sf_dir):
    k = F.col("o_orderkey")
    end = ledger.outcome(k % 2 == 0, k % 3 != 0, k % 11 == 0, k % 5 != 0, k % 7 != 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", end["successful"].alias("successful"), end["dirty"].alias("dirty"))


@query(f"SELECT 'run' AS kind, id, coalesce(successful, false) AS state FROM {RUNS} UNION ALL SELECT 'group', group_id, dirty OR diagnostic_id = 4 FROM {GROUPS}")
def failed_and_flagged(spark, sf_dir):
    runs = ledger.fail_running(executions(spark, sf_dir)).select(F.lit("run").alias("kind"), "id", F.col("successful").alias("state"))
    return runs.unionByName(ledger.flag_dirty(groups(spark, sf_dir), F.col("diagnostic_id") == 4).select(F.lit("group").alias("kind"), "id", F.col("dirty").alias("state")))


@query("SELECT DISTINCT l_orderkey AS execution_id, l_partkey AS dataset_id FROM lineitem")
def execution_links(spark, sf_dir):
    return ledger.execution_datasets(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("execution_id"), F.col("l_partkey").alias("dataset_id")))


@query(f"""
WITH gone AS (SELECT group_id FROM {GROUPS} WHERE provider = 'BUILDING'), r AS (SELECT id FROM {RUNS} WHERE group_id IN (SELECT * FROM gone))
SELECT 'groups' AS name, group_id AS id, 0 AS part FROM {GROUPS} WHERE group_id NOT IN (SELECT * FROM gone) UNION ALL SELECT 'executions', id, 0 FROM {RUNS} WHERE group_id NOT IN (SELECT * FROM gone)
UNION ALL SELECT 'values', l_orderkey, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM r)
""")
def deleted_groups(spark, sf_dir):
    """What is left of groups, executions and values without one provider's groups."""
    values = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("execution_id"), F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"))
    left = ledger.delete_groups(groups(spark, sf_dir), {"values": values}, executions(spark, sf_dir), F.col("provider") == "BUILDING")
    rows = [df.select(F.lit(name).alias("name"), "id", (F.col("part") if name == "values" else F.lit(0)).cast("long").alias("part")) for name, df in left.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0 THEN o_totalprice ELSE 1.0 END AS wall_seconds FROM orders")
def recorded_usage(spark, sf_dir):
    """A measurement that is missing or null leaves what was there."""
    o = table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_orderkey").alias("id"), F.lit(1.0).alias("wall_seconds"))
    return ledger.with_usage(runs, o.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 8 != 0, F.col("o_totalprice")).alias("wall_seconds")))


def candidates(spark, sf_dir) -> DataFrame:
    """Every group of even number with new data, and as many new groups."""
    g = groups(spark, sf_dir).select("provider", "diagnostic", "diagnostic_version", "dataset_key", "group_id")
    even = g.where("group_id % 2 = 0").withColumn("dataset_hash", F.lit("new"))
    return even.unionByName(even.withColumn("dataset_key", F.concat("dataset_key", F.lit("-x")))).drop("group_id")


@query(f"""
WITH e AS (SELECT provider, diagnostic, diagnostic_version, dataset_key, dirty FROM {GROUPS} WHERE group_id % 2 = 0)
SELECT *, 'new' AS dataset_hash, 1 AS runs FROM e UNION ALL SELECT * REPLACE (dataset_key || '-x' AS dataset_key, true AS dirty), 'new', 1 FROM e
UNION ALL SELECT provider, diagnostic, diagnostic_version, dataset_key, dirty, 'old', (SELECT count(*) FROM {RUNS} r WHERE r.group_id = g.group_id) FROM {GROUPS} g
""")
def solved_ledger(spark, sf_dir):
    """After a solve: what was started, by the key of its group, and beside it how many executions each old group had before."""
    every, runs = ledger.solved(candidates(spark, sf_dir), groups(spark, sf_dir), executions(spark, sf_dir), now())
    key = ["provider", "diagnostic", "diagnostic_version", "dataset_key", "dirty"]
    of = every.select(F.col("id").alias("group_id"), *key)
    new = F.col("dataset_hash") == "new"
    started = runs.where(new).where("successful is null").join(of, "group_id").select(*key, "dataset_hash").withColumn("runs", F.lit(1).cast("long"))
    before = runs.where(~new).groupBy("group_id").agg(F.count("*").alias("runs"))
    old = of.where(~F.col("dataset_key").endswith("-x")).join(before, "group_id", "left").select(*key, F.lit("old").alias("dataset_hash"), F.coalesce("runs", F.lit(0)).alias("runs"))
    return started.unionByName(old)


FIRSTS = f"""(SELECT f.id, f.group_id FROM (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at, id) = 1) f
  JOIN (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1) l USING (group_id) WHERE f.successful IS TRUE AND l.successful IS TRUE)"""


@query(f"SELECT DISTINCT f.id AS execution_id, f.group_id, p_type AS source_type, p_name AS slug, p_partkey AS path FROM {FIRSTS} f JOIN lineitem ON l_orderkey = f.id JOIN part ON p_partkey = l_partkey")
def reconstructed_executions(spark, sf_dir):
    """From an execution over its datasets to the files it was made from."""
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("execution_id"), F.col("l_partkey").alias("dataset_id"))
    p = table(spark, sf_dir, "part")
    d = p.select(F.col("p_partkey").alias("dataset_id"), F.col("p_type").alias("source_type"), F.col("p_name").alias("slug"))
    return ledger.reconstructed(executions(spark, sf_dir), links, d, p.select(F.col("p_partkey").alias("dataset_id"), F.col("p_partkey").alias("path")))


@query(f"""
WITH whole AS (SELECT l_orderkey FROM lineitem JOIN {RUNS} r ON r.id = l_orderkey GROUP BY 1 HAVING bool_and(l_linenumber <> 7))
SELECT group_id, r.id = l_orderkey AS known, l_quantity, l_partkey FROM lineitem JOIN {RUNS} r ON r.id = l_orderkey WHERE l_orderkey IN (SELECT * FROM whole)
""")
def reingested_results(spark, sf_dir):
    """The values that were read whole, each under a new, successful execution of its group; nothing of the others."""
    runs = executions(spark, sf_dir)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("execution_id"), (F.col("l_linenumber") != 7).alias("whole"), "l_quantity", "l_partkey")
    every, values = ledger.reingested(runs, rows, now())
    made = every.join(runs.select("id"), "id", "left_anti").where(F.col("successful") & (F.col("created_at") == now())).select(F.col("id").alias("execution_id"), "group_id")
    return values.join(made, "execution_id").select("group_id", F.lit(True).alias("known"), "l_quantity", "l_partkey")


# ------------------------------------------------------------------------- solving


def plain_diagnostics() -> list[Diagnostic]:
    by_source = DataRequirement("cmip6", ({"grid_label": ["SMALL"]},), ("source_id",))
    by_grid = DataRequirement("cmip6", ({"variable_id": ["red"]},), ("grid_label",))
    return [Diagnostic("a", "first", ((by_source,),)), Diagnostic("b", "second", ((by_grid,), (by_source,)), 2)]


def catalog(spark, sf_dir):
    return {"cmip6": part_datasets(spark, sf_dir).withColumn("instance_id", F.col("row_id").cast("string"))}


@query(f"""
WITH p AS {PARTS}, s AS (SELECT DISTINCT source_id AS k FROM p WHERE grid_label = 'SMALL'), g AS (SELECT DISTINCT grid_label AS k FROM p WHERE variable_id = 'red')
SELECT 'a' AS provider, 'first' AS diagnostic, 'cmip6_' || k AS dataset_key FROM s UNION ALL SELECT 'b', 'second', 'cmip6_' || k FROM g UNION ALL SELECT 'b', 'second', 'cmip6_' || k FROM s
""")
def solved_alternatives(spark, sf_dir):
    """Each alternative of a diagnostic that the catalogue satisfies gives its executions."""
    return requirement.solve(plain_diagnostics(), catalog(spark, sf_dir), unfinished=["units"]).select("provider", "diagnostic", "dataset_key")


@query(f"WITH p AS {PARTS} SELECT 'first' AS diagnostic, sha1('cmip6:' || sha1(string_agg(CAST(row_id AS VARCHAR), chr(10) ORDER BY CAST(row_id AS VARCHAR)))) AS dataset_hash FROM p WHERE grid_label = 'SMALL' AND NOT (source_id = 'Brand#1' OR variable_id = 'red') GROUP BY source_id")
def solved_without_ignored(spark, sf_dir):
    """Listed datasets are left out before groups are hashed."""
    ignored = {"a": {"first": {"cmip6": [{"source_id": ["Brand#1"]}, {"variable_id": ["red"]}]}}}
    chosen = requirement.with_ignored(plain_diagnostics()[:1], ignored)
    assert all(isinstance(c, IgnoreFacets) for c in chosen[0].requirements[0][0].constraints)
    return requirement.solve(chosen, catalog(spark, sf_dir)).select("diagnostic", "dataset_hash")


@query(f"WITH p AS {PARTS} SELECT 'cmip6_' || source_id AS dataset_key FROM (SELECT DISTINCT source_id FROM p WHERE grid_label = 'SMALL' AND source_id IN ('Brand#1', 'Brand#2'))")
def solved_for_facets(spark, sf_dir):
    found = requirement.solve(plain_diagnostics()[:1], catalog(spark, sf_dir), {"source_id": ["Brand#1", "Brand#2"], "absent": ["x"]})
    return found.select("dataset_key")


# ------------------------------------------------------------------------- bundles


@query("SELECT 'region' AS level, 'missing' AS problem, r_name AS key FROM region WHERE r_regionkey > 3 UNION ALL SELECT DISTINCT 'nation', 'undeclared', n_name FROM nation WHERE n_nationkey > 5 AND n_regionkey <= 3")
def bundle_shape(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    declared = {"region": [r["r_name"] for r in table(spark, sf_dir, "region").collect()], "nation": [r["n_name"] for r in table(spark, sf_dir, "nation").where("n_nationkey <= 5").collect()]}  # five and six rows
    rows = n.where("n_regionkey <= 3").select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.lit(1.0).alias("value"))
    return bundles.shape_problems(bundles.nest(rows, ["region", "nation"]), "results", ["region", "nation"], declared)


@query("SELECT 'brand' AS dimension, p_brand AS value, CASE WHEN bool_or(p_size < 26) THEN 'left' ELSE 'right' END AS attributes FROM part GROUP BY p_brand")
def merged_dimensions(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.lit("brand").alias("dimension"), F.col("p_brand").alias("value"), "p_size")
    a, b = p.where("p_size < 26"), p.where("p_size >= 26")
    return bundles.merged_dimensions(*(d.select("dimension", "value").distinct().withColumn("attributes", F.lit(n)) for d, n in ((a, "left"), (b, "right"))))


@query("SELECT l_returnflag AS season, max(l_quantity) AS value FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1")
def seasons_only(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.max("l_quantity").alias("value")).select(F.when(F.col("l_returnflag") == "N", "CalendarMonths").otherwise(F.col("l_returnflag")).alias("season"), F.lit("x").alias("axis"), "value")
    return bundles.seasons_only(df, ["axis"])


@query("SELECT c_mktsegment AS model, 'r' || (c_nationkey % 2) AS realization, 'rmse' AS metric, 'd' || c_nationkey AS reference_source_id, max(c_acctbal) AS value FROM customer GROUP BY ALL")
def results_of_runs(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy("c_mktsegment", (F.col("c_nationkey") % 2).alias("run"), F.concat(F.lit("d"), "c_nationkey").alias("r")).agg(F.max("c_acctbal").alias("v"))
    runs = c.groupBy("c_mktsegment", "run").agg(F.map_from_entries(F.collect_list(F.struct("r", F.struct(F.col("v").alias("value"))))).alias("m"))
    metrics = F.struct(F.create_map(F.lit("rmse"), F.struct(F.col("m").alias("metric"))).alias("value"))
    nested = runs.groupBy("c_mktsegment").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("r"), "run"), metrics))).alias("runs"))
    return bundles.from_runs(nested.select(F.to_json(F.create_map("c_mktsegment", "runs")).alias("json")), "json")


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false ELSE true END AS same FROM part")
def json_scalars_compared(spark, sf_dir):
    """Whole and broken numbers within the tolerance, a truth value against a number, NaN, different texts, nulls."""
    pairs = [("1", "1.000001"), ("true", "1"), ("NaN", "NaN"), ('"a"', '"b"'), (None, None)]
    pick = [F.element_at(F.array(*(F.lit(p[k]).cast("string") for p in pairs)), (F.col("p_size") % 5 + 1).cast("int")) for k in (0, 1)]
    return table(spark, sf_dir, "part").select("p_partkey", bundles.compare_json(*pick).alias("same"))


# -------------------------------------------------------------------- gridded data


CELLS = f"(SELECT variable_id, year, month, lat, lon, max(value) AS value, max(area) AS area FROM {GRID} GROUP BY ALL)"


def cells(spark, sf_dir) -> DataFrame:
    """One value per cell and month."""
    return grid(spark, sf_dir).groupBy("variable_id", "year", "month", "lat", "lon").agg(F.max("value").alias("value"), F.max("area").alias("area"))


def yearly(spark, sf_dir, name="value") -> DataFrame:
    return grid(spark, sf_dir).groupBy("variable_id", "year").agg(F.avg("value").alias(name))


YEARLY = f"(SELECT variable_id, year, avg(value) AS value FROM {GRID} GROUP BY 1, 2)"


@query(f"SELECT variable_id, (year * 12 + month - 1) // 12 AS block, round(avg(value), 4) AS value FROM {GRID} GROUP BY 1, 2")
def coarse_time(spark, sf_dir):
    return gridded.coarsen_time(grid(spark, sf_dir), ["variable_id"]).withColumn("value", F.round("value", 4))


@query(f"SELECT variable_id, lat, lon, round({MEAN}, 4) AS value FROM {GRID} GROUP BY 1, 2, 3")
def already_coarse_grid(spark, sf_dir):
    """A grid that is coarse enough keeps its cells."""
    return gridded.coarsen(grid(spark, sf_dir), ["variable_id"], 2.0).select("variable_id", "lat", "lon", F.round("value", 4).alias("value"))


@query(f"SELECT variable_id, year, month, count(*) AS n FROM (SELECT *, CASE WHEN month <> 2 THEN value END AS v FROM {GRID}) GROUP BY ALL HAVING count(v) > 0")
def valid_times(spark, sf_dir):
    df = grid(spark, sf_dir).withColumn("value", F.when(F.col("month") != 2, F.col("value")))
    return gridded.valid_times(df, ["variable_id"]).groupBy("variable_id", "year", "month").agg(F.count("*").alias("n"))


@query(f"SELECT variable_id, year, month, lat, lon, min(o) AS o FROM (SELECT *, CASE WHEN area > 25 THEN 1 ELSE 2 END AS o FROM {GRID}) GROUP BY ALL")
def files_concatenated(spark, sf_dir):
    df = grid(spark, sf_dir).withColumn("o", F.when(F.col("area") > 25, 1).otherwise(2))
    return gridded.concatenated(df, ["variable_id"], "o").select("variable_id", "year", "month", "lat", "lon", "o")


@query(f"SELECT variable_id, count(*) AS n FROM {GRID} WHERE lat > 0 AND lon < 200 GROUP BY 1")
def masked_cells(spark, sf_dir):
    df = grid(spark, sf_dir)
    mask = df.select("lat", "lon").distinct().withColumn("fraction", F.when((F.col("lat") > 0) & (F.col("lon") < 200), 0.7).otherwise(0.2))
    return gridded.masked(df, mask).groupBy("variable_id").agg(F.count("*").alias("n"))


@query(f"WITH a AS (SELECT variable_id, year, value AS n, value * 0.5 + year AS t FROM {YEARLY}) SELECT variable_id, round(regr_slope(n, t), 4) AS lambda, round(-regr_intercept(n, t) / regr_slope(n, t) / 2, 1) AS ecs FROM a GROUP BY 1")
def climate_sensitivity(spark, sf_dir):
    y = yearly(spark, sf_dir)
    found = diagnostics.climate_sensitivity(y.withColumnRenamed("value", "anomaly"), y.select("variable_id", "year", (F.col("value") * 0.5 + F.col("year")).alias("anomaly")), ["variable_id"])
    return found.select("variable_id", F.round("lambda", 4).alias("lambda"), F.round("ecs", 1).alias("ecs"))


@query(f"WITH y AS {YEARLY}, f AS (SELECT variable_id, regr_slope(value, year) AS s, regr_intercept(value, year) AS i FROM y GROUP BY 1) SELECT y.variable_id, round(avg(2 * value - s * year - i), 3) AS tcr FROM y JOIN f ON y.variable_id = f.variable_id WHERE year BETWEEN 1997 AND 1999 GROUP BY 1")
def transient_response(spark, sf_dir):
    y = yearly(spark, sf_dir)
    return diagnostics.transient_response(y.withColumn("value", F.col("value") * 2), y, ["variable_id"], 1997, 1999).withColumn("tcr", F.round("tcr", 3))


@query(f"WITH y AS (SELECT *, sum(value) OVER (PARTITION BY variable_id ORDER BY year) AS total FROM {YEARLY}) SELECT variable_id, round(max_by(value / total, year), 6) AS tcre FROM y WHERE total <> 0 GROUP BY 1")
def response_to_emissions(spark, sf_dir):
    y = yearly(spark, sf_dir)
    return diagnostics.response_to_emissions(y.withColumnRenamed("value", "anomaly"), y, ["variable_id"]).withColumn("tcre", F.round("tcre", 6))


@query(f"WITH y AS {YEARLY} SELECT variable_id, round(avg(value) FILTER (year BETWEEN 1999 AND 2000) - avg(value) FILTER (year < 1998), 4) AS zec FROM y GROUP BY 1")
def zero_emission_commitment(spark, sf_dir):
    y = yearly(spark, sf_dir)
    return diagnostics.zero_emission_commitment(y, y.where("year < 1998"), ["variable_id"], 1999, 2000).withColumn("zec", F.round("zec", 4))


@query(f"""
WITH c AS (SELECT variable_id, lat, lon, month, avg(value) AS value FROM {GRID} GROUP BY ALL), r AS (SELECT * FROM c WHERE variable_id = 'A')
SELECT c.variable_id, round(avg(c.value - r.value), 4) AS bias, round(sqrt(avg(power(c.value - r.value, 2))), 4) AS rmse, round(corr(c.value, r.value), 6) AS correlation FROM c JOIN r ON c.lat = r.lat AND c.lon = r.lon AND c.month = r.month WHERE c.variable_id <> 'A' GROUP BY 1
""")
def pattern_statistics(spark, sf_dir):
    c = grid(spark, sf_dir).groupBy("variable_id", "lat", "lon", "month").agg(F.avg("value").alias("value"))
    found = diagnostics.pattern_statistics(c.where("variable_id <> 'A'"), c.where("variable_id = 'A'"), ["variable_id"])
    return found.select("variable_id", F.round("bias", 4).alias("bias"), F.round("rmse", 4).alias("rmse"), F.round("correlation", 6).alias("correlation"))


@query(f"WITH m AS (SELECT variable_id, year, month, avg(value) AS value FROM {GRID} GROUP BY ALL), w AS (SELECT *, lag(value) OVER (PARTITION BY variable_id ORDER BY year, month) AS before FROM m) SELECT variable_id, round(stddev_pop(value), 4) AS amplitude, round(corr(value, before), 6) AS persistence FROM w GROUP BY 1")
def index_statistics(spark, sf_dir):
    m = grid(spark, sf_dir).groupBy("variable_id", "year", "month").agg(F.avg("value").alias("value"))
    return diagnostics.index_statistics(m, ["variable_id"]).select("variable_id", F.round("amplitude", 4).alias("amplitude"), F.round("persistence", 6).alias("persistence"))


@query(f"""
WITH b AS (SELECT *, 'north' AS region FROM {GRID} WHERE lat >= 0 AND lat < 90 UNION ALL SELECT *, 'west' FROM {GRID} WHERE lon >= 0 AND lon < 180), m AS (SELECT variable_id, region, year, month, {MEAN} AS value FROM b GROUP BY ALL),
y AS (SELECT variable_id, region, year, avg(value) AS value FROM m GROUP BY ALL), base AS (SELECT variable_id, region, avg(value) AS base FROM y WHERE year BETWEEN 1996 AND 1998 GROUP BY ALL)
SELECT y.variable_id, y.region, y.year, round(value - base, 3) AS anomaly FROM y JOIN base ON y.variable_id = base.variable_id AND y.region = base.region
""")
def regional_timeseries(spark, sf_dir):
    boxes = spark.createDataFrame([("north", 0.0, 90.0, -1000.0, 1000.0), ("west", -90.0, 90.1, 0.0, 180.0)], "region string, lat_min double, lat_max double, lon_min double, lon_max double")
    found = diagnostics.regional_timeseries(grid(spark, sf_dir), boxes, ["variable_id"], 1996, 1998)
    return found.select("variable_id", "region", "year", F.round("anomaly", 3).alias("anomaly"))


@query("SELECT l_suppkey % 18 * 10 - 85 AS lat, round(avg(l_quantity - l_tax), 5) AS swcre, round(avg(l_discount - l_tax), 5) AS lwcre FROM lineitem GROUP BY 1")
def cloud_effects(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 18 * 10 - 85).alias("lat"), F.col("l_tax").alias("rsut"), F.col("l_quantity").alias("rsutcs"), F.col("l_tax").alias("rlut"), F.col("l_discount").alias("rlutcs"))
    return diagnostics.cloud_effects(df, []).withColumns({c: F.round(c, 5) for c in ("swcre", "lwcre")})


@query(f"""
WITH c AS {CELLS}, b AS (SELECT variable_id, year, month, {MEAN} AS value FROM (SELECT variable_id, year, month, value, coalesce(area, cos(radians(lat))) AS area FROM c WHERE lat BETWEEN -5 AND 5 AND lon BETWEEN 190 AND 240) GROUP BY ALL),
u AS (SELECT variable_id, month, avg(value) AS usual FROM b GROUP BY ALL), i AS (SELECT b.variable_id, b.year, b.month, value - usual AS x FROM b JOIN u ON b.variable_id = u.variable_id AND b.month = u.month)
SELECT c.variable_id, c.lat, c.lon, count(*) AS n, round(regr_slope(value, x), 3) AS slope FROM c JOIN i ON c.variable_id = i.variable_id AND c.year = i.year AND c.month = i.month GROUP BY ALL
""")
def enso_teleconnection(spark, sf_dir):
    c = cells(spark, sf_dir)
    found = diagnostics.enso_teleconnection(c, c, ["variable_id"])
    return found.select("variable_id", "lat", "lon", "n", F.round("slope", 3).alias("slope"))


@query(f"""
WITH c AS {CELLS}, r AS (SELECT c.variable_id, c.lat, c.lon, c.month, c.value, c.area, o.value AS ref FROM c JOIN c o ON o.variable_id = 'A' AND c.lat = o.lat AND c.lon = o.lon AND c.year = o.year AND c.month = o.month WHERE c.variable_id <> 'A'),
k AS (SELECT variable_id, lat, lon, avg(value) - avg(ref) AS bias, stddev_pop(ref) AS spread, avg(power(value - ref, 2)) AS square, max(area) AS area FROM r GROUP BY ALL HAVING stddev_pop(ref) > 0),
p AS (SELECT variable_id, lat, lon, month, avg(value) AS m, avg(ref) AS r FROM r GROUP BY ALL), q AS (SELECT variable_id, lat, lon, max_by(month, (m, month)) - max_by(month, (r, month)) AS shift FROM p GROUP BY ALL),
s AS (SELECT k.*, exp(-abs(bias) / spread) AS b, exp(-sqrt(greatest(square - bias * bias, 0)) / spread) AS e, (1 + cos(2 * pi() * least(abs(shift), 12 - abs(shift)) / 12)) / 2 AS t, 1.0 AS w FROM k JOIN q ON k.variable_id = q.variable_id AND k.lat = q.lat AND k.lon = q.lon)
SELECT variable_id, round(avg(b), 5) AS bias_score, round(avg(e), 5) AS rmse_score, round(avg(t), 5) AS season_score, round((avg(b) + 2 * avg(e) + avg(t)) / 4, 5) AS overall FROM s GROUP BY 1
""")
def standard_scores(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("area", F.lit(1.0))
    found = diagnostics.standard_scores(c.where("variable_id <> 'A'"), c.where("variable_id = 'A'"), ["variable_id"])
    return found.select("variable_id", *(F.round(n, 5).alias(n) for n in ("bias_score", "rmse_score", "season_score", "overall")))


# -------------------------------------------------------- baselines and result files


@query("""
WITH c AS (SELECT *, p_partkey % 11 <> 0 AS managed, p_partkey % 7 <> 0 AS base, p_partkey % 13 <> 0 AS bundle_ok, p_partkey % 17 <> 0 AS inputs_ok, CASE WHEN p_size % 5 <> 0 THEN p_size % 3 END AS code, p_size % 2 + 1 AS d, p_partkey % 2 + 1 AS bd,
  p_partkey % 3 AS v, p_size % 3 AS bv, p_size % 4 = 0 AS same, p_partkey % 5 < 3 AS native, p_size % 7 = 0 AS changed, p_partkey % 19 < 9 AS touched FROM part)
SELECT p_partkey, CASE WHEN NOT managed AND base THEN 'fail' WHEN NOT managed THEN 'skip' WHEN NOT bundle_ok OR NOT inputs_ok THEN 'fail' WHEN code <> d THEN 'fail' WHEN NOT base THEN CASE WHEN native THEN 'replay' ELSE 'skip' END
  WHEN v < bv OR d < bd THEN 'fail' WHEN v > bv THEN CASE WHEN native THEN 'replay' ELSE 'skip' END WHEN NOT same THEN 'fail' WHEN changed OR touched THEN CASE WHEN native THEN 'replay' ELSE 'skip' END ELSE 'skip' END AS action FROM c
""")
def regression_gate(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size")
    bundle = F.create_map(F.lit("a.json"), F.lit("x"))
    native = F.when(k % 5 < 3, F.create_map(F.lit("n.nc"), F.lit("y"))).otherwise(F.create_map().cast("map<string,string>"))
    cases = table(spark, sf_dir, "part").select(
        "p_partkey", (k % 11 != 0).alias("managed"), (k % 7 != 0).alias("base_managed"), (k % 13 != 0).alias("committed_ok"), (k % 17 != 0).alias("catalog_ok"), (k % 19 < 9).alias("extraction_changed"), F.when(n % 5 != 0, n % 3).alias("code_version"),
        (n % 2 + 1).alias("diagnostic_version"), (k % 2 + 1).alias("base_diagnostic_version"), (k % 3).alias("case_version"), (n % 3).alias("base_case_version"), bundle.alias("committed"),
        F.when(n % 4 == 0, bundle).otherwise(F.create_map(F.lit("a.json"), F.lit("z"))).alias("base_committed"), native.alias("native"), F.when(n % 7 == 0, F.create_map(F.lit("n.nc"), F.lit("w"))).otherwise(native).alias("base_native"),
    )
    return regression.gate(cases).select("p_partkey", "action")


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '/res/out/' || s_suppkey || '/f.png' WHEN 1 THEN '/res/f.png' WHEN 3 THEN '/res/x' END AS path FROM supplier")
def artefact_paths(spark, sf_dir):
    """Paths with dots, one that leads out, and one from the top that leads in again."""
    k = F.col("s_suppkey")
    fragment = F.when(k % 4 == 0, F.concat(F.lit("out/./"), k)).when(k % 4 == 1, "a/..").when(k % 4 == 2, "../res2").otherwise("/res/y/..")
    return table(spark, sf_dir, "supplier").select("s_suppkey", regression.inside("/res", fragment, F.when(k % 4 == 3, "x").otherwise("f.png")).alias("path"))


@query("""
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'The bias score for ' || s_name || ' over the Northern region.' WHEN 1 THEN 'The distribution of pr for the reference data' WHEN 2 THEN '' ELSE 'The RMSE over the xx region.' END AS caption,
  CASE s_suppkey % 4 WHEN 0 THEN 'Bias score' WHEN 1 THEN 'Distribution|pr' WHEN 3 THEN 'RMSE' END AS statistic, CASE s_suppkey % 4 WHEN 0 THEN 'model' WHEN 1 THEN 'reference' WHEN 3 THEN 'model' END AS kind FROM supplier
""")
def figure_captions(spark, sf_dir):
    k = F.col("s_suppkey") % 4
    name = F.when(k == 0, F.concat("s_name", F.lit("_nh_biasscore.png"))).when(k == 1, "Reference_nan_distribution-pr.png").when(k == 2, "m_nh_other.png").otherwise("None_xx_rmse.png")
    figures = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("plots/"), name).alias("file"))
    regions = spark.createDataFrame([("nh", "Northern")], "region string, name string")
    return regression.captions(figures, regions).select("s_suppkey", "caption", "statistic", "kind")


# ------------------------------------------------------------------------- running

STARTED = """
WITH p AS (SELECT *, split_part(p_name, ' ', 1) AS variable_id FROM part WHERE p_size > 10),
q AS (SELECT p_brand AS source_id, l_returnflag AS statistic, sum(l_quantity) AS value FROM p JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2),
g AS (SELECT DISTINCT p_brand AS source_id FROM p),
e AS (SELECT d, source_id, d = 'quantity' OR (d = 'strict' AND source_id <> 'Brand#13') AS successful, d = 'unreachable' AS dirty FROM g, (VALUES ('quantity'), ('strict'), ('unreachable')) t(d) WHERE d <> 'unreachable' OR source_id IN ('Brand#1', 'Brand#2'))
"""


def run_brands(spark, sf_dir):
    """Three diagnostics over the brands of parts: one runs, one fails on a brand, one never reaches its data."""
    models = part_datasets(spark, sf_dir).withColumn("instance_id", F.col("row_id").cast("string")).where("size > 10")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("dataset_id"), "l_returnflag", "l_quantity")

    def quantity(inputs, _):
        rows = inputs["cmip6"].join(lines, "dataset_id").groupBy("execution_id", F.col("l_returnflag").alias("statistic")).agg(F.sum("l_quantity").alias("value"))
        outputs = inputs["cmip6"].groupBy("execution_id").agg(F.lit("data").alias("output_type"), F.lit("sums").alias("short_name"), F.concat(F.lit("sums/"), F.min("source_id")).alias("filename"))
        return runner.Findings(scalars=rows, outputs=outputs)

    def strict(inputs, part):
        wrong = F.when(F.col("source_id") == "Brand#13", F.raise_error(F.lit("no such brand")).cast("string")).otherwise(F.col("source_id"))
        return quantity({"cmip6": inputs["cmip6"].withColumn("source_id", wrong)}, part)

    def unreachable(inputs, _):
        raise TimeoutError("storage does not answer")

    def need(*brands):
        return ((DataRequirement("cmip6", ({"source_id": brands},) if brands else (), ("source_id",)),),)

    d = [Diagnostic("p", "quantity", need(), execute=quantity), Diagnostic("p", "strict", need(), execute=strict), Diagnostic("p", "unreachable", need("Brand#1", "Brand#2"), execute=unreachable)]
    none = spark.createDataFrame([], "id long, provider string, diagnostic string, diagnostic_version int, dataset_key string, dirty boolean")
    runs = spark.createDataFrame([], "id long, group_id long, dataset_hash string, successful boolean, created_at timestamp_ntz")
    return runner.solve_and_run(d, {"cmip6": models}, none, runs, now(), ["statistic"])


@query(STARTED + "SELECT d AS diagnostic, 'cmip6_' || e.source_id AS dataset_key, successful, dirty, statistic, value FROM e LEFT JOIN q ON e.source_id = q.source_id AND e.successful")
def run_solved(spark, sf_dir):
    """From the catalogue to values: every execution's state, its group's flag, and what it gave."""
    done, marked, store = run_brands(spark, sf_dir)
    groups_of = marked.select(F.col("id").alias("group_id"), "diagnostic", "dataset_key", "dirty")
    rows = done.join(groups_of, "group_id").join(store.read("values"), F.col("id") == F.col("execution_id"), "left")
    return rows.select("diagnostic", "dataset_key", "successful", "dirty", "statistic", "value")


# ---------------------------------------------------------------------- other grids


def coarse_cells(spark, sf_dir):
    """Nations as a grid of five latitudes and five longitudes."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select((n % 5 * 36 - 72).cast("double").alias("lat"), (F.floor(n / 5) * 72 + 36).cast("double").alias("lon"))


#: Cells' borders, halfway to the neighbours; longitudes go round from 50 to 350 in steps of 50.
REGRIDDED = f"""
c AS MATERIALIZED {CELLS}, s AS (SELECT DISTINCT lat FROM c), t(lat) AS (SELECT DISTINCT n_nationkey % 5 * 36 - 72.0 FROM nation), u(lon) AS (SELECT DISTINCT n_nationkey // 5 * 72 + 36.0 FROM nation),
b AS (SELECT lat, lag(lat) OVER (ORDER BY lat) AS p, lead(lat) OVER (ORDER BY lat) AS q FROM s), e AS (SELECT lat, greatest(lat - coalesce(lat - p, q - lat) / 2, -90) AS lo, least(lat + coalesce(q - lat, lat - p) / 2, 90) AS hi FROM b),
y AS (SELECT e.lat, t.lat AS tlat, sin(radians(least(hi, t.lat + 18))) - sin(radians(greatest(lo, t.lat - 18))) AS w FROM e, t WHERE least(hi, t.lat + 18) > greatest(lo, t.lat - 18)),
g(lon, lo, hi) AS (VALUES (50, 20, 75), (100, 75, 125), (150, 125, 175), (200, 175, 225), (250, 225, 275), (300, 275, 325), (350, 325, 360), (350, 0, 20)),
x AS (SELECT g.lon, u.lon AS tlon, radians(sum(least(hi, u.lon + 36) - greatest(lo, u.lon - 36))) AS w FROM g, u WHERE least(hi, u.lon + 36) > greatest(lo, u.lon - 36) GROUP BY 1, 2),
r AS MATERIALIZED (SELECT variable_id, year, month, tlat AS lat, tlon AS lon, sum(value * y.w * x.w) / sum(y.w * x.w) AS value, sum(y.w * x.w) AS area,
  sum(y.w * x.w) / ((sin(radians(tlat + 18)) - sin(radians(tlat - 18))) * radians(72)) AS cover FROM c JOIN y ON c.lat = y.lat JOIN x ON c.lon = x.lon WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4, 5)"""


@query(f"WITH {REGRIDDED} SELECT variable_id, year, month, lat, lon, round(value, 3) AS value, round(area, 6) AS area, round(least(cover, 1), 5) AS cover FROM r")
def regridded(spark, sf_dir):
    """Cells of ten by fifty degrees as areas of cells of 36 by 72."""
    rows = regrid.regrid(cells(spark, sf_dir), coarse_cells(spark, sf_dir), ["variable_id", "year", "month"])
    return rows.select("variable_id", "year", "month", "lat", "lon", F.round("value", 3).alias("value"), F.round("area", 6).alias("area"), F.round("cover", 5).alias("cover"))


@query(f"""WITH {REGRIDDED}, k AS (SELECT lat, min(hi) AS hi, min(lo) AS lo FROM e GROUP BY 1)
SELECT variable_id, year, month, round(sum(value * (sin(radians(hi)) - sin(radians(lo))) * CASE lon WHEN 350 THEN radians(55) WHEN 50 THEN radians(55) ELSE radians(50) END) / 1000, 4) AS total FROM c JOIN k USING (lat) GROUP BY 1, 2, 3""")
def conserved_sums(spark, sf_dir):
    """Sums of value times area after regridding; the SQL has those of the cells before."""
    rows = regrid.regrid(cells(spark, sf_dir), coarse_cells(spark, sf_dir), ["variable_id", "year", "month"])
    return rows.groupBy("variable_id", "year", "month").agg(F.round(F.sum(F.col("value") * F.col("area")) / 1000, 4).alias("total"))


@query(f"""
WITH {REGRIDDED}, m AS (SELECT a.*, o.value AS ref FROM r a JOIN r o ON o.variable_id = 'A' AND a.lat = o.lat AND a.lon = o.lon AND a.year = o.year AND a.month = o.month WHERE a.variable_id <> 'A' AND a.cover >= 0.1 AND o.cover >= 0.1),
k AS (SELECT variable_id, lat, lon, avg(value) AS mv, avg(ref) AS rv, avg(value) - avg(ref) AS bias, stddev_pop(ref) AS spread, avg(power(value - ref, 2)) AS square, first(area) AS a1 FROM m GROUP BY ALL HAVING stddev_pop(ref) > 0),
p AS (SELECT variable_id, lat, lon, month, avg(value) AS mv, avg(ref) AS rv, count(*) AS n, sum(value * value) AS m2, sum(ref * ref) AS r2 FROM m GROUP BY ALL),
q AS (SELECT variable_id, lat, lon, max_by(month, (mv, month)) - max_by(month, (rv, month)) AS shift, sqrt(greatest(sum(m2 - n * mv * mv) / sum(n), 0)) AS ml, sqrt(greatest(sum(r2 - n * rv * rv) / sum(n), 0)) AS rl FROM p GROUP BY ALL),
z AS (SELECT k.*, cos(radians(k.lat)) AS w, exp(-abs(bias) / spread) AS b, exp(-sqrt(greatest(square - bias * bias, 0)) / spread) AS e, (1 + cos(2 * pi() * least(abs(shift), 12 - abs(shift)) / 12)) / 2 AS t, CASE WHEN rl > 1e-6 * spread THEN exp(-abs(ml - rl) / rl) END AS i
  FROM k JOIN q ON k.variable_id = q.variable_id AND k.lat = q.lat AND k.lon = q.lon),
f AS (SELECT variable_id, sum(w * b) / sum(w) AS b, sum(w * e) / sum(w) AS e, sum(w * t) / sum(w) AS t, sum(w * i) / sum(CASE WHEN i IS NOT NULL THEN w END) AS i, sqrt(sum(w * mv * mv) / sum(w) - power(sum(w * mv) / sum(w), 2)) AS sm, sqrt(sum(w * rv * rv) / sum(w) - power(sum(w * rv) / sum(w), 2)) AS sr,
  sum(w * mv * rv) / sum(w) - sum(w * mv) / sum(w) * sum(w * rv) / sum(w) AS j FROM z GROUP BY 1)
SELECT variable_id, round(b, 4) AS bias_score, round(e, 4) AS rmse_score, round(t, 4) AS season_score, round(i, 4) AS interannual_score, round(2 * (1 + j / (sm * sr)) / power(sm / sr + sr / sm, 2), 4) AS spatial_score,
  round((b + 2 * e + t + coalesce(i, 0) + 2 * (1 + j / (sm * sr)) / power(sm / sr + sr / sm, 2)) / CASE WHEN i IS NULL THEN 5 ELSE 6 END, 4) AS overall FROM f
""")
def benchmark_scores(spark, sf_dir):
    """Scores of two variables against a third after all have come to the coarse grid; cells count by the cosine of latitude."""
    c = cells(spark, sf_dir)
    found = benchmarks.benchmark_scores(c.where("variable_id <> 'A'"), c.where("variable_id = 'A'").drop("variable_id"), ["variable_id"], coarse_cells(spark, sf_dir), 0.1)
    names = ("bias_score", "rmse_score", "season_score", "interannual_score", "spatial_score", "overall")
    return found.select("variable_id", *(F.round(n, 4).alias(n) for n in names))


# ------------------------------------------------------------------ regions and modes


def tiles(spark, sf_dir):
    """Nations as 25 slanted tiles of the globe."""
    n = F.col("n_nationkey")
    low, west = (n % 5 * 36 - 90).cast("double"), F.floor(n / 5) * 72.0
    point = lambda lat, lon: F.struct(lat.alias("lat"), lon.alias("lon"))
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("t"), n).alias("region"), F.array(point(low, west), point(low, west + 72), point(low + 36, west + 92), point(low + 36, west + 20)).alias("ring"))


def _east_of(border: str) -> str:
    """The area east of a border under lon = a + b * lat, from l to h."""
    whole = lambda y: f"((a - ({border}) + b * ({y})) * sin({y}) + b * cos({y}))"
    return f"({whole('h')} - {whole(f'least(greatest((({border}) - a) / b, l), h)')})"


COVER = f"""
c AS MATERIALIZED {CELLS}, k AS (SELECT DISTINCT lat, lon FROM c), la AS (SELECT DISTINCT lat FROM k), b1 AS (SELECT lat, lag(lat) OVER (ORDER BY lat) AS p, lead(lat) OVER (ORDER BY lat) AS q FROM la),
e AS (SELECT lat, greatest(lat - coalesce(lat - p, q - lat) / 2, -90) AS south, least(lat + coalesce(q - lat, lat - p) / 2, 90) AS north FROM b1), g(lon, west, east) AS (VALUES (50, 20, 75), (100, 75, 125), (150, 125, 175), (200, 175, 225), (250, 225, 275), (300, 275, 325), (350, 325, 380)),
cell AS (SELECT k.lat, k.lon, south, north, west, east FROM k JOIN e ON k.lat = e.lat JOIN g ON k.lon = g.lon),
line AS (SELECT 't' || n_nationkey AS region, n_nationkey % 5 * 36 - 90 AS y1, n_nationkey % 5 * 36 - 54 AS y2, n_nationkey // 5 * 72 + x.d AS x1, x.s, 20 / radians(36) AS b FROM nation, (VALUES (72, 1), (0, -1)) x(d, s)),
pair AS (SELECT region, lat, lon, west + t AS west, east + t AS east, s, b, x1 - b * radians(y1) AS a, radians(greatest(south, y1)) AS l, radians(least(north, y2)) AS h, (east - west) * (sin(radians(north)) - sin(radians(south))) AS size
  FROM cell, line, (VALUES (-360), (0), (360)) turns(t) WHERE least(north, y2) > greatest(south, y1)),
cover AS MATERIALIZED (SELECT region, lat, lon, sum(s * ({_east_of("west")} - {_east_of("east")}) / size) AS cover FROM pair GROUP BY ALL HAVING abs(sum(s * ({_east_of("west")} - {_east_of("east")}) / size)) > 1e-9),
mean AS (SELECT variable_id, region, year, month, sum(CASE WHEN value IS NOT NULL THEN value * coalesce(area, cos(radians(lat))) * cover END) / sum(CASE WHEN value IS NOT NULL THEN coalesce(area, cos(radians(lat))) * cover END) AS value FROM c JOIN cover USING (lat, lon) GROUP BY ALL)"""


def covered(spark, sf_dir):
    c = cells(spark, sf_dir)
    grid_of = regions.grid_cells(c)
    return c, grid_of, regions.region_cover(grid_of, tiles(spark, sf_dir))


@query(f"WITH {COVER} SELECT region, lat, lon, round(cover, 6) AS cover FROM cover UNION ALL SELECT 'ocean', lat, lon, round(1 - sum(CASE WHEN region IN ('t3', 't17') THEN 0 ELSE cover END), 6) FROM cover GROUP BY lat, lon HAVING 1 - sum(CASE WHEN region IN ('t3', 't17') THEN 0 ELSE cover END) > 1e-9")
def region_shares(spark, sf_dir):
    """The share of every cell in every tile, and what is left of a cell without two of them."""
    _, grid_of, cover = covered(spark, sf_dir)
    rest = regions.with_rest(cover.where("region not in ('t3', 't17')"), grid_of).where("region = 'ocean'")
    return cover.unionByName(rest).select("region", "lat", "lon", F.round("cover", 6).alias("cover"))


@query(f"WITH {COVER}, y AS (SELECT variable_id, region, year, avg(value) AS value FROM mean GROUP BY ALL) SELECT variable_id, region, round(regr_slope(value, year), 3) AS slope, count(*) AS n FROM y GROUP BY 1, 2")
def region_trends(spark, sf_dir):
    c, _, cover = covered(spark, sf_dir)
    return regions.regional_trends(c, cover, ["variable_id"]).select("variable_id", "region", F.round("slope", 3).alias("slope"), "n")


@query(f"WITH {COVER} SELECT variable_id, region, month, round(avg(value), 3) AS value FROM mean GROUP BY ALL")
def region_cycles(spark, sf_dir):
    c, _, cover = covered(spark, sf_dir)
    return regions.regional_cycle(c, cover, ["variable_id"]).select("variable_id", "region", "month", F.round("value", 3).alias("value"))


@query(f"WITH {COVER}, y AS (SELECT variable_id, region, year, avg(value) AS value FROM mean GROUP BY ALL), b AS (SELECT variable_id, region, avg(value) AS base FROM y WHERE year BETWEEN 1993 AND 1995 GROUP BY ALL) SELECT variable_id, region, year, round(value - base, 3) AS anomaly FROM y JOIN b USING (variable_id, region)")
def region_anomalies(spark, sf_dir):
    c, _, cover = covered(spark, sf_dir)
    return regions.regional_anomalies(c, cover, ["variable_id"], 1993, 1995).select("variable_id", "region", "year", F.round("anomaly", 3).alias("anomaly"))


@query(f"WITH {COVER}, m AS (SELECT lat, lon, least(sum(cover), 1) AS fraction FROM cover WHERE region IN ('t1', 't2', 't6', 't7') GROUP BY ALL HAVING least(sum(cover), 1) >= 0.5) SELECT variable_id, year, count(*) AS n, round(sum(value), 2) AS total FROM c JOIN m USING (lat, lon) GROUP BY 1, 2")
def region_mask(spark, sf_dir):
    """Cells of which four tiles hold at least half."""
    c, _, cover = covered(spark, sf_dir)
    kept = gridded.masked(c, regions.mask(cover, ["t1", "t2", "t6", "t7"]), 0.5)
    return kept.groupBy("variable_id", "year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""
WITH c AS (SELECT l_suppkey, year(l_shipdate) AS year, l_linenumber * 15000.0 AS p, CASE WHEN max(l_quantity) < 48 THEN max(l_extendedprice) END AS v FROM lineitem GROUP BY ALL), t(lev) AS (VALUES (20000.0), (45000.0), (97000.0)),
s AS (SELECT l_suppkey, year, lev, max(p) FILTER (p <= lev) AS p0, min(p) FILTER (p >= lev) AS p1, arg_max(coalesce(v, 'NaN'::DOUBLE), p) FILTER (p <= lev) AS v0, arg_min(coalesce(v, 'NaN'::DOUBLE), p) FILTER (p >= lev) AS v1 FROM c, t GROUP BY ALL)
SELECT l_suppkey, CAST(year AS INTEGER) AS year, CAST(lev AS DOUBLE) AS lev, round(CASE WHEN p0 = p1 THEN CASE WHEN NOT isnan(v0) THEN v0 END WHEN NOT isnan(v0) AND NOT isnan(v1) THEN v0 + (ln(lev) - ln(p0)) / (ln(p1) - ln(p0)) * (v1 - v0) END, 3) AS value FROM s
""")
def level_values(spark, sf_dir):
    """Suppliers' lines as columns of air; a line with a large quantity lacks its value."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"), (F.col("l_linenumber") * 15000.0).alias("lev")).agg(F.when(F.max("l_quantity") < 48, F.max("l_extendedprice")).alias("value"))
    found = levels.at_levels(rows, ["l_suppkey", "year"], [20000.0, 45000.0, 97000.0])
    return found.select("l_suppkey", "year", "lev", F.round("value", 3).alias("value"))


@query(f"""
WITH c AS {CELLS}, k AS (SELECT variable_id, lat, lon, month, avg(value) AS v FROM c GROUP BY ALL), d AS (SELECT *, CASE month WHEN 2 THEN 28.25 WHEN 4 THEN 30 WHEN 6 THEN 30 WHEN 9 THEN 30 WHEN 11 THEN 30 ELSE 31 END AS days FROM k WHERE v IS NOT NULL),
q(season, first, last, months) AS (VALUES ('DJF', 12, 2, 3), ('MAM', 3, 5, 3), ('JJA', 6, 8, 3), ('SON', 9, 11, 3), ('AC', 1, 12, 12)),
s AS (SELECT variable_id, lat, lon, season, sum(v * days) / sum(days) AS v FROM d JOIN q ON CASE WHEN first <= last THEN month BETWEEN first AND last ELSE month >= first OR month <= last END GROUP BY variable_id, lat, lon, season, months HAVING count(*) = months),
r(region, low, high) AS (VALUES ('global', -90, 90.1), ('NHEX', 30, 90.1), ('SHEX', -90, -30), ('TROPICS', -30, 30)),
p AS (SELECT a.variable_id, region, season, cos(radians(lat)) AS w, a.v AS m, b.v AS o FROM s a JOIN s b USING (lat, lon, season) JOIN r ON lat >= low AND lat < high WHERE a.variable_id <> 'A' AND b.variable_id = 'A'),
f AS (SELECT variable_id, region, season, sum((m - o) * w) / sum(w) AS bias, sum(abs(m - o) * w) / sum(w) AS mae, sqrt(sum((m - o) * (m - o) * w) / sum(w)) AS rms, sum(m * w) / sum(w) AS a, sum(o * w) / sum(w) AS b, sum(m * m * w) / sum(w) AS mm, sum(o * o * w) / sum(w) AS oo, sum(m * o * w) / sum(w) AS mo FROM p GROUP BY ALL)
SELECT variable_id, region, season, round(bias, 3) AS bias_xy, round(mae, 3) AS mae_xy, round(rms, 3) AS rms_xy, round(sqrt(greatest(rms * rms - bias * bias, 0)), 2) AS rmsc_xy, round(CASE WHEN mm - a * a > 1e-12 * mm AND oo - b * b > 1e-12 * oo THEN (mo - a * b) / (sqrt(mm - a * a) * sqrt(oo - b * b)) END, 4) AS cor_xy FROM f
""")
def annual_cycle_statistics(spark, sf_dir):
    """Seasonal statistics of two variables against a third by bands of latitude."""
    clim = cells(spark, sf_dir).groupBy("variable_id", "lat", "lon", "month").agg(F.avg("value").alias("value")).withColumn("level", F.lit(0.0))
    found = annual_cycle.statistics(clim.where("variable_id <> 'A'"), clim.where("variable_id = 'A'").drop("variable_id"), ["variable_id"])
    digits = {"bias_xy": 3, "mae_xy": 3, "rms_xy": 3, "rmsc_xy": 2, "cor_xy": 4}
    return found.groupBy("variable_id", "region", "season").agg(*(F.round(F.max(F.when(F.col("statistic") == n, F.col("value"))), k).alias(n) for n, k in digits.items()))


def yearly_field(spark, sf_dir):
    """Each cell's yearly means minus the mean of its years, time being the year."""
    y = cells(spark, sf_dir).where("value is not null").groupBy("variable_id", "lat", "lon", F.col("year").alias("time")).agg(F.avg("value").alias("v"))
    usual = y.groupBy("variable_id", "lat", "lon").agg(F.avg("v").alias("u"))
    return y.join(usual, ["variable_id", "lat", "lon"]).select("variable_id", "lat", "lon", "time", (F.col("v") - F.col("u")).alias("value"))


FIELD = f"c AS {CELLS}, y AS (SELECT variable_id, lat, lon, year AS time, avg(value) AS v FROM c WHERE value IS NOT NULL GROUP BY ALL), a AS (SELECT *, v - avg(v) OVER (PARTITION BY variable_id, lat, lon) AS value, count(*) OVER (PARTITION BY variable_id, lat, lon) AS n FROM y)"


@query(f"WITH {FIELD}, t AS (SELECT variable_id, count(DISTINCT time) AS times FROM y GROUP BY 1) SELECT variable_id, CAST(times AS INTEGER) AS modes, round(sum(value * value * cos(radians(lat))) / 1e6, 3) AS variance, 1.0::DOUBLE AS share FROM a JOIN t USING (variable_id) WHERE n = times GROUP BY 1, 2")
def mode_variance(spark, sf_dir):
    """All modes of a field: their variances, spread over the cells again, sum to the field's, and their shares to one."""
    df = yearly_field(spark, sf_dir)
    patterns, series = modes.modes(df, ["variable_id"], modes.MAX_TIMES)
    shares = series.select("variable_id", "mode", "share").distinct().groupBy("variable_id").agg(F.count("*").cast("int").alias("modes"), F.round(F.sum("share"), 9).alias("share"))
    times = df.groupBy("variable_id").agg(F.count_distinct("time").alias("times"))
    total = patterns.groupBy("variable_id").agg(F.sum(F.col("value") * F.col("value") * F.cos(F.radians("lat"))).alias("v")).join(times, "variable_id")
    return total.join(shares, "variable_id").select("variable_id", "modes", F.round(F.col("v") * F.col("times") / 1e6, 3).alias("variance"), "share")


@query(f"WITH {FIELD}, e AS (SELECT lat, lon, avg(v) AS e FROM y WHERE variable_id = 'A' GROUP BY ALL) SELECT variable_id, time, round(sum(cos(radians(lat)) * value * e) / sum(cos(radians(lat)) * e * e), 8) AS value FROM a JOIN e USING (lat, lon) GROUP BY ALL")
def mode_projection(spark, sf_dir):
    """How strongly each year shows the mean field of one variable."""
    c = cells(spark, sf_dir).where("value is not null and variable_id = 'A'")
    pattern = c.groupBy("lat", "lon", "year").agg(F.avg("value").alias("v")).groupBy("lat", "lon").agg(F.avg("v").alias("value")).withColumn("mode", F.lit(1))
    return modes.projected(yearly_field(spark, sf_dir), pattern, ["variable_id"]).select("variable_id", "time", F.round("value", 8).alias("value"))


# -------------------------------------------------------------------- whole documents


def order_documents(spark, sf_dir, actual: bool):
    """Orders as nested documents; the actual ones lack, add, retype or shift something by their key."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    shifted = F.when(k % 7 == 0, price * (1 + 2e-6)).when(k % 11 == 0, price + 100).otherwise(price) if actual else price
    member = lambda name, value: F.concat(F.lit(f'"{name}": '), value)
    lists = F.when((k % 5 == 0) & F.lit(actual), "[1, [2]]").otherwise("[1, [2, 3]]")
    custkey = F.when((k % 3 == 0) & F.lit(actual), F.concat(F.lit('"'), "o_custkey", F.lit('"'))).otherwise(F.col("o_custkey").cast("string"))
    extra = F.when((k % 13 == 0) & F.lit(actual), ', "more": {"x": null}').otherwise("")
    doc = F.concat(F.lit('{"order": {'), member("customer", custkey), F.lit(", "), member("price", F.format_string("%.4e", shifted)), F.lit('}, "parts": '), lists, extra, F.lit("}"))
    return table(spark, sf_dir, "orders").select("o_orderkey", doc.alias("doc"))


@query("""
WITH o AS (SELECT o_orderkey AS k, o_totalprice AS p FROM orders)
SELECT k AS o_orderkey, 'order.customer' AS path, 'retyped' AS difference FROM o WHERE k % 3 = 0
UNION ALL SELECT k, 'order.price', 'differs' FROM o WHERE k % 11 = 0 AND k % 7 <> 0 AND 100 > 1e-4 * (p + 100) * 1.01
UNION ALL SELECT k, 'parts[1][1]', 'missing' FROM o WHERE k % 5 = 0 UNION ALL SELECT k, 'more.x', 'extra' FROM o WHERE k % 13 = 0
""")
def documents_compared(spark, sf_dir):
    """Nested documents path by path: retyped, beyond the tolerance, missing and extra."""
    found = documents.compare_documents(order_documents(spark, sf_dir, False), order_documents(spark, sf_dir, True), ["o_orderkey"], "doc", rtol=1e-4)
    near = found.where("difference = 'differs'").join(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey").where("100 <= 1e-4 * (o_totalprice + 100) * 1.01")
    return found.join(near.select("o_orderkey", "path"), ["o_orderkey", "path"], "left_anti").select("o_orderkey", "path", "difference")


@query("SELECT o_orderkey, list_transform([o_totalprice / 7, o_totalprice * 1234.567], lambda x: CAST(printf('%.6e', x) AS DOUBLE)) AS numbers, CAST(o_custkey AS BIGINT) AS whole FROM orders")
def rounded_documents(spark, sf_dir):
    """Every number of a document with a fraction in seven figures, whole ones as they are."""
    doc = F.to_json(F.struct(F.array(F.struct((F.col("o_totalprice") / 7).alias("x")), F.struct((F.col("o_totalprice") * 1234.567).alias("x"))).alias("a"), F.col("o_custkey").cast("long").alias("whole"), F.lit(None).cast("string").alias("none")), {"ignoreNullFields": "false"})
    found = table(spark, sf_dir, "orders").select("o_orderkey", F.from_json(documents.without_nulls(documents.rounded(doc)), "a array<struct<x:double>>, whole long").alias("d"))
    return found.select("o_orderkey", F.transform("d.a", lambda v: v["x"]).alias("numbers"), "d.whole")


# ------------------------------------------------------------------------ life cycles


def order_index(spark, sf_dir):
    """Orders' mean price by priority and month as an index; every seventeenth month of a priority is missing."""
    o = table(spark, sf_dir, "orders")
    t = enso.month_number(F.year("o_orderdate"), F.month("o_orderdate")).cast("long")
    rows = o.groupBy(F.col("o_orderpriority").alias("k"), t.alias("time")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("s"), F.count("*").alias("n"))
    return rows.where((F.col("time") + F.length("k")) % 17 != 0).select("k", "time", ((F.col("s") / F.col("n") / 100 - 200000) / 20000 + F.sin(F.col("time") / 5)).alias("value"))


INDEX = """i AS MATERIALIZED (SELECT k, time, (s / n / 100 - 200000) / 20000 + sin(time / 5) AS value FROM (SELECT o_orderpriority AS k, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS time, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS s, count(*) AS n FROM orders GROUP BY 1, 2) WHERE (time + length(k)) % 17 <> 0)"""
INDEX_EVENTS = f"""{INDEX}, b AS (SELECT *, CASE WHEN value >= 0.5 THEN 'warm' ELSE 'cold' END AS kind FROM i WHERE abs(value) >= 0.5), r AS (SELECT *, time - row_number() OVER (PARTITION BY k, kind ORDER BY time) AS run FROM b),
e AS (SELECT k, kind, min(time) AS start, max(time) AS "end", count(*) AS months, arg_max(time, (abs(value), -time)) AS peak_time, arg_max(value, (abs(value), -time)) AS peak FROM r GROUP BY k, kind, run HAVING count(*) >= 5)"""


@query(f'WITH {INDEX_EVENTS} SELECT k, kind, start, "end", months, peak_time, round(peak, 6) AS peak FROM e')
def index_events(spark, sf_dir):
    """Runs of consecutive months, broken by missing ones."""
    return enso.events(order_index(spark, sf_dir), ["k"]).withColumn("peak", F.round("peak", 6))


@query(f"WITH {INDEX_EVENTS} SELECT e.k, kind, CAST(lag AS INTEGER) AS lag, round(avg(value), 6) AS value, count(*) AS n FROM e, range(-12, 13) l(lag), i WHERE i.k = e.k AND i.time = peak_time + lag GROUP BY 1, 2, 3")
def index_composites(spark, sf_dir):
    """The mean course of events around their peaks."""
    df = order_index(spark, sf_dir)
    return enso.composites(df, enso.events(df, ["k"]), ["k"]).withColumn("value", F.round("value", 6))


@query(f"WITH {INDEX}, d AS (SELECT i.k, time, value - (mv + coalesce(slope, 0) * (time - mt)) AS value FROM i JOIN (SELECT k, regr_slope(value, time) AS slope, avg(time) AS mt, avg(value) AS mv FROM i GROUP BY 1) f ON i.k = f.k), w AS (SELECT k, time, avg(value) OVER x AS value, count(*) OVER x AS n FROM d WINDOW x AS (PARTITION BY k ORDER BY time RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)) SELECT k, time, round(value, 6) AS value FROM w WHERE n = 5")
def index_smoothed(spark, sf_dir):
    """Detrended, then means of five months where all five are there."""
    return enso.smoothed(enso.detrended(order_index(spark, sf_dir), ["k"]), ["k"]).withColumn("value", F.round("value", 6))


def _metrics_sql(name: str, source: str, key: str) -> str:
    """The metrics of an index table (k, time, value) and its events."""
    return f"""{name}_p AS (SELECT a.k, stddev_pop(a.value) AS amplitude, avg(power(a.value - m.m, 3)) / power(stddev_pop(a.value), 3) AS asymmetry, stddev_pop(CASE WHEN a.time % 12 IN (10, 11, 0) THEN a.value END) / stddev_pop(CASE WHEN a.time % 12 IN (2, 3, 4) THEN a.value END) AS seasonality, corr(a.value, b.value) AS persistence
  FROM {source} a JOIN (SELECT k, avg(value) AS m FROM {source} GROUP BY 1) m ON m.k = a.k LEFT JOIN {source} b ON b.k = a.k AND b.time = a.time - 1 GROUP BY 1),
{name}_m AS (SELECT p.*, coalesce(w, 0) AS warm_events, coalesce(c, 0) AS cold_events, duration FROM {name}_p p LEFT JOIN (SELECT k, count(*) FILTER (kind = 'warm') AS w, count(*) FILTER (kind = 'cold') AS c, avg(months) AS duration FROM e WHERE {key} GROUP BY 1) x ON p.k = x.k),
{name} AS (SELECT k, metric, value FROM (SELECT k, amplitude, asymmetry, seasonality, persistence, CAST(warm_events AS DOUBLE) AS warm_events, CAST(cold_events AS DOUBLE) AS cold_events, CAST(duration AS DOUBLE) AS duration FROM {name}_m) UNPIVOT INCLUDE NULLS (value FOR metric IN (amplitude, asymmetry, seasonality, persistence, warm_events, cold_events, duration)))"""


@query(f"""WITH {INDEX_EVENTS}, im AS (SELECT * FROM i WHERE k <> '1-URGENT'), ir AS (SELECT * FROM i WHERE k = '1-URGENT'), {_metrics_sql("mm", "im", "k <> '1-URGENT'")}, {_metrics_sql("rr", "ir", "k = '1-URGENT'")},
c AS (SELECT e.k, lag, avg(value) AS v FROM e, range(-12, 13) l(lag), i WHERE kind = 'warm' AND i.k = e.k AND i.time = peak_time + lag GROUP BY 1, 2)
SELECT mm.k, metric, round(mm.value, 5) AS model, round(rr.value, 5) AS reference, round(CASE WHEN rr.value <> 0 THEN 100 * (mm.value - rr.value) / abs(rr.value) END, 3) AS error FROM mm JOIN rr USING (metric)
UNION ALL SELECT a.k, 'lifecycle', NULL, NULL, round(sqrt(avg(power(a.v - b.v, 2))), 3) FROM c a JOIN c b ON a.lag = b.lag AND b.k = '1-URGENT' WHERE a.k <> '1-URGENT' GROUP BY 1""")
def index_metric_matrix(spark, sf_dir):
    """Four priorities' indices against that of the most urgent one."""
    df = order_index(spark, sf_dir)
    found = enso.metric_matrix(df.where("k <> '1-URGENT'"), df.where("k = '1-URGENT'").drop("k"), ["k"])
    return found.select("k", "metric", F.round("model", 5).alias("model"), F.round("reference", 5).alias("reference"), F.round("error", 3).alias("error"))


@query(f"""WITH c AS {CELLS}, z AS (SELECT variable_id, lon, sum(value * cos(radians(lat))) / sum(CASE WHEN value IS NOT NULL THEN cos(radians(lat)) END) AS value FROM c WHERE lat BETWEEN -5 AND 5 AND lon BETWEEN 150 AND 270 GROUP BY ALL), m AS (SELECT variable_id, lat, avg(value) AS value FROM c WHERE lat BETWEEN -15 AND 15 AND lon BETWEEN 150 AND 270 GROUP BY ALL)
SELECT 'lon' AS axis, a.variable_id, round(sqrt(avg(power(a.value - b.value, 2))), 3) AS error FROM z a JOIN z b ON a.lon = b.lon AND b.variable_id = 'A' GROUP BY 2 UNION ALL SELECT 'lat', a.variable_id, round(sqrt(avg(power(a.value - b.value, 2))), 3) FROM m a JOIN m b ON a.lat = b.lat AND b.variable_id = 'A' GROUP BY 2""")
def profile_errors(spark, sf_dir):
    """Zonal and meridional profiles of the equatorial Pacific against those of one variable."""
    c = cells(spark, sf_dir)
    found = []
    for axis, profile in (("lon", enso.zonal_profile(c, ["variable_id"])), ("lat", enso.meridional_profile(c, ["variable_id"]))):
        error = enso.profile_error(profile, profile.where("variable_id = 'A'").drop("variable_id"), ["variable_id"], axis)
        found.append(error.select(F.lit(axis).alias("axis"), "variable_id", F.round("value", 3).alias("error")))
    return found[0].unionByName(found[1])


# ---------------------------------------------------------------- smaller features


@query(f"WITH y AS (SELECT variable_id, year, avg(value) AS value FROM (SELECT variable_id, year, month, {MEAN} AS value FROM {GRID} GROUP BY 1, 2, 3) GROUP BY 1, 2), r AS (SELECT year, avg(value) AS value FROM (SELECT year, month, sum(value * cos(radians(lat))) / sum(CASE WHEN value IS NOT NULL THEN cos(radians(lat)) END) AS value FROM {GRID} WHERE variable_id = 'A' GROUP BY 1, 2) GROUP BY 1) SELECT variable_id, year, round(y.value - r.value, 4) AS bias, round(avg(y.value - r.value) OVER (PARTITION BY variable_id), 4) AS mean_bias, round(sqrt(avg(power(y.value - r.value, 2)) OVER (PARTITION BY variable_id)), 4) AS rmse FROM y JOIN r USING (year) WHERE variable_id <> 'A'")
def sea_surface_bias(spark, sf_dir):
    """Yearly biases of models weighted by area against a reference weighted by the cosine of latitude, and their statistics."""
    g = grid(spark, sf_dir)
    rows, stats = diagnostics.sst_bias(g.where("variable_id <> 'A'"), g.where("variable_id = 'A'"), ["variable_id"])
    return rows.join(stats, "variable_id").select("variable_id", "year", *(F.round(c, 4).alias(c) for c in ("bias", "mean_bias", "rmse")))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F'")
def facets_of_arguments(spark, sf_dir):
    """Facets as arguments of a command line; a repeated one collects values."""
    facets = parse_facets(["l_returnflag=A", "l_linestatus = F", "l_returnflag=R"])
    return facet_filter(table(spark, sf_dir, "lineitem"), [facets]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_suppkey AS gk, l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY l_extendedprice >= median(l_extendedprice) OVER (PARTITION BY l_suppkey)")
def constraint_of_ones_own(spark, sf_dir):
    """A constraint in pandas, called for each group: lines of at least the group's median price."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("gk"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    kept = ByGroup(lambda g: g[g["l_extendedprice"] >= g["l_extendedprice"].median()]).apply(rows, rows)
    return kept.drop("l_extendedprice")


@query("SELECT CAST(o_custkey AS VARCHAR) AS dataset_key, md5(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)) AS dataset_hash FROM orders GROUP BY o_custkey HAVING bool_or(o_orderstatus = 'O')")
def groups_with_new_data(spark, sf_dir):
    """Customers whose orders have changed since those still open were not there: other orders, or their first."""
    o = table(spark, sf_dir, "orders")
    keyed = lambda df: df.groupBy(F.col("o_custkey").cast("string").alias("dataset_key")).agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda k: k.cast("string")), ",").cast("binary")).alias("dataset_hash"))
    return changed_groups(keyed(o.where("o_orderstatus <> 'O'")), keyed(o))


@query("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y%m%d') || 'T000000' AS compact, strftime(CAST(o_orderdate AS DATE), '%Y%m%dT120000') AS basic FROM orders")
def compact_times(spark, sf_dir):
    """Times as analysis windows are written."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    time = calendars.parse_time(day, F.lit("standard"))
    return table(spark, sf_dir, "orders").select("o_orderkey", calendars.compact_text(time).alias("compact"), calendars.iso_basic(F.concat(day, F.lit("T12:00:00"))).alias("basic"))


def short_names(tables):
    """A check of one's own: parts whose names have few letters."""
    return doctor.findings(tables["parts"].where(F.length("p_name") < 10), "short-names", "warning", F.col("p_partkey"), F.concat(F.lit("only "), F.length("p_name")))


@query("SELECT 'short-names' AS \"check\", 'warning' AS severity, CAST(p_partkey AS VARCHAR) AS subject, 'only ' || length(p_name) AS message FROM part WHERE length(p_name) < 10")
def check_of_ones_own(spark, sf_dir):
    """A check that is registered for this run."""
    doctor.check("short-names")(short_names)
    try:
        return doctor.run_checks({"parts": table(spark, sf_dir, "part")}, names=["short-names"])
    finally:
        doctor.CHECKS.pop("short-names")
