"""The library's operators on the driver's tables, each beside equivalent SQL.

The tables stand in for the library's own: ``orders`` for executions of a group
(customer), ``lineitem`` for files, metric values and grid cells, ``part`` for
versioned datasets, ``events`` for time ranges and measurements.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions import calendars as cal
from meridian.functions import catalog as fn
from meridian.operators import aggregates as agg
from meridian.operators import bundles, constraints, filters, gridded, outliers, windows
from meridian.plans import diagnostics, doctor, ledger, results, upsert
from meridian.plans.requirement import DataRequirement, solve_inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out by a key: a small file is one row group or few, and costly work on its rows would keep that many cores busy."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


# ------------------------------------------------------------ stand-in tables


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files that cover a minute each: group event_type, sub-group user_id."""
    second = F.unix_timestamp(F.date_trunc("second", "ts"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), F.col("event_type").alias("gk"), "user_id", second.alias("start_ord"), (second + 60).alias("end_ord"))


def part_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as datasets: source brand, grid type, version from the size."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_partkey").alias("dataset_id"), F.col("p_brand").alias("source_id"), F.col("p_type").alias("grid_label"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("variable_id"), F.concat(F.lit("v"), "p_size").alias("version"), F.col("p_size").alias("size"),
    )


PARTS = "(SELECT p_partkey AS row_id, p_brand AS source_id, p_type AS grid_label, split_part(p_name, ' ', 1) AS variable_id, 'v' || p_size AS version, p_size AS size FROM part)"


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as executions of their customer's group; F succeeded, P failed, O is running."""
    state = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "P", False)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("group_id"), F.col("o_orderdate").alias("created_at"), state.alias("successful"), F.col("o_orderpriority").alias("dataset_hash"), F.lit(False).alias("retracted")
    )


RUNS = "(SELECT o_orderkey AS id, o_custkey AS group_id, o_orderdate AS created_at, CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END AS successful, o_orderpriority AS dataset_hash FROM orders)"


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("group_id"), F.col("c_mktsegment").alias("provider"), F.concat(F.lit("d"), "c_nationkey").alias("diagnostic"), F.col("c_nationkey").alias("diagnostic_id"),
        (F.col("c_acctbal") < 0).alias("dirty"), (F.col("c_custkey") % 3 + 1).cast("int").alias("diagnostic_version"), F.col("c_name").alias("dataset_key"),
    )


GROUPS = "(SELECT c_custkey AS group_id, c_mktsegment AS provider, 'd' || c_nationkey AS diagnostic, c_nationkey AS diagnostic_id, c_acctbal < 0 AS dirty, CAST(c_custkey % 3 + 1 AS INTEGER) AS diagnostic_version, c_name AS dataset_key FROM customer)"


def metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scalar values: source supplier, statistic and metric flags; a null statistic and infinite values among them."""
    value = F.when(F.col("l_quantity") == 50, F.lit(float("inf"))).otherwise(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") == 7, "Reference").otherwise(F.col("l_suppkey").cast("string")).alias("source_id"), F.nullif("l_returnflag", F.lit("R")).alias("statistic"), F.col("l_linestatus").alias("metric"), value.alias("value")
    )


VALUES = "(SELECT CASE WHEN l_suppkey = 7 THEN 'Reference' ELSE CAST(l_suppkey AS VARCHAR) END AS source_id, nullif(l_returnflag, 'R') AS statistic, l_linestatus AS metric, CASE WHEN l_quantity = 50 THEN CAST('inf' AS DOUBLE) ELSE l_extendedprice END AS value FROM lineitem)"


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as measured executions; some incomplete, failed or shared."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("provider"), F.col("l_linestatus").alias("diagnostic"), F.col("l_quantity").alias("wall_seconds"), F.nullif(F.col("l_extendedprice") / 100, F.lit(0.0)).alias("cpu_seconds"),
        F.when(F.col("l_linenumber") != 7, (F.col("l_extendedprice") * 1000).cast("long")).alias("peak_memory_bytes"), F.lit(20_000_000).cast("long").alias("memory_limit_bytes"),
        F.when(F.col("l_linenumber") <= 4, "cgroup").otherwise("rusage").alias("memory_source"), (F.col("l_suppkey") % 10 != 0).alias("resources_exclusive"), (F.col("l_partkey") % 50 != 0).alias("successful"),
        F.col("l_shipdate").alias("created_at"), F.col("l_orderkey").alias("id"),
    )


USAGE = "(SELECT l_returnflag AS provider, l_linestatus AS diagnostic, l_quantity AS wall_seconds, nullif(l_extendedprice / 100, 0.0) AS cpu_seconds, CASE WHEN l_linenumber <> 7 THEN CAST(trunc(l_extendedprice * 1000) AS BIGINT) END AS peak, CASE WHEN l_linenumber <= 4 THEN 'cgroup' ELSE 'rusage' END AS memory_source, l_suppkey % 10 <> 0 AS exclusive, l_partkey % 50 <> 0 AS successful FROM lineitem)"


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as grid cells: variable flag, latitude from the supplier, longitude from the line, weight quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("variable_id"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), (F.col("l_suppkey") % 18 * 10 - 85).cast("double").alias("lat"), (F.col("l_linenumber") * 50).cast("double").alias("lon"),
        F.nullif("l_extendedprice", F.lit(0.0)).alias("value"), F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("area"),
    )


GRID = "(SELECT l_returnflag AS variable_id, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(l_suppkey % 18 * 10 - 85 AS DOUBLE) AS lat, CAST(l_linenumber * 50 AS DOUBLE) AS lon, nullif(l_extendedprice, 0.0) AS value, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS area FROM lineitem)"
MEAN = "sum(CASE WHEN value IS NOT NULL THEN value * coalesce(area, 0) END) / nullif(sum(CASE WHEN value IS NOT NULL THEN coalesce(area, 0) END), 0)"


# -------------------------------------------------------------------- filters


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_returnflag IN ('A', 'N') AND l_linestatus IN ('F')) OR (l_returnflag IN ('R'))")
def facet_filter_or_and(spark, sf_dir):
    df = filters.facet_filter(table(spark, sf_dir, "lineitem"), [{"l_returnflag": ["A", "N"], "l_linestatus": ["F"]}, {"l_returnflag": ["R"]}])
    return df.select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT count(*) AS n FROM lineitem")
def facet_filter_empty(spark, sf_dir):
    """One filter without facets lets everything through."""
    return filters.facet_filter(table(spark, sf_dir, "lineitem"), [{"l_returnflag": ["A"]}, {}]).agg(F.count("*").alias("n"))


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#2', 'Brand#3')")
def known_facets_only(spark, sf_dir):
    return filters.known_facets(table(spark, sf_dir, "part"), {"p_brand": ["Brand#2", "Brand#3"], "absent": ["x"]}).select("p_partkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_type = 'SMALL' AND p_brand IN ('Brand#1', 'Brand#4') AND (p_name ILIKE '%RED%' OR p_name ILIKE '%b_lt%')")
def dimension_filters(spark, sf_dir):
    df = filters.dimension_filter(table(spark, sf_dir, "part"), {"p_type": "SMALL", "p_brand": ["Brand#1", "Brand#4"]})
    return df.where(filters.contains_any(F.col("p_name"), ["RED", "b_lt"])).select("p_partkey", "p_name")


@query("SELECT r_regionkey FROM region WHERE r_regionkey IN (1, 2)")
def isolated_ids(spark, sf_dir):
    """Excluded ids do not count when some are isolated."""
    return filters.ids_filter(table(spark, sf_dir, "region"), "r_regionkey", isolate=[1, 2], exclude=[1]).select("r_regionkey")


@query(f"SELECT successful IS TRUE AS ok, count(*) AS n FROM {RUNS} GROUP BY 1")
def tri_state_success(spark, sf_dir):
    runs = executions(spark, sf_dir)
    return runs.select(filters.successful(F.col("successful"), True).alias("ok")).groupBy("ok").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey = 3")
def selector_facets(spark, sf_dir):
    def pairs(k, v):
        return F.array(F.struct(F.lit(k).alias("k"), F.col(v).cast("string").alias("v")))

    df = table(spark, sf_dir, "customer").withColumn("selectors", F.create_map(F.lit("cmip6"), pairs("segment", "c_mktsegment"), F.lit("obs"), pairs("nation", "c_nationkey")))
    wanted = filters.selector_matches(F.col("selectors"), "cmip6.segment", ["BUILDING"]) | filters.selector_matches(F.col("selectors"), "nation", ["3"])
    return df.where(wanted).select("c_custkey")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem)")
def distinct_with_maps(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", F.create_map(F.lit("s"), "l_linestatus").alias("m"), "l_linenumber")
    return filters.distinct_rows(df).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- constraints


def line_groups(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumns({"gk": F.col("l_orderkey"), "row_id": F.col("l_partkey")})


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 2) GROUP BY 1")
def require_facets_all(spark, sf_dir):
    rows = line_groups(spark, sf_dir)
    return constraints.RequireFacets("l_returnflag", ("A", "R")).apply(rows, rows).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linestatus, count(*) AS n FROM lineitem l WHERE EXISTS (SELECT 1 FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_linestatus = l.l_linestatus AND m.l_returnflag IN ('A', 'R')) GROUP BY 1, 2")
def require_facets_any(spark, sf_dir):
    rows = line_groups(spark, sf_dir)
    return constraints.RequireFacets("l_returnflag", ("A", "R"), "any", ("l_linestatus",)).apply(rows, rows).groupBy("l_orderkey", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT (coalesce(nullif(l_returnflag, 'N') IN ('A'), false) AND l_linestatus IN ('F')) GROUP BY 1")
def ignore_facets(spark, sf_dir):
    rows = line_groups(spark, sf_dir).withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return constraints.IgnoreFacets({"l_returnflag": ("A",), "l_linestatus": ("F",)}).apply(rows, rows).groupBy("l_orderkey").agg(F.count("*").alias("n"))


EVENTS = "(SELECT event_id AS row_id, event_type AS gk, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS start_ord, CAST(floor(epoch(ts)) AS BIGINT) + 60 AS end_ord FROM events)"
GAPS = f"(SELECT gk, user_id, max(start_ord - before) AS gap, min(start_ord) AS low, max(end_ord) AS high FROM (SELECT *, lag(end_ord) OVER (PARTITION BY gk, user_id ORDER BY start_ord, row_id) AS before FROM {EVENTS}) GROUP BY gk, user_id)"


@query(f"SELECT e.gk, e.user_id, count(*) AS n FROM {EVENTS} e JOIN {GAPS} g ON e.gk = g.gk AND e.user_id = g.user_id WHERE coalesce(g.gap <= 432000, true) GROUP BY 1, 2")
def contiguous_timerange(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    return constraints.RequireContiguousTimerange(("user_id",), 432_000).apply(rows, rows).groupBy("gk", "user_id").agg(F.count("*").alias("n"))


@query(f"SELECT e.gk, e.user_id, count(*) AS n FROM {EVENTS} e JOIN {GAPS} g ON e.gk = g.gk AND e.user_id = g.user_id WHERE coalesce(g.gap <= 864000, true) AND g.low <= 1704240000 AND g.high >= 1706486400 GROUP BY 1, 2")
def timerange_required(spark, sf_dir):
    rows = event_rows(spark, sf_dir)
    c = constraints.RequireTimerange(("user_id",), 1_704_240_000, 1_706_486_400, 864_000)
    return c.apply(rows, rows).groupBy("gk", "user_id").agg(F.count("*").alias("n"))


@query(f"WITH e AS (SELECT *, user_id % 40 AS g FROM {EVENTS}), s AS (SELECT g, gk, min(start_ord) AS low, max(end_ord) AS high FROM e GROUP BY 1, 2), k AS (SELECT g FROM s GROUP BY g HAVING max(low) + 2000000 < min(high)) SELECT g AS gk, count(*) AS n FROM e WHERE g IN (SELECT g FROM k) GROUP BY 1")
def overlapping_timerange(spark, sf_dir):
    rows = event_rows(spark, sf_dir).select("row_id", F.col("gk").alias("kind"), (F.col("user_id") % 40).alias("gk"), (F.col("start_ord") + 2_000_000).alias("start_ord"), "end_ord")
    return constraints.RequireOverlappingTimerange(("kind",)).apply(rows, rows).groupBy("gk").agg(F.count("*").alias("n"))


@query(f"""
WITH p AS {PARTS}, g AS (SELECT source_id AS gk, * FROM p WHERE size > 45),
want AS (SELECT DISTINCT gk, source_id, grid_label, version FROM g), cand AS (SELECT * FROM p WHERE variable_id IN ('red')),
scored AS (SELECT w.gk, w.source_id, w.grid_label, w.version, c.row_id, c.size AS vkey, c.grid_label AS cg, c.version AS cv,
  CAST(w.grid_label = c.grid_label AS INT) + CAST(w.version = c.version AS INT) AS score FROM want w JOIN cand c ON w.source_id = c.source_id),
best AS (SELECT * FROM scored QUALIFY rank() OVER (PARTITION BY gk, source_id, grid_label, version ORDER BY score DESC, vkey DESC) = 1),
firsts AS (SELECT *, min(row_id) OVER (PARTITION BY gk, source_id, grid_label, version, cg, cv) AS f FROM best),
picked AS (SELECT * FROM firsts QUALIFY rank() OVER (PARTITION BY gk, source_id, grid_label, version ORDER BY f) = 1)
SELECT gk, row_id FROM picked UNION SELECT gk, row_id FROM g
""")
def supplementary_best_match(spark, sf_dir):
    parts = part_datasets(spark, sf_dir)
    rows = parts.where("size > 45").withColumn("gk", F.col("source_id"))
    return constraints.AddSupplementaryDataset({"variable_id": ("red",)}, ("source_id",), ("grid_label", "version")).apply(rows, parts).select("gk", "row_id")


@query("""
WITH c AS (SELECT n_nationkey + 100 AS dataset_id, n_name AS name, r_name AS parent_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 4
  UNION ALL SELECT r_regionkey, r_name, NULL FROM region WHERE r_name <> 'ASIA'),
kin AS (SELECT a.dataset_id AS child, b.dataset_id AS parent FROM c a JOIN c b ON a.parent_name = b.name)
SELECT 'all' AS gk, CAST(child AS BIGINT) AS dataset_id FROM kin UNION SELECT 'all', CAST(parent AS BIGINT) FROM kin
""")
def parent_dataset(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    children = nation.where("n_nationkey <> 4").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select((F.col("n_nationkey") + 100).cast("long").alias("dataset_id"), F.col("n_name").alias("name"), F.col("r_name").alias("parent_name"))
    roots = region.where("r_name <> 'ASIA'").select(F.col("r_regionkey").cast("long").alias("dataset_id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_name"))
    catalog = children.unionByName(roots).withColumn("row_id", F.col("dataset_id"))
    rows = catalog.withColumn("gk", F.lit("all"))
    return constraints.AddParentDataset({"name": "parent_name"}).apply(rows, catalog).select("gk", "dataset_id").distinct()


LABEL = "CASE WHEN c_custkey % 11 = 0 THEN 'x' || c_custkey WHEN c_custkey % 7 = 0 THEN NULL ELSE 'r' || (c_custkey % 12 + 1) || 'i1p1f1' END"


@query(f"""
WITH c AS (SELECT c_custkey, c_nationkey, {LABEL} AS member FROM customer),
k AS (SELECT *, regexp_extract(member, '^r([0-9]+)', 1) AS r FROM c),
o AS (SELECT *, CASE WHEN member IS NULL THEN NULL WHEN r <> '' THEN lpad(r, 6, '0') ELSE 'zz' || member END AS o FROM k),
f AS (SELECT *, min(o) OVER (PARTITION BY c_nationkey) AS first FROM o)
SELECT c_custkey, member FROM f WHERE first IS NULL OR o = first
""")
def first_member(spark, sf_dir):
    k = F.col("c_custkey")
    label = F.when(k % 11 == 0, F.concat(F.lit("x"), k)).when(k % 7 == 0, None).otherwise(F.concat(F.lit("r"), k % 12 + 1, F.lit("i1p1f1")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", label.alias("member"), F.lit("all").alias("gk"))
    return constraints.SelectFirstMember("member", ("c_nationkey",)).apply(rows, rows).select("c_custkey", "member")


# ---------------------------------------------------- versions, runs and pages


@query(f"SELECT row_id, version FROM {PARTS} QUALIFY rank() OVER (PARTITION BY source_id, grid_label ORDER BY size DESC) = 1")
def latest_version(spark, sf_dir):
    return windows.latest_version(part_datasets(spark, sf_dir), ["source_id", "grid_label"]).select("row_id", "version")


@query(f"SELECT row_id, version FROM {PARTS} WHERE size <= 30 QUALIFY rank() OVER (PARTITION BY source_id ORDER BY size DESC) = 1")
def filtered_latest_version(spark, sf_dir):
    return windows.ranked_latest(part_datasets(spark, sf_dir), ["source_id"], "size", F.col("size") <= 30).select("row_id", "version")


@query(f"SELECT group_id, id, created_at FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1")
def latest_execution(spark, sf_dir):
    return ledger.latest_executions(executions(spark, sf_dir)).select("group_id", "id", "created_at")


@query(f"""
WITH pre AS (SELECT group_id, id FROM {RUNS} WHERE successful IS TRUE QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1),
post AS (SELECT group_id, id FROM (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1) WHERE successful IS TRUE)
SELECT pre.group_id, pre.id AS latest_successful, post.id AS successful_latest FROM pre LEFT JOIN post USING (group_id)
""")
def pre_post_rank_success(spark, sf_dir):
    runs, ok = executions(spark, sf_dir), filters.successful(F.col("successful"), True)
    pre = ledger.latest_executions(runs, before=ok).select("group_id", F.col("id").alias("latest_successful"))
    post = ledger.latest_executions(runs, after=ok).select("group_id", F.col("id").alias("successful_latest"))
    return pre.join(post, "group_id", "left")


@query(f"SELECT group_id, min_by(id, (created_at, id)) AS id FROM {RUNS} GROUP BY 1")
def oldest_execution(spark, sf_dir):
    return windows.oldest_per_group(executions(spark, sf_dir), ["group_id"], "created_at", "id").select("group_id", "id")


@query(f"""
WITH f AS (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at, id) = 1),
l AS (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1)
SELECT f.group_id, f.id FROM f JOIN l USING (group_id) WHERE f.successful IS TRUE AND l.successful IS TRUE
""")
def reingest_candidates(spark, sf_dir):
    return ledger.for_reingest(executions(spark, sf_dir)).select("group_id", "id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def paged_orders(spark, sf_dir):
    return windows.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100, 50)


@query("SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def one_per_group(spark, sf_dir):
    return windows.one_per(table(spark, sf_dir, "orders"), ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_orderpriority", "o_orderkey")


@query("SELECT o_orderkey, first_value(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS status FROM orders")
def first_value_fix(spark, sf_dir):
    return windows.first_value(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"], "o_orderkey").select("o_orderkey", F.col("o_orderstatus").alias("status"))


@query("SELECT o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1")
def first_of_repeated_time(spark, sf_dir):
    return windows.first_of_time(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_orderkey")


@query(f"SELECT row_id, covered_until FROM (SELECT *, max(end_ord + 3600) OVER (PARTITION BY user_id ORDER BY start_ord, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered_until FROM {EVENTS}) WHERE start_ord <= covered_until")
def overlap_running_max(spark, sf_dir):
    rows = event_rows(spark, sf_dir).withColumn("end_ord", F.col("end_ord") + 3600)
    return windows.overlaps(rows, ["user_id"], "start_ord", "end_ord", "row_id").select("row_id", "covered_until")


# ----------------------------------------------------------------- statistics


STATS = f"""
SELECT provider, diagnostic, count(*) AS total, count(*) FILTER (l.id IS NOT NULL AND l.successful IS NULL) AS running, count(*) FILTER (NOT l.successful) AS failed,
  count(*) FILTER (l.successful) AS successful, count(*) FILTER (l.id IS NULL) AS not_started, count(*) FILTER (dirty) AS dirty
FROM {GROUPS} g LEFT JOIN (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1) l USING (group_id) GROUP BY 1, 2
"""
COUNTS = ["total", "running", "failed", "successful", "not_started", "dirty"]


@query(STATS)
def execution_statistics(spark, sf_dir):
    return agg.execution_statistics(groups(spark, sf_dir), ledger.latest_executions(executions(spark, sf_dir)))


@query(f"WITH s AS ({STATS}) SELECT * FROM s UNION ALL SELECT provider, '(total)', {', '.join(f'CAST(sum({c}) AS BIGINT)' for c in COUNTS)} FROM s GROUP BY 1")
def provider_totals(spark, sf_dir):
    return agg.with_totals(execution_statistics(spark, sf_dir), "provider", "diagnostic", COUNTS)


@query("SELECT s_nationkey, count(DISTINCT s_suppkey) AS datasets, count(l_suppkey) AS files, count(DISTINCT s_suppkey) FILTER (s_acctbal > 0) AS finalised, count(DISTINCT s_suppkey) FILTER (NOT s_acctbal > 0) AS unfinalised FROM supplier LEFT JOIN (SELECT l_suppkey FROM lineitem WHERE l_suppkey % 3 = 0) ON s_suppkey = l_suppkey GROUP BY 1")
def dataset_statistics(spark, sf_dir):
    d = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("dataset_id"), (F.col("s_acctbal") > 0).alias("finalised"), "s_nationkey")
    files = table(spark, sf_dir, "lineitem").where("l_suppkey % 3 = 0").select(F.col("l_suppkey").alias("dataset_id"))
    return agg.dataset_statistics(d, files, ["s_nationkey"])


@query("SELECT DISTINCT 'l_returnflag' AS dimension, nullif(l_returnflag, 'N') AS value FROM lineitem WHERE l_returnflag <> 'N' UNION SELECT DISTINCT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem")
def facet_values(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    return agg.facet_values(df, ["l_returnflag", "l_linenumber"])


@query(f"SELECT n_nationkey, coalesce(max(diagnostic_version), 1) AS promoted_version, count(group_id) AS n_groups FROM nation LEFT JOIN (SELECT * FROM {GROUPS} WHERE diagnostic_id <> 5) ON n_nationkey = diagnostic_id GROUP BY 1")
def promoted_versions(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").alias("diagnostic_id"))
    g = groups(spark, sf_dir).where("diagnostic_id <> 5")
    return agg.group_counts(agg.promoted_version(g, nations), g).select("n_nationkey", "promoted_version", "n_groups")


@query("SELECT l_orderkey, list_filter([CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END, CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END], lambda x: x IS NOT NULL) AS columns FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1 OR count(DISTINCT l_linestatus) > 1")
def inconsistent_datasets(spark, sf_dir):
    return agg.inconsistent(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"])


@query("SELECT l_suppkey, list_sort(list(DISTINCT l_returnflag)) AS l_returnflag, list_sort(list(DISTINCT l_linenumber)) AS l_linenumber FROM lineitem GROUP BY 1")
def group_facets(spark, sf_dir):
    return agg.group_facets(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_returnflag", "l_linenumber"])


@query("SELECT user_id, max(low) AS start, min(high) AS end FROM (SELECT user_id, event_type, min(ts) AS low, max(ts) AS high FROM events GROUP BY 1, 2) GROUP BY 1")
def common_time_range(spark, sf_dir):
    return agg.common_time_range(table(spark, sf_dir, "events"), ["user_id"], "event_type", "ts", "ts")


@query("SELECT c_mktsegment AS experiment, list_sort(list(DISTINCT n_name)) AS variables FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 <> 0 GROUP BY 1 UNION ALL SELECT '*', list_sort(list(DISTINCT n_name)) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 = 0")
def variables_by_experiment(spark, sf_dir):
    df = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    df = df.select(F.when(F.col("c_custkey") % 4 != 0, F.array("c_mktsegment")).alias("experiments"), F.array("n_name").alias("variables"))
    return agg.variables_by_experiment(df)


@query(f"SELECT provider, diagnostic, count(*) FILTER (NOT successful) AS n_failed, count(*) AS n_measured FROM {USAGE} GROUP BY 1, 2")
def measured_counts(spark, sf_dir):
    return agg.resource_profile(measurements(spark, sf_dir)).select("provider", "diagnostic", "n_failed", "n_measured")


FULL = f"(SELECT * FROM {USAGE} WHERE wall_seconds > 0 AND cpu_seconds IS NOT NULL AND peak IS NOT NULL AND NOT (memory_source = 'cgroup' AND NOT exclusive))"
PROFILE = f"""
SELECT f.provider, f.diagnostic, any_value(f.memory_source) AS memory_source, count(*) AS n_samples, CAST(round_even(quantile_cont(CAST(peak AS DOUBLE), 0.5), 0) AS BIGINT) AS peak_p50,
  CAST(round_even(quantile_cont(CAST(peak AS DOUBLE), 0.95), 0) AS BIGINT) AS peak_p95, max(peak) AS peak_max, round(quantile_cont(wall_seconds, 0.95), 6) AS wall_p95, round(quantile_cont(cpu_seconds, 0.95), 6) AS cpu_p95,
  round(quantile_cont(cpu_seconds / wall_seconds, 0.95), 6) AS parallelism_p95
FROM {FULL} f JOIN (SELECT provider, diagnostic, max_by(memory_source, (n, p)) AS memory_source FROM (SELECT provider, diagnostic, memory_source, count(*) AS n, CASE memory_source WHEN 'cgroup' THEN 0 ELSE -2 END AS p FROM {FULL} GROUP BY 1, 2, 3) GROUP BY 1, 2) d
  ON f.provider = d.provider AND f.diagnostic = d.diagnostic AND f.memory_source = d.memory_source GROUP BY 1, 2
"""
def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in names})


@query(PROFILE)
def percentile_profile(spark, sf_dir):
    p = agg.resource_profile(measurements(spark, sf_dir)).where("n_samples > 0")
    return rounded(p, "wall_p95", "cpu_p95", "parallelism_p95").select("provider", "diagnostic", "memory_source", "n_samples", "peak_p50", "peak_p95", "peak_max", "wall_p95", "cpu_p95", "parallelism_p95")


@query(f"WITH p AS ({PROFILE}) SELECT provider, CAST(sum(n_samples) AS BIGINT) AS n_samples, max(peak_p95) AS peak_p95, max(peak_max) AS peak_max, max(wall_p95) AS wall_p95, max(cpu_p95) AS cpu_p95 FROM p GROUP BY 1")
def profile_rollup(spark, sf_dir):
    p = agg.provider_profile(agg.resource_profile(measurements(spark, sf_dir)))
    return rounded(p, "wall_p95", "cpu_p95").select("provider", "n_samples", "peak_p95", "peak_max", "wall_p95", "cpu_p95")


@query(f"WITH p AS ({PROFILE}) SELECT provider, diagnostic, greatest(CAST(ceil(peak_p95 * 1.2 / 1073741824) AS BIGINT), 1) AS gib, greatest(CAST(ceil(parallelism_p95) AS BIGINT), 1) AS cpus, CASE WHEN n_samples < 10 THEN 'thin' ELSE 'good' END AS confidence, 20000000 / peak_p95 < 1 AS over_limit FROM p")
def recommended_resources(spark, sf_dir):
    p = results.resources(measurements(spark, sf_dir)).where("n_samples > 0")
    return p.select("provider", "diagnostic", F.col("recommended_memory_gib").cast("long").alias("gib"), F.col("recommended_cpus").cast("long").alias("cpus"), "confidence", "over_limit")


# ------------------------------------------------------------------- outliers


@query(f"""
WITH v AS {VALUES}, ok AS (SELECT * FROM v WHERE isfinite(value) AND statistic IS NOT NULL),
p AS (SELECT statistic, metric, source_id, avg(value) AS x FROM ok WHERE source_id <> 'Reference' GROUP BY 1, 2, 3),
q AS (SELECT statistic, metric, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b, count(*) AS n FROM p GROUP BY 1, 2),
w AS (SELECT statistic, metric, a - 5 * (b - a) AS low, b + 5 * (b - a) AS high FROM q WHERE n >= 4 AND b > a),
j AS (SELECT v.*, v.statistic IS NOT NULL AND (NOT isfinite(value) OR (source_id <> 'Reference' AND coalesce(value < low OR value > high, false))) AS is_outlier FROM v LEFT JOIN w ON v.statistic = w.statistic AND v.metric = w.metric)
SELECT source_id, statistic, metric, is_outlier, count(*) AS n FROM j GROUP BY ALL
""")
def outlier_iqr_sources(spark, sf_dir):
    found = outliers.detect(metric_values(spark, sf_dir), outliers.OutlierPolicy(factor=5.0))
    return found.groupBy("source_id", "statistic", "metric", "is_outlier").agg(F.count("*").alias("n"))


@query(f"""
WITH v AS {VALUES}, q AS (SELECT metric, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM v WHERE isfinite(value) GROUP BY 1)
SELECT v.metric, NOT isfinite(value) OR value < a - 0.5 * (b - a) OR value > b + 0.5 * (b - a) AS is_outlier, count(*) AS n FROM v JOIN q ON v.metric = q.metric GROUP BY ALL
""")
def outlier_iqr_values(spark, sf_dir):
    found = outliers.detect(metric_values(spark, sf_dir).drop("source_id"), outliers.OutlierPolicy(factor=0.5, group_by=("metric", "absent")))
    return found.groupBy("metric", "is_outlier").agg(F.count("*").alias("n"))


# -------------------------------------------------------------------- bundles


def flat_bundle(spark, sf_dir, name="l_quantity"):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string").alias("l_linenumber")).agg(F.max(name).alias("value"))


DIMS = ["l_returnflag", "l_linestatus", "l_linenumber"]
FLAT = "SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS l_linenumber, max(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3"


@query(f"SELECT l_returnflag, l_linestatus, l_linenumber, value, 'model' AS kind FROM ({FLAT})")
def nest_and_flatten_bundle(spark, sf_dir):
    nested = bundles.nest(flat_bundle(spark, sf_dir), DIMS)
    return bundles.flatten(nested, "results", DIMS).select(*DIMS, "value", "kind")


@query(f"WITH f AS ({FLAT}), a AS (SELECT * FROM f WHERE l_linenumber <> '2'), b AS (SELECT l_returnflag, l_linestatus, l_linenumber, -value AS value FROM f WHERE l_returnflag = 'A') SELECT l_returnflag, l_linestatus, l_linenumber, coalesce(b.value, a.value) AS value FROM a FULL JOIN b USING (l_returnflag, l_linestatus, l_linenumber)")
def bundle_merge(spark, sf_dir):
    f = flat_bundle(spark, sf_dir)
    return bundles.merge(f.where("l_linenumber <> '2'"), f.where("l_returnflag = 'A'").withColumn("value", -F.col("value")), DIMS)


@query(f"WITH f AS ({FLAT}) SELECT 'one' AS level, l_returnflag, l_linestatus, l_linenumber, value FROM f UNION ALL SELECT 'two', l_returnflag, l_linestatus, l_linenumber, value FROM f WHERE l_returnflag = 'N'")
def bundle_stack(spark, sf_dir):
    f = flat_bundle(spark, sf_dir)
    return bundles.stack({"one": f, "two": f.where("l_returnflag = 'N'")}, "level")


@query(f"SELECT l_linestatus, l_linenumber, value FROM ({FLAT}) WHERE l_returnflag = 'A'")
def bundle_remove_dimension(spark, sf_dir):
    return bundles.remove_dimension(flat_bundle(spark, sf_dir).where("l_returnflag = 'A'"), DIMS, "l_returnflag")


@query("SELECT DISTINCT 'l_linenumber' AS dimension, CAST(l_linenumber AS VARCHAR) AS value FROM lineitem WHERE l_linenumber > 5")
def undeclared_values(spark, sf_dir):
    f = flat_bundle(spark, sf_dir)
    known = f.where("l_linenumber <= 5").select(F.lit("l_linenumber").alias("dimension"), F.col("l_linenumber").alias("value")).distinct()
    return bundles.undeclared(f, known, ["l_linenumber"])


@query(f"SELECT l_returnflag, l_linestatus, l_linenumber, CASE WHEN l_linenumber = '1' THEN 'missing' ELSE 'differs' END AS difference FROM ({FLAT}) WHERE l_linenumber = '1' OR l_returnflag = 'R'")
def bundle_compare(spark, sf_dir):
    f = flat_bundle(spark, sf_dir)
    other = f.where("l_linenumber <> '1'").withColumn("value", F.col("value") * F.when(F.col("l_returnflag") == "R", 1.1).otherwise(1.000001))
    return bundles.compare(f, other, DIMS).select(*DIMS, "difference")


@query("SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, round(CAST(embedding[i] AS DOUBLE), 5) AS value FROM embeddings, generate_series(1, len(embedding)) t(i)")
def series_explode(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("values"), F.lit(None).cast("array<string>").alias("index"))
    return bundles.series_points(df).select("vec_id", "position", F.round("value", 5).alias("value"))


@query("SELECT l_returnflag, list(y ORDER BY y) AS index, list(round(v, 2) ORDER BY y) AS values FROM (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS y, max(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def series_gather(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.year("l_shipdate").alias("y")).agg(F.round(F.max("l_extendedprice"), 2).alias("v"))
    return bundles.gather_series(df, ["l_returnflag"], "y", "v")


# -------------------------------------------------------------- gridded data


@query(f"SELECT variable_id, year, round(sum(CASE WHEN value IS NOT NULL THEN value * coalesce(area, 0) END) / sum(CASE WHEN value IS NOT NULL THEN coalesce(area, 0) END), 4) AS value FROM (SELECT variable_id, year, lat, lon, avg(value) AS value, max(area) AS area FROM {GRID} GROUP BY 1, 2, 3, 4) GROUP BY 1, 2")
def annual_weighted_mean(spark, sf_dir):
    cells = grid(spark, sf_dir)
    cells = cells.withColumn("area", F.max("area").over(windows.Window.partitionBy("variable_id", "year", "lat", "lon")))
    return diagnostics.global_mean_timeseries(cells, ["variable_id"]).withColumn("value", F.round("value", 4))


@query(f"SELECT variable_id, year, round(avg(value), 4) AS value FROM (SELECT variable_id, year, month, {MEAN} AS value FROM {GRID} GROUP BY 1, 2, 3) GROUP BY 1, 2")
def weighted_mean(spark, sf_dir):
    return gridded.global_then_annual(grid(spark, sf_dir), ["variable_id"]).withColumn("value", F.round("value", 4))


@query(f"WITH y AS (SELECT variable_id, year, avg(value) AS value FROM (SELECT variable_id, year, month, {MEAN} AS value FROM {GRID} GROUP BY 1, 2, 3) GROUP BY 1, 2), b AS (SELECT m.variable_id, m.year, m.value - r.value AS bias FROM y m JOIN y r ON m.year = r.year AND r.variable_id = 'A' WHERE m.variable_id <> 'A') SELECT variable_id, round(avg(bias), 4) AS mean_bias, round(sqrt(avg(bias * bias)), 4) AS rmse, count(*) AS years FROM b GROUP BY 1")
def bias_rmse(spark, sf_dir):
    y = gridded.global_then_annual(grid(spark, sf_dir), ["variable_id"])
    rows = gridded.bias(y.where("variable_id <> 'A'"), y.where("variable_id = 'A'"), ["variable_id"])
    return gridded.bias_statistics(rows, ["variable_id"]).withColumns({c: F.round(c, 4) for c in ("mean_bias", "rmse")})


@query("SELECT l_returnflag, CAST(floor(l_quantity / 10) AS INTEGER) AS x_bin, CAST(floor(l_discount / 0.025) AS INTEGER) AS y_bin, count(*) AS n FROM lineitem WHERE l_quantity < 50 AND floor(l_discount / 0.025) BETWEEN 0 AND 3 GROUP BY 1, 2, 3")
def joint_histogram(spark, sf_dir):
    return gridded.joint_histogram(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_discount", (0.0, 50.0, 5), (0.0, 0.1, 4))


@query(f"SELECT variable_id, lat, round(regr_slope(value, year), 3) AS slope, count(value) AS n FROM {GRID} GROUP BY 1, 2")
def regional_trend(spark, sf_dir):
    return gridded.trend(grid(spark, sf_dir), ["variable_id", "lat"]).select("variable_id", "lat", F.round("slope", 3).alias("slope"), "n")


@query(f"SELECT variable_id, month, round(avg(value), 4) AS value FROM {GRID} GROUP BY 1, 2")
def seasonal_cycle(spark, sf_dir):
    return diagnostics.annual_cycle(grid(spark, sf_dir), ["variable_id"]).withColumn("value", F.round("value", 4))


@query(f"SELECT variable_id, lat, round(avg(value), 4) AS value FROM {GRID} GROUP BY 1, 2")
def zonal_mean(spark, sf_dir):
    return gridded.zonal_mean(grid(spark, sf_dir), ["variable_id"]).withColumn("value", F.round("value", 4))


@query(f"WITH y AS (SELECT variable_id, year, avg(value) AS value FROM {GRID} GROUP BY 1, 2), b AS (SELECT variable_id, avg(value) AS base FROM y WHERE year BETWEEN 1996 AND 1998 GROUP BY 1) SELECT variable_id, year, round(value - base, 4) AS anomaly FROM y JOIN b USING (variable_id)")
def anomaly_series(spark, sf_dir):
    y = grid(spark, sf_dir).groupBy("variable_id", "year").agg(F.avg("value").alias("value"))
    return gridded.anomalies(y, ["variable_id"], 1996, 1998).select("variable_id", "year", F.round("anomaly", 4).alias("anomaly"))


@query(f"SELECT variable_id, (floor(lat / 60) + 0.5) * 60 AS lat, (floor(lon / 60) + 0.5) * 60 AS lon, round({MEAN}, 4) AS value FROM {GRID} GROUP BY 1, 2, 3")
def coarse_grid(spark, sf_dir):
    return gridded.coarsen(grid(spark, sf_dir), ["variable_id"], 60.0).select("variable_id", "lat", "lon", F.round("value", 4).alias("value"))


@query(f"SELECT variable_id, year, round({MEAN}, 4) AS value FROM {GRID} WHERE month = 10 AND lat BETWEEN -90 AND -50 AND area IS NOT NULL GROUP BY 1, 2")
def polar_cap_series(spark, sf_dir):
    return diagnostics.polar_cap(grid(spark, sf_dir).where("area is not null"), ["variable_id"], 10, -90.0, -50.0).withColumn("value", F.round("value", 4))


@query(f"SELECT variable_id, year, month, round(sum(value / 100 * area), 3) AS value FROM {GRID} WHERE value IS NOT NULL AND area IS NOT NULL GROUP BY 1, 2, 3")
def sea_ice_area(spark, sf_dir):
    return diagnostics.sea_ice_area(grid(spark, sf_dir), ["variable_id"]).withColumn("value", F.round("value", 3))


@query(f"WITH y AS (SELECT variable_id, year, avg(value) AS v FROM {GRID} GROUP BY 1, 2), w AS (SELECT *, avg(v) OVER (PARTITION BY variable_id ORDER BY year ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m, count(v) OVER (PARTITION BY variable_id ORDER BY year ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS n FROM y), l(level) AS (VALUES (25000.0::DOUBLE), (25400.0::DOUBLE), (26000.0::DOUBLE)) SELECT variable_id, level, min(year) AS year FROM w, l WHERE n = 3 AND m >= level GROUP BY 1, 2")
def warming_level_years(spark, sf_dir):
    y = grid(spark, sf_dir).groupBy("variable_id", "year").agg(F.avg("value").alias("anomaly"))
    return diagnostics.warming_level_years(y, [25000.0, 25400.0, 26000.0], ["variable_id"], 3)


# ----------------------------------------------------- solving and the ledger


@query(f"SELECT source_id, sha1(string_agg(slug, chr(10) ORDER BY slug)) AS hash, 'cmip6_' || source_id AS key FROM (SELECT source_id, grid_label || '.' || row_id AS slug FROM {PARTS}) GROUP BY 1")
def execution_key_hash(spark, sf_dir):
    df = part_datasets(spark, sf_dir).withColumn("slug", F.concat_ws(".", "grid_label", F.col("row_id").cast("string")))
    rows = df.withColumn("pairs", fn.selector("source_id")).groupBy("source_id", "pairs").agg(fn.stable_hash(F.collect_list("slug")).alias("hash"))
    return rows.select("source_id", "hash", fn.selector_text("cmip6", F.col("pairs")).alias("key"))


@query(f"""
WITH p AS {PARTS}, a AS (SELECT source_id, string_agg(row_id::VARCHAR, chr(10) ORDER BY row_id::VARCHAR) AS s FROM p WHERE variable_id = 'red' AND size > 10 GROUP BY 1),
b AS (SELECT s_nationkey, string_agg(s_suppkey::VARCHAR, chr(10) ORDER BY s_suppkey::VARCHAR) AS s FROM supplier WHERE s_nationkey IN (1, 2, 3) GROUP BY 1)
SELECT 'cmip6_' || source_id || '__obs4mips_' || s_nationkey AS dataset_key, sha1('cmip6:' || sha1(a.s) || chr(10) || 'obs4mips:' || sha1(b.s)) AS dataset_hash FROM a, b
""")
def solve_two_inputs(spark, sf_dir):
    """The product of the groups of two requirements, with keys and hashes."""
    models = part_datasets(spark, sf_dir).withColumn("instance_id", F.col("row_id").cast("string"))
    references = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("s_nationkey"), F.col("s_suppkey").cast("string").alias("instance_id"), F.col("s_suppkey").alias("row_id"))
    needs = [
        DataRequirement("cmip6", ({"variable_id": ["red"]},), ("source_id",), (constraints.IgnoreFacets({"size": tuple(range(11))}),)),
        DataRequirement("obs4mips", ({"s_nationkey": ["1", "2", "3"]},), ("s_nationkey",)),
    ]
    return solve_inputs(needs, {"cmip6": models, "obs4mips": references}).select("dataset_key", "dataset_hash")


@query(f"""
WITH l AS (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY created_at DESC, id DESC) = 1),
j AS (SELECT g.*, l.id, l.successful, l.dataset_hash, l.created_at, CASE WHEN g.group_id % 2 = 0 THEN '1-URGENT' ELSE l.dataset_hash END AS wanted FROM {GROUPS} g LEFT JOIN l USING (group_id)),
s AS (SELECT *, coalesce(successful IS NULL AND created_at < TIMESTAMP '2000-01-01', false) AS stale FROM j)
SELECT dataset_key FROM s WHERE CASE WHEN id IS NULL THEN true WHEN dataset_hash IS DISTINCT FROM wanted THEN true WHEN successful IS NULL AND NOT stale THEN false WHEN dirty THEN true ELSE coalesce(NOT successful, false) OR stale END
""")
def required_executions(spark, sf_dir):
    runs, g = executions(spark, sf_dir), groups(spark, sf_dir)
    last = ledger.latest_executions(runs).select("group_id", "dataset_hash")
    wanted = g.join(last, "group_id", "left").withColumn("dataset_hash", F.when(F.col("group_id") % 2 == 0, "1-URGENT").otherwise(F.col("dataset_hash"))).drop("id", "dirty", "group_id")
    return ledger.required_executions(wanted, g, runs, True, F.lit("2000-01-01").cast("timestamp_ntz")).select("dataset_key")


@query(f"SELECT id, CASE WHEN successful IS NULL AND created_at < TIMESTAMP '2000-01-01' - INTERVAL 6 HOUR THEN false ELSE successful END AS successful FROM {RUNS}")
def stale_executions(spark, sf_dir):
    done, _ = ledger.fail_stale(executions(spark, sf_dir), groups(spark, sf_dir), F.lit("2000-01-01").cast("timestamp_ntz"))
    return done.select("id", "successful")


@query(f"SELECT group_id AS id, dirty OR group_id IN (SELECT group_id FROM {RUNS} WHERE successful IS NULL AND created_at < TIMESTAMP '2000-01-01' - INTERVAL 6 HOUR) AS dirty FROM {GROUPS}")
def stale_groups(spark, sf_dir):
    _, marked = ledger.fail_stale(executions(spark, sf_dir), groups(spark, sf_dir), F.lit("2000-01-01").cast("timestamp_ntz"))
    return marked.select("id", "dirty")


@query("SELECT state, count(*) AS n FROM (SELECT CASE WHEN n.p_partkey IS NULL THEN 'kept' WHEN o.p_partkey IS NULL THEN 'created' WHEN o.p_size % 3 = 0 AND nullif(o.p_size, 6) IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS state FROM (SELECT * FROM part WHERE p_partkey % 5 <> 0) o FULL JOIN (SELECT * FROM part WHERE p_partkey % 7 <> 0) n USING (p_partkey)) GROUP BY 1")
def upsert_states(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("slug"), F.col("p_size").alias("levels"))
    changed = parts.withColumn("levels", F.when(F.col("levels") == 6, None).when(F.col("levels") % 3 == 0, F.col("levels") + 1).otherwise(F.col("levels")))
    states = upsert.upsert_datasets(parts.where("slug % 5 <> 0"), changed.where("slug % 7 <> 0"))
    return upsert.ingestion_statistics(states)


@query("SELECT dataset_id, path, state FROM (SELECT o_custkey AS dataset_id, o_orderkey AS path, CASE WHEN o_orderkey % 7 = 0 THEN 'removed' WHEN o_orderkey % 5 = 0 THEN 'added' WHEN o_orderkey % 3 = 0 THEN 'updated' ELSE 'unchanged' END AS state, o_orderkey FROM orders) WHERE NOT (o_orderkey % 5 = 0 AND o_orderkey % 7 = 0)")
def file_changes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("path"), F.lit("a").alias("start_time"), F.lit("b").alias("end_time"))
    new = o.where("path % 7 <> 0").withColumn("end_time", F.when(F.col("path") % 3 == 0, "c").otherwise("b"))
    return upsert.diff_files(o.where("path % 5 <> 0"), new).select("dataset_id", "path", "state")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT p_name FROM part) WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size > 45)")
def new_by_hash(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.sha2("p_name", 256).alias("hash"), "p_size")
    return upsert.new_by_hash(p.where("p_size > 45"), p).agg(F.count("*").alias("n"))


@query("SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0)")
def missing_reference(spark, sf_dir):
    need = table(spark, sf_dir, "nation").select("n_nationkey", F.lit("obs4mips").alias("source_type"), F.col("n_nationkey").alias("source_id"))
    have = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.lit("obs4mips").alias("source_type"), F.col("s_nationkey").alias("source_id"))
    return agg.missing_references(need, have).select("n_nationkey")


@query("SELECT 'overlapping-registries' AS \"check\", CAST(n_nationkey AS VARCHAR) AS subject FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) AND n_nationkey IN (SELECT c_nationkey FROM customer)")
def doctor_registries(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").select(F.lit("suppliers").alias("registry"), F.col("s_nationkey").alias("source_id"))
    b = table(spark, sf_dir, "customer").select(F.lit("customers").alias("registry"), F.col("c_nationkey").alias("source_id"))
    return doctor.run_checks({"registry": a.unionByName(b)}, names=["overlapping-registries"]).select("check", "subject")


# ------------------------------------------------------------------ functions


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) ELSE -1 END AS vkey, 'P.' || p_brand || '.' || p_type AS instance_id, lower(replace(p_name, ' ', '-')) AS slug FROM part")
def identifiers(spark, sf_dir):
    version = F.concat(F.when(F.col("p_size") % 2 == 0, "v").otherwise("x"), "p_size")
    return table(spark, sf_dir, "part").select("p_partkey", fn.version_key(version).alias("vkey"), fn.instance_id("P", "p_brand", "p_type").alias("instance_id"), fn.slugify(F.col("p_name")).alias("slug"))


@query("SELECT o_orderkey, CAST(datediff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS ordinal, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS back FROM orders")
def calendar_ordinals(spark, sf_dir):
    standard = F.lit("standard")
    df = table(spark, sf_dir, "orders").withColumn("t", cal.parse_time(F.date_format("o_orderdate", "yyyy-MM-dd"), standard)).withColumn("ordinal", cal.ordinal(F.col("t"), standard))
    return df.select("o_orderkey", "ordinal", cal.time_text(cal.from_ordinal(F.col("ordinal"), standard)).alias("back"))


@query("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + INTERVAL 7 MONTH, '%Y%m%dT000000') AS moved FROM orders")
def shifted_months(spark, sf_dir):
    standard = F.lit("standard")
    t = cal.parse_time(F.date_format("o_orderdate", "yyyy-MM-dd"), standard)
    return table(spark, sf_dir, "orders").select("o_orderkey", cal.compact_text(cal.shift_months(t, 7, standard)).alias("moved"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS start_time, strftime(o_orderdate, '%Y-%m-30') AS end_time FROM orders")
def date_ranges(spark, sf_dir):
    month = F.date_format("o_orderdate", "yyyyMM")
    r = cal.parse_date_range(F.concat_ws("-", month, month))
    return table(spark, sf_dir, "orders").select("o_orderkey", r["start_time"].alias("start_time"), r["end_time"].alias("end_time"))


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice - 273.15), 2) AS c FROM lineitem GROUP BY 1")
def celsius(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", fn.to_celsius(F.col("l_extendedprice"), F.lit(" K ")).alias("x")).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("x"), 2).alias("c"))
