"""Queries of sources, column functions and catalogue changes, each beside equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import calendars as cal
from meridian.functions import catalog as fn
from meridian.operators import aggregates as agg
from meridian.operators import constraints, filters, quantiles, windows
from meridian.plans import branches, diagnostics, doctor, ingest, upsert
from meridian.queries import EVENTS, PARTS, event_rows, part_datasets, query, spread, table
from meridian.sources import catalogs, paths

# ------------------------------------------------------------- paths and headers

def part_paths(spark, sf_dir) -> DataFrame:
    """Parts as CMIP6 files; every tenth name is too short, every eleventh table unknown, every seventh without dates."""
    k = F.col("p_partkey")
    t = F.when(k % 11 == 0, "Xmon").when(k % 3 == 0, "Oday").otherwise("Amon")
    member = F.concat(F.when(k % 5 == 0, "s1960-").otherwise(""), F.lit("r"), k % 9, F.lit("i1p1f1"))
    name = F.when(k % 10 == 0, F.concat_ws("_", "p_type", t, "p_brand")).otherwise(F.concat_ws("_", "p_type", t, "p_brand", F.lit("hist"), member, F.lit("gn"), F.when(k % 7 != 0, "200001-200112")))
    path = F.concat(F.lit("/data/CMIP6/CMIP/"), F.concat_ws("/", F.concat(F.lit("I"), "p_size"), "p_brand", F.lit("hist"), member, t, "p_type", F.lit("gn"), F.concat(F.lit("v"), 20200000 + k), F.concat(name, F.lit(".nc"))))
    return table(spark, sf_dir, "part").select("p_partkey", path.alias("path"))


PART_PATHS = """(SELECT *, CASE WHEN p_partkey % 11 = 0 THEN 'Xmon' WHEN p_partkey % 3 = 0 THEN 'Oday' ELSE 'Amon' END AS t, CASE WHEN p_partkey % 5 = 0 THEN 's1960-' ELSE '' END || 'r' || (p_partkey % 9) || 'i1p1f1' AS member, p_partkey % 10 <> 0 AS ok,
  'v' || (20200000 + p_partkey) AS version FROM part)"""


@query(f"""
SELECT p_partkey, CASE WHEN ok THEN p_brand END AS source_id, CASE WHEN ok THEN 'I' || p_size END AS institution_id, CASE WHEN ok THEN 'r' || (p_partkey % 9) || 'i1p1f1' END AS variant_label,
  CASE WHEN ok THEN CASE WHEN p_partkey % 5 = 0 THEN 's1960' ELSE 'none' END END AS sub_experiment_id, CASE WHEN ok THEN CASE t WHEN 'Oday' THEN 'day' WHEN 'Amon' THEN 'mon' END END AS frequency, version,
  CASE WHEN ok AND p_partkey % 7 <> 0 THEN '2000-01-01' END AS start_time, CASE WHEN ok AND p_partkey % 7 <> 0 THEN '2001-12-30' END AS end_time,
  CASE WHEN NOT ok THEN 'not six or seven name parts' WHEN t = 'Xmon' THEN 'unknown table' END AS invalid_asset,
  CASE WHEN ok THEN concat_ws('.', 'CMIP6', 'CMIP', 'I' || p_size, p_brand, 'hist', member, t, p_type, 'gn', version) END AS instance_id FROM {PART_PATHS}
""")
def cmip6_paths(spark, sf_dir):
    rows = paths.cmip6_from_path(part_paths(spark, sf_dir))
    return rows.select("p_partkey", "source_id", "institution_id", "variant_label", "sub_experiment_id", "frequency", "version", "start_time", "end_time", "invalid_asset", "instance_id")


@query("""
SELECT c_custkey, CASE WHEN ok THEN c_mktsegment END AS source_id, CASE WHEN ok THEN 'glb' END AS region, CASE WHEN ok THEN 'tavg' END AS branding_suffix, '2001-01-01' AS start_time, CASE WHEN NOT ok THEN 'too few folders' END AS invalid_asset,
  CASE WHEN ok THEN concat_ws('.', 'CMIP7', 'CMIP', 'I' || c_nationkey, c_mktsegment, 'hist', 'r1i1p1f1', 'glb', 'mon', 'tas', 'tavg', 'gn', 'v3') END AS instance_id
FROM (SELECT *, c_custkey % 6 <> 0 AS ok FROM customer)
""")
def cmip7_paths(spark, sf_dir):
    k = F.col("c_custkey")
    whole = F.concat(F.lit("/MIP-DRS7/CMIP7/CMIP/I"), "c_nationkey", F.lit("/"), "c_mktsegment", F.lit("/hist/r1i1p1f1/glb/mon/tas/tavg/gn/v3/tas_tavg_mon_2001-2004.nc"))
    df = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 6 != 0, whole).otherwise(F.lit("/short/v3/tas_2001-2004.nc")).alias("path"))
    return paths.cmip7_from_path(df).select("c_custkey", "source_id", "region", "branding_suffix", "start_time", "invalid_asset", "instance_id")


@query("""
SELECT c_custkey, CASE WHEN ok THEN 'S' || c_nationkey END AS source_id, CASE WHEN ok THEN 'CMIP' END AS activity_id, CASE WHEN ok THEN 'I' || c_nationkey % 3 END AS institution_id, CASE WHEN ok THEN c_mktsegment END AS experiment_id, CASE WHEN ok THEN 'tavg-h2m-hxy-u' END AS branding_suffix,
  CASE WHEN ok AND c_custkey % 5 <> 0 THEN '2001-01-01' END AS start_time, CASE WHEN ok AND c_custkey % 5 <> 0 THEN '2004-12-30' END AS end_time, 'v20250101' AS version,
  CASE WHEN c_custkey % 6 = 0 THEN 'not eight or nine name parts' WHEN c_custkey % 7 = 0 THEN 'no folder of the source below activity and institution' END AS invalid_asset,
  CASE WHEN ok THEN concat_ws('.', 'CMIP7', 'CMIP', 'I' || c_nationkey % 3, 'S' || c_nationkey, c_mktsegment, 'r1i1p1f1', 'glb', 'mon', 'tas', 'tavg-h2m-hxy-u', 'gn', 'v20250101') END AS instance_id FROM (SELECT *, c_custkey % 6 <> 0 AND c_custkey % 7 <> 0 AS ok FROM customer)
""")
def cmip7_file_names(spark, sf_dir):
    """Names of eight parts and of nine; every sixth of seven, every seventh in a folder of another source."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    source = F.concat(F.lit("S"), n)
    folder = F.concat(F.lit("/data/MIP-DRS7/CMIP7/CMIP/I"), n % 3, F.lit("/"), F.when(k % 7 == 0, "other").otherwise(source), F.lit("/x/r1i1p1f1/glb/mon/tas/tavg-h2m-hxy-u/gn/v20250101/"))
    name = F.concat_ws("_", F.lit("tas"), F.lit("tavg-h2m-hxy-u"), F.lit("mon"), F.when(k % 6 != 0, "glb"), F.lit("gn"), source, "c_mktsegment", F.lit("r1i1p1f1"), F.when((k % 5 != 0) & (k % 6 != 0), "200101-200412"))
    rows = paths.cmip7_from_name(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.concat(folder, name, F.lit(".nc")).alias("path")))
    return rows.select("c_custkey", "source_id", "activity_id", "institution_id", "experiment_id", "branding_suffix", "start_time", "end_time", "version", "invalid_asset", "instance_id")


@query("""
SELECT s_suppkey, CASE kind WHEN 0 THEN 'OBS6' WHEN 1 THEN 'native6' WHEN 2 THEN 'obs4MIPs' END AS project, CASE WHEN kind < 2 THEN 'Tier2' END AS tier, CASE WHEN kind < 3 THEN s_name END AS source_id,
  CASE kind WHEN 0 THEN '1.0' WHEN 1 THEN 'v5' WHEN 2 THEN 'v20' END AS version, CASE WHEN kind = 0 THEN 'Amon' END AS table_id, CASE WHEN kind < 3 THEN 'tas' END AS variable_id, CASE WHEN kind = 3 THEN 'no known layout' END AS invalid_asset
FROM (SELECT *, s_suppkey % 4 AS kind FROM supplier)
""")
def reference_paths(spark, sf_dir):
    kind, name = F.col("s_suppkey") % 4, F.col("s_name")
    path = (
        F.when(kind == 0, F.concat(F.lit("/d/OBS6/Tier2/"), name, F.lit("/OBS6_x_sat_1.0_Amon_tas_2000.nc"))).when(kind == 1, F.concat(F.lit("/d/native6/Tier2/"), name, F.lit("/v5/tas_x.nc")))
        .when(kind == 2, F.concat(F.lit("/d/obs4MIPs/"), name, F.lit("/v20/tas_mon.nc"))).otherwise(F.concat(F.lit("/d/OBS/TierX/"), name, F.lit("/tas.nc")))
    )
    rows = paths.reference_from_path(table(spark, sf_dir, "supplier").select("s_suppkey", path.alias("path")))
    return rows.select("s_suppkey", "project", "tier", "source_id", "version", "table_id", "variable_id", "invalid_asset")


@query("""
SELECT s_suppkey, CASE kind WHEN 0 THEN 'S' || s_suppkey WHEN 1 THEN 'S' || s_suppkey END AS source_id, CASE WHEN kind < 2 THEN 'ts' END AS variable_id, CASE WHEN kind < 2 THEN 'gn' END AS grid_label, CASE kind WHEN 0 THEN 'v2025' WHEN 1 THEN 'v2024' END AS version,
  CASE WHEN kind >= 2 THEN 'no known key' END AS invalid_asset FROM (SELECT *, s_suppkey % 4 AS kind FROM supplier)
""")
def registry_keys(spark, sf_dir):
    """A key of eight parts, a climatology, a name without dates and a short key."""
    kind, s = F.col("s_suppkey") % 4, F.concat(F.lit("S"), "s_suppkey")
    head = F.concat(F.lit("obs4REF/MOHC/"), s, F.lit("/mon/ts/gn/v2025/"))
    key = (
        F.when(kind == 0, F.concat(head, F.lit("ts_mon_"), s, F.lit("_PCMDI_gn_187001-202501.nc"))).when(kind == 1, F.concat(F.lit("clim/ts/"), s, F.lit("/gn/ts_mon_x_AC_v2024.nc")))
        .when(kind == 2, F.concat(head, F.lit("notes.nc"))).otherwise(F.lit("a/b.nc"))
    )
    return paths.registry_key(table(spark, sf_dir, "supplier").select("s_suppkey", key.alias("key"))).select("s_suppkey", "source_id", "variable_id", "grid_label", "version", "invalid_asset")


def headers(spark, sf_dir, attributes) -> DataFrame:
    """Customers as files whose headers were read: every ninth without one, every fourth without a source, every fifth a fixed field."""
    k = F.col("c_custkey")
    given = {n: F.lit(f"{n}-x") for n in attributes} | {"source_id": F.when(k % 4 != 0, F.col("c_mktsegment")), "activity_id": F.when(k % 7 == 0, "other").otherwise("obs4MIPs"), "sub_experiment_id": F.when(k % 2 == 0, "s1960").otherwise("none")}
    header = F.map_filter(F.create_map(*(x for n, v in given.items() for x in (F.lit(n), v))), lambda _, v: v.isNotNull())
    return spread(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").select(
        "c_custkey", F.concat(F.lit("/d/v7/f"), k, F.lit(".nc")).alias("path"), F.when(k % 9 != 0, header).alias("header"), F.when(k % 5 != 0, F.array(F.lit(0.5), F.lit(364.5))).alias("times"), F.lit("days since 2001-01-01").alias("time_units"),
        F.lit("noleap").alias("calendar"), F.when(k % 3 == 0, F.create_map(F.lit("plev"), F.lit(19), F.lit("x"), F.lit(4))).otherwise(F.create_map(F.lit("x"), F.lit(4))).alias("dimensions"),
    )


def _header_sql(valid: str, what: str, extra: str = "") -> str:
    return f"""
SELECT c_custkey, CASE WHEN ok THEN {"c_mktsegment" if extra else "CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END"} END AS source_id, CASE WHEN ok AND c_custkey % 5 <> 0 THEN '2001-01-01 12:00:00' END AS start_time, CASE WHEN ok AND c_custkey % 5 <> 0 THEN '2001-12-31 12:00:00' END AS end_time,
  CASE WHEN ok THEN CASE WHEN c_custkey % 3 = 0 THEN 19 ELSE 1 END END AS vertical_levels, ok AS finalised, CASE WHEN c_custkey % 9 = 0 THEN 'no header' WHEN NOT ok THEN 'missing attributes: ' || {what} END AS invalid_asset, 'v7' AS version
FROM (SELECT *, {valid} AS ok FROM customer)"""


def _header_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: cal.time_text(F.col(c)) for c in ("start_time", "end_time")}).select("c_custkey", "source_id", "start_time", "end_time", "vertical_levels", "finalised", "invalid_asset", "version")


@query(_header_sql("c_custkey % 9 <> 0", "''"))
def cmip6_headers(spark, sf_dir):
    return _header_columns(paths.cmip6_from_header(headers(spark, sf_dir, paths.CMIP6_ATTRIBUTES)))


@query(_header_sql("c_custkey % 9 <> 0 AND c_custkey % 4 <> 0", "'source_id'", "x"))
def cmip7_headers(spark, sf_dir):
    return _header_columns(paths.cmip7_from_header(headers(spark, sf_dir, paths.CMIP7_ATTRIBUTES)))


@query(_header_sql("c_custkey % 9 <> 0 AND c_custkey % 4 <> 0 AND c_custkey % 7 <> 0", "CASE WHEN c_custkey % 7 = 0 THEN 'an activity of observations' ELSE 'source_id' END", "x"))
def observation_headers(spark, sf_dir):
    return _header_columns(paths.observations_from_header(headers(spark, sf_dir, paths.OBS_ATTRIBUTES)))


@query("SELECT n_nationkey, 'tas_tavg_mon_glb_gn_' || n_name || '_hist_r1_' || (1990 + n_nationkey) || '01-' || (1990 + n_nationkey) || '12.nc' AS name, 'MIP-DRS7/CMIP7/CMIP/X/' || n_name || '/hist/r1/glb/mon/tas/tavg/gn/v1' AS folder FROM nation")
def cmip7_names(spark, sf_dir):
    year = 1990 + F.col("n_nationkey")
    when = [cal.parse_time(F.format_string(f"%04d-{m}", year), F.lit("standard")) for m in ("01-01", "12-31")]
    facets = {"variable_id": "tas", "branding_suffix": "tavg", "frequency": "mon", "region": "glb", "grid_label": "gn", "experiment_id": "hist", "variant_label": "r1", "activity_id": "CMIP", "institution_id": "X", "version": "v1"}
    df = table(spark, sf_dir, "nation").withColumns({k: F.lit(v) for k, v in facets.items()} | {"source_id": F.col("n_name")}).withColumn("time_range", cal.month_range_text(*when, F.col("frequency")))
    return df.select("n_nationkey", paths.cmip7_file_name().alias("name"), paths.cmip7_path().alias("folder"))


@query("SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'tas_tavg' END AS branded_variable, CASE WHEN p_type = 'SMALL' THEN 'nh' ELSE 'glb' END AS region, 'r' || p_size AS realization_index, 'f3' AS forcing_index, 'mon' AS frequency FROM part")
def converted_attributes(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.lit("Amon").alias("table_id"), F.when(F.col("p_type") == "SMALL", "tas").otherwise("pr").alias("variable_id"), F.concat(F.lit("r"), "p_size", F.lit("i1p1f3")).alias("variant_label"), F.lit(None).cast("string").alias("frequency"))
    mapping = spark.createDataFrame([("Amon", "tas", "tavg", "nh", "atmos")], "table_id string, variable_id string, branding_suffix string, region string, realm string")
    return paths.cmip7_attributes(df, mapping).select("p_partkey", "branded_variable", "region", "realization_index", "forcing_index", "frequency")


# ------------------------------------------------------------------- catalogues


@query(f"""
WITH d AS (SELECT * FROM {PARTS} WHERE row_id % 6 <> 0 QUALIFY rank() OVER (PARTITION BY source_id, grid_label ORDER BY size DESC) = 1)
SELECT row_id AS dataset_id, o_orderkey AS path, CAST(datediff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS start_ord FROM d JOIN orders ON o_custkey = row_id
""")
def loaded_catalog(spark, sf_dir):
    """Files of the latest datasets that are not retracted."""
    parts = part_datasets(spark, sf_dir).withColumn("retracted_at", F.when(F.col("row_id") % 6 == 0, F.lit("2020-01-01")))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    files = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("path"), day.alias("start_time"), day.alias("end_time"))
    return catalogs.load_catalog(parts, files, ("source_id", "grid_label")).select("dataset_id", "path", "start_ord")


@query("SELECT c_custkey AS key, min(o_orderkey) AS row_id, min(o_orderdate) AS time_start, max(o_orderdate) AS time_end FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def search_results_once(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("row_id"), F.col("o_orderdate").alias("time_start"), F.col("o_orderdate").alias("time_end"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return catalogs.deduplicated(df.join(known, "key", "left_semi")).select("key", "row_id", "time_start", "time_end")


@query("SELECT '/new/' || n_name AS path, n_regionkey AS region, NULL::INTEGER AS extra FROM nation UNION ALL SELECT '/other/' || r_name, NULL, r_regionkey FROM region")
def scans_in_one(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.concat(F.lit("/old/"), "n_name").alias("path"), F.col("n_regionkey").alias("region"))
    b = table(spark, sf_dir, "region").select(F.concat(F.lit("/other/"), "r_name").alias("path"), F.col("r_regionkey").alias("extra"))
    return catalogs.union_catalogs([a, b], {"/old/": "/new/"})


@query(f"SELECT row_id, CASE WHEN row_id % 4 = 0 THEN -1 ELSE size END AS version_key FROM {PARTS}")
def version_keys(spark, sf_dir):
    df = part_datasets(spark, sf_dir).withColumn("version", F.when(F.col("row_id") % 4 == 0, "latest").otherwise(F.col("version")))
    return catalogs.with_version_key(df).select("row_id", "version_key")


@query(f"SELECT instance_id, start_time FROM (SELECT source_id AS instance_id, CASE WHEN row_id % 3 <> 0 THEN lpad(CAST(row_id AS VARCHAR), 8, '0') END AS start_time FROM {PARTS}) ORDER BY instance_id, start_time NULLS LAST LIMIT 40")
def sorted_catalog_head(spark, sf_dir):
    df = part_datasets(spark, sf_dir).select(F.col("source_id").alias("instance_id"), F.when(F.col("row_id") % 3 != 0, F.lpad(F.col("row_id").cast("string"), 8, "0")).alias("start_time"))
    return windows.sorted_catalog(df).limit(40)


@query(f"SELECT row_id AS id FROM {PARTS} WHERE source_id = 'Brand#3' ORDER BY size DESC, row_id DESC LIMIT 1")
def dataset_by_slug(spark, sf_dir):
    df = part_datasets(spark, sf_dir).select(F.col("row_id").alias("id"), F.col("source_id").alias("slug"), F.col("size").alias("version_key"))
    return windows.latest_by_slug(df, "Brand#3").select("id")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS n FROM orders")
def numbered_rows(spark, sf_dir):
    return agg.numbered(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "n").select("o_orderkey", "n")


@query("SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate), row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS n FROM orders")
def numbered_whole_orders(spark, sf_dir):
    """All columns, so that the ranges of the numbers and those of the rows would differ if they were dealt twice."""
    return agg.numbered(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], "n").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice, row_number() OVER (ORDER BY l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_discount, l_tax, l_returnflag) - 1 AS n FROM lineitem")
def numbered_whole_lines(spark, sf_dir):
    rows = agg.numbered(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"], "n")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice", "n")


@query("SELECT o_orderkey, o_custkey, CAST(coalesce(sum(o_custkey % 7) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM orders")
def totals_before(spark, sf_dir):
    """Running totals inside three groups of a third of all rows each."""
    rows = agg.running_total(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], F.col("o_custkey") % 7, ["o_orderstatus"])
    return rows.select("o_orderkey", "o_custkey", "before")


@query("SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def latest_by_aggregate(spark, sf_dir):
    return windows.latest_by_aggregate(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey")


@query("""
SELECT nullif(l_returnflag, 'R') AS flag, round(quantile_cont(CASE WHEN l_linenumber <> 4 THEN l_extendedprice END, 0.5), 6) AS mid, round(quantile_cont(l_quantity, 0.9), 6) AS high, round(quantile_cont(CASE WHEN l_linenumber > 100 THEN l_tax END, 0.5), 6) AS none
FROM lineitem GROUP BY 1
""")
def exact_percentiles(spark, sf_dir):
    """Null keys, null values, many ties, and a value that is null everywhere."""
    df = table(spark, sf_dir, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("R")))
    n = F.col("l_linenumber")
    found = quantiles.exact_percentiles(df, ["flag"], {"mid": (F.when(n != 4, F.col("l_extendedprice")), 0.5), "high": (F.col("l_quantity"), 0.9), "none": (F.when(n > 100, F.col("l_tax")), 0.5)})
    return found.withColumns({c: F.round(c, 6) for c in ("mid", "high", "none")})


# ---------------------------------------------------------------------- filters


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2') AND p_size % 3 <> 0 AND p_type = 'SMALL'")
def metadata_facets(spark, sf_dir):
    """A facet that a row lacks is a mismatch."""
    meta = F.map_filter(F.create_map(F.lit("brand"), "p_brand", F.lit("kind"), F.when(F.col("p_size") % 3 != 0, F.col("p_type"))), lambda _, v: v.isNotNull())
    return table(spark, sf_dir, "part").where(filters.matches_facets(meta, {"brand": ["Brand#1", "Brand#2"], "kind": ["SMALL"]})).select("p_partkey")


@query(f"SELECT source_id, grid_label, version FROM {PARTS}")
def dataset_columns(spark, sf_dir):
    return filters.subset_columns(part_datasets(spark, sf_dir), ["version", "source_id", "grid_label"])


@query("""
SELECT CASE WHEN c_mktsegment LIKE 'B%' AND c_nationkey BETWEEN 10 AND 19 THEN 'big' WHEN c_nationkey = 3 THEN 'three' WHEN c_mktsegment = 'MACHINERY' THEN 'machines' ELSE 'rest' END AS queue, count(*) AS n FROM customer GROUP BY 1
""")
def routed_tasks(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("provider"), F.concat(F.lit("d"), "c_nationkey").alias("diagnostic"))
    return agg.queue_counts(filters.routed(df, [("B*", "d1?", "big"), ("*", "d3", "three")], {"MACHINERY": "machines"}, "rest"))


@query("SELECT '/a/' || n_regionkey || '/' || n_name AS path FROM nation WHERE n_regionkey IN (1, 3) OR n_name = 'CHINA'")
def changed_paths(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_regionkey", F.concat(F.lit("/a/"), "n_regionkey", F.lit("/"), "n_name").alias("path"), "n_name")
    roots = spark.createDataFrame([("/a/1/",), ("/a/3",), ("/a",)], "root string").where("root <> '/a'").unionByName(nation.where("n_name = 'CHINA'").select(F.col("path").alias("root")))
    return filters.touches(nation, roots)


@query("SELECT 'with' AS kind, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'without', count(*) FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT 'all', count(*) FROM orders")
def reference_series(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "r").alias("reference_id"))
    rows = {"with": True, "without": False, "all": None}
    found = [filters.reference_filter(df, only).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, only in rows.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND (l_linenumber <= 2 OR l_returnflag = 'A') GROUP BY 1, 2")
def measured_since(spark, sf_dir):
    """Measured rows, and failed ones without a measurement."""
    n = F.col("l_linenumber")
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(n == 1, F.col("l_tax")).alias("wall_seconds"), F.lit(None).cast("double").alias("cpu_seconds"), F.when(n == 2, 7).cast("long").alias("peak_memory_bytes"), F.when(F.col("l_returnflag") == "A", False).when(F.col("l_returnflag") == "N", True).alias("successful"), F.col("l_shipdate").alias("created_at"))
    return filters.measured(df, F.lit("1998-01-01").cast("timestamp_ntz")).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query(f"SELECT row_id FROM {EVENTS} WHERE start_ord >= 1704931200 AND start_ord < 1706745600")
def partial_times(spark, sf_dir):
    """Times not before 11 January 2024 and not after January of that year."""
    df = event_rows(spark, sf_dir).withColumn("t", cal.parse_time(F.date_format(F.timestamp_seconds("start_ord"), "yyyy-MM-dd HH:mm:ss"), F.lit("standard")))
    return df.where(cal.at_or_after(F.col("t"), year=2024, month=1, day=11) & cal.at_or_before(F.col("t"), year=2024, month=1)).select("row_id")


# ------------------------------------------------------------ requirement summaries


def requirement_rows(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(F.col("c_mktsegment").alias("source_type"), F.concat(F.lit("d"), F.col("c_custkey") % 7).alias("diagnostic"), F.when(F.col("c_custkey") % 4 != 0, F.array(F.concat(F.lit("e"), "n_regionkey"))).alias("experiments"), F.array("n_name").alias("variables"), F.array(F.concat(F.lit("s"), F.col("c_custkey") % 5)).alias("sources"))


NEEDS = "(SELECT c_mktsegment AS source_type, 'd' || (c_custkey % 7) AS diagnostic, CASE WHEN c_custkey % 4 <> 0 THEN 'e' || n_regionkey ELSE '*' END AS experiment, n_name AS variable, 's' || (c_custkey % 5) AS source_id FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(f"SELECT source_type, experiment, variable, list_sort(list(DISTINCT diagnostic)) AS diagnostics FROM {NEEDS} GROUP BY 1, 2, 3")
def diagnostics_by_variable(spark, sf_dir):
    rows = agg.diagnostics_by_variable(requirement_rows(spark, sf_dir)).select("source_type", F.explode("experiments").alias("e"))
    return rows.select("source_type", F.col("e.experiment").alias("experiment"), F.explode("e.variables").alias("v")).select("source_type", "experiment", F.col("v.variable").alias("variable"), F.col("v.diagnostics").alias("diagnostics"))


@query(f"SELECT source_type, source_id, list_sort(list(DISTINCT variable)) AS variables, list_sort(list(DISTINCT diagnostic)) AS diagnostics FROM {NEEDS} GROUP BY 1, 2")
def required_references(spark, sf_dir):
    return agg.required_references(requirement_rows(spark, sf_dir))


@query("""
SELECT * FROM (SELECT 'error' AS severity, count(*) AS n FROM (SELECT DISTINCT s_nationkey FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey - c_nationkey % 2 FROM customer))
UNION ALL SELECT 'info', count(DISTINCT c_mktsegment) FROM customer) WHERE n > 0
""")
def findings_by_severity(spark, sf_dir):
    """References of nations with an odd number are missing; no requirement asks for segments."""
    have = table(spark, sf_dir, "customer").select(F.lit("need").alias("source_type"), (F.col("c_nationkey") - F.col("c_nationkey") % 2).alias("source_id"), "c_mktsegment")
    have = have.select("source_type", "source_id").unionByName(have.select(F.col("c_mktsegment").alias("source_type"), "source_id"))
    need = table(spark, sf_dir, "supplier").select(F.lit("need").alias("source_type"), F.col("s_nationkey").alias("source_id")).distinct()
    return doctor.severity_counts(doctor.run_checks({"datasets": have, "required": need}, names=["missing-reference", "unreachable-type"]))


@query("SELECT 'unreachable-type' AS \"check\", r_name AS subject FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation WHERE n_nationkey > 20)")
def unreachable_types(spark, sf_dir):
    have = table(spark, sf_dir, "region").select(F.col("r_name").alias("source_type"), F.lit("x").alias("source_id"))
    need = table(spark, sf_dir, "nation").where("n_nationkey > 20").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("source_type"), F.lit("x").alias("source_id"))
    return doctor.run_checks({"datasets": have, "required": need}, names=["unreachable-type"]).select("check", "subject")


@query(f"SELECT 'duplicate-coverage' AS \"check\", CAST(user_id AS VARCHAR) AS subject, 'covered twice: ' || row_id AS message FROM (SELECT *, max(end_ord + 7200) OVER (PARTITION BY user_id ORDER BY start_ord, CAST(row_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM {EVENTS}) WHERE start_ord <= until")
def covered_twice(spark, sf_dir):
    files = event_rows(spark, sf_dir).select(F.col("user_id").alias("dataset_id"), F.col("row_id").cast("string").alias("path"), "start_ord", (F.col("end_ord") + 7200).alias("end_ord"))
    return doctor.run_checks({"files": files}, names=["duplicate-coverage"]).select("check", "subject", "message")


@query(f"""
SELECT 'duplicate-coverage' AS "check", CAST(user_id AS VARCHAR) AS subject, 'covered twice: ' || row_id AS message FROM (SELECT *, max(end_ord + 7200) OVER (PARTITION BY user_id ORDER BY start_ord, CAST(row_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM {EVENTS}) WHERE start_ord <= until
UNION ALL SELECT 'missing-reference', 'required', 'the check could not run' UNION ALL SELECT 'overlapping-registries', 'registry', 'the check could not run'
""")
def failing_check(spark, sf_dir):
    """Checks without their tables are findings, beside those of a check that has them."""
    files = event_rows(spark, sf_dir).select(F.col("user_id").alias("dataset_id"), F.col("row_id").cast("string").alias("path"), "start_ord", (F.col("end_ord") + 7200).alias("end_ord"))
    found = doctor.run_checks({"files": files, "datasets": files}, names=["duplicate-coverage", "missing-reference", "overlapping-registries"])
    return found.select("check", "subject", "message")


# -------------------------------------------------------------- catalogue changes


@query("SELECT p_partkey AS path, CASE WHEN p_size % 2 = 0 THEN p_brand WHEN p_partkey % 3 = 0 AND p_partkey % 5 <> 0 THEN coalesce(nullif(p_type, 'SMALL'), p_brand) ELSE p_brand END AS source, p_size % 2 = 0 OR p_partkey % 3 = 0 AS finalised FROM part")
def finalised_rows(spark, sf_dir):
    """Headers fill in what is not final; a null in them overwrites nothing."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.col("p_partkey").alias("path"), F.col("p_brand").alias("source"), (F.col("p_size") % 2 == 0).alias("finalised"))
    parsed = p.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("path"), F.when(F.col("p_partkey") % 5 != 0, F.nullif("p_type", F.lit("SMALL"))).alias("source"))
    return upsert.finalise(rows, parsed)


@query("SELECT count(DISTINCT l_orderkey) AS datasets, count(*) AS files FROM lineitem WHERE l_linestatus = 'O'")
def unfinalised_counts(spark, sf_dir):
    return upsert.unfinalised(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dataset_id"), (F.col("l_linestatus") != "O").alias("finalised")))


@query("SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size > 25 THEN coalesce(CASE WHEN p_partkey % 2 = 0 THEN 'before' END, 'now') WHEN p_partkey % 2 = 0 THEN 'before' END AS retracted_at FROM part")
def retracted_rows(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 2 == 0, "before").alias("retracted_at"))
    return upsert.unretract(upsert.retract(df, F.col("p_size") > 25, F.lit("now")), F.col("p_size") % 7 == 0).select("p_partkey", "retracted_at")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1) GROUP BY 1")
def valid_datasets(spark, sf_dir):
    return upsert.validate(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_partkey"], ["l_returnflag"], skip_invalid=True).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""
SELECT slug, CASE WHEN o_final AND NOT n_final THEN o_size ELSE n_size END AS levels, CASE WHEN o_final AND NOT n_final THEN o_final ELSE n_final END AS finalised,
  CASE WHEN (o_final AND NOT n_final) OR (o_size = n_size AND o_final = n_final) THEN 'unchanged' ELSE 'updated' END AS state
FROM (SELECT CAST(p_partkey AS VARCHAR) AS slug, p_size AS o_size, p_size % 2 = 0 AS o_final, p_size + p_partkey % 3 AS n_size, p_partkey % 5 = 0 AS n_final FROM part)
""")
def upsert_never_downgrades(spark, sf_dir):
    """Paths alone never overwrite what headers gave."""
    p = table(spark, sf_dir, "part").withColumn("slug", F.col("p_partkey").cast("string"))
    old = p.select("slug", F.col("p_size").cast("long").alias("levels"), (F.col("p_size") % 2 == 0).alias("finalised"))
    new = p.select("slug", (F.col("p_size") + F.col("p_partkey") % 3).alias("levels"), (F.col("p_partkey") % 5 == 0).alias("finalised"))
    return upsert.upsert_datasets(old, new)


# ------------------------------------------------------------------ result ingest


def series(spark, sf_dir) -> DataFrame:
    """Embeddings as series: copies of one another by label, on two axes."""
    e = table(spark, sf_dir, "embeddings").where("label is not null")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("values"))
    rows = e.select("label", "vec_id").join(first, "label")
    axis = F.when(F.col("vec_id") % 2 == 0, F.array(F.lit("1"), F.lit("2"))).otherwise(F.array(F.lit("1")))
    return rows.select(F.col("vec_id").alias("execution_id"), F.col("values").cast("array<double>").alias("values"), axis.alias("index"), F.lit("time").alias("index_name"), F.when(F.col("vec_id") % 3 == 0, "reference").alias("kind"), F.concat(F.lit("m"), "label").alias("metric"))


@query("""
SELECT 'm' || label AS metric, kind, count(*) AS n, CAST(CASE kind WHEN 'reference' THEN count(DISTINCT odd) ELSE 0 END AS BIGINT) AS reference_ids
FROM (SELECT label, CASE WHEN vec_id % 3 = 0 THEN 'reference' ELSE 'model' END AS kind, vec_id % 2 AS odd FROM embeddings WHERE label IS NOT NULL) GROUP BY label, kind
""")
def ingested_series(spark, sf_dir):
    """Equal reference series have one name, however many executions bring them."""
    axes = spark.createDataFrame([], "hash string, index_name string, index array<string>")
    rows, _ = ingest.series_values(series(spark, sf_dir), axes, ["metric"])
    return rows.groupBy("metric", "kind").agg(F.count("*").alias("n"), F.count_distinct("reference_id").alias("reference_ids"))


@query("SELECT 'time' AS index_name, unnest([1, 2]) AS size")
def ingested_axes(spark, sf_dir):
    axes = spark.createDataFrame([], "hash string, index_name string, index array<string>")
    return ingest.series_values(series(spark, sf_dir), axes, ["metric"])[1].select("index_name", F.size("index").alias("size"))


@query("SELECT c_custkey AS execution_id, 'b' AS metric, c_mktsegment AS source_id, c_acctbal AS value FROM customer WHERE c_custkey % 2 = 1")
def ingested_scalars(spark, sf_dir):
    found, _ = ingest.scalar_values(scalar_bundles(spark, sf_dir), ["metric", "source_id"], vocabulary(spark))
    return found.where("metric = 'b'").select("execution_id", "metric", "source_id", "value")


@query("SELECT DISTINCT 'source_id' AS dimension, c_mktsegment AS value FROM customer WHERE c_mktsegment <> 'BUILDING'")
def values_outside_vocabulary(spark, sf_dir):
    return ingest.scalar_values(scalar_bundles(spark, sf_dir), ["metric", "source_id"], vocabulary(spark))[1]


def scalar_bundles(spark, sf_dir) -> DataFrame:
    metric = F.when(F.col("c_custkey") % 2 == 1, "b").otherwise("a")
    results = F.to_json(F.map_from_arrays(F.array(metric), F.array(F.map_from_arrays(F.array("c_mktsegment"), F.array("c_acctbal")))))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("execution_id"), results.alias("results"))


def vocabulary(spark) -> DataFrame:
    return spark.createDataFrame([("metric", "a"), ("metric", "b"), ("source_id", "BUILDING")], "dimension string, value string")


@query("SELECT n_nationkey AS execution_id, 'plot' AS output_type, n_name AS short_name, n_name || '.png' AS filename, NULL::VARCHAR AS long_name, NULL::VARCHAR AS description FROM nation")
def registered_outputs(spark, sf_dir):
    df = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("execution_id"), F.lit("plot").alias("output_type"), F.col("n_name").alias("short_name"), F.concat("n_name", F.lit(".png")).alias("filename"))
    return ingest.output_rows(df)


# ---------------------------------------------------------------- small functions


@query("""
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN '1hrCM' WHEN 1 THEN 'dec' WHEN 2 THEN 'fx' WHEN 3 THEN 'monC' WHEN 4 THEN '6hrPt' END AS known,
  CASE p_size % 6 WHEN 0 THEN 'mon' WHEN 1 THEN 'mon' WHEN 2 THEN 'mon' WHEN 3 THEN 'mon' WHEN 4 THEN '6hr' ELSE 'mon' END AS guessed FROM part
""")
def table_frequencies(spark, sf_dir):
    t = F.element_at(F.array(*map(F.lit, ("E1hrClimMon", "Odec", "IfxGre", "monC", "6hrPlevPt", "nonsense"))), (F.col("p_size") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", fn.known_frequency(t).alias("known"), fn.guessed_frequency(t).alias("guessed"))


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'kg m-2 s-1' WHEN 1 THEN 'K' WHEN 2 THEN 'months since 1980' WHEN 3 THEN 'W m-2' ELSE NULL END AS units, CASE p_size % 5 WHEN 0 THEN 'kg / meter 2 / second' WHEN 1 THEN 'kelvin' WHEN 2 THEN 'months since 1980' WHEN 3 THEN 'W m-2' END AS clean FROM part")
def unit_texts(spark, sf_dir):
    u = F.element_at(F.array(F.lit("kg / meter ** 2 / second"), F.lit("kelvin"), F.lit("months since 1980"), F.lit("W m-2"), F.lit(None).cast("string")), (F.col("p_size") % 5 + 1).cast("int"))
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey").select("p_partkey", fn.canonical_units(u).alias("units"), fn.clean_units(u).alias("clean"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'v' || p_size ELSE 'v0' END AS version, 'v' || (p_size + 1000) AS longest, CASE WHEN p_size % 2 = 0 THEN 'r' || p_size ELSE 'r7' END AS part, p_brand || '_' || p_type AS joined,
  CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS branch, p_brand AS bare, p_type AS name, CASE WHEN p_size % 2 = 0 THEN 'x_y' END AS region, '<DATA>/a/' || p_size AS path FROM part
""")
def text_helpers(spark, sf_dir):
    n, s = F.col("p_size"), F.col("p_size").cast("string")
    even = n % 2 == 0
    return table(spark, sf_dir, "part").select(
        "p_partkey", fn.version_from_path(F.concat(F.lit("/a/"), F.when(n % 3 == 0, F.concat(F.lit("v"), s)).otherwise("x"), F.lit("/f.nc"))).alias("version"),
        fn.longest_match(F.concat(F.lit("v1 v"), n + 1000, F.lit(" v22")), r"v\d+").alias("longest"), fn.variant_part(F.when(even, s).otherwise("r7"), "r").alias("part"), fn.joined_facet(F.col("p_brand"), F.col("p_type")).alias("joined"),
        fn.branch_time(F.when(even, F.concat(s, F.lit("D"))).otherwise("none")).alias("branch"), fn.without_units(F.concat("p_brand", F.when(even, " [K]").otherwise(""))).alias("bare"),
        fn.name_and_region(F.concat("p_type", F.when(even, "_x_y").otherwise("")))["name"].alias("name"), fn.name_and_region(F.concat("p_type", F.when(even, "_x_y").otherwise("")))["region"].alias("region"),
        fn.rewritten_path(F.concat(F.lit("/data/deep/a/"), s), {"/data": "<ROOT>", "/data/deep": "<DATA>"}).alias("path"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber < 3 THEN l_extendedprice END AS finite, CASE WHEN l_quantity = 1 THEN 0.0 ELSE l_quantity END AS filled, CASE WHEN l_linenumber < 3 THEN 1 ELSE 2 END AS nulls FROM lineitem
""")
def number_helpers(spark, sf_dir):
    n, x = F.col("l_linenumber"), F.col("l_extendedprice")
    odd = F.when(n < 3, x).when(n < 5, float("inf")).otherwise(float("nan"))
    values = F.array(F.lit(1.0), F.when(n < 3, 2.0))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.finite_or_null(odd).alias("finite"), F.nanvl(fn.fill_to_nan(F.col("l_quantity"), 1.0), F.lit(0.0)).alias("filled"),
        F.when(F.exists(fn.null_to_nan(values), F.isnan), 2).otherwise(F.when(F.size(F.filter(fn.finite_values(fn.null_to_nan(values)), lambda v: v.isNotNull())) == 2, 1)).alias("nulls"),
    )


@query("SELECT o_orderkey, CAST(printf('%.6e', o_totalprice / 7) AS DOUBLE) AS x FROM orders")
def seven_figures(spark, sf_dir):
    """A seventh of a price has more figures than stay."""
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.seven_figures(F.col("o_totalprice") / 7).alias("x"))


# ----------------------------------------------------------------------- calendars


@query("""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE o_orderkey % 4 WHEN 0 THEN '360_day' WHEN 1 THEN 'noleap' WHEN 2 THEN 'all_leap' END AS calendar FROM orders),
p AS (SELECT *, year(d) - 1 AS y, month(d) AS m, day(d) AS dd FROM d),
v AS (SELECT *, NOT (calendar = '360_day' AND dd > 30) AND NOT (calendar = 'noleap' AND m = 2 AND dd = 29) AS ok, list_sum(([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[1:m - 1]) AS before FROM p)
SELECT o_orderkey, CAST(CASE WHEN calendar IS NULL THEN datediff('day', DATE '0001-01-01', d) WHEN NOT ok THEN NULL WHEN calendar = '360_day' THEN y * 360 + (m - 1) * 30 + dd - 1 WHEN calendar = 'noleap' THEN y * 365 + coalesce(before, 0) + dd - 1
  ELSE y * 366 + coalesce(before, 0) + CASE WHEN m > 2 THEN 1 ELSE 0 END + dd - 1 END AS BIGINT) * 86400 AS ordinal, CASE WHEN coalesce(ok, true) THEN strftime(d, '%Y-%m-%d 00:00:00') END AS back FROM v
""")
def calendars_side_by_side(spark, sf_dir):
    """A calendar per row, null meaning the standard one; days that a calendar lacks are null there and back."""
    c = F.when(F.col("o_orderkey") % 4 == 0, "360_day").when(F.col("o_orderkey") % 4 == 1, "noleap").when(F.col("o_orderkey") % 4 == 2, "all_leap")
    df = table(spark, sf_dir, "orders").withColumns({"c": c, "t": cal.parse_time(F.date_format("o_orderdate", "yyyy-MM-dd"), c)}).withColumn("ordinal", cal.ordinal(F.col("t"), F.col("c")))
    return df.select("o_orderkey", "ordinal", cal.time_text(cal.from_ordinal(F.col("ordinal"), F.col("c"))).alias("back"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(DATE '2000-03-01' + CAST(o_orderkey % 4000 AS INTEGER), '%Y-%m-%d 12:00:00') END AS t FROM orders")
def decoded_times(spark, sf_dir):
    k = F.col("o_orderkey")
    value = F.when(k % 5 != 0, k % 4000 + 0.5)
    return table(spark, sf_dir, "orders").select("o_orderkey", cal.time_text(cal.decode_time(value, F.lit("days since 2000-03-01"), F.lit("standard"))).alias("t"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN strftime(DATE '1850-01-01' + INTERVAL (c_custkey) DAY, '%Y-%m-%d %H:%M:%S') END AS child_start,
  CASE WHEN c_custkey % 3 <> 0 THEN strftime(DATE '1850-01-01' + INTERVAL (c_custkey) DAY + INTERVAL 36500 DAY - INTERVAL (c_custkey % 10) DAY, '%Y-%m-%d %H:%M:%S') END AS parent_start FROM customer
""")
def branch_times(spark, sf_dir):
    """Parents count days from 1850, children too; the parent is 36,500 days further on."""
    k = F.col("c_custkey")
    start = F.date_format(F.date_add(F.lit("1850-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd")
    children = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.lit(36500.0).alias("branch_time_in_parent"), (k % 10).cast("double").alias("branch_time_in_child"), F.lit("days since 1850-01-01").alias("time_units"), F.lit("standard").alias("calendar"), F.when(k % 3 != 0, start).alias("start_time"))
    parents = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.lit("days since 1850-01-01").alias("time_units"), F.lit("standard").alias("calendar"))
    rows = diagnostics.branch_aligned(children, parents, ["c_custkey"])
    return rows.select("c_custkey", cal.time_text(F.col("child_start")).alias("child_start"), cal.time_text(F.col("parent_start")).alias("parent_start"))


@query("WITH n AS (SELECT n_nationkey, n_regionkey FROM nation) SELECT n_regionkey AS gk, n_nationkey AS row_id FROM n WHERE NOT (n_regionkey = 1 AND n_nationkey % 2 = 0)")
def kept_after_ignoring(spark, sf_dir):
    df = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("gk"), F.col("n_nationkey").alias("row_id"), (F.col("n_nationkey") % 2).cast("string").alias("odd"), F.col("n_regionkey").cast("string").alias("region"))
    return constraints.IgnoreFacets({"region": ("1",), "odd": ("0",)}).apply(df, df).select("gk", "row_id")


@query("""
WITH c AS (SELECT c_custkey, c_nationkey, regexp_replace(regexp_replace(c_name || ' / ' || c_mktsegment, '[^A-Za-z0-9_-]+', '_', 'g'), '^_+|_+$', '', 'g') AS a, repeat('word_', CAST(c_custkey % 20 AS INTEGER)) AS w FROM customer),
t AS (SELECT *, a || CASE WHEN rtrim(w, '_') <> '' THEN '_' || rtrim(w, '_') ELSE '' END AS words FROM c)
SELECT c_custkey, CASE WHEN length(words) <= 64 THEN words ELSE regexp_replace(words[1:64], '_[^_]*$', '') END || '_g' || c_custkey || '_v' || (c_nationkey % 3 + 1) || '_' AS head, 8 AS digits FROM t
""")
def folder_names(spark, sf_dir):
    """Names of groups' folders; the digest at their end is only counted."""
    pair = lambda k, v: F.array(F.struct(F.lit(k).alias("k"), v.alias("v")))
    selectors = F.create_map(F.lit("obs"), pair("word", F.expr("repeat('word_', cast(c_custkey % 20 as int))")), F.lit("cmip6"), pair("who", F.concat_ws(" / ", "c_name", "c_mktsegment")))
    name = fn.folder_name(selectors, F.col("c_custkey"), F.col("c_nationkey") % 3 + 1)
    rows = table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))
    return rows.select("c_custkey", F.expr("left(name, length(name) - 8)").alias("head"), F.length(F.regexp_extract("name", "[0-9a-f]{8}$", 0)).alias("digits"))


@query("""
SELECT c_custkey, strftime(DATE '1870-01-01' + INTERVAL (c_custkey) DAY, '%Y-%m-%d %H:%M:%S') AS child_start,
  strftime(DATE '1870-01-01' + INTERVAL (c_custkey) DAY + (DATE '1850-01-01' + INTERVAL 36500 DAY - (DATE '1860-03-01' + INTERVAL (c_custkey % 100) HOUR)), '%Y-%m-%d %H:%M:%S') AS parent_start FROM customer
""")
def branch_times_of_two_units(spark, sf_dir):
    """Children count hours from 1860, parents days from 1850."""
    k = F.col("c_custkey")
    start = F.date_format(F.date_add(F.lit("1870-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd")
    children = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.lit(36500.0).alias("branch_time_in_parent"), (k % 100).cast("double").alias("branch_time_in_child"), F.lit("hours since 1860-03-01").alias("time_units"), F.lit("standard").alias("calendar"), start.alias("start_time"))
    parents = spread(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.lit("days since 1850-01-01").alias("time_units"), F.lit("standard").alias("calendar"))
    rows = diagnostics.branch_aligned(children, parents, ["c_custkey"])
    return rows.select("c_custkey", cal.time_text(F.col("child_start")).alias("child_start"), cal.time_text(F.col("parent_start")).alias("parent_start"))


def _runs(spark, sf_dir):
    """Nations as runs: closed orders are the run's yearly means, others its parent's; both in units of 10,000."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("k")), "o_custkey")
    yearly = lambda rows, x: rows.groupBy("k", F.year("o_orderdate").alias("year")).agg((F.avg(x) / 10000).alias("value"))
    closed = F.col("o_orderkey") % 2 == 0
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    children = n.select("k", (F.col("k") % 2 * 365).cast("double").alias("branch_time_in_parent"), F.lit(0.0).alias("branch_time_in_child"), F.lit("days since 1992-01-01").alias("time_units"), F.lit("noleap").alias("calendar"), F.concat((1992 + F.col("k") % 3).cast("string"), F.lit("-01-01")).alias("start_time"))
    parents = n.select("k", F.lit("days since 1992-01-01").alias("time_units"), F.lit("noleap").alias("calendar"))
    price, number = F.col("o_totalprice"), (F.col("o_custkey") % 1000) * 10
    return children, parents, (yearly(o.where(closed), price), yearly(o.where(~closed), price)), (yearly(o.where(closed), number), yearly(o.where(~closed), number))


RUNS_OF_NATIONS = """
o AS (SELECT c_nationkey AS k, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey % 2 = 0 AS run, o_totalprice / 10000 AS p, o_custkey % 1000 * 10 / 10000 AS q FROM orders JOIN customer ON c_custkey = o_custkey),
y AS (SELECT k, year, run, avg(p) AS p, avg(q) AS q FROM o GROUP BY ALL), w AS (SELECT n_nationkey AS k, 1992 + n_nationkey % 3 AS a, 1992 + n_nationkey % 3 + n_nationkey % 2 AS b FROM nation),
c AS (SELECT y.k, year - a AS year, p, q FROM y JOIN w ON y.k = w.k WHERE run AND year BETWEEN a AND a + 3), m AS (SELECT y.k, year - b AS year, p, q FROM y JOIN w ON y.k = w.k WHERE NOT run AND year BETWEEN b AND b + 3),
d AS (SELECT k, year, c.p - m.p AS n, c.q - m.q AS t FROM c JOIN m USING (k, year))"""


@query(f"WITH {RUNS_OF_NATIONS}, f AS (SELECT k, CASE WHEN count(*) > 1 THEN regr_slope(n, t) END AS s, CASE WHEN count(*) > 1 THEN regr_intercept(n, t) END AS i FROM d GROUP BY 1) SELECT k, round(s, 5) AS lambda, round(-i / s / 2, 5) AS ecs FROM f")
def sensitivity_of_runs(spark, sf_dir):
    """From branch times to windows of four years, and to the regression of one departure on the other."""
    children, parents, radiation, temperature = _runs(spark, sf_dir)
    windows = branches.branch_windows(children, parents, ["k"], 4, 0, 4)
    found = branches.sensitivity(radiation, temperature, windows, ["k"])
    return found.select("k", F.round("lambda", 5).alias("lambda"), F.round("ecs", 5).alias("ecs"))


@query(f"""WITH {RUNS_OF_NATIONS}, l AS (SELECT k, regr_slope(p, year) AS s, regr_intercept(p, year) AS i FROM m GROUP BY 1), r AS (SELECT c.k, avg(p - s * year - i) AS tcr FROM c JOIN l USING (k) WHERE year BETWEEN 1 AND 2 GROUP BY 1),
e AS (SELECT k, year, sum(q) OVER (PARTITION BY k ORDER BY year) AS total FROM c), x AS (SELECT d.k, arg_max(n / total, year) AS tcre FROM d JOIN e USING (k, year) GROUP BY 1), z AS (SELECT k, avg(p) AS after FROM c WHERE year BETWEEN 1 AND 2 GROUP BY 1), b AS (SELECT k, avg(p) AS base FROM m GROUP BY 1)
SELECT k, round(tcr, 5) AS tcr, round(tcre, 5) AS tcre, round(after - base, 5) AS zec FROM r JOIN x USING (k) JOIN z USING (k) JOIN b USING (k)""")
def responses_of_runs(spark, sf_dir):
    """Transient response, response to emissions and commitment of runs in the windows of their branches."""
    children, parents, (run, control), (emissions, _) = _runs(spark, sf_dir)
    windows = branches.branch_windows(children, parents, ["k"], 4, 0, 4)
    found = branches.transient(run, control, windows, ["k"], (1, 2)).join(branches.per_emissions(run, control, emissions, windows, ["k"]), "k").join(branches.commitment(run, control, windows, ["k"], (1, 2)), "k")
    return found.select("k", *(F.round(c, 5).alias(c) for c in ("tcr", "tcre", "zec")))
