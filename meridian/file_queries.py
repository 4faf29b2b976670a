"""Queries over files that Spark first writes from the tables: folders as a stream, and headers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions import calendars as cal
from meridian.functions.catalog import null_to_nan, rounded
from meridian.operators import bundles
from meridian.plans import regression
from meridian.queries import part_datasets, query, spread, table
from meridian.sources import catalogs, files, netcdf, paths
from meridian.sources.folders import file_system
from meridian.sources.shared import fresh_folder
from meridian.streaming.folders import Catalog, ingest_folders


def write_files(files: DataFrame, root: str) -> int:
    """Writes each row (name, content) as a file below ``root``, and gives their number."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = file_system(root)
        made: set[str] = set()
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                if (folder := f"{base}/{name}".rpartition("/")[0]) not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(f"{base}/{name}") as f:
                    f.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    return files.mapInPandas(run, "n long").agg(F.sum("n")).first()[0]


@query("""
WITH s AS (SELECT s_suppkey, 'Nation' || s_nationkey AS source_id, s_nationkey FROM supplier WHERE s_nationkey % 6 <> 5)
SELECT 'CMIP6.CMIP.INST.' || source_id || '.hist.r1i1p1f1.Amon.tas.gn.v' || (20200000 + s_nationkey) AS instance_id, source_id, 'mon' AS frequency, CAST(1000 + s_suppkey AS VARCHAR) || '-01-01' AS start_time, CAST(1000 + s_suppkey AS VARCHAR) || '-12-30' AS end_time,
  (SELECT count(DISTINCT s_nationkey) FROM s) AS datasets, (SELECT count(*) FROM supplier WHERE s_nationkey % 6 = 5) AS left_out FROM s
""")
def ingested_by_folder(spark, sf_dir):
    """Suppliers as files in a folder for each nation, taken in ten folders at a time; every sixth nation's table is unknown."""
    root = fresh_folder(spark, "arrived")
    n, k = F.col("s_nationkey"), F.col("s_suppkey")
    source, t = F.concat(F.lit("Nation"), n), F.when(n % 6 == 5, "Xmon").otherwise("Amon")
    name = F.concat(F.lit("CMIP6/CMIP/INST/"), source, F.lit("/hist/r1i1p1f1/"), t, F.lit("/tas/gn/v"), 20200000 + n, F.lit("/tas_"), t, F.lit("_"), source, F.lit("_hist_r1i1p1f1_gn_"), 1000 + k, F.lit("01-"), 1000 + k, F.lit("12.nc"))
    write_files(table(spark, sf_dir, "supplier").select(name.alias("name"), F.lit(b"CDF").alias("content")), root)
    catalog = Catalog(spark, fresh_folder(spark, "catalog"), ("source_id", "frequency", "variable_id"))
    ingest_folders(catalog, root, fresh_folder(spark, "checkpoint"), paths.cmip6_from_path, 10)
    datasets = catalog.datasets().select("instance_id", "source_id", "frequency")
    counts = datasets.agg(F.count("*").alias("datasets")).join(F.broadcast(catalog.rows("invalid").agg(F.count("*").alias("left_out"))), F.lit(True))  # one row each
    return catalog.files().select("instance_id", "start_time", "end_time").join(datasets, "instance_id").join(F.broadcast(counts), F.lit(True))


def header_files(spark, sf_dir) -> DataFrame:
    """Suppliers as small files: every tenth torn, every seventh without times, every eleventh of another format."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, nation, name in zip(batch["s_suppkey"], batch["s_nationkey"], batch["s_name"], strict=True):
                dims = {"time": None if key % 2 else 12, "plev": 19} if key % 3 else {"time": None if key % 2 else 12, "x": 2}
                own = [] if key % 7 == 0 else [("time", "double", ["time"], {"units": "days since 2001-01-01", "calendar": "noleap"}, [30.0 * m + key % 30 for m in range(12)])]
                own.append(("tas", "float", ["time"], {"units": "K", "standard_name": "air_temperature", "long_name": name}, [float(nation)] * 12))
                given = {n: f"{n}-x" for n in paths.CMIP6_ATTRIBUTES} | {"source_id": f"N{nation}", "variable_id": "tas", "sub_experiment_id": "s1960" if key % 5 == 0 else "none", "realization": int(key % 4)}
                data = netcdf.encode(dims, given, own, (1, 2, 5)[key % 3])
                rows.append((f"v20200101/s{key:07d}.nc", b"\x89HDF" + data if key % 11 == 0 else data[:200] if key % 10 == 0 else data))
            yield pd.DataFrame(rows, columns=["name", "content"])

    return spread(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name"), "s_suppkey").mapInPandas(run, "name string, content binary")


@query("""
SELECT s_suppkey, CASE WHEN ok THEN 'N' || s_nationkey END AS source_id, CASE WHEN ok AND s_suppkey % 7 <> 0 THEN strftime(DATE '2001-01-01' + CAST(s_suppkey % 30 AS INTEGER), '%Y-%m-%d 00:00:00') END AS start_time,
  CASE WHEN ok AND s_suppkey % 7 <> 0 THEN strftime(DATE '2001-01-01' + CAST(330 + s_suppkey % 30 AS INTEGER), '%Y-%m-%d 00:00:00') END AS end_time, CASE WHEN ok THEN CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 19 END END AS vertical_levels,
  CASE WHEN ok AND s_suppkey % 5 = 0 THEN 1960 END AS init_year, CASE WHEN ok THEN s_name END AS long_name, CASE WHEN ok THEN 'K' END AS units,
  CASE WHEN s_suppkey % 11 = 0 THEN 'ValueError: an HDF5 file: only the classic layouts are read' WHEN s_suppkey % 10 = 0 THEN 'ValueError: the file ends inside its header' END AS invalid_asset
FROM (SELECT *, s_suppkey % 11 <> 0 AND s_suppkey % 10 <> 0 AS ok FROM supplier)
""")
def headers_of_files(spark, sf_dir):
    """What the headers of classic files say, in three layouts, with records and without; bad files are rows with their error."""
    root = fresh_folder(spark, "headers")
    write_files(header_files(spark, sf_dir), root)
    valid, left_out = netcdf.find_datasets(spark, root, paths.cmip6_from_header, target=str(8 << 20))
    rows = valid.withColumns({c: cal.time_text(F.col(c)) for c in ("start_time", "end_time")}).unionByName(left_out, allowMissingColumns=True)
    key = F.regexp_extract("path", r"s(\d+)\.nc", 1).cast("long").alias("s_suppkey")
    return rows.select(key, "source_id", "start_time", "end_time", "vertical_levels", "init_year", "long_name", "units", "invalid_asset")


def file_names(spark, sf_dir) -> DataFrame:
    """A file for each supplier, in a folder of its nation or one below; every sixth is no result."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = F.concat(F.lit("n"), n, F.when(k % 4 == 0, "/deep/er").otherwise(""), F.lit("/f"), k, F.when(k % 6 == 0, ".txt").otherwise(".nc"))
    return table(spark, sf_dir, "supplier").select(name.alias("name"), F.col("s_name").cast("binary").alias("content"))


def _number_in_name(path: str) -> dict:
    """The number in a file's name; those that nine divides count as unreadable."""
    k = int(path.rpartition("/f")[2].partition(".")[0])
    if k % 9 == 0:
        raise ValueError("nine")
    return {"k": k}


@query("""
SELECT s_suppkey AS k, s_suppkey % 4 <> 0 AS shallow, CASE WHEN s_suppkey % 9 = 0 THEN 'ValueError: nine' END AS invalid_asset FROM supplier WHERE s_suppkey % 6 <> 0
""")
def discovered_files(spark, sf_dir):
    """Files found by pattern and depth, read by a function of one's own; those on which it fails stand beside with their error."""
    root = fresh_folder(spark, "found")
    write_files(file_names(spark, sf_dir), root)
    found = files.discover(spark, [root])
    shallow = files.discover(spark, [root], depth=1).withColumn("shallow", F.lit(True))
    valid, left_out = files.split_invalid(files.parse(found, _number_in_name, "k long"))
    named = left_out.withColumn("k", F.regexp_extract("path", r"/f(\d+)\.nc", 1).cast("long"))
    rows = valid.unionByName(named, allowMissingColumns=True).join(shallow, "path", "left")
    return rows.select("k", F.coalesce("shallow", F.lit(False)).alias("shallow"), "invalid_asset")


@query("SELECT 'f' || s_suppkey || CASE WHEN s_suppkey % 6 = 0 THEN '.txt' ELSE '.nc' END AS name, sha256(s_name) AS sha256 FROM supplier WHERE s_suppkey % 4 = 1")
def file_digests(spark, sf_dir):
    """The digests of named files of a folder; names that are not there give nothing."""
    root = fresh_folder(spark, "baseline")
    rows = file_names(spark, sf_dir).withColumn("name", F.element_at(F.split("name", "/"), -1))
    write_files(rows, root)
    last = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0]
    wanted = [f"f{k}{'.txt' if k % 6 == 0 else '.nc'}" for k in range(1, last + 1, 4)]
    return regression.digests(spark, root, [*wanted, "absent.nc"])


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2")
def bundle_written_and_read(spark, sf_dir):
    """A result file as it is written, read back and opened."""
    path = fresh_folder(spark, "bundle")
    flat = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("value"))
    dims = ["l_returnflag", "l_linestatus"]
    catalogs.write_bundle(bundles.nest(flat, dims), path, dims)
    read = catalogs.read_bundle(spark, path)
    order = read.first()["json_structure"]  # the names of the dimensions
    return bundles.flatten(read.select("results"), "results", order).select("l_returnflag", "l_linestatus", "value")


@query("SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'plot' WHEN n_nationkey % 3 = 1 THEN 'data' ELSE 'html' END AS output_type, n_name AS short_name, 'out/' || n_nationkey AS filename, n_name || ' of ' || n_regionkey AS long_name FROM nation")
def outputs_written_and_read(spark, sf_dir):
    """The registered files of an execution, written and read back."""
    path = fresh_folder(spark, "outputs")
    k = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select(
        F.when(k % 3 == 0, "plot").when(k % 3 == 1, "data").otherwise("html").alias("output_type"), F.col("n_name").alias("short_name"), F.concat(F.lit("out/"), k).alias("filename"), F.concat("n_name", F.lit(" of "), "n_regionkey").alias("long_name"),
    )
    catalogs.write_outputs(rows, path)
    return catalogs.read_outputs(spark, path).select("output_type", "short_name", "filename", "long_name")


@query("SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 'reference' ELSE 'model' END AS kind, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 5)) AS values FROM embeddings")
def series_written_and_read(spark, sf_dir):
    """Whole embeddings as series, written and read back."""
    path = fresh_folder(spark, "series")
    e = table(spark, sf_dir, "embeddings")
    rows = e.select(
        F.create_map(F.lit("vec"), F.col("vec_id").cast("string")).alias("dimensions"), F.col("embedding").cast("array<double>").alias("values"), F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda k: k.cast("string")).alias("index"),
        F.lit("k").alias("index_name"), F.when(F.col("vec_id") % 3 == 0, "reference").otherwise("model").alias("kind"),
    )
    catalogs.write_series(rows, path)
    found = spark.read.schema(catalogs.SERIES).json(path)
    found = found.withColumns({"values": null_to_nan(F.col("values")), "kind": F.coalesce("kind", F.lit("model"))})
    return found.select(F.col("dimensions")["vec"].cast("long").alias("vec_id"), "kind", F.transform("values", lambda v: rounded(v, 5)).alias("values"))


@query("SELECT p_brand AS source, p_type AS region, 'x' AS analysis, CAST(p_size AS VARCHAR) AS name, CAST(min(p_partkey) AS VARCHAR) AS value FROM part GROUP BY 1, 2, 4")
def metric_tables_read(spark, sf_dir):
    """Metric tables of several CSV files in one, each key once: the first of its rows in the first file."""
    path = fresh_folder(spark, "tables")
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), F.col("p_type").alias("region"), F.lit("x").alias("analysis"), F.col("p_size").alias("name"), F.col("p_partkey").alias("value"))
    rows.repartitionByRange(4, "value").sortWithinPartitions("value").write.option("header", "true").csv(path)
    return catalogs.read_metric_tables(spark, path)


@query("SELECT o_orderpriority, n, 2 AS left_out FROM (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1 ORDER BY 1 LIMIT 3)")
def sql_over_tables(spark, sf_dir):
    """A query of one's own over named tables: its first rows, and how many were left out."""
    tables = {"o": table(spark, sf_dir, "orders"), "c": table(spark, sf_dir, "customer")}
    rows, left_out = catalogs.run_sql(spark, "SELECT o_orderpriority, count(*) AS n FROM o JOIN c ON o_custkey = c_custkey GROUP BY 1 ORDER BY 1", tables, 3)
    return rows.withColumn("left_out", F.lit(left_out))


@query("""
SELECT p_partkey AS dataset_id, p_brand AS source_id, '2000-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' AS start_time FROM part QUALIFY p_size = max(p_size) OVER (PARTITION BY p_brand)
""")
def catalogs_written_and_read(spark, sf_dir):
    """A catalogue written with its times as texts, and read as the latest versions of each source."""
    folder = fresh_folder(spark, "catalogs")
    rows = spread(part_datasets(spark, sf_dir), "dataset_id").select("dataset_id", "source_id", "version", F.concat(F.lit("2000-01-"), F.lpad((F.col("size") % 28 + 1).cast("string"), 2, "0")).alias("start_time"), F.lit("2001-12-31").alias("end_time"), F.lit("standard").alias("calendar"))
    catalogs.write_catalog(catalogs.with_times(rows), f"{folder}/cmip6.parquet")
    found = catalogs.read_catalogs(spark, folder, ["cmip6"], {"cmip6": ["source_id"]})["cmip6"]
    return found.select("dataset_id", "source_id", cal.time_text(F.col("start_time")).alias("start_time"))
