"""Metadata from the grammar of paths and file names, as column expressions over ``path``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.calendars import decode_pair, let, parse_date_range
from meridian.functions.catalog import instance_id, known_frequency, table_frequency, version_from_path

#: The order of folders in each layout, outermost first.
CMIP6_FOLDERS = ("activity_id", "institution_id", "source_id", "experiment_id", "member_id", "table_id", "variable_id", "grid_label")
CMIP7_FOLDERS = ("activity_id", "institution_id", "source_id", "experiment_id", "variant_label", "region", "frequency", "variable_id", "branding_suffix", "grid_label")
OBS_PREFIX = ("project", "source_id", "type", "version", "table_id", "variable_id")
#: Fixed value: variable, frequency, source, institution, grid and dates of a registry's file names.
DATED_NAME = r"^[a-zA-Z0-9]+_[a-zA-Z]+_[A-Za-z0-9-]+_[A-Za-z0-9-]+_[a-zA-Z]+_\d+(-\d+)?\.nc$"


def _folders(path: Column) -> Column:
    return F.split(path, "/")


def _from_end(parts: Column, k: int) -> Column:
    """The k-th part from the end, 1 being the last; null when there is none."""
    return F.when(F.size(parts) >= k, F.element_at(parts, -k))


def file_name(path: Column) -> Column:
    return F.element_at(_folders(path), -1)


def cmip6_from_path(df: DataFrame) -> DataFrame:
    """Facets, member, version, frequency and times of CMIP6 files from their paths alone.

    The name has six parts, or seven with a date range; others are invalid. Rows are
    not final: what only headers hold is missing.
    """
    path = F.col("path")
    stem = F.regexp_replace(file_name(path), r"\.nc$", "")
    parts, folders = F.split(stem, "_"), _folders(path)
    named = {n: F.get(parts, k) for k, n in enumerate(("variable_id", "table_id", "source_id", "experiment_id", "member_id", "grid_label"))}
    valid = F.size(parts).isin(6, 7) & path.endswith(".nc")
    times = parse_date_range(F.get(parts, 6))
    at = F.size(folders) - 1 - len(CMIP6_FOLDERS) - 1
    outer = {n: F.when(at >= 0, F.get(folders, at + k)) for k, n in enumerate(("activity_id", "institution_id"))}
    member = F.get(parts, 4)
    sub = F.when(member.contains("-"), F.split_part(member, F.lit("-"), F.lit(1)))
    rows = df.withColumns({n: F.when(valid, c) for n, c in (named | outer).items()}).withColumns({
        "sub_experiment_id": F.when(valid, F.coalesce(sub, F.lit("none"))), "variant_label": F.when(valid, F.when(sub.isNotNull(), F.split_part(member, F.lit("-"), F.lit(2))).otherwise(member)),
        "version": version_from_path(path), "frequency": F.when(valid, known_frequency(F.col("table_id"))),
        "start_time": F.when(valid, times["start_time"]), "end_time": F.when(valid, times["end_time"]), "finalised": F.lit(False),
        "invalid_asset": F.when(~valid, F.lit("not six or seven name parts")).when(known_frequency(F.col("table_id")).isNull(), F.lit("unknown table")),
    })
    return rows.withColumn("instance_id", instance_id("CMIP6", *CMIP6_FOLDERS, "version"))


def cmip7_from_path(df: DataFrame) -> DataFrame:
    """The same for CMIP7, whose folders hold all facets."""
    path = F.col("path")
    folders = _folders(path)
    base = F.size(folders) - 2 - len(CMIP7_FOLDERS)
    stem = F.regexp_replace(file_name(path), r"\.nc$", "")
    times = parse_date_range(F.element_at(F.split(stem, "_"), -1))
    valid = (base >= 0) & path.endswith(".nc")
    rows = df.withColumns({n: F.when(valid, F.get(folders, base + k)) for k, n in enumerate(CMIP7_FOLDERS)}).withColumns({
        "version": version_from_path(path), "start_time": times["start_time"], "end_time": times["end_time"], "finalised": F.lit(False),
        "invalid_asset": F.when(~valid, F.lit("too few folders")),
    })
    return rows.withColumn("instance_id", instance_id("CMIP7", *CMIP7_FOLDERS, "version"))


#: Fixed value: the parts of a CMIP7 file's name, perhaps with a time range behind them.
CMIP7_NAME = ("variable_id", "branding_suffix", "frequency", "region", "grid_label", "source_id", "experiment_id", "variant_label")


def cmip7_from_name(df: DataFrame) -> DataFrame:
    """Facets of CMIP7 files from the eight parts of their names, or nine with a time range; others are invalid.

    Activity and institution are the two folders above the one of the source, which must be
    there; the version is that of the folders.
    """
    path = F.col("path")
    folders = F.slice(_folders(path), F.lit(1), F.greatest(F.size(_folders(path)) - 1, F.lit(0)))
    parts = F.split(F.regexp_replace(file_name(path), r"\.nc$", ""), "_")
    named = F.size(parts).isin(8, 9)
    source = F.when(named, F.get(parts, CMIP7_NAME.index("source_id")))
    at = F.coalesce(F.array_position(folders, source), F.lit(0)).cast("int")
    valid = named & (at >= 3)
    times = parse_date_range(F.get(parts, 8))
    found = {n: F.when(valid, F.get(parts, k)) for k, n in enumerate(CMIP7_NAME)}
    rows = df.withColumns(found | {
        "activity_id": F.when(valid, F.get(folders, at - 3)), "institution_id": F.when(valid, F.get(folders, at - 2)), "version": version_from_path(F.array_join(folders, "/")),
        "time_range": F.when(valid, F.get(parts, 8)), "start_time": F.when(valid, times["start_time"]), "end_time": F.when(valid, times["end_time"]), "mip_era": F.lit("CMIP7"), "finalised": F.lit(False),
        "invalid_asset": F.when(~named, F.lit("not eight or nine name parts")).when(~valid, F.lit("no folder of the source below activity and institution")),
    })
    return rows.withColumn("instance_id", instance_id("CMIP7", *CMIP7_FOLDERS, "version"))


def reference_from_path(df: DataFrame) -> DataFrame:
    """Reference data in one of three layouts, found by the rightmost anchor folder: OBS, native6 or obs4MIPs."""
    folders = _folders(F.col("path"))
    n = F.size(folders)
    anchor = F.array_max(F.transform(F.filter(F.sequence(F.lit(1), n), lambda k: F.element_at(folders, k).isin("OBS", "OBS6", "native6", "obs4MIPs")), lambda k: k))
    kind = F.when(anchor.isNotNull(), F.element_at(folders, anchor))
    tier = F.when(anchor < n, F.get(folders, anchor))
    stem = F.split(F.regexp_replace(file_name(F.col("path")), r"\.nc$", ""), "_")
    tiered = tier.rlike(r"^Tier[1-3]$")
    valid = F.coalesce(F.when(kind == "obs4MIPs", n - anchor >= 2).otherwise(tiered & (n - anchor >= 3)), F.lit(False))
    obs = kind.isin("OBS", "OBS6")
    source = F.when(kind == "obs4MIPs", F.get(folders, anchor)).otherwise(F.get(folders, anchor + 1))
    return df.withColumns({
        "project": F.when(valid, kind), "tier": F.when(valid & tiered, tier), "source_id": F.when(valid, source),
        "version": F.when(valid & obs, F.get(stem, 3)).when(valid & (kind == "native6"), F.get(folders, anchor + 2)).when(valid, version_from_path(F.col("path"))),
        "table_id": F.when(valid & obs, F.get(stem, 4)), "variable_id": F.when(valid & obs, F.get(stem, 5)).when(valid, F.get(stem, 0)),
        "invalid_asset": F.when(~valid, F.lit("no known layout")),
    })


def registry_key(df: DataFrame, key: str = "key") -> DataFrame:
    """Facets of registry keys: eight parts with a dated name, or five parts of a climatology with ``_AC_``."""
    parts = F.split(F.col(key), "/")
    name = F.element_at(parts, -1)
    plain = (F.size(parts) == 8) & name.rlike(DATED_NAME)
    climatology = (F.size(parts) == 5) & name.rlike(r"_AC_")
    eight = ("activity_id", "institution_id", "source_id", "frequency", "variable_id", "grid_label", "version")
    found = {n: F.when(plain, F.get(parts, k)) for k, n in enumerate(eight)}
    found["variable_id"] = F.coalesce(found["variable_id"], F.when(climatology, F.get(parts, 1)))
    found["source_id"] = F.coalesce(found["source_id"], F.when(climatology, F.get(parts, 2)))
    found["grid_label"] = F.coalesce(found["grid_label"], F.when(climatology, F.get(parts, 3)))
    found["version"] = F.coalesce(found["version"], F.when(climatology, F.regexp_extract(name, r"_(v\d+)", 1)))
    return df.withColumns(found | {"invalid_asset": F.when(~(plain | climatology), F.lit("no known key"))})


def cmip7_file_name() -> Column:
    """File names from facets in their fixed order, with the months covered."""
    return F.concat(F.concat_ws("_", "variable_id", "branding_suffix", "frequency", "region", "grid_label", "source_id", "experiment_id", "variant_label", "time_range"), F.lit(".nc"))


def cmip7_path() -> Column:
    return F.concat_ws("/", F.lit("MIP-DRS7"), F.lit("CMIP7"), *CMIP7_FOLDERS, "version")


def cmip7_attributes(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """CMIP6 metadata in CMIP7's terms. ``mapping``: table_id, variable_id, branding_suffix, region, realm.

    The mapping is a fixed table of the data request; its size is that of the request.
    """
    rows = df.join(mapping, ["table_id", "variable_id"], "left")
    letters = {"r": "realization", "i": "initialization", "p": "physics", "f": "forcing"}
    index = {f"{n}_index": F.concat(F.lit(k), F.regexp_extract("variant_label", rf"{k}(\d+)", 1)) for k, n in letters.items()}
    return rows.withColumns(index | {
        "branded_variable": F.when(F.col("branding_suffix").isNotNull(), F.concat_ws("_", "variable_id", "branding_suffix")), "region": F.coalesce("region", F.lit("glb")),
        "mip_era": F.lit("CMIP7"), "frequency": F.coalesce("frequency", table_frequency(F.col("table_id"))),
    })


#: Global attributes that headers have, by kind of dataset.
CMIP6_ATTRIBUTES = (
    "activity_id", "branch_method", "branch_time_in_child", "branch_time_in_parent", "experiment", "experiment_id", "frequency", "grid", "grid_label", "institution_id", "nominal_resolution", "parent_activity_id",
    "parent_experiment_id", "parent_source_id", "parent_time_units", "parent_variant_label", "realm", "product", "source_id", "source_type", "sub_experiment", "sub_experiment_id", "table_id", "variable_id", "variant_label",
)
CMIP7_ATTRIBUTES = (
    "activity_id", "institution_id", "source_id", "experiment_id", "variant_label", "variable_id", "grid_label", "frequency", "region", "branding_suffix", "branded_variable", "mip_era", "realm", "nominal_resolution", "license_id", "tracking_id",
)
CMIP7_OPTIONAL = ("branch_time_in_child", "branch_time_in_parent", "parent_activity_id", "parent_experiment_id", "parent_mip_era", "parent_source_id", "parent_time_units", "parent_variant_label", "external_variables")
OBS_ATTRIBUTES = ("activity_id", "frequency", "grid", "grid_label", "institution_id", "nominal_resolution", "product", "realm", "source_id", "source_type", "source_version_number", "variable_id", "variant_label")
OBS_ACTIVITIES = ("obs4MIPs", "obs4REF")
OBS_ID = ("activity_id", "institution_id", "source_id", "frequency", "variable_id", "grid_label", "version")
#: Names of vertical dimensions, the first one that a file has counts.
VERTICAL = ("lev", "plev", "olevel", "height", "depth", "level", "altitude")


def _absent(names: tuple[str, ...], counts: Callable[[Column], Column]) -> Column:
    """Those of ``names`` for which a header has no value that counts; one pass over the header, null without one."""
    return F.array_except(F.array(*map(F.lit, names)), F.map_keys(F.map_filter("header", lambda _, v: counts(v))))


def _from_header(df: DataFrame, names: tuple[str, ...], lacking: Column) -> DataFrame:
    """The attributes ``names`` of headers that are there and lack nothing; what else a file says of its times and levels."""
    # columns of their own, so that they are worked out once for all attributes
    df = df.withColumns({"__lacking": lacking, "__bounds": time_bounds(F.col("times"), F.col("time_units"), F.col("calendar"))})
    lacking, bounds = F.col("__lacking"), F.col("__bounds")
    valid = F.col("header").isNotNull() & (F.size(lacking) == 0)
    folder = F.array_join(F.slice(_folders(F.col("path")), F.lit(1), F.greatest(F.size(_folders(F.col("path"))) - 1, F.lit(0))), "/")
    rows = df.withColumns({n: F.when(valid, F.try_element_at("header", F.lit(n))) for n in names})
    return rows.withColumns({
        "version": version_from_path(folder), "start_time": F.when(valid, bounds["start_time"]), "end_time": F.when(valid, bounds["end_time"]),
        "vertical_levels": F.when(valid, vertical_levels(F.col("dimensions"))), "finalised": valid,
        "invalid_asset": F.when(F.col("header").isNull(), F.lit("no header")).when(~valid, F.concat(F.lit("missing attributes: "), F.array_join(lacking, ", "))),
    }).drop("header", "times", "dimensions", "__lacking", "__bounds")


def cmip6_from_header(df: DataFrame) -> DataFrame:
    """CMIP6 files by what was read of their headers.

    ``df``: path, header (map of attributes, null where it cannot be read), times (their
    first and last numbers), time_units, calendar, dimensions (map of sizes). A header
    needs no attribute in particular; the member is the variant.
    """
    rows = _from_header(df, CMIP6_ATTRIBUTES, F.array().cast("array<string>"))
    year = F.regexp_extract("sub_experiment_id", r"\d{4}", 0).try_cast("int")
    return rows.withColumns({"member_id": F.col("variant_label"), "init_year": year}).withColumn("instance_id", instance_id("CMIP6", *CMIP6_FOLDERS, "version"))


def cmip7_from_header(df: DataFrame) -> DataFrame:
    """The same for CMIP7, where a header must have all of ``CMIP7_ATTRIBUTES``, none of them empty."""
    lacking = _absent(CMIP7_ATTRIBUTES, lambda v: F.coalesce(v, F.lit("")) != "")
    return _from_header(df, CMIP7_ATTRIBUTES + CMIP7_OPTIONAL, lacking).withColumn("instance_id", instance_id("CMIP7", *CMIP7_FOLDERS, "version"))


def observations_from_header(df: DataFrame) -> DataFrame:
    """Observations: the activity must be one of ``OBS_ACTIVITIES`` and no attribute absent; the version is the parent folder, with a v before it."""
    activity = F.coalesce(F.try_element_at("header", F.lit("activity_id")), F.lit(""))
    absent = _absent(OBS_ATTRIBUTES, lambda v: v.isNotNull())
    lacking = F.when(activity.isin(*OBS_ACTIVITIES), absent).otherwise(F.array(F.lit("an activity of observations")))
    parent = F.element_at(_folders(F.col("path")), -2)
    rows = _from_header(df, OBS_ATTRIBUTES, lacking)
    return rows.withColumn("version", F.when(parent.startswith("v"), parent).otherwise(F.concat(F.lit("v"), parent))).withColumn("instance_id", instance_id("obs4MIPs", *OBS_ID))


def vertical_levels(sizes: Column) -> Column:
    """The size of a file's vertical dimension, 1 without one."""
    found = F.coalesce(*(F.try_element_at(sizes, F.lit(n)) for n in VERTICAL))
    return F.coalesce(found, F.lit(1)).cast("int")


def time_bounds(values: Column, units: Column, calendar: Column) -> Column:
    """The first and the last of a file's times, as a struct; nulls where it has none."""
    def of(both: Column) -> Column:
        return F.struct(F.get(both, 0).alias("start_time"), F.get(both, 1).alias("end_time"))

    return let(decode_pair(F.get(values, 0), F.try_element_at(values, F.lit(-1)), units, calendar), of)
