"""Regression baselines and result files: digests, the gate, paths and captions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def digests(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """(name, sha256) of those files of a folder that are there."""
    files = spark.read.format("binaryFile").load(folder).where(F.element_at(F.split("path", "/"), -1).isin(*names))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


def gate(cases: DataFrame) -> DataFrame:
    """What to do with each test case's baseline: ``action`` skip, replay or fail, and the ``reason``.

    ``cases``: managed, base_managed (whether this and the base branch have a manifest),
    committed_ok, catalog_ok, extraction_changed, code_version, diagnostic_version,
    base_diagnostic_version, case_version, base_case_version, committed, base_committed,
    native, base_native (maps of digests). The first rule that holds decides; without a
    code version it is not compared. Only a native baseline can be replayed.
    """
    def col(name: str) -> Column:
        return F.col(name)

    def text(digests_: Column) -> Column:  # maps cannot be compared
        return F.to_json(F.array_sort(F.map_entries(digests_)))

    replay = F.when(F.size("native") > 0, "replay").otherwise("skip")
    new_bundle = text(col("committed")) != text(col("base_committed"))
    new_native = text(col("native")) != text(col("base_native"))
    rules: list[tuple[Column, Column | str, str]] = [
        (~col("managed") & col("base_managed"), "fail", "the baseline was removed"),
        (~col("managed"), "skip", "no baseline"),
        (~col("committed_ok"), "fail", "the bundle does not match its manifest"),
        (~col("catalog_ok"), "fail", "the inputs do not match the manifest"),
        (col("code_version") > col("diagnostic_version"), "fail", "the baseline is older than the code"),
        (col("code_version") < col("diagnostic_version"), "fail", "the code is older than the baseline"),
        (~col("base_managed"), replay, "a new baseline"),
        (col("case_version") < col("base_case_version"), "fail", "the case's version decreased"),
        (col("diagnostic_version") < col("base_diagnostic_version"), "fail", "the diagnostic's version decreased"),
        (col("case_version") > col("base_case_version"), replay, "the case's version was raised"),
        (new_bundle, "fail", "the bundle changed without a new version"),
        (new_native | col("extraction_changed"), replay, "what the bundle is made from changed"),
    ]
    decision = F.struct(F.lit("skip").alias("action"), F.lit("nothing changed").alias("reason"))
    for holds, action, reason in reversed(rules):
        own = F.struct((action if isinstance(action, Column) else F.lit(action)).alias("action"), F.lit(reason).alias("reason"))
        decision = F.when(F.coalesce(holds, F.lit(False)), own).otherwise(decision)
    return cases.withColumn("__d", decision).select(*cases.columns, "__d.action", "__d.reason")


def inside(root: str, *parts: Column) -> Column:
    """A path below ``root``, its dots resolved without a look at the files; one that leads out of it is null.

    A part that begins at the top replaces what stands before it.
    """
    top = [p for p in root.split("/") if p]
    steps = F.array(*map(F.lit, top)).cast("array<string>")
    for part in parts:
        own = F.filter(F.split(part, "/"), lambda s: (s != "") & (s != "."))
        start = F.when(part.startswith("/"), F.array().cast("array<string>")).otherwise(steps)
        up = lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, s))
        steps = F.aggregate(own, start, up)
    good = F.lit(True) if not top else F.slice(steps, 1, len(top)) == F.array(*map(F.lit, top))
    return F.when(good, F.concat(F.lit("/"), F.array_join(steps, "/")))


#: Kinds of plots -> how a caption and how a statistic names them.
PLOTS = {
    "bias": ("bias", "Bias"), "biasscore": ("bias score", "Bias score"), "cycle": ("annual cycle", "Annual cycle"), "cyclescore": ("annual cycle score", "Annual cycle score"), "mean": ("period mean", "Period Mean"),
    "rmse": ("RMSE", "RMSE"), "rmsescore": ("RMSE score", "RMSE score"), "shift": ("shift in maximum month", "Shift in maximum month"), "tmax": ("maxmimum month", "Maximum month"), "trace": ("regional mean", "Regional mean"),
    "taylor": ("Taylor diagram", "Taylor diagram"), "distribution": ("distribution", "Distribution"), "response": ("response", "Response"),
}


def captions(figures: DataFrame, regions: DataFrame) -> DataFrame:
    """``figures`` (file: source_region_plot[-option].ext) with caption, region, statistic and kind; ``regions``: region, name.

    An unknown plot has an empty caption and no statistic.
    """
    parts = F.split(F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[^.]*$", ""), "_")
    source, region, plot = (F.get(parts, k) for k in range(3))
    kind, option = F.split_part(plot, F.lit("-"), F.lit(1)), F.regexp_extract(plot, r"^[^-]*-(.*)$", 1)
    region = F.when(F.lower(region).isin("none", "nan", "<na>"), "None").otherwise(region)
    named = figures.withColumn("region", region).join(regions, "region", "left")
    words = [F.create_map(*(F.lit(x) for k, v in PLOTS.items() for x in (k, v[n]))) for n in (0, 1)]
    title, statistic = (F.try_element_at(w, kind) for w in words)
    caption = F.concat(
        F.lit("The "), title, F.when(plot.contains("-"), F.concat(F.lit(" of "), option)).otherwise(""),
        F.when(source == "Reference", " for the reference data").when(source != "None", F.concat(F.lit(" for "), source)).otherwise(""),
        F.when(F.col("region") != "None", F.concat(F.lit(" over the "), F.coalesce("name", "region"), F.lit(" region."))).otherwise(""),
    )
    return named.withColumns({
        "caption": F.coalesce(caption, F.lit("")), "statistic": F.concat(statistic, F.when(plot.contains("-"), F.concat(F.lit("|"), option)).otherwise("")),
        "kind": F.when(title.isNotNull(), F.when(source == "Reference", "reference").otherwise("model")),
    }).drop("name")
