"""Merkle manifest of a table: a digest per row, a tree per group, a root over all groups.

1. Every row becomes a leaf, the sha256 of its fields.
2. The ids of each group become bitmaps: words of 64 bits are merged by OR from all
   tasks, and a chunk of 4096 ids keeps its words other than 0 behind a mask of which
   they are, with the number of rows before each word. The rows before each chunk are
   running totals over the chunks.
3. A row's place among its group's leaves is a rank query on its own chunk: rows before
   the chunk, rows before the word, bits below its own. No rows are sorted.
4. Leaves take their slots in arrays of 64, keyed by group and place, which two levels
   of hashing reduce to a node; nodes take slots in the next arrays, until each group
   has its subroot, and the subroots do the same until there is a root.
5. Paths go down again: a block's path to the root is joined to it once, and the
   siblings inside the block come from its own arrays.

Everything is DataFrame code. The bitmaps, the arrays and the paths are rows of bounded
size, and each step after the leaves is smaller than the one before.

Edge cases: a null field counts as ``-``; null groups are a group of their own, the
first; null ids come first in their group; rows that repeat an id are told apart by
their leaves, and of equal rows it doesn't matter which comes first; an empty text is not a null one; a
group of one row has its leaf as its subroot, and a table of one group its subroot as
its root; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, materialise
from meridian.operators.aggregates import running_total

FAN = 8
#: Levels of one array of slots, and its length.
LEVELS = 2
BLOCK = FAN**LEVELS
#: The chunk of null ids, below all others.
NO_ID = -(1 << 52)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as its number of bytes, a colon and its text, or ``-``."""
    texts = [f.cast("string") for f in fields]
    return sha(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _below(place: Column) -> Column:
    """All bits below a place."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), place.cast("int")))


def leaf_table(rows: DataFrame) -> DataFrame:
    """``rows`` (id, grp, leaf, ...) with what places them: grp as text that sorts, chunk, word and bit, and a number of the row."""
    i = F.col("id")
    return materialise(
        rows.withColumns({
            "grp": F.coalesce(F.concat(F.lit("1"), F.col("grp").cast("string")), F.lit("0")), "chunk": F.coalesce(F.shiftright(i, 12), F.lit(NO_ID)),
            "word": F.coalesce(F.shiftright(i, 6).bitwiseAND(63), F.lit(0)).cast("int"), "bit": F.coalesce(i.bitwiseAND(63), F.lit(0)).cast("int"), "row": F.monotonically_increasing_id(),
        }),
        "leaves",
    )


def bitmap_words(leaves: DataFrame) -> DataFrame:
    """The ids of each group as 64-bit words, with how many rows each stands for."""
    return leaves.groupBy("grp", "chunk", "word").agg(F.bit_or(_bit(F.col("bit"))).alias("bits"), F.count("*").alias("rows"))


def directory(words: DataFrame) -> DataFrame:
    """A row per group and chunk: mask of its words, the words, the rows before each, and the rows before the chunk."""
    entries = words.groupBy("grp", "chunk").agg(F.sort_array(F.collect_list(F.struct("word", "bits", "rows"))).alias("e"), F.sum("rows").alias("total"))  # 64 words at most
    zero = F.lit(0).cast("long")
    before = F.transform(F.sequence(F.lit(1), F.size("e")), lambda k: F.aggregate(F.slice("e", 1, k - 1), zero, lambda a, x: a + x["rows"]))
    chunks = entries.select(
        "grp", "chunk", "total", F.aggregate("e", zero, lambda a, x: a.bitwiseOR(_bit(x["word"]))).alias("mask"), F.transform("e", lambda x: x["bits"]).alias("words"), before.alias("word_starts"),
    )
    return running_total(chunks, ["chunk"], F.col("total"), ["grp"], "chunk_start")


def rank(word: Column, bit: Column) -> Column:
    """The number of rows of smaller ids, from a row of the directory; ids of one row each are assumed in the own word."""
    place = F.bit_count(F.col("mask").bitwiseAND(_below(word)))
    return F.col("chunk_start") + F.get("word_starts", place) + F.bit_count(F.get("words", place).bitwiseAND(_below(bit)))


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``place`` in their group, from 0, and ``size``, the rows of the group."""
    words = materialise(bitmap_words(leaves), "words")
    chunks = materialise(directory(words), "directory")
    sizes = materialise(chunks.groupBy("grp").agg(F.sum("total").alias("size")), "sizes")
    known = leaves.join(chunks.select("grp", "chunk", "mask", "words", "word_starts", "chunk_start"), ["grp", "chunk"]).withColumn("place", rank(F.col("word"), F.col("bit")))
    known = known.drop("mask", "words", "word_starts", "chunk_start")
    crowded = words.where(F.col("rows") > F.bit_count("bits")).select("grp", "chunk", "word")
    if not crowded.isEmpty():  # ids of several rows each
        inside = ["grp", "chunk", "word"]
        suspects = materialise(leaves.join(crowded, inside, "left_semi").select(*inside, "bit", "leaf", "row"), "suspects")
        times = materialise(suspects.groupBy(*inside, "bit").agg((F.count("*") - 1).alias("more")).where("more > 0"), "repeated")
        extra = times.groupBy(*inside).agg(F.collect_list(F.struct("bit", "more")).alias("extra"))  # 64 bits at most
        nth = running_total(suspects.join(times.drop("more"), [*inside, "bit"], "left_semi"), ["leaf", "row"], by=[*inside, "bit"], name="nth").select("row", "nth")
        known = known.join(extra, inside, "left").join(materialise(nth, "ties"), "row", "left")
        below = F.aggregate(F.filter("extra", lambda x: x["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda a, x: a + x["more"])
        known = known.withColumn("place", F.col("place") + F.coalesce(below, F.lit(0)) + F.coalesce("nth", F.lit(0))).drop("extra", "nth")
    return known.join(sizes, "grp")


# ------------------------------------------------------------------------- tree


def _hashed(digests: Column) -> Column:
    """The nodes above: one for each run of ``FAN``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int")), lambda k: sha(F.array_join(F.slice(digests, k * FAN + 1, FAN), "")))


def _levels(size: Column) -> Column:
    """How many levels a block of a group of ``size`` nodes has."""
    found = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        found = F.when(size <= FAN**k, k).otherwise(found)
    return found


def reduced(nodes: DataFrame, label: str, *payload: str) -> DataFrame:
    """Nodes (grp, place, size, digest) in slots of blocks: grp, block, size, levels, the digests of each level, ``node``.

    ``payload`` columns go with their slots, as ``items``.
    """
    slot = F.col("place").bitwiseAND(BLOCK - 1).cast("int")
    slots = F.sort_array(F.collect_list(F.struct(slot.alias("slot"), "digest", *([F.struct(*payload).alias("item")] if payload else []))))  # BLOCK of them at most
    blocks = nodes.withColumn("block", F.shiftright("place", LEVELS * 3)).groupBy("grp", "size", "block").agg(slots.alias("slots"))
    blocks = blocks.select(
        "grp", "block", "size", _levels(F.col("size")).alias("levels"), F.transform("slots", lambda s: s["digest"]).alias("digests_0"), *([F.transform("slots", lambda s: s["item"]).alias("items")] if payload else [])
    )
    for k in range(LEVELS):
        blocks = blocks.withColumn(f"digests_{k + 1}", F.when(F.col("levels") > k, _hashed(F.col(f"digests_{k}"))))
    node = F.coalesce(*(F.get(f"digests_{k}", F.lit(0)) for k in reversed(range(LEVELS + 1))))
    return materialise(blocks.withColumn("node", node).drop(f"digests_{LEVELS}"), label)


def _upwards(nodes: DataFrame, largest: int, label: str, *payload: str) -> list[DataFrame]:
    """The blocks of each stage, until every group has one node."""
    stages = []
    while True:
        stages.append(reduced(nodes, f"{label}-{len(stages)}", *payload))
        largest, payload = -(-largest // BLOCK), ()
        if largest <= 1:
            return stages
        nodes = stages[-1].select("grp", F.col("block").alias("place"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("node").alias("digest"))


def _siblings(digests: str, k: Column) -> Column:
    """What stands left and right of place ``k`` in its run, each as one text."""
    inside = k % FAN
    return F.struct(
        F.array_join(F.slice(digests, k - inside + 1, inside), "").alias("left"), F.array_join(F.slice(digests, k + 2, F.lit(FAN - 1) - inside), "").alias("right"),
    )


def _path(k: Column) -> Column:
    """The path of slot ``k`` through its block."""
    steps = [F.when(F.col("levels") > n, F.array(_siblings(f"digests_{n}", F.floor(k / FAN**n).cast("int")))).otherwise(F.array().cast(PATH)) for n in range(LEVELS)]
    return F.concat(*steps)


def _downwards(stages: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """The path to the root of every block of the first stage, from those of the last nodes (grp, block, path, ...)."""
    kept = [c for c in above.columns if c not in ("grp", "block", "path")]
    for blocks in reversed(stages[1:]):
        inner = F.transform(F.sequence(F.lit(0), F.size("digests_0") - 1), lambda k: F.struct((F.col("block") * BLOCK + k).alias("block"), _path(k).alias("path")))
        nodes = blocks.withColumn("inner", inner).select("grp", "block", "inner").join(above, ["grp", "block"])
        rest = nodes.select("grp", "path", *kept, F.explode("inner").alias("i"))
        above = rest.select("grp", F.col("i.block").alias("block"), F.concat("i.path", "path").alias("path"), *kept)
    return above


def fold(start: Column, path: Column) -> Column:
    """The root that a digest leads to along a path."""
    return F.aggregate(path, start, lambda a, s: sha(F.concat(s["left"], a, s["right"])))


def path_digest(own: Column, above: Column) -> Column:
    """The sha256 of all siblings on a path in two parts, from the leaf up, left to right."""
    return sha(F.concat(*(F.array_join(F.transform(p, lambda s: F.concat(s["left"], s["right"])), "") for p in (own, above))))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", altered: Sequence[Column] | None = None, where: Column | None = None) -> DataFrame:
    """id, grp, leaf, subroot, root, path_sha256, folded_root of every row of ``docs``.

    ``altered`` are the fields of a row as they are found now, in the rows that ``where``
    holds for: ``folded_root`` is the root that they lead to with the siblings of old.
    """
    leaf = leaf_of([F.col(f) for f in fields])
    found = F.lit(None).cast("string") if altered is None else F.when(F.lit(True) if where is None else where, leaf_of(altered))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(group).alias("grp"), leaf.alias("leaf"), found.alias("found"))
    leaves = leaf_table(rows.withColumn("found", F.when(F.col("found") != F.col("leaf"), F.col("found"))))
    nodes = placed(leaves).select("grp", "place", "size", F.col("leaf").alias("digest"), "id", "found")
    sizes = leaves.groupBy("grp").agg(F.count("*").alias("size")).agg(F.max("size").alias("largest"), F.count("*").alias("groups")).first()
    stages = _upwards(nodes, sizes["largest"] or 0, "blocks", "id", "found")
    subroots = stages[-1].select("grp", F.col("node").alias("subroot"))
    numbered = materialise(running_total(subroots, ["grp"], name="place"), "subroots")
    tops = _upwards(numbered.select(F.lit("").alias("grp"), "place", F.lit(sizes["groups"]).cast("long").alias("size"), F.col("subroot").alias("digest")), sizes["groups"], "tops")
    end = tops[-1].select("grp", "block", F.array().cast(PATH).alias("path"), F.col("node").alias("root"))
    blocks = _downwards(tops, end)
    inner = F.transform(F.sequence(F.lit(0), F.size("digests_0") - 1), lambda k: F.struct((F.col("block") * BLOCK + k).alias("place"), _path(k).alias("path")))
    heads = tops[0].withColumn("inner", inner).select("block", F.explode("inner").alias("i")).join(blocks.drop("grp"), "block")
    heads = heads.select(F.col("i.place").alias("place"), F.concat("i.path", "path").alias("path"), "root").join(numbered, "place")
    above = _downwards(stages, heads.select("grp", F.lit(0).cast("long").alias("block"), "path", "subroot", "root"))

    own = stages[0].withColumn("own", F.transform(F.sequence(F.lit(0), F.size("items") - 1), _path)).drop("digests_1", "node").join(above, ["grp", "block"])
    member = lambda x, k: F.struct(x["id"].alias("id"), F.get("digests_0", k).alias("leaf"), path_digest(F.get("own", k), F.col("path")).alias("path_sha256"), fold(fold(F.coalesce(x["found"], F.get("digests_0", k)), F.get("own", k)), F.col("path")).alias("folded_root"))
    out = own.select("grp", "subroot", "root", F.explode(F.transform("items", member)).alias("m"))
    return out.select("m.id", F.expr("substring(grp, 2)").alias("grp"), "m.leaf", "subroot", "root", "m.path_sha256", "m.folded_root")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the manifest of all documents; a third of them, by crc32 of the doc_id, are found with their A-Z in lower case."""
    docs = documents(spark, sf_dir, *FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    found = manifest(docs, altered=[*(F.col(f) for f in FIELDS[:-1]), lowered], where=tampered)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("path_sha256").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _levels_sql(nodes: str, runs: str, count: int) -> list[str]:
    """``count`` levels above the table ``nodes``0 (grp, place, size, d), with the runs that they come from."""
    return [
        x
        for k in range(count)
        for x in (
            f"{runs}{k} AS MATERIALIZED (SELECT grp, place // 8 AS place, size, list(d ORDER BY place) AS ds FROM {nodes}{k} GROUP BY grp, place // 8, size)",
            f"{nodes}{k + 1} AS MATERIALIZED (SELECT grp, place, (size + 7) // 8 AS size, CASE WHEN size > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {runs}{k})",
        )
    ]


def _paths_sql(table: str, runs: str, count: int) -> list[str]:
    """``table``0 (grp, place, size, f, p, ...) taken up ``count`` levels: f folds, p gathers siblings."""
    left, right = "array_to_string(ds[1:t.place % 8], '')", "array_to_string(ds[t.place % 8 + 2:], '')"
    return [
        f"""{table}{k + 1} AS MATERIALIZED (SELECT t.* EXCLUDE (place, size, f, p), t.place // 8 AS place, (t.size + 7) // 8 AS size,
  CASE WHEN t.size > 1 THEN sha256({left} || f || {right}) ELSE f END AS f, CASE WHEN t.size > 1 THEN p || {left} || {right} ELSE p END AS p
  FROM {table}{k} t JOIN {runs}{k} r ON t.grp = r.grp AND t.place // 8 = r.place)"""
        for k in range(count)
    ]


def _sql() -> str:
    fields = [f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}")]
    leaf = "sha256(" + " || ".join(fields) + ")"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = """xor(list_reduce(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) FOR _ IN range(8)]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""
    parts = [
        f"""t0 AS MATERIALIZED (SELECT doc_id, coalesce('1' || lang, '0') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size, leaf,
  CASE WHEN {crc} % 3 = 0 THEN {leaf.format(text=lowered)} ELSE leaf END AS f, '' AS p FROM (SELECT *, {leaf.format(text="text")} AS leaf FROM documents))""",
        "n0 AS (SELECT grp, place, size, leaf AS d FROM t0)", *_levels_sql("n", "r", 8), *_paths_sql("t", "r", 8),
        "m0 AS MATERIALIZED (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS size, d, grp AS own FROM n8)", *_levels_sql("m", "s", 3),
        "u0 AS (SELECT doc_id, leaf, m0.d AS subroot, '' AS grp, m0.place AS place, m0.size AS size, f, p FROM t8 JOIN m0 ON t8.grp = m0.own)", *_paths_sql("u", "s", 3),
    ]
    return "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, (SELECT d FROM m3) AS root, sha256(p) AS proof_sha256, f AS folded_root, f = (SELECT d FROM m3) AS verified FROM u3"


SQL = _sql()
