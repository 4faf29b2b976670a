"""Exact deduplication by exchanging Golomb-coded fingerprints.

1. Each task hashes its texts and sends every owner (a range of fingerprints) its
   sorted distinct fingerprints as Golomb-coded gaps.
2. An owner merges the messages and sends each task back a bitmap of the
   fingerprints that another task has too.
3. Only rows behind a set bit, or repeated within their task, are suspects. Their
   texts alone are gathered and compared byte by byte.

Texts are equal when identical after each run of ASCII white space becomes one
space; the row with the smallest doc_id stays.

Edge cases: null text counts as empty (and empty texts equal each other); a null
doc_id comes after all others, so such a row stays only where its whole group has
none; of rows with equal doc_id and text the first one read stays; an empty table
gives no rows; further columns are ignored by ``find_copies`` and kept by
``drop_copies``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, free_names, join_known, limited_broadcast, materialise, text_bytes

#: White space that is not already one single space.
UNEVEN = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
#: Rows of a batch that a task sends.
ROWS = 20_000
#: Fingerprints of an owner.
OWNED = 2_000_000
SENT = "part int, nth int, doc_id long, sha string, owner int, rank int, twice boolean, n int, message binary"


def golomb_encode(values: np.ndarray, rice: int) -> bytes:
    """Ascending uint64 values as Golomb codes of their gaps, with divisor ``2**rice``."""
    gaps = np.diff(values, prepend=np.uint64(0))
    high = (gaps >> np.uint64(rice)).astype("i8")
    ends = np.cumsum(high + 1 + rice)
    bits = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    stop = ends - rice - 1
    bits[stop] = True
    for j in range(rice):
        bits[stop + 1 + j] = (gaps >> np.uint64(rice - 1 - j)) & np.uint64(1)
    return bytes([rice]) + np.packbits(bits).tobytes()


def golomb_decode(message: bytes, n: int) -> np.ndarray:
    rice = message[0]
    bits = np.unpackbits(np.frombuffer(message, "u1", offset=1))
    ones = np.where(bits, np.arange(len(bits)), len(bits))
    following = np.minimum.accumulate(ones[::-1])[::-1].tolist()  # the next set bit from each place on
    at, stops, starts = 0, [], []
    for _ in range(n):
        stop = following[at]
        starts.append(at)
        stops.append(stop)
        at = stop + 1 + rice
    gaps = np.array(stops, "u8") - np.array(starts, "u8")
    where = np.array(stops, "i8") + 1
    for j in range(rice):
        gaps = (gaps << np.uint64(1)) | bits[where + j]
    return np.cumsum(gaps, dtype="u8")


def rice_parameter(n: int, space: int) -> int:
    """The power of two nearest below 0.69 times the mean gap, which is the best divisor for random values."""
    return max(0, int(0.69 * space / max(n, 1)).bit_length() - 1)


def _fingerprints(owners: int):
    """One row for each document and one for each message of a task."""
    uneven = re.compile(UNEVEN.encode())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, ids, digests = TaskContext.get().partitionId(), [], bytearray()
        for batch in batches:
            ids.append(batch.column(0).cast(pa.int64()))
            for x in batch.column(1).to_pylist():
                digests += hashlib.sha256(uneven.sub(b" ", x)).digest()
        n = len(digests) // 32
        if not n:
            return
        ids = pa.concat_arrays(ids)
        prints = np.frombuffer(digests, ">u8")[::4].astype("u8")
        own, place, times = np.unique(prints, return_inverse=True, return_counts=True)
        owner = ((own >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
        first = np.searchsorted(owner, np.arange(owners + 1))
        rank = np.arange(len(own)) - first[owner.astype("i8")]
        for low in range(0, n, ROWS):
            m = min(ROWS, n - low)
            at = place[low : low + m]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * m, pa.int32()), "nth": pa.array(np.arange(low, low + m, dtype="i4")), "doc_id": ids.slice(low, m),
                "sha": [digests[32 * k : 32 * k + 32].hex() for k in range(low, low + m)], "owner": pa.array(owner[at].astype("i4")), "rank": pa.array(rank[at].astype("i4")),
                "twice": pa.array(times[at] > 1), "n": pa.nulls(m, pa.int32()), "message": pa.nulls(m, pa.binary()),
            })
        k = np.flatnonzero(np.diff(first))
        count = np.diff(first)[k]
        space = (1 << 64) // owners
        sent = [golomb_encode(own[first[o] : first[o + 1]] - np.uint64(-(-(int(o) << 64) // owners) if o else 0), rice_parameter(int(c), space)) for o, c in zip(k, count, strict=True)]
        m = len(k)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * m, pa.int32()), "nth": pa.nulls(m, pa.int32()), "doc_id": pa.nulls(m, pa.int64()),
            "sha": pa.nulls(m, pa.string()), "owner": pa.array(k.astype("i4")), "rank": pa.nulls(m, pa.int32()),
            "twice": pa.nulls(m, pa.bool_()), "n": pa.array(count.astype("i4")), "message": pa.array(sent, pa.binary()),
        })

    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: for each task, which of its fingerprints another task sent too."""
    sent = [golomb_decode(m, n) for m, n in zip(messages["message"], messages["n"], strict=True)]
    values, times = np.unique(np.concatenate(sent), return_counts=True)
    twice = values[times > 1]
    marks = [np.isin(x, twice, assume_unique=True) for x in sent]
    keep = [k for k, m in enumerate(marks) if m.any()]
    out = messages.iloc[keep][["part", "owner"]].copy()
    out["bitmap"] = [np.packbits(marks[k]).tobytes() for k in keep]
    return out


def normalised(text: F.Column) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN, " ")


def find_copies(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    owners = owners or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // OWNED))
    sent = materialise(docs.select("doc_id", text_bytes().alias("text")).mapInArrow(_fingerprints(owners), SENT), "fingerprints")
    rows = sent.where("message is null").select("part", "nth", "doc_id", "sha", "owner", "rank", "twice")
    messages = sent.where("message is not null").select("part", "owner", "n", "message")
    bitmaps = messages.groupBy("owner").applyInPandas(_answer, "part int, owner int, bitmap binary")

    byte = F.conv(F.hex(F.expr("substring(bitmap, rank div 8 + 1, 1)")), 16, 10).cast("int")
    bit = F.coalesce(F.expr("shiftright(bits, 7 - rank % 8) & 1") == 1, F.lit(False))
    marked = materialise(
        rows.join(bitmaps, ["part", "owner"], "left").withColumn("bits", byte).select("part", "nth", "doc_id", "sha", (F.col("twice") | bit).alias("suspect")),
        "marked",
    )
    suspects = marked.where("suspect")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part", "nth")
    groups = materialise(suspects.groupBy("sha").agg(F.min(order).alias("keep"), F.count("*").alias("size")).where("size > 1"), "groups")

    # equal hashes are only candidates: the texts of the suspects are compared
    texts = docs.select(normalised(F.col("text")).alias("norm")).withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    texts = texts.join(limited_broadcast(groups.select("sha"), 250_000), "sha", "left_semi")
    same = texts.groupBy("sha", "norm").agg(F.count("*").alias("rows")).groupBy("sha").agg(F.count("*").alias("texts"), F.sum("rows").alias("rows"))
    proven = groups.join(same, "sha").withColumn(
        "size", F.when((F.col("texts") == 1) & (F.col("rows") == F.col("size")), F.col("size")).otherwise(F.raise_error(F.lit("texts of one hash differ")).cast("long"))
    )
    proven = materialise(proven.select("sha", "keep", "size"), "proven")
    grouped = join_known(suspects, proven.withColumn("rows", F.col("size")), "sha", "rows")
    alone = F.col("size").isNull()
    is_kept = alone | ((F.col("keep.part") == F.col("part")) & (F.col("keep.nth") == F.col("nth")))
    found = grouped.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), is_kept.alias("kept"), F.col("sha").alias("text_sha256"),
    )
    single = marked.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return single.unionByName(found)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns kept."""
    found = materialise(find_copies(docs), "copies")
    key = ["doc_id", "text_sha256"]
    gone = found.where("not kept")
    copies = gone.where("not (doc_id <=> keep_id)").select(*key).distinct()
    repeated = gone.where("doc_id <=> keep_id").select(*key).distinct()
    own, id_, sha_ = free_names(docs, 3)
    named = docs.withColumn(own, F.sha2(normalised(F.col("text")).cast("binary"), 256))

    def side_of(side: DataFrame) -> DataFrame:
        return limited_broadcast(side.select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha_)), 250_000)

    def on(side: DataFrame) -> F.Column:
        return named["doc_id"].eqNullSafe(side[id_]) & (named[own] == side[sha_])

    side = side_of(copies)
    named = named.join(side, on(side), "left_anti")
    if not repeated.isEmpty():
        side = side_of(repeated)
        named = named.join(side, on(side), "left_anti").unionByName(named.join(side, on(side), "left_semi").dropDuplicates(["doc_id", own]))
    return named.drop(own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the groups of equal texts among all documents."""
    return find_copies(documents(spark, sf_dir, "doc_id", "text"))


SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM norm
"""
