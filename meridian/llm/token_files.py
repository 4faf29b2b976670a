"""Token-ID files: independent zstandard frames with a trailing seek table.

Layout of a file, all numbers little-endian:

* one zstandard frame for each document, holding its ids as uint16 where every id
  of the vocabulary fits, else as uint32;
* one skippable frame (so that the whole file stays a valid zstandard stream) with
  the seek table, one record of ``SEEK`` per document, and a footer ``FOOTER``.

A reader fetches the footer and the table, and then decompresses only the frames
of the documents asked for; a frame's crc32 is checked against its record.

Edge cases: a null text counts as empty and still gets its end id; null doc_ids
come first, repeated doc_ids stay as rows of their own in the order of their
texts; an empty table gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import documents, fresh_path, materialise, text_bytes
from meridian.llm.tokens import WordTokenizer, default_path

SEEK = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("bytes", "<u4"), ("tokens", "<u4"), ("crc32", "<u4")])
FOOTER = struct.Struct("<QIB7s")
MAGIC = b"MTOKSK1"
SKIPPABLE = 0x184D2A5E
MANIFEST = "part int, file string, n_docs long, n_tokens long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, docs: Iterable[tuple[int | None, bytes]], width: int, level: int = 3) -> tuple[int, int, int]:
    """Write documents (doc_id, ids as uint32 bytes) in the order given; returns documents, tokens and bytes.

    The bytes go to a name of this attempt and are moved when complete.
    """
    import zstandard

    store, path = _open(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    part, table = f"{path}.{uuid.uuid4().hex}.tmp", []
    pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
    size = 0
    with store.open_output_stream(part) as out:
        for doc_id, raw in docs:
            ids = np.frombuffer(raw, "<u4")
            frame = pack.compress(ids.astype("<u2").tobytes() if width == 2 else raw)
            out.write(frame)
            size += len(frame)
            table.append((doc_id is not None, doc_id or 0, len(frame), len(ids), zlib.crc32(raw)))
        seek = np.array(table, SEEK).tobytes()
        tail = seek + FOOTER.pack(len(table), zlib.crc32(seek), width, MAGIC)
        out.write(struct.pack("<II", SKIPPABLE, len(tail)) + tail)
    store.move(part, path)
    return len(table), int(sum(t[3] for t in table)), size + len(tail) + 8


class TokenFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        store, path = _open(uri)
        self._in = store.open_input_file(path)
        end = self._in.size()
        n, crc, self.width, magic = FOOTER.unpack(self._in.read_at(FOOTER.size, end - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        seek = self._in.read_at(n * SEEK.itemsize, end - FOOTER.size - n * SEEK.itemsize)
        if zlib.crc32(seek) != crc:
            raise ValueError(f"{uri}: the seek table is damaged")
        self.table = np.frombuffer(seek, SEEK)
        self.offsets = np.concatenate([[0], np.cumsum(self.table["bytes"], dtype="i8")])

    def __len__(self) -> int:
        return len(self.table)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document; only its frame is read and decompressed."""
        import zstandard

        row = self.table[k]
        raw = zstandard.ZstdDecompressor().decompress(self._in.read_at(int(row["bytes"]), int(self.offsets[k])))
        ids = np.frombuffer(raw, f"<u{self.width}").astype("<u4")
        if len(ids) != row["tokens"] or zlib.crc32(ids.tobytes()) != row["crc32"]:
            raise ValueError(f"document {k}: its frame does not match the seek table")
        return ids

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents with this doc_id."""
        return [self.ids(int(k)) for k in np.flatnonzero((self.table["doc_id"] == doc_id) & (self.table["has_id"] == 1))]

    def close(self) -> None:
        self._in.close()


#: Bytes of text that go into one file.
FILE_BYTES = 256 << 20


def write_tokens(docs: DataFrame, uri: str, tokenizer: str | None = None, end_id: int = 2, level: int = 3) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) and write them under ``uri`` in ascending doc_id order.

    Returns the manifest, one row per file; ``part`` numbers the files in order. The
    manifest names only files of tasks that succeeded.
    """
    tokenizer = tokenizer or default_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        words = WordTokenizer.of_worker(tokenizer)
        width = 2 if max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()

        def encoded():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield doc_id, words.encode(text) + end

        rows = encoded()
        first = next(rows, None)
        if first is not None:
            file = f"{uri}/part-{part:06d}-{uuid.uuid4().hex}.mtok"

            def whole():
                yield first
                yield from rows

            n_docs, n_tokens, n_bytes = write_file(file, whole(), width, level)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [file], "n_docs": [n_docs], "n_tokens": [n_tokens], "n_bytes": [n_bytes]}
            )

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(tasks, -(-size // FILE_BYTES))
    rows = docs.select("doc_id", text_bytes().alias("text"), F.xxhash64("text").alias("mark"))  # the mark parts rows of one doc_id
    rows = rows.repartitionByRange(files, "doc_id", "mark").sortWithinPartitions("doc_id", "mark").select("doc_id", "text")
    return materialise(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the files in ``manifest``: doc_id, start, n_tokens, ids_crc32 [, ids].

    ``start`` counts the ids of all documents before it, over all files.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                f = TokenFile(file)
                for low in range(0, len(f), 2000):
                    some = range(low, min(low + 2000, len(f)))
                    ids = [f.ids(k) for k in some]
                    n = np.array([len(x) for x in ids], "i8")
                    has = f.table["has_id"][some.start : some.stop] == 0
                    out = {
                        "doc_id": pa.array(f.table["doc_id"][some.start : some.stop].astype("i8"), pa.int64(), mask=has),
                        "start": pa.array(start + np.cumsum(n) - n),
                        "n_tokens": pa.array(n),
                        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([x.tolist() for x in ids], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)
                    start += int(n.sum())
                f.close()

    # one row per file; the running total over files is small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("part", "file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    tasks = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), manifest.count())
    return starts.repartition(tasks, "part").mapInArrow(read, ROWS + (", ids array<long>" if with_ids else ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: write all documents as token files and describe each from the files read back."""
    manifest = write_tokens(documents(spark, sf_dir, "doc_id", "text"), fresh_path(spark, "tokens"))
    return read_tokens(manifest)
