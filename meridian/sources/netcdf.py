"""Headers of files in the classic NetCDF layouts (CDF-1, CDF-2, CDF-5), without any library.

Only the bytes of the header and the first and last time are read. A file that cannot be
read is a row with its error in ``invalid_asset``. ``spark.read.format("netcdf_headers")``
scans a root (options ``path``, ``pattern``, ``target``: weight of a partition in bytes);
``with_headers`` reads the headers of files that a DataFrame names.
"""

from __future__ import annotations

import fnmatch
import struct
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from meridian.sources.files import INVALID, split_invalid
from meridian.sources.folders import file_system
from meridian.sources.shared import written

#: Fixed values of the layout: type number -> struct code.
TYPES = {1: "b", 2: "c", 3: "h", 4: "i", 5: "f", 6: "d", 7: "B", 8: "H", 9: "I", 10: "q", 11: "Q"}
TYPE_NAMES = {1: "byte", 2: "char", 3: "short", 4: "int", 5: "float", 6: "double", 7: "ubyte", 8: "ushort", 9: "uint", 10: "int64", 11: "uint64"}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
HDF5 = b"\x89HDF"
FIRST_READ = 8192
#: What opening a file weighs beside its bytes, and what a partition weighs at most.
OPEN_COST = 1 << 20
TARGET = 64 << 20
VARIABLES = "array<struct<name:string,type:string,dimensions:array<string>,attributes:map<string,string>>>"
COLUMNS = f"header map<string,string>, dimensions map<string,int>, variables {VARIABLES}, times array<double>, time_units string, calendar string, {INVALID} string"
NAMES = ("header", "dimensions", "variables", "times", "time_units", "calendar")


class _Short(Exception):
    """The bytes at hand end inside the header."""


class _Cursor:
    """Reads the parts of a header one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise _Short
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, code: str) -> int:
        return struct.unpack(">" + code, self.take(struct.calcsize(code)))[0]

    def padded(self, n: int) -> bytes:
        return self.take(n + -n % 4)[:n]


def _parsed(data: bytes) -> dict:
    c = _Cursor(data)
    magic = c.take(4)
    if magic == HDF5:
        raise ValueError("an HDF5 file: only the classic layouts are read")
    if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
        raise ValueError("not a NetCDF file")
    count = "q" if magic[3] == 5 else "i"
    offset = "i" if magic[3] == 1 else "q"
    records = c.number(count)

    def name() -> str:
        return c.padded(c.number(count)).decode()

    def listed(tag: int, item: Callable[[], object]) -> list:
        kind, n = c.number("i"), c.number(count)
        if kind not in (0, tag) or n < 0 or (kind == 0 and n):
            raise ValueError("a damaged header")
        return [item() for _ in range(n)]

    def attribute() -> tuple[str, str]:
        key, kind, n = name(), c.number("i"), c.number(count)
        if kind not in TYPES or n < 0:
            raise ValueError("a damaged header")
        raw = c.padded(n * struct.calcsize(TYPES[kind]))
        if kind == 2:
            return key, raw.decode(errors="replace").rstrip("\0")
        return key, " ".join(str(x) for x in struct.unpack(f">{n}{TYPES[kind]}", raw))

    dims = listed(DIMENSION, lambda: (name(), c.number(count)))
    header = dict(listed(ATTRIBUTE, attribute))

    def variable() -> dict:
        key = name()
        own = [c.number(count if magic[3] == 5 else "i") for _ in range(c.number(count))]
        found = {"name": key, "own": own, "attributes": dict(listed(ATTRIBUTE, attribute)), "kind": c.number("i"), "size": c.number(count), "begin": c.number(offset)}
        if found["kind"] not in TYPES or any(not 0 <= d < len(dims) for d in own):
            raise ValueError("a damaged header")
        return found

    return {"records": records, "dims": dims, "header": header, "variables": listed(VARIABLE, variable)}


def read_header(read: Callable[[int, int], bytes], size: int) -> dict:
    """What a file says of itself; ``read(offset, n)`` gives its bytes and ``size`` is its length."""
    n = FIRST_READ
    while True:
        try:
            found = _parsed(read(0, min(n, size)))
            break
        except _Short:
            if n >= size:
                raise ValueError("the file ends inside its header") from None
            n *= 4
    dims, variables = found["dims"], found["variables"]
    recorded = [v for v in variables if v["own"] and dims[v["own"][0]][1] == 0]
    width = sum(v["size"] for v in recorded)
    if len(recorded) == 1:  # a single one is not padded
        (v,) = recorded
        width = struct.calcsize(TYPES[v["kind"]])
        for d in v["own"][1:]:
            width *= dims[d][1]
    records = found["records"]
    if records < 0:  # written as a stream: as many as the file holds
        records = (size - min((v["begin"] for v in recorded), default=size)) // width if width else 0
    sizes = {k: records if length == 0 else length for k, length in dims}
    out = {
        "header": found["header"], "dimensions": sizes, "times": None, "time_units": None, "calendar": None,
        "variables": [(v["name"], TYPE_NAMES[v["kind"]], [dims[d][0] for d in v["own"]], v["attributes"]) for v in variables],
    }
    time = next((v for v in variables if v["name"] == "time"), None)
    if time and len(time["own"]) == 1 and time["kind"] != 2:
        code = TYPES[time["kind"]]
        step = width if time in recorded else struct.calcsize(code)
        n = sizes[dims[time["own"][0]][0]]
        out["time_units"], out["calendar"] = time["attributes"].get("units"), time["attributes"].get("calendar", "standard")
        if n:
            ends = [read(time["begin"] + k * step, struct.calcsize(code)) for k in (0, n - 1)]
            if any(len(x) < struct.calcsize(code) for x in ends):
                raise ValueError("the file ends before its last time")
            out["times"] = [float(struct.unpack(">" + code, x)[0]) for x in ends]
    return out


def header_of(path: str) -> dict:
    fs, inside = file_system(path)
    size = fs.get_file_info(inside).size
    if size is None:
        raise FileNotFoundError(path)
    with fs.open_input_file(inside) as f:
        return read_header(lambda at, n: f.read_at(n, at) if at < size else b"", size)


def _row(path: str) -> tuple:
    try:
        found = header_of(path)
        return (*(found[n] for n in NAMES), None)
    except Exception as e:  # noqa: BLE001  a bad file must not end the scan
        return (*(None for _ in NAMES), f"{type(e).__name__}: {e}")


def with_headers(files: DataFrame) -> DataFrame:
    """``files`` (path, ...) with the columns of their headers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *_row(p)) for p in batch["path"]]
            yield pd.DataFrame(rows, columns=["path", *NAMES, INVALID])

    found = files.select("path").distinct().mapInPandas(run, f"path string, {COLUMNS}")
    return files.join(found, "path")


class Files(InputPartition):
    def __init__(self, paths: Sequence[tuple[str, int]]):
        self.paths = list(paths)


def packed(files: Sequence[tuple[str, int]], target: int) -> list[Files]:
    """Files in order, in partitions of some weight: their bytes and a cost for each."""
    parts, weight = [[]], 0
    for path, size in files:
        own = OPEN_COST + min(size, OPEN_COST)  # of a large file no more than its header is read
        if parts[-1] and weight + own > target:
            parts.append([])
            weight = 0
        parts[-1].append((path, size))
        weight += own
    return [Files(p) for p in parts if p]


class _HeaderReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.pattern, self.target = options["path"].rstrip("/"), options.get("pattern", "*.nc"), int(options.get("target", TARGET))

    def partitions(self) -> list[Files]:
        fs, root = file_system(self.root)
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        files = sorted((x.path, x.size) for x in found if x.type == pyarrow.fs.FileType.File and fnmatch.fnmatch(x.base_name, self.pattern))
        if not files:
            raise ValueError(f"no files {self.pattern} below {self.root}")
        return packed(files, self.target)

    def read(self, partition: Files) -> Iterator[tuple]:
        for path, size in partition.paths:
            yield (path, size, *_row(path))


class HeaderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf_headers"

    def schema(self) -> str:
        return f"path string, size long, {COLUMNS}"

    def reader(self, schema) -> DataSourceReader:
        return _HeaderReader(self.options)


def headers(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """The header of every file below a root; no file at all is an error."""
    spark.dataSource.register(HeaderSource)
    return spark.read.format("netcdf_headers").option("path", root).options(**options).load()


def find_datasets(spark: SparkSession, root: str, from_header: Callable[[DataFrame], DataFrame], **options: str) -> tuple[DataFrame, DataFrame]:
    """The catalogue rows of the files below a root by their headers, and what was left out (path, invalid_asset).

    ``from_header`` is one of those of ``sources.paths``. The attributes of a dataset's own
    variable, standard_name, long_name and units, come with it. A file's own error stands
    before that of its attributes. No valid file at all is an error.
    """
    df = headers(spark, root, **options)
    rows = from_header(df.withColumnRenamed(INVALID, "__unreadable").withColumnRenamed("variables", "__variables"))
    own = F.get(F.filter("__variables", lambda v: v["name"] == F.col("variable_id")), F.lit(0))["attributes"]
    rows = rows.withColumns({n: F.try_element_at(own, F.lit(n)) for n in ("standard_name", "long_name", "units")})
    rows = rows.withColumn(INVALID, F.coalesce("__unreadable", INVALID)).drop("__unreadable", "__variables")
    valid, left_out = split_invalid(written(rows, "headers"))  # each file is opened once
    if valid.isEmpty():
        raise ValueError(f"no valid datasets below {root}")
    return valid, left_out


# ---------------------------------------------------------------------- writing


def encode(dimensions: Mapping[str, int | None], attributes: Mapping[str, object], variables: Sequence[tuple[str, str, Sequence[str], Mapping[str, object], Sequence[float]]], version: int = 1) -> bytes:
    """A classic file. ``dimensions``: name -> length, None for records. ``variables``: name, type, dimensions, attributes, values in order."""
    numbers = {n: k for k, n in TYPE_NAMES.items()}
    count, offset = ("q" if version == 5 else "i"), ("i" if version == 1 else "q")

    def pack(code: str, *values) -> bytes:
        return struct.pack(f">{len(values)}{code}", *values)

    def fill(raw: bytes) -> bytes:
        return raw + b"\0" * (-len(raw) % 4)

    def text(x: str) -> bytes:
        return pack(count, len(x.encode())) + fill(x.encode())

    def listed(tag: int, items: Sequence[bytes]) -> bytes:
        return pack("i", tag if items else 0) + pack(count, len(items)) + b"".join(items)

    def attribute(key: str, value: object) -> bytes:
        if isinstance(value, str):
            return text(key) + pack("i", 2) + text(value)
        values = list(value) if isinstance(value, (list, tuple)) else [value]
        kind = 4 if all(isinstance(v, int) for v in values) else 6
        return text(key) + pack("i", kind) + pack(count, len(values)) + fill(pack(TYPES[kind], *values))

    names = list(dimensions)
    records = 0
    parts, recorded = [], []
    for name, kind, dims, own, values in variables:
        code = TYPES[numbers[kind]]
        shape = [dimensions[d] for d in dims]
        is_record = bool(shape) and shape[0] is None
        each = 1
        for s in shape[1:] if is_record else shape:
            each *= s
        if is_record:
            records = max(records, len(values) // each)
            recorded.append((name, each * struct.calcsize(code)))
        parts.append((name, code, dims, own, values, is_record, each, numbers[kind]))

    def head(begins: Mapping[str, int]) -> bytes:
        listed_variables = [
            text(n) + pack(count, len(dims)) + b"".join(pack(count if version == 5 else "i", names.index(d)) for d in dims) + listed(ATTRIBUTE, [attribute(*a) for a in own.items()])
            + pack("i", number) + pack(count, len(fill(b"\0" * each * struct.calcsize(code)))) + pack(offset, begins.get(n, 0))
            for n, code, dims, own, _, _, each, number in parts
        ]
        return (
            b"CDF" + bytes([version]) + pack(count, records) + listed(DIMENSION, [text(n) + pack(count, length or 0) for n, length in dimensions.items()])
            + listed(ATTRIBUTE, [attribute(*a) for a in attributes.items()]) + listed(VARIABLE, listed_variables)
        )

    single = len(recorded) == 1
    at, begins, body = len(head({})), {}, b""
    for name, code, _, _, values, is_record, _, _ in parts:
        if not is_record:
            begins[name] = at + len(body)
            body += fill(pack(code, *values))
    width = 0
    for name, own in recorded:
        begins[name] = at + len(body) + width
        width += own if single else own + -own % 4
    for r in range(records):
        for _, code, _, _, values, is_record, each, _ in parts:
            if is_record:
                raw = pack(code, *values[r * each : (r + 1) * each])
                body += raw if single else fill(raw)
    return head(begins) + body
