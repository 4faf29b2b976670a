"""Secret scan: keyword automaton, anchored expressions at its hits, checksums.

One Aho-Corasick pass over a text finds all keywords; an expression is tried only
where its own keyword was hit. Runs of hex digits have no keyword, so they alone
are searched for directly. Beyond the base kinds (assign, access, hex) the method
adds: github and npm tokens whose last six characters are the base-62 CRC-32 of
the rest, JSON web tokens whose header decodes, and private-key headers.

Spans are kind:start:end in code points, end exclusive, ordered by start, then by
kind as listed in ``KINDS``.

Edge cases: a null text counts as empty and has no spans; null and repeated
doc_ids give a row each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "pem")
FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

#: Keyword (lower case) -> kind.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "-----begin ": "pem",
}
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    "pem": re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
}
HEX = re.compile(r"[0-9a-f]{32,}")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(body: str) -> str:
    """CRC-32 as six base-62 digits, as token issuers append it."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, low = divmod(value, 62)
        digits = DIGITS[low] + digits
    return digits


def _json_header(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (ValueError, binascii.Error, RecursionError):
        return False


VALID = {
    "assign": lambda m: len(m[2]) >= 8,
    "access": lambda m: len(m[0]) >= 16,
    "github": lambda m: checksum(m[1][:-6]) == m[1][-6:],
    "npm": lambda m: checksum(m[1][:-6]) == m[1][-6:],
    "jwt": lambda m: _json_header(m[1]),
    "pem": lambda m: True,
}


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def scan(text: str, words) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, in order."""
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    # U+0130 is the one code point whose lower case is longer
    lower = text.lower() if "İ" not in text else text.replace("İ", "i").lower()
    past: dict[str, int] = {}
    for at, (kind, n) in words.iter(lower):
        start = at - n + 1
        if start < past.get(kind, 0):
            continue
        m = PATTERNS[kind].match(text, start)
        if m:
            past[kind] = m.end()
            if VALID[kind](m):
                found.append((start, m.end(), kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _spans(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets for every row of ``docs`` (doc_id, text)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            found = [scan(x or "", words) for x in batch.column(1).to_pylist()]
            counts = {k: pa.array([sum(x[2] == k for x in f) for f in found], pa.int64()) for k in BASE}
            base = [hashlib.sha256(_spans([x for x in f if x[2] in BASE]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(pa.int64()), "n_assign": counts["assign"], "n_access": counts["access"], "n_hex": counts["hex"],
                "base_sha256": pa.array(base, pa.string()), "spans": pa.array([_spans(f) for f in found], pa.string()),
            })

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(search, FOUND)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: secrets in all documents."""
    return find_secrets(documents(spark, sf_dir, "doc_id", "text"))
