"""Word and shingle hashes of whole texts, computed for many texts at once with numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

WIDTH = 5
#: Bytes hashed at a time; longer texts are hashed in pieces that end at white space.
CHUNK = 1 << 20

#: Bytes that words are made of: all but white space, or letters, digits and anything beyond ASCII.
SPACED = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
ALPHANUMERIC = np.isin(np.arange(256), [*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)])
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 64, 256, "u8")[_LOWER]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = _rng.integers(0, 1 << 63, WIDTH, "u8") * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of uint64 values that scatters them; each seed gives another."""
    x = x ^ np.uint64(seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, table: list[np.ndarray] = [np.ones(1, "u8")]) -> np.ndarray:  # noqa: B006  kept between calls
    if len(table[0]) < n:
        steps = np.full(max(n, 256), _STEP)
        steps[0] = 1
        table[0] = np.multiply.accumulate(steps)
    return table[0]


def _hash_words(data: bytes, made_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start and the hash of each word of ``data``, A-Z as a-z."""
    raw = np.frombuffer(data, "u1")
    inside = made_of[raw]
    edge = np.diff(inside.astype("i1"), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.zeros(0, "u8")
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    value = _BYTE[raw[inside]] * _powers(int(size.max()))[place]
    return starts, mix(np.add.reduceat(value, first) + size.astype("u8"))


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > CHUNK:
        cut = max(text.rfind(b" ", at, at + CHUNK), text.rfind(b"\n", at, at + CHUNK))
        if cut < at:
            cut = min((x for x in (text.find(b" ", at + CHUNK), text.find(b"\n", at + CHUNK)) if x >= 0), default=len(text) - 1)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def words(texts: list[bytes], made_of: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of ``texts``, and how many each text has."""
    hashes, counts = [], np.zeros(len(texts), "i8")
    group: list[bytes] = []
    of: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if group:
            bounds = np.cumsum([len(g) + 1 for g in group])
            starts, found = _hash_words(b"\n".join(group), made_of)
            hashes.append(found)
            np.add.at(counts, np.array(of)[np.searchsorted(bounds, starts, side="right")], 1)
            group.clear()
            of.clear()
            held = 0

    for k, text in enumerate(texts):
        for piece in _pieces(text):
            group.append(piece)
            of.append(k)
            held += len(piece)
            if held >= CHUNK:
                flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, "u8")), counts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer than ``WIDTH`` words has its whole sequence as its one shingle; a
    text without words has none.
    """
    hashes, counts = words(texts)
    ends = np.cumsum(counts)
    n = len(hashes) - WIDTH + 1
    every = np.zeros(max(n, 0), "u8")
    for j in range(WIDTH if n > 0 else 0):
        every += hashes[j : n + j] * _MULTIPLY[j]
    every = mix(every, 1)
    found = []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        if count >= WIDTH:
            found.append(np.unique(every[end - count : end - WIDTH + 1]))
        elif count:
            own = hashes[end - count : end]
            found.append(mix(np.sum(own * _MULTIPLY[:count], dtype="u8", keepdims=True) + np.uint64(count), 2))
        else:
            found.append(np.zeros(0, "u8"))
    return found


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed 64-bit numbers."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
