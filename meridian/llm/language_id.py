"""Language identification by cross-parsing: in which language does a text fall into fewest phrases?

For every language a suffix automaton of a bounded sample of its labelled text accepts
just the strings that occur in the sample. A text is parsed greedily from the left:
each phrase is the longest match from its place on, or one character where nothing
matches. A phrase costs log2 of the sample's length, so that samples of different
lengths compare; the language with the fewest normalised phrases, that is bits a
character, wins.

Texts are lower-cased; letters and the marks on them stay, and every run of anything
else is one space. Phrases also end every ``PIECE`` characters, in all languages alike, so
that numpy parses the pieces of many texts and all languages side by side, one
character at a time. An automaton is kept as one displaced array of transitions.

``max_chars`` bounds the characters of all samples together and ``sample_chars`` those of
one language; texts are taken in the order of their hashes, each text once, at most
``sample_texts`` of them and a ``SHARE``-th of the sample from each. Of more than
``max_languages`` labels those with the most texts are learned. Everything else covers
every row and whole texts.

Edge cases: a null text, and one without a letter, is ``und`` with score 0, as is every
text if no language was learned; a label whose sample has no letter is not learned; with
equal costs the first language by name wins; the only language learned wins with score 1;
rows with null doc_ids teach nothing; null and repeated doc_ids are predicted as rows of
their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import documents, materialise, release_memory, slices

SAMPLE_CHARS = 60_000
MAX_CHARS = 4_000_000
MAX_LANGUAGES = 200
SAMPLE_TEXTS = 64
SHARE = 16
#: Characters of a piece, and of what is held as one array.
PIECE = 256
CHUNK = 1 << 20
#: A score is the odds after so many characters at most.
ODDS_CHARS = 40
UNKNOWN = "und"
_KINDS: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """For every code point: 2 for letters, 1 for marks on them, 0 for all else."""
    if not _KINDS:
        _KINDS.append(np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)], "u1"))
    return _KINDS[0]


def normalised(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of ``texts`` one behind the other, 0 for a run of others; how many each has, and which have a letter.

    No text begins with a space.
    """
    lower = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lower], "i8")
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), "<u4").astype("i4")
    kind = kinds()[codes]
    codes[kind == 0] = 0
    ends = np.cumsum(sizes)
    before = np.zeros(len(codes), "i4")
    before[1:] = codes[:-1]
    before[(ends - sizes)[sizes > 0]] = 0
    keep = (codes != 0) | (before != 0)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[ends] - total[ends - sizes]

    return codes[keep], per_text(keep), per_text(kind == 2) > 0


# -------------------------------------------------------------------- automaton


def suffix_automaton(codes: Sequence[int]) -> list[dict[int, int]]:
    """The transitions of each state; state 0 is the start. All paths together spell the substrings of ``codes``."""
    follow, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p, last = last, state
        while p >= 0 and c not in follow[p]:
            follow[p][c] = state
            p = link[p]
        if p < 0:
            continue
        q = follow[p][c]
        if length[q] == length[p] + 1:
            link[state] = q
            continue
        copy = len(follow)
        follow.append(dict(follow[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = link[state] = copy
        while p >= 0 and follow[p].get(c) == q:
            follow[p][c] = copy
            p = link[p]
    return follow


def displaced(follow: Sequence[dict[int, int]], width: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions over characters below ``width`` as (base, owner, target): state s goes by c to target[base[s] + c] if owner there is s.

    States of many transitions take the first of some random places that are free, those
    of one transition what is left over.
    """
    total = sum(map(len, follow))
    size = int(1.3 * total) + width
    owner = [-1] * (size + 2 * width)
    target = [0] * (size + 2 * width)
    base = [0] * len(follow)
    rng = np.random.default_rng(seed)
    order = sorted((s for s, f in enumerate(follow) if len(f) > 1), key=lambda s: -len(follow[s]))

    def places() -> Iterator[int]:
        nonlocal size
        while True:
            yield from rng.integers(width, size + 1, 8 * len(order) + 1024).tolist()
            more = size // 2  # so many places were taken: make room
            owner.extend([-1] * more)
            target.extend([0] * more)
            size += more

    draw = places()
    for s in order:
        own = follow[s]
        b = next(b for b in draw if all(owner[b + c] < 0 for c in own))
        base[s] = b
        for c, t in own.items():
            owner[b + c], target[b + c] = s, t
    free = (p for p in range(width, size + width) if owner[p] < 0)
    for s, own in enumerate(follow):
        if len(own) == 1:
            ((c, t),) = own.items()
            p = next(free)
            base[s], owner[p], target[p] = p - c, s, t
    return np.array(base, "i4"), np.array(owner, "i4"), np.array(target, "i4")


@dataclass(frozen=True)
class Languages:
    """The automata of all languages in common arrays.

    ``alphabet`` has the known code points in order; a character's class is its place there
    from 1 on, 0 is the space, and one more class stands for all unknown ones. ``start`` gives a language's
    state after a first character; state 0, which no character leaves, is where it is after one that does not occur.
    """

    names: tuple[str, ...]
    alphabet: np.ndarray
    lengths: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    start: np.ndarray

    def classes(self, codes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.alphabet, codes)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == codes
        return np.where(codes == 0, 0, np.where(known, place + 1, len(self.alphabet) + 1)).astype("i4")

    def phrases(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many phrases each text of ``sizes`` characters has in each language (texts x languages)."""
        found = np.zeros((len(sizes), len(self.names)), "i8")
        pieces = -(-sizes // PIECE)
        of = np.repeat(np.arange(len(sizes)), pieces)
        if not len(of):
            return found
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(np.cumsum(sizes) - sizes, pieces) + nth * PIECE
        long = np.minimum(np.repeat(sizes, pieces) - nth * PIECE, PIECE)
        order = np.argsort(-long, kind="stable")
        first, long, of = first[order], long[order], of[order]
        active = np.searchsorted(-long, -np.arange(PIECE), side="left")  # pieces longer than each step
        classes = self.classes(codes)
        state = np.zeros((len(self.names), len(of)), "i4")  # the first character always begins a phrase
        count = np.zeros(state.shape, "i4")
        for step in range(int(long[0])):
            n = active[step]
            own, c = state[:, :n], classes[first[:n] + step]
            place = self.base.take(own)
            place += c
            hit = self.owner.take(place) == own
            state[:, :n] = np.where(hit, self.target.take(place), self.start.take(c, axis=1))
            count[:, :n] += ~hit
        np.add.at(found, of, count.T)
        return found

    def costs(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits a character of each text in each language, the characters, and whether a text has a letter."""
        phrases = np.zeros((len(texts), len(self.names)), "i8")
        sizes, letters = np.zeros(len(texts), "i8"), np.zeros(len(texts), bool)
        group: list[str] = []
        of: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if group:
                codes, own, some = normalised(group)
                at = np.array(of)
                np.add.at(phrases, at, self.phrases(codes, own))
                np.add.at(sizes, at, own)
                np.logical_or.at(letters, at, some)
                group.clear()
                of.clear()
                held = 0

        for k, text in enumerate(texts):
            for low in range(0, len(text or ""), CHUNK):
                part = text[low : low + CHUNK]
                if held + len(part) > CHUNK:
                    flush()
                group.append(part)
                of.append(k)
                held += len(part)
        flush()
        return phrases * np.log2(self.lengths + 1) / np.maximum(sizes, 1)[:, None], sizes, letters

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its score."""
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        bits, sizes, letters = self.costs(texts)
        best = bits.argmin(axis=1)
        apart = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(sizes, ODDS_CHARS)[:, None]
        score = np.where(letters, 1 / np.exp2(-apart).sum(axis=1), 0.0)
        return [self.names[b] if some else UNKNOWN for b, some in zip(best, letters, strict=True)], score


# --------------------------------------------------------------------- learning


def fold(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def sampled(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """lang, mark, text: some labelled texts of each language outside of fold 2, those with the smallest hashes."""
    rows = docs.where("lang is not null and text is not null").where(fold() != 2).select("lang", "text", F.xxhash64("text").alias("mark"))
    marks = materialise(rows.select("lang", "mark").distinct(), "marks")
    most = marks.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).select("lang")
    first = Window.partitionBy("lang").orderBy("mark")  # each task sends sample_texts rows of a language at most
    chosen = marks.join(F.broadcast(most), "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_texts).drop("n")
    chosen = materialise(chosen, "chosen")  # sample_texts x max_languages rows
    return materialise(rows.join(F.broadcast(chosen), ["lang", "mark"]).dropDuplicates(["lang", "mark"]), "sample")


def _automaton(alphabet: np.ndarray, chars: int):
    """A language's automaton from its texts; its length is 0 where they have no letter."""

    def build(texts: pd.DataFrame) -> pd.DataFrame:
        parts, left = [], chars
        for text in texts.sort_values("mark")["text"]:
            codes, _, _ = normalised([text])
            part = codes[: min(left, max(1, chars // SHARE))]
            parts += [np.where(part > 0, np.searchsorted(alphabet, part) + 1, 0), np.zeros(1, "i8")]
            left -= len(part)
            if left <= 0:
                break
        codes = np.concatenate(parts)
        follow = suffix_automaton(codes.tolist())
        base, owner, target = displaced(follow, len(alphabet) + 2)
        start = np.full(len(alphabet) + 2, -1, "i4")
        for c, t in follow[0].items():
            start[c] = t
        return pd.DataFrame({"lang": [texts["lang"].iloc[0]], "length": [len(codes) if codes.any() else 0], **{k: [v.tobytes()] for k, v in (("base", base), ("owner", owner), ("target", target), ("start", start))}})

    return build


def learn(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, max_chars: int = MAX_CHARS, max_languages: int = MAX_LANGUAGES, sample_texts: int = SAMPLE_TEXTS) -> Languages:
    """The automata of the labels in ``docs`` (doc_id, text, lang)."""
    sample = sampled(docs, sample_texts, max_languages)

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _, _ = normalised([t[i : i + CHUNK] for t in batch.column(0).to_pylist() for i in range(0, len(t), CHUNK)])
            yield pa.RecordBatch.from_pydict({"c": pa.array(np.unique(codes[codes > 0]).astype("i4"))})

    alphabet = np.array(sorted(r["c"] for r in sample.select("text").mapInArrow(letters, "c int").distinct().collect()), "i4")  # code points
    if not len(alphabet):
        return Languages((), alphabet, *(np.zeros(0, "i4"),) * 5)
    chars = min(sample_chars, max_chars // max(1, sample.select("lang").distinct().count()))
    kind = "lang string, length long, base binary, owner binary, target binary, start binary"
    found = sorted(sample.groupBy("lang").applyInPandas(_automaton(alphabet, chars), kind).where("length > 0").collect(), key=lambda r: r["lang"])  # max_chars bounds them
    width = len(alphabet) + 2
    base, owner, target, start = [np.full(1, width, "i4")], [np.full(3 * width, -1, "i4")], [np.zeros(3 * width, "i4")], []
    states, places = 1, 3 * width
    for r in found:
        b, o, t, s = (np.frombuffer(r[k], "i4") for k in ("base", "owner", "target", "start"))
        base.append(b + places)
        owner.append(np.where(o < 0, -1, o + states))
        target.append(t + states)
        start.append(np.where(s < 0, 0, s + states))
        states += len(b)
        places += len(o)
    return Languages(tuple(r["lang"] for r in found), alphabet, np.array([r["length"] for r in found], "f8"), *map(np.concatenate, (base, owner, target)), np.array(start, "i4").reshape(len(found), -1))


def identify(docs: DataFrame, languages: Languages) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, score = languages.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)})
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the language of all documents."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = identify(docs, learn(docs))
    return found.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
