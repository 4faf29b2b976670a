"""License scan: a trained paragraph classifier, calibrated, and confirmed against templates.

A text's lines are judged one by one. Lines between blank ones form a block, which is
judged by sentence and by every run of as many words as a template has, so that a
notice is found whatever shares its line and wherever its lines are wrapped.
A multinomial logistic regression over hashed words, word pairs and triples tells the families of
``TEMPLATES`` and an unknown class apart. It is trained on variations of the
templates and on at most ``max_unknown`` lines of the corpus that resemble no
template: one, chosen by hash, of each document of a hash sample. Some templates are
left out at first; a temperature fitted on their variations and on lines left out
likewise calibrates the probabilities, then they are trained on too.
A prediction counts only if the words judged are those of a template of its family.
Where findings of one family overlap, the line counts before the sentences, and these
before runs of words.

Most lines and sentences are dismissed by a bound: no family can beat the unknown
class when the sum, over the features, of the best family's lead does not.

Edge cases: null and blank texts have no paragraphs; null and repeated doc_ids give
rows of their own; an empty table gives no rows, and the classifier then knows only
the built-in unknown sentences; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents, hash_sample
from meridian.llm.shingles import ALPHANUMERIC, mix, words

MAX_UNKNOWN = 4_000
BITS = 16
UNKNOWN = "unknown"
#: A finding needs this calibrated probability and this share of its word pairs in a template of the family.
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
#: Runs of words have no ends of their own, so more of their word pairs must be the template's.
RUN_SIMILARITY = 0.75
SCALE = 8.0

#: The usual short notices and key sentences of each family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Released under the Apache License 2.0.", "This project is licensed under the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "bsd": (
        "Licensed under the BSD License.", "Released under the 3-Clause BSD License.", "This software is released under the two clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License version 2 or later.", "Released under the GPL.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.", "Released under the LGPL.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.", "This program is licensed under the terms of the GNU Affero General Public License as published by the Free Software Foundation.", "Released under the AGPL.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "Released under the MPL.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Available under the Creative Commons Attribution license.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc0": (
        "Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "This work is dedicated to the public domain under CC0.",
    ),
    "proprietary": (
        "All rights reserved.", "Copyright 2020 Example Corporation. All rights reserved.", "This document is confidential and proprietary; unauthorized copying is strictly prohibited.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}
#: Sentences that share words with licences and are none.
OTHERS = (
    "He lost his driving license last year.", "The general public was invited to the free concert.", "She studied at MIT and works on software.", "The apache tribes lived in the south west.",
    "Copyright law is taught in the second term.", "All rights belong to the people, he said.", "The version of events under discussion is disputed.", "Permission to enter was granted to any person with a ticket.",
    "The work is done and the program is over.", "Commons and lords debated the bill.", "The document was reserved for the library.", "Terms and conditions of the sale apply to the public.",
)
FAMILIES = (*TEMPLATES, UNKNOWN)

_CUT = re.compile(r"(?<=[.!?])\s+")
ROWS = "doc_id long, paragraph int, start int, end int, family string, probability double, similarity double"


def paragraphs(text: str) -> list[tuple[int, int]]:
    """(start, end) of each line that is not blank."""
    found, at = [], 0
    for line in text.split("\n"):
        if line and not line.isspace():
            found.append((at, at + len(line)))
        at += len(line) + 1
    return found


def blocks(lines: list[tuple[int, int]], text: str) -> list[tuple[int, int, int]]:
    """(number of its first line, start, end) of each stretch of lines without a blank one between."""
    found: list[tuple[int, int, int]] = []
    for k, (a, b) in enumerate(lines):
        if found and text.count("\n", found[-1][2], a) == 1:
            found[-1] = (*found[-1][:2], b)
        else:
            found.append((k, a, b))
    return found


def sentences(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a block, none if it is only one."""
    cuts = list(_CUT.finditer(text, start, end))
    lows, highs = [start, *(m.end() for m in cuts)], [*(m.start() for m in cuts), end]
    return [(a, b) for a, b in zip(lows, highs, strict=True) if b > a] if cuts else []


def numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of many paragraphs, and the paragraph of each."""
    hashes, counts = words([t.encode() for t in texts], ALPHANUMERIC)
    of = np.repeat(np.arange(len(texts)), counts)
    found, rows = [hashes], [of]
    for n, seed in ((2, 6), (3, 7)):
        if len(hashes) >= n:
            inside = of[n - 1 :] == of[: len(of) - n + 1]
            gram = hashes[: len(hashes) - n + 1].copy()
            for j in range(1, n):
                gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[j : len(hashes) - n + 1 + j]
            found.append(mix(gram, seed)[inside])
            rows.append(of[n - 1 :][inside])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype("i8"), np.concatenate(rows)


_WORD = re.compile(r"[^\W_]+")


def _words(text: str) -> list[str]:
    return ["#" if w.isdigit() else w for w in _WORD.findall(text.lower())]


def _pairs(text: str) -> set[tuple[str, ...]]:
    w = ["", *_words(text), ""]
    return set(zip(w, w[1:], strict=False))


def similarity(text: str, family: str) -> float:
    """The largest share of the paragraph's word pairs that one template of the family has."""
    own = _pairs(text)
    return max((len(own & t) / len(own) for t in _TEMPLATE_PAIRS.get(family, ())), default=0.0)


_TEMPLATE_PAIRS = {family: [_pairs(t) for t in texts] for family, texts in TEMPLATES.items()}
#: Word pair -> the templates that have it, and each template's number of words.
_LENGTHS = [len(_words(t)) for texts in TEMPLATES.values() for t in texts]
_TEMPLATES_OF: dict[tuple[str, str], list[int]] = {}
for _k, _own in enumerate(p for pairs in _TEMPLATE_PAIRS.values() for p in pairs):
    for _pair in _own:
        _TEMPLATES_OF.setdefault(_pair, []).append(_k)


def _keys(template: set[tuple[str, str]]) -> list[str]:
    """Long words of a template, so many that no run without any of them has ``RUN_SIMILARITY`` of its pairs."""
    found: list[str] = []
    for w in sorted({x for pair in template for x in pair if x not in ("", "#")}, key=lambda x: (-len(x), x)):
        if sum(not set(pair) & set(found) for pair in template) < RUN_SIMILARITY * len(template):
            break
        found.append(w)
    return found


_PAIRS_OF = [pairs for family in _TEMPLATE_PAIRS.values() for pairs in family]
#: Key word -> the templates that it may show.
_KEYS: dict[str, set[int]] = {}
for _k, _own in enumerate(_PAIRS_OF):
    for _key in _keys(_own):
        _KEYS.setdefault(_key, set()).add(_k)


def runs(text: str, start: int, end: int, keys: list[str]) -> list[tuple[int, int]]:
    """(start, end) of the runs of a template's number of words that have ``RUN_SIMILARITY`` of its pairs, the best first.

    ``keys`` are the key words that the text has.
    """
    line = text[start:end].lower()
    wanted = set().union(*(_KEYS[w] for w in keys if w in line))
    if not wanted:
        return []
    spans = [m.span() for m in _WORD.finditer(text, start, end)]
    own = ["#" if w.isdigit() else w for w in (text[a:b].lower() for a, b in spans)]
    places: dict[int, list[int]] = {}
    for i, pair in enumerate(zip(own, own[1:], strict=False)):
        for k in _TEMPLATES_OF.get(pair, ()):
            if k in wanted:
                places.setdefault(k, []).append(i)
    found = {}
    for k, at in places.items():
        m, template = _LENGTHS[k], _PAIRS_OF[k]
        least = max(RUN_SIMILARITY * len(template) - 2, 1)  # the two ends may be the template's as well
        if len(at) < least:
            continue
        hit = np.zeros(len(own) + 1, "i8")
        hit[np.array(at) + 1] = 1
        total = np.cumsum(hit)
        low = np.arange(max(len(own) - m + 1, 0))
        for i in low[total[low + m - 1] - total[low] >= least].tolist():
            pairs = set(zip(["", *own[i : i + m]], [*own[i : i + m], ""], strict=True))
            share = len(pairs & template) / max(len(pairs), len(template))
            if share >= RUN_SIMILARITY:
                span = (spans[i][0], spans[i + m - 1][1])
                found[span] = max(found.get(span, (0, 0)), (share, m))
    return sorted(found, key=lambda x: (-found[x][0], -found[x][1], x))


@dataclass(frozen=True)
class LicenseModel:
    weights: np.ndarray  # feature x family, the unknown class last
    bias: np.ndarray
    temperature: float

    def logits(self, feature: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        size = np.maximum(np.bincount(row, minlength=n), 1)
        out = np.stack([np.bincount(row, self.weights[feature, k], minlength=n) for k in range(len(self.bias))], axis=1)
        return out * (SCALE / np.sqrt(size))[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def lead(self) -> np.ndarray:
        """Per feature, how far the best family is ahead of the unknown class."""
        return (self.weights[:, :-1] - self.weights[:, -1:]).max(axis=1)


def variations(seed: int, per_template: int = 30) -> tuple[list[str], list[int], list[bool]]:
    """Templates with words dropped, numbers changed and neighbours joined; their families; whether of a template left out at first.

    Every fourth template of a family is left out, one at least.
    """
    rng = np.random.default_rng(seed)
    texts, kinds, late = [], [], []
    for k, family in enumerate(TEMPLATES):
        own = TEMPLATES[family]
        left_out = [m % 4 == 1 for m in range(len(own))]
        for m, t in enumerate(own):
            others = [x for x, out in zip(own, left_out, strict=True) if out == left_out[m]]
            for j in range(per_template):
                w = t.split()
                if j:
                    drop = rng.random(len(w)) < rng.choice([0.0, 0.05, 0.15])
                    w = [re.sub(r"\d+", lambda m: str(rng.integers(1, 2030)), x) if rng.random() < 0.3 else x for x, d in zip(w, drop, strict=True) if not d] or w
                joined = " ".join(w)
                if j % 5 == 4:
                    joined += " " + others[rng.integers(len(others))]
                texts.append(joined)
                kinds.append(k)
                late.append(left_out[m])
    return texts, kinds, late


def train(unknown: list[str], steps: int = 100, seed: int = 5) -> LicenseModel:
    """Full-batch gradient descent with momentum on the variations and the unknown paragraphs.

    The temperature is fitted when only the templates not left out are known; as many
    steps over all of them follow.
    """
    texts, kinds, late = variations(seed)
    others = [*OTHERS * 10, *unknown]
    rng = np.random.default_rng(seed)
    held = np.concatenate([np.array(late, bool), rng.random(len(others)) < 0.2])
    texts, kinds = [*texts, *others], np.array([*kinds, *[len(TEMPLATES)] * len(others)])
    feature, row = numbers(texts)
    used, feature = np.unique(feature, return_inverse=True)
    n, k = len(texts), len(FAMILIES)
    size = np.maximum(np.bincount(row, minlength=n), 1)
    value = (SCALE / np.sqrt(size))[row]
    target = np.eye(k)[kinds]
    w, b = np.zeros((len(used), k)), np.zeros(k)

    def descend(w: np.ndarray, b: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = (1.0 / np.bincount(kinds[rows], minlength=k).clip(1))[kinds] * rows  # each class weighs the same in sum
        weight /= weight.sum()
        vw, vb = 0.0, 0.0
        for _ in range(steps):
            model = LicenseModel(w, b, 1.0)
            error = (model.probabilities(model.logits(feature, row, n)) - target) * weight[:, None]
            slope = np.stack([np.bincount(feature, error[row, j] * value, minlength=len(used)) for j in range(k)], axis=1) + 1e-5 * w
            vw, vb = 0.9 * vw - 0.5 * slope, 0.9 * vb - 0.5 * error.sum(axis=0)
            w, b = w + vw, b + vb
        return w, b

    w, b = descend(w, b, ~held)
    z, own = LicenseModel(w, b, 1.0).logits(feature, row, n)[held], kinds[held]
    share = (1.0 / np.bincount(own, minlength=k).clip(1))[own]

    def loss(t: float) -> float:
        p = LicenseModel(w, b, t).probabilities(z)
        return float(-(share * np.log(p[np.arange(len(own)), own].clip(1e-12))).sum())

    temperature = min(np.geomspace(0.2, 5, 25), key=loss)
    w, b = descend(w, b, np.ones(n, bool))
    weights = np.zeros((1 << BITS, k), "f4")
    weights[used] = w
    return LicenseModel(weights, b, temperature)


def unknown_sample(docs: DataFrame, bound: int = MAX_UNKNOWN) -> list[str]:
    """At most ``bound`` whole lines, one of each document of a hash sample, that resemble no template."""
    some = hash_sample(docs.where("text is not null").select("doc_id", F.col("text").cast("string")), bound, "doc_id", "text")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    line = F.get("lines", F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.size("lines")).cast("int"))
    rows = some.withColumn("lines", lines).where(F.size("lines") > 0).select(line.alias("line")).collect()  # at most bound lines
    return [r["line"] for r in rows if max(similarity(r["line"], f) for f in TEMPLATES) < 0.3]


def find_licenses(docs: DataFrame, model: LicenseModel | None = None) -> DataFrame:
    """One row for each licence notice in ``docs`` (doc_id, text).

    Returns doc_id, paragraph (the number, among lines not blank, of its line, or of the first line of its block), start, end (code
    points), family, probability, similarity.
    """
    model = model or train(unknown_sample(docs))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = model.lead()
        ahead = float((model.bias[:-1] - model.bias[-1]).max())
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            rows = []
            for low in range(0, len(texts), 200):
                lines = [(d, k, a, b) for d in range(low, min(low + 200, len(texts))) for k, (a, b) in enumerate(paragraphs(texts[d]))]
                own_lines: dict[int, list[tuple[int, int]]] = {}
                for d, _, a, b in lines:
                    own_lines.setdefault(d, []).append((a, b))
                whole, block_of = [], {}
                for d, own in own_lines.items():
                    found = blocks(own, texts[d])
                    whole += [(d, *x) for x in found]
                    firsts = [x[0] for x in found]
                    for first, after in zip(firsts, [*firsts[1:], len(own)], strict=True):
                        block_of |= {(d, k): first for k in range(first, after)}
                known = {(d, a, b) for d, _, a, b in lines}
                cut = [(d, k, a, b) for d, k, *block in whole for a, b in sentences(texts[d], *block) if (d, a, b) not in known]
                keys = {d: [w for w in _KEYS if w in small] for d in {x[0] for x in lines} for small in (texts[d].lower(),)}
                rest = [(d, k, a, b) for d, k, *block in whole if keys[d] for a, b in runs(texts[d], *block, keys[d])]
                where = [*lines, *cut, *rest]
                least = np.repeat([LEAST_SIMILARITY, LEAST_SIMILARITY, RUN_SIMILARITY], [len(lines), len(cut), len(rest)])
                own = [texts[d][a:b] for d, _, a, b in where]
                feature, row = numbers(own)
                n = len(own)
                size = np.maximum(np.bincount(row, minlength=n), 1)
                bound = np.bincount(row, lead[feature], minlength=n) * SCALE / np.sqrt(size) + ahead
                maybe = np.flatnonzero(bound > 0)
                if not len(maybe):
                    continue
                inside = np.isin(row, maybe)
                p = model.probabilities(model.logits(feature[inside], np.searchsorted(maybe, row[inside]), len(maybe)))
                taken: dict[tuple[int, int, str], list[tuple[int, int]]] = {}
                for m, q in zip(maybe.tolist(), p, strict=True):
                    family = FAMILIES[int(q.argmax())]
                    if family != UNKNOWN and q.max() >= LEAST_PROBABILITY and (s := similarity(own[m], family)) >= least[m]:
                        d, k, a, b = where[m]
                        others = taken.setdefault((d, block_of[d, k], family), [])
                        if all(b <= x or y <= a for x, y in others):
                            others.append((a, b))
                            rows.append((ids[d], k, a, b, family, float(q.max()), s))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], [c.split()[0] for c in ROWS.split(", ")])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(scan, ROWS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: licence notices in all documents."""
    return find_licenses(documents(spark, sf_dir, "doc_id", "text"))
