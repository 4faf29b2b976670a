"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: densities of a fixed lexicon, of a learned lexicon of words and of one of
word beginnings (for words that are inflected or compounded), hits near second-person
words, rates of capitals, punctuation, exclamation and obfuscated words. The learned
lexicon, the trees and the calibration are fitted on at most ``max_labelled``
labelled rows, those with the smallest hashes of their doc_id; rows whose
crc32(doc_id as text) mod 5 is 0 are never among them. Lexicon and trees are fitted on
the rows with remainders 1 to 3, the calibration on those with remainder 4. Where either
part lacks a label the trees are fitted on both and their own probability is the score,
not calibrated.

Edge cases: a null text counts as empty and is scored like any other; a doc_id with
several labels counts as toxic if one of them says so; null labels and null
doc_ids teach nothing; with fewer than 5 training rows of either class nothing can
be told apart and every score is 0; null and repeated
doc_ids are scored as rows of their own; an empty table gives no rows; further
columns are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import TEXT_HASH, documents, drop_rows, hash_sample, materialise, slices, with_text_hash

MAX_LABELLED = 20_000
#: Rows of a class that a leaf of the trees needs as well.
LEAST_OF_CLASS = 5
#: Letters of a word beginning; only longer words have one.
STEM = 5
#: A hit counts as aimed at somebody within so many words of a second-person word.
NEAR = 6

#: Fixed values.
INSULTS = frozenset(
    """idiot idiots moron morons imbecile stupid dumb dumbass fool loser losers clown clowns scum trash garbage filth vermin
    worthless pathetic disgusting revolting ugly freak creep pig bastard bitch asshole jerk shit crap fuck fucking hate kill
    idiote imbécile crétin crétins connard salaud ordure dégoûtant pathétique minable stupide
    dummkopf trottel arschloch abschaum wertlos erbärmlich widerlich dreckskerl schwachkopf blödmann
    imbécil estúpido estúpida basura asqueroso patético inútil payaso perdedor tonto cabrón""".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros eres".split())
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "+": "t", "_": "", "-": "", ".": ""})

WORD = re.compile(r"[^\W\d_]+")
#: Letters with digits or marks between them.
MASKED = re.compile(r"[^\W\d_]+(?:[0-9@$!*+_.\-]{1,3}[^\W\d_]+)+")

FEATURES = ("insults", "learned", "stems", "hits", "aimed", "capitals", "shouted", "punctuation", "exclamations", "masked", "masked_hits", "length")
ROWS = f"doc_id long, {TEXT_HASH} long, " + ", ".join(f"{f} double" for f in FEATURES)

#: Classes of bytes: 1 capital, 2 small letter or beyond ASCII, 3 digit, 4 mark, 0 space.
_CLASS = np.full(256, 4, "u1")
_CLASS[[*range(0x00, 0x21)]] = 0
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[0x80:] = 1, 2, 3, 2


def features(text: str, learned: dict[str, float], stems: dict[str, float]) -> list[float]:
    words = WORD.findall(text.lower())
    n = max(len(words), 1)
    hits = [k for k, w in enumerate(words) if w in INSULTS or w in learned]
    aimed = sum(any(w in SECOND_PERSON for w in words[max(0, k - NEAR) : k + NEAR + 1]) for k in hits)
    raw = np.frombuffer(text.encode(), "u1")
    kind = _CLASS[raw]
    count = np.bincount(kind, minlength=5)
    letters, size = max(int(count[1] + count[2]), 1), max(len(raw), 1)
    masked = masked_hits = 0
    inner = kind[1:-1]
    if len(raw) > 2 and (((inner == 3) | (inner == 4)) & (kind[:-2] % 3 > 0) & (kind[:-2] < 3)).any():
        found = MASKED.findall(text.lower())
        masked = len(found)
        masked_hits = sum((w := m.translate(LEET)) in INSULTS or w in learned for m in found)
    capital = kind == 1
    shouted = int((capital[:-2] & capital[1:-1] & capital[2:]).sum()) if len(raw) > 2 else 0
    return [
        sum(words[k] in INSULTS for k in hits) / n, sum(learned.get(words[k], 0.0) for k in hits) / n, sum(stems[w[:STEM]] for w in words if w[:STEM] in stems and len(w) > STEM) / n, float(np.log1p(len(hits))), aimed / n,
        count[1] / letters, shouted / letters, count[4] / size, text.count("!") / size, masked / n, float(np.log1p(masked_hits)), float(np.log1p(len(words))),
    ]


def _compute(learned: dict[str, float], stems: dict[str, float]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([features(x or "", learned, stems) for x in batch.column(1).to_pylist()], "f8").reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c) for c in found.T)], ["doc_id", TEXT_HASH, *FEATURES])

    return rows


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic documents, and how many of all, hold each word and each word beginning (marked by a star)."""
    toxic, every = Counter(), Counter()
    for batch in slices(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = set(WORD.findall((text or "").lower()))
            own |= {w[:STEM] + "*" for w in own if len(w) > STEM}
            every.update(own)
            if label:
                toxic.update(own)
    yield pa.RecordBatch.from_pydict({"word": pa.array(list(every), pa.string()), "toxic": pa.array([toxic[w] for w in every], pa.int64()), "n": pa.array(list(every.values()), pa.int64())})


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def training_labels(labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, toxic, fold) of at most ``max_labelled`` labelled rows outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("fold", fold()).where("fold <> 0")
    return hash_sample(known, max_labelled, "doc_id")


def learn_lexicon(docs: DataFrame, training: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words, and beginnings of words, that toxic training rows hold far oftener than the others.

    Each with the logarithm of how much oftener, 8 times for words and 6 for beginnings
    at least; it needs 5 toxic documents and 2 % of them. That share alone bounds the
    lexicon: to 50 times the distinct words of a toxic row on average.
    """
    rows = docs.join(F.broadcast(training.select("doc_id", "toxic")), "doc_id").select("text", "toxic")  # at most max_labelled rows
    counts = materialise(rows.mapInArrow(_count_words, "word string, toxic long, n long"), "words").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    total = training.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    if not total["toxic"] or total["toxic"] == total["n"]:
        return {}, {}
    least = max(5, total["toxic"] * 0.02)
    ratio = ((F.col("toxic") + 0.5) / (total["toxic"] + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (total["n"] - total["toxic"] + 1))
    found = counts.where(F.col("toxic") >= least).withColumn("ratio", ratio).where(F.col("ratio") >= F.when(F.col("word").endswith("*"), 6).otherwise(8))
    found = {r["word"]: float(np.log(r["ratio"])) for r in found.collect()}
    return {w: v for w, v in found.items() if w[-1] != "*"}, {w[:-1]: v for w, v in found.items() if w[-1] == "*"}


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text_hash, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    ``labels`` needs doc_id and toxic.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = materialise(training_labels(labels, max_labelled), "training-labels")
    learned, stems = learn_lexicon(docs, training.where("fold < 4"))
    dense = materialise(with_text_hash(docs).mapInArrow(_compute(learned, stems), ROWS), "features")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(dense)
    rows = vectors.join(F.broadcast(training), "doc_id").select("features", F.col("toxic").cast("double").alias("label"), "fold")
    rows = materialise(rows.coalesce(4), "training-rows")
    seen = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if min(seen.get(0.0, 0), seen.get(1.0, 0)) < LEAST_OF_CLASS:
        scored = vectors.withColumn("score", F.lit(0.0))
    else:
        own, other = rows.where("fold < 4"), rows.where("fold = 4")
        both = all(d.groupBy("label").count().count() == 2 for d in (own, other))
        trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, minInstancesPerNode=LEAST_OF_CLASS, seed=17).fit(own if both else rows)

        def raw(df: DataFrame) -> DataFrame:
            return trees.transform(df).withColumn("raw", vector_to_array("probability")[1])

        if both:
            steps = IsotonicRegression(featuresCol="raw", predictionCol="score").fit(raw(other).select("label", "raw"))
            scored = steps.transform(raw(vectors))
        else:  # no rows that the trees have not seen hold both labels: nothing to calibrate on
            scored = raw(vectors).withColumn("score", F.col("raw"))
    scored = scored.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))
    held_out = F.coalesce(fold() == 0, F.lit(False))
    return scored.select("doc_id", TEXT_HASH, held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns kept."""
    return drop_rows(docs, score(docs, labels, max_labelled).where("predicted = 1"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: toxicity of all documents."""
    return score(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop(TEXT_HASH)
