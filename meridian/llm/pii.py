"""Personal data: expressions propose spans, checksums confirm them, context adjusts their score.

DataFrame functions only. Spark gives the matches of an expression and the text
between them, but no positions; a span starts after all pieces and matches before
it, so positions are running totals of their lengths in code points. Those totals
are taken in blocks, which keeps very long lists of matches linear.

Base kinds (email, ip, card, phone) always stay. The method adds: ``iban`` where
mod-97 holds, and ``ssn``, whose bare shape is too weak and which needs a word
such as "social security" nearby to reach the score for staying.

The expressions are written with possessive quantifiers and start guards, so that
they read any text in linear time; they find the same spans as the plain forms.

Edge cases: a null text counts as empty and has no spans; null and repeated
doc_ids give a row each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import documents

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: A span of an added kind stays from this score on.
STAYS = 0.5
#: Characters before and after a match in which a context word counts.
NEAR = (40, 20)
BLOCK = 128

#: Fixed values. ``\G`` lets a match begin where the one before ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What a text must hold for the expression to be worth trying.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}
CONTEXT = {
    "email": r"\b(?:e-?mail|mail|contact|write)\b", "ip": r"\b(?:ip|address|host|server)\b", "card": r"\b(?:card|visa|credit|payment)\b",
    "phone": r"\b(?:phone|tel|call|mobile|fax)\b", "iban": r"\b(?:iban|account|bank|konto)\b", "ssn": r"\b(?:ssn|social security)\b",
}
#: Score without and with a context word.
SCORE = {"email": (0.8, 0.9), "ip": (0.6, 0.8), "card": (0.8, 0.95), "phone": (0.6, 0.85), "iban": (0.9, 0.99), "ssn": (0.3, 0.8)}


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _within(digits: Column, least: int, most: int) -> Column:
    n = F.length(digits)
    return (n >= least) & (n <= most)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn: every second digit from the right counts double."""
    place = F.reverse(_characters(digits))

    def value(c: Column, k: Column) -> Column:
        d = c.cast("int") * F.when(k % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(place, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether the number that an account code stands for leaves 1 when divided by 97."""
    code = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        number = F.when(c.rlike("[0-9]"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55)
        return number % 97

    return F.aggregate(_characters(turned), F.lit(0), step) == 1


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: x.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"),
    "card": lambda x: F.when(_within(F.regexp_replace(x, "[ -]", ""), 12, 19), luhn(F.regexp_replace(x, "[ -]", ""))).otherwise(False),
    "phone": lambda x: _within(F.regexp_replace(x, "[^0-9]", ""), 9, 15),
    "iban": mod97,
    "ssn": lambda x: ~x.rlike(r"^(?:000|666|9[0-9]{2})-|-00-|-0000$"),
}


def _proposed(kind: str, matches: Column, pieces: Column) -> Column:
    """The matches with their places: array of (start, end, kind, ord, text, near)."""
    both = F.zip_with(
        matches, F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("before"), F.slice(pieces, 2, F.size(matches)).alias("after")),
        lambda m, p: F.struct(m.alias("text"), F.length(p["before"]).alias("skip"), F.concat(F.right(p["before"], F.lit(NEAR[0])), F.lit(" "), F.left(p["after"], F.lit(NEAR[1]))).alias("near")),
    )
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int")), lambda b: F.slice(both, b * BLOCK + 1, BLOCK))

    def span(at: Column, x: Column) -> Column:
        start = at + x["skip"]
        return F.struct(start.alias("start"), (start + F.length(x["text"])).alias("end"), x["text"].alias("text"), x["near"].alias("near"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string,near:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = span(acc["at"], x)
        return F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(s)).alias("out"))

    inner = F.transform(blocks, lambda b: F.aggregate(b, empty, step))
    starts = F.aggregate(inner, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, b: F.struct((a["at"] + b["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"]
    return F.flatten(
        F.zip_with(inner, starts, lambda b, at: F.transform(b["out"], lambda s: F.struct((s["start"] + at).alias("start"), F.lit(KINDS.index(kind)).alias("ord"), (s["end"] + at).alias("end"), F.lit(kind).alias("kind"), s["text"].alias("text"), s["near"].alias("near"))))
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data for every row of ``docs`` (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and scores, the
    score of each of the spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<string>")
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    df = df.select("doc_id", "text", *(F.when(F.col("text").rlike(NEEDS[k]), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"m_{k}") for k in KINDS))
    df = df.select("doc_id", *(f"m_{k}" for k in KINDS), *(F.when(F.size(f"m_{k}") > 0, F.split("text", PATTERNS[k], -1)).alias(f"p_{k}") for k in KINDS))
    span_type = "array<struct<start:int,ord:int,end:int,kind:string,score:double>>"

    def confirmed(k: str) -> Column:
        low, high = SCORE[k]
        found = F.filter(_proposed(k, F.col(f"m_{k}"), F.col(f"p_{k}")), lambda s: CHECKS[k](s["text"]))
        scored = F.transform(found, lambda s: F.struct(s["start"], s["ord"], s["end"], s["kind"], F.when(F.lower(s["near"]).rlike(CONTEXT[k]), high).otherwise(low).alias("score")))
        if k not in BASE:
            scored = F.filter(scored, lambda s: s["score"] >= STAYS)
        return F.when(F.size(f"m_{k}") > 0, scored).otherwise(F.array().cast(span_type)).cast(span_type)

    df = df.select("doc_id", *(confirmed(k).alias(k) for k in KINDS))

    def joined(spans: Column, value: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), value), ",")

    def place(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    base = joined(F.concat(*(F.col(k) for k in BASE)), place)
    every = F.concat(*(F.col(k) for k in KINDS))
    return df.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        joined(every, place).alias("spans"), joined(every, lambda s: s["score"].cast("string")).alias("scores"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: personal data in all documents."""
    return find_pii(documents(spark, sf_dir, "doc_id", "text"))
