"""Exact percentiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.sources.shared import written

#: Groups of so many values are aggregated whole, some 10 MB for each percentile.
WHOLE = 200_000
#: Of a larger group so many values at most are gathered.
ACCURACY = 10_000
#: Parts that a bracket too wide is divided into; the ones around the percentile stay.
PARTS = 64
#: Bounds of so many groups go to every task; those of more are joined by key.
BROADCAST_GROUPS = 100_000


def exact_percentiles(df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[Column, float]], whole: int = WHOLE, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group with the interpolated percentile of each of ``wanted`` (name -> value, share).

    Groups of at most ``whole`` values are pre-aggregated whole. Where there are larger
    ones, brackets around each percentile are narrowed, by sketches and exact counts,
    until at most ``accuracy`` values lie strictly inside; these alone are gathered, each
    distinct one with its count. So no task holds a group's values, and no rows are
    shuffled by key: only sums, sketches and what lies in the brackets. The input is read
    when this is called and must give the same rows each time. Nulls are left out;
    without any value the percentile is null.
    """
    keys, names = list(keys), list(wanted)
    shares = [p for _, p in wanted.values()]
    rows = df.select(*keys, *(c.cast("double").alias(f"__x{i}") for i, (c, _) in enumerate(wanted.values())))
    stats = range(len(names))
    sizes = written(rows.groupBy(*keys).agg(*(F.count(f"__x{i}").alias(f"__n{i}") for i in stats)), "group-sizes")
    largest = sizes.agg(F.max(F.greatest(*(F.col(f"__n{i}") for i in stats), F.lit(0)))).first()[0] or 0
    if largest <= whole:
        return rows.groupBy(*keys).agg(*(F.percentile(f"__x{i}", F.lit(p)).alias(n) for i, (n, p) in enumerate(zip(names, shares, strict=True))))
    none = F.lit(None).cast("double")
    brackets = sizes.select(*(F.col(k).alias(f"__{k}") for k in keys), *(F.struct(none.alias("low"), none.alias("high"), F.lit(0).cast("long").alias("until"), F.col(f"__n{i}").alias("n"), F.col(f"__n{i}").alias("inside")).alias(f"__b{i}") for i in stats))
    while largest > accuracy:
        brackets = written(_narrower(_joined(rows, keys, brackets), keys, shares, accuracy), "brackets")
        following = brackets.agg(F.max(F.greatest(*(F.col(f"__b{i}.inside") for i in stats), F.lit(0)))).first()[0]
        if following >= largest:
            raise ValueError("percentiles: the input does not give the same rows each time")
        largest = following
    both = _joined(rows, keys, brackets)
    points = F.array(*(F.struct(F.lit(i).alias("stat"), F.col(f"__x{i}").alias("x"), F.col(f"__b{i}").alias("b")) for i in stats))
    points = both.select(*keys, F.explode(points).alias("p")).select(*keys, "p.stat", "p.x", "p.b").where("x is not null and (b.high is null or x <= b.high)")
    counted = points.groupBy(*keys, "stat", F.when(F.col("b.low").isNull() | (F.col("x") >= F.col("b.low")), F.col("x")).alias("x")).agg(F.count("*").alias("c"))
    found = counted.groupBy(*keys, "stat").agg(
        F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("c"))), F.lit(0)).alias("below"), F.sort_array(F.collect_list(F.when(F.col("x").isNotNull(), F.struct("x", "c")))).alias("inside"),
    )
    wide = found.groupBy(*keys).agg(*(F.max(F.when(F.col("stat") == i, F.struct("below", "inside"))).alias(f"__s{i}") for i in stats))
    wide = wide.select(*(F.col(k).alias(f"__{k}") for k in keys), *(f"__s{i}" for i in stats))
    joined = sizes.join(wide, _same(keys), "left")
    return joined.select(*keys, *(_at(F.col(f"__s{i}"), F.col(f"__n{i}"), p).alias(n) for i, (n, p) in enumerate(zip(names, shares, strict=True))))


def _same(keys: Sequence[str]) -> Column:
    found = F.lit(True)
    for k in keys:
        found &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return found


def _joined(rows: DataFrame, keys: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Rows with the brackets of their group; rows stay where they are unless the groups are many, and so small on average."""
    few = not keys or brackets.count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(brackets) if few else brackets, _same(keys))


def _narrower(both: DataFrame, keys: Sequence[str], shares: Sequence[float], accuracy: int) -> DataFrame:
    """Brackets (low, high, rows up to low, all rows, rows strictly inside) that are narrower by some ``PARTS``.

    A sketch of the values strictly inside gives the borders of ``PARTS`` parts. The new
    bracket is those three parts on each side of the percentile's rank; a second pass counts
    it. Brackets that hold at most ``accuracy`` values stay.
    """
    inner = {}
    for i in range(len(shares)):
        b, x = F.col(f"__b{i}"), F.col(f"__x{i}")
        inner[i] = F.when((b["low"].isNull() | (x > b["low"])) & (b["high"].isNull() | (x < b["high"])), x)
    grid = F.array(*(F.lit(k / PARTS) for k in range(PARTS + 1)))
    sketched = both.groupBy(*keys).agg(*(F.percentile_approx(v, grid, F.lit(100 * PARTS)).alias(f"__g{i}") for i, v in inner.items()), *(F.first(f"__b{i}").alias(f"__b{i}") for i in inner))
    fresh = []
    for i, p in enumerate(shares):
        b = F.col(f"__b{i}")
        place = F.floor(((b["n"] - 1) * F.lit(p) - b["until"]) / F.greatest(b["inside"], F.lit(1)) * PARTS).cast("int")
        grid_at = lambda k: F.get(f"__g{i}", F.greatest(F.lit(0), F.least(k, F.lit(PARTS))))  # noqa: B023, E731
        low = F.when(place > PARTS + 3, b["high"]).when(place >= 3, grid_at(F.least(place, F.lit(PARTS)) - 3))
        high = F.when(place < -4, b["low"]).when(place <= PARTS - 4, grid_at(F.greatest(place, F.lit(-1)) + 4))
        wide = b["inside"] > accuracy
        low, high = F.coalesce(F.when(wide, low), b["low"]), F.coalesce(F.when(wide, high), b["high"])
        fresh.append(F.struct(low.alias("low"), high.alias("high"), b["n"].alias("n")).alias(f"__b{i}"))
    bounds = written(sketched.select(*(F.col(k).alias(f"__{k}") for k in keys), *fresh), "bounds")
    rows = both.drop(*(f"__b{i}" for i in inner), *(f"__{k}" for k in keys))
    again = _joined(rows, keys, bounds)
    counts = []
    for i in inner:
        b, x = F.col(f"__b{i}"), F.col(f"__x{i}")
        above = b["low"].isNull() | (x > b["low"])
        counts += [F.count(F.when(~above, 1)).alias(f"__u{i}"), F.count(F.when(above & (b["high"].isNull() | (x < b["high"])) & x.isNotNull(), 1)).alias(f"__i{i}"), F.first(f"__b{i}").alias(f"__b{i}")]
    counted = again.groupBy(*keys).agg(*counts)
    return counted.select(*(F.col(k).alias(f"__{k}") for k in keys), *(F.struct(F.col(f"__b{i}.low"), F.col(f"__b{i}.high"), F.col(f"__u{i}").alias("until"), F.col(f"__b{i}.n"), F.col(f"__i{i}").alias("inside")).alias(f"__b{i}") for i in inner))


def _at(found: Column, n: Column, share: float) -> Column:
    """The value at a share of ``n`` ranks, between two of them in proportion."""
    position = (n - 1) * F.lit(share)
    low, high = F.floor(position), F.ceil(position)

    def value(rank: Column) -> Column:
        start = F.struct(found["below"].alias("seen"), F.lit(None).cast("double").alias("v"))
        step = lambda a, e: F.struct((a["seen"] + e["c"]).alias("seen"), F.when(a["v"].isNull() & (a["seen"] + e["c"] > rank), e["x"]).otherwise(a["v"]).alias("v"))
        return F.aggregate(found["inside"], start, step, lambda a: a["v"])

    return F.when(low == high, value(low)).otherwise((high - position) * value(low) + (position - low) * value(high))
