"""Calendar-aware times as columns.

A time is a struct (y, mo, d, h, mi, s) beside the name of its calendar, because
30 February is a day in some of them and no Spark date. ``ordinal`` turns it into
seconds that can be compared and subtracted within one calendar. The standard
calendar is taken as proleptic Gregorian.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
EQUAL_MONTHS = ("360_day",)
NO_LEAP = ("noleap", "365_day")
ALL_LEAP = ("all_leap", "366_day")
MONTH_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)

_TIME = r"^\s*(-?\d{1,4})-(\d{1,2})-(\d{1,2})(?:[ T](\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.\d+)?)?)?\s*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_leap(year: Column, calendar: Column) -> Column:
    gregorian = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(calendar.isin(*ALL_LEAP), True).when(calendar.isin(*NO_LEAP, *EQUAL_MONTHS), False).when(calendar == "julian", year % 4 == 0).otherwise(gregorian)


def month_length(year: Column, month: Column, calendar: Column) -> Column:
    days = F.element_at(F.array(*map(F.lit, MONTH_DAYS)), month)
    return F.when(calendar.isin(*EQUAL_MONTHS), 30).when((month == 2) & is_leap(year, calendar), 29).otherwise(days)


def _time(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    return F.struct(*(c.cast("int").alias(n) for c, n in zip((y, mo, d, h, mi, s), ("y", "mo", "d", "h", "mi", "s"), strict=True)))


def parse_time(text: Column, calendar: Column) -> Column:
    """``YYYY-MM-DD[ hh:mm[:ss[.f]]]`` as a time; null where it is no time of the calendar."""
    calendar = F.coalesce(calendar, F.lit("standard"))
    parts = F.transform(F.split(F.regexp_replace(text, _TIME, "$1,$2,$3,$4,$5,$6"), ","), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))

    def checked(v: Column) -> Column:
        y, mo, d, h, mi, s = (F.get(v, k) for k in range(6))
        valid = (F.size(v) == 6) & mo.between(1, 12) & h.between(0, 23) & mi.between(0, 59) & s.between(0, 59)
        valid &= d.between(1, F.when(mo.between(1, 12), month_length(y, mo, calendar)).otherwise(0))
        return F.when(valid, _time(y, mo, d, h, mi, s))

    return F.when(text.rlike(_TIME), let(parts, checked))


def _days_before_month(year: Column, month: Column, calendar: Column) -> Column:
    before = [sum(MONTH_DAYS[:k]) for k in range(12)]
    days = F.element_at(F.array(*map(F.lit, before)), month)
    return days + F.when((month > 2) & is_leap(year, calendar), 1).otherwise(0)


def _days_before_year(year: Column, calendar: Column) -> Column:
    y = year.cast("long") - 1
    gregorian = y * 365 + F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400)
    return (
        F.when(calendar.isin(*EQUAL_MONTHS), y * 360).when(calendar.isin(*NO_LEAP), y * 365).when(calendar.isin(*ALL_LEAP), y * 366)
        .when(calendar == "julian", y * 365 + F.floor(y / 4)).otherwise(gregorian)
    )


def day_number(time: Column, calendar: Column) -> Column:
    """Days since 1 January of year 1 in the calendar."""
    calendar = F.coalesce(calendar, F.lit("standard"))

    def number(t: Column) -> Column:
        inner = F.when(calendar.isin(*EQUAL_MONTHS), (t["mo"] - 1) * 30).otherwise(_days_before_month(t["y"], t["mo"], calendar))
        return (_days_before_year(t["y"], calendar) + inner + t["d"] - 1).cast("long")

    return let(time, number)


def ordinal(time: Column, calendar: Column) -> Column:
    """Seconds since the start of year 1 in the calendar."""
    return let(time, lambda t: day_number(t, calendar) * 86400 + t["h"] * 3600 + t["mi"] * 60 + t["s"])


#: Days from 1 March of year 0 to 1 January of year 1, and from there to 1 January 1970.
MARCH, EPOCH = 306, 719_162


def _date(day: Column, calendar: Column) -> Column:
    """The struct (y, mo, d) of a day number.

    The standard calendar is Spark's own. In the others years are taken to begin in
    March, so that a leap day ends its year and months follow one rule.
    """
    z = day + MARCH
    of_cycle = F.pmod(z, F.lit(1461))
    in_cycle = F.floor((of_cycle - F.floor(of_cycle / 1460)) / 365)
    length = F.when(calendar.isin(*ALL_LEAP), 366).otherwise(365)
    year = F.when(calendar == "julian", F.floor(z / 1461) * 4 + in_cycle).otherwise(F.floor(z / length))
    of_year = F.when(calendar == "julian", of_cycle - in_cycle * 365).otherwise(F.pmod(z, length))

    def dated(x: Column) -> Column:
        return let(F.floor((x["day"] * 5 + 2) / 153), lambda m: F.struct((x["year"] + (m >= 10).cast("int")).alias("y"), F.when(m < 10, m + 3).otherwise(m - 9).alias("mo"), (x["day"] - F.floor((m * 153 + 2) / 5) + 1).alias("d")))

    def fields(y: Column, mo: Column, d: Column) -> Column:
        return F.struct(*(c.cast("long").alias(n) for c, n in ((y, "y"), (mo, "mo"), (d, "d"))))

    equal = fields(F.floor(day / 360) + 1, F.floor(F.pmod(day, F.lit(360)) / 30) + 1, F.pmod(day, F.lit(30)) + 1)
    real = let(F.date_from_unix_date((day - EPOCH).try_cast("int")), lambda t: fields(F.year(t), F.month(t), F.day(t)))
    other = let(F.struct(year.alias("year"), of_year.alias("day")), dated)
    return (
        F.when(calendar.isin(*EQUAL_MONTHS), equal).when(calendar.isin(*NO_LEAP, *ALL_LEAP, "julian"), let(other, lambda x: fields(x["y"], x["mo"], x["d"]))).otherwise(real)
    )


def from_ordinal(seconds: Column, calendar: Column) -> Column:
    """The time that ``ordinal`` gives ``seconds`` for; null for null."""
    calendar = F.coalesce(calendar, F.lit("standard"))

    def dated(s: Column) -> Column:
        rest = F.pmod(s, F.lit(86400))
        whole = let(F.floor(s / 86400).cast("long"), lambda day: _date(day, calendar))
        return F.when(s.isNotNull(), let(whole, lambda t: _time(t["y"], t["mo"], t["d"], F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))))

    return let(seconds, dated)


def _decoded(values: Sequence[Column], units: Column, calendar: Column) -> Column:
    """Numbers with ``<unit> since <time>`` units as an array of times; what the units say is worked out once for all."""
    unit = F.lower(F.regexp_extract(units, r"^\s*(\w+?)s?\s+since", 1))
    seconds = F.when(unit == "day", 86400).when(unit.isin("hour", "hr"), 3600).when(unit.isin("minute", "min"), 60).when(unit.isin("second", "sec"), 1)
    base = parse_time(F.regexp_extract(units, r"since\s+([0-9-]+(?:[ T][0-9:.]+)?)", 1), calendar)
    at = F.struct(ordinal(base, calendar).alias("base"), seconds.alias("unit"))
    return let(at, lambda x: F.array(*(from_ordinal(x["base"] + F.round(v * x["unit"]).cast("long"), calendar) for v in values)))


def decode_time(value: Column, units: Column, calendar: Column) -> Column:
    """A number with ``<unit> since <time>`` units as a time of the calendar."""
    return F.get(_decoded([value], units, calendar), F.lit(0))


def decode_pair(first: Column, last: Column, units: Column, calendar: Column) -> Column:
    """Two such numbers as an array of two times."""
    return _decoded([first, last], units, calendar)


def _text(time: Column, form: str) -> Column:
    return let(time, lambda t: F.when(t.isNotNull(), F.format_string(form, *(t[k] for k in ("y", "mo", "d", "h", "mi", "s")))))


def time_text(time: Column) -> Column:
    return _text(time, "%04d-%02d-%02d %02d:%02d:%02d")


def compact_text(time: Column) -> Column:
    """ISO basic form, as analysis windows are written."""
    return _text(time, "%04d%02d%02dT%02d%02d%02d")


def iso_basic(text: Column) -> Column:
    """An ISO time without its separators."""
    return F.translate(text, "-:", "")


def shift_months(time: Column, months: Column | int, calendar: Column) -> Column:
    """A time moved by whole months, its day held within the month it lands in; null for null."""
    calendar = F.coalesce(calendar, F.lit("standard"))

    def moved(t: Column) -> Column:
        total = t["y"] * 12 + t["mo"] - 1 + months
        year, month = F.floor(total / 12).cast("int"), (F.pmod(total, F.lit(12)) + 1).cast("int")
        return F.when(t.isNotNull(), _time(year, month, F.least(t["d"], month_length(year, month, calendar)), t["h"], t["mi"], t["s"]))

    return let(time, moved)


def at_or_before(time: Column, **fields: int) -> Column:
    """Whether a time is not later than a partial one; only the fields given are compared, in order."""
    return _compare(time, fields, lambda a, b: a <= b)


def at_or_after(time: Column, **fields: int) -> Column:
    return _compare(time, fields, lambda a, b: a >= b)


def _compare(time: Column, fields: dict[str, int], holds) -> Column:
    names = {"year": "y", "month": "mo", "day": "d", "hour": "h", "minute": "mi", "second": "s"}
    unknown = [k for k in fields if k not in names]
    if unknown:
        raise TypeError(f"not a field of a time: {unknown}")
    keys = [k for k in names if k in fields]
    return holds(F.struct(*(time[names[k]].alias(k) for k in keys)), F.struct(*(F.lit(fields[k]).alias(k) for k in keys)))


def parse_date_range(text: Column) -> Column:
    """``start-end`` of a file name as a struct of two texts; both ends need the same length.

    Years, months, days and minutes are known; hours and minutes are dropped, and a
    bare month ends on its 30th. An odd number of digits begins with a year of five.
    """
    halves = F.split(text, "-")
    low, high = F.get(halves, 0), F.get(halves, 1)

    def text_of(x: Column, end: bool) -> Column:
        width = F.length(x) % 2 + 4
        rest = F.length(x) - width
        y, mo, d = x.substr(F.lit(1), width), x.substr(width + 1, F.lit(2)), x.substr(width + 3, F.lit(2))
        return (
            F.when(rest == 0, F.concat(y, F.lit("-12-30" if end else "-01-01"))).when(rest == 2, F.concat_ws("-", y, mo, F.lit("30" if end else "01")))
            .when(rest.isin(4, 8), F.concat_ws("-", y, mo, d))
        )

    good = (F.size(halves) == 2) & (F.length(low) == F.length(high)) & low.rlike(r"^\d+$") & high.rlike(r"^\d+$") & F.length(low).isin(4, 5, 6, 7, 8, 9, 12, 13)
    return F.struct(F.when(good, text_of(low, False)).alias("start_time"), F.when(good, text_of(high, True)).alias("end_time"))


def month_range_text(start: Column, end: Column, frequency: Column) -> Column:
    """``YYYYMM-YYYYMM`` for a file name; null for fixed fields."""
    text = F.format_string("%04d%02d-%04d%02d", start["y"], start["mo"], end["y"], end["mo"])
    return F.when((frequency != "fx") & start.isNotNull() & end.isNotNull(), text)
