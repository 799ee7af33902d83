"""Dates and times in free text, as one cascade of column expressions.

Each date pattern is tried in a fixed order and the first that yields a real
calendar date wins. Offsets are in minutes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventweave.functions.terms import plain_dashes

# fixed values: English month names in calendar order
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

# fixed values: what may stand between the parts of a date, and the words of an open end
DAY, MONTH, YEAR = r"(\d\d?)", r"(\w{3,9})", r"(\d{2,4})"
TO, ONGOING = r"\s*(?:-|until|to)\s*", r"([Pp]resent|[Oo]ngoing)"
AFTER_MONTH, BEFORE_YEAR = r"\s*(?:/|\s)\s*", r"\s*[/,]\s*"


def _grammar() -> list[tuple[str, str]]:
    """(pattern, parts in order of its groups), in the order they are tried.

    Parts: d, m, y of the first day, D, M, Y of the second, o for an open end. Month
    first takes a slash or space before the day and needs a comma or slash before
    the year; day first takes spaces alone.
    """
    md, dm = MONTH + AFTER_MONTH + DAY, DAY + r"\s+" + MONTH
    mdy, dmy = md + BEFORE_YEAR + YEAR, dm + r"\s+" + YEAR
    return [
        (mdy + TO + mdy, "mdyMDY"),
        (dmy + TO + dmy, "dmyDMY"),
        (md + TO + MONTH + r"\s*" + DAY + BEFORE_YEAR + YEAR, "mdMDy"),
        (dm + TO + dmy, "dmDMy"),
        (md + TO + DAY + BEFORE_YEAR + YEAR, "mdDy"),
        (DAY + TO + dmy, "dDmy"),
        (mdy + TO + ONGOING, "mdyo"),
        (dmy + TO + ONGOING, "dmyo"),
        (mdy, "mdy"),
        (dmy, "dmy"),
    ]


MARK = "\x01"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def month_number(name: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(name)).cast("int")
    return F.when(at > 0, at)


def parse_dates(text: Column) -> Column:
    """struct(date, until, ongoing), or null where no pattern gives a calendar date."""
    return _let(plain_dashes(text), _dates)


def _dates(value: Column) -> Column:
    def attempt(pattern: str, parts: str) -> Column:
        # all groups of the first match by one replacement, each after a mark; without a match nothing begins with the mark
        groups = F.regexp_replace(value, f"(?Us)^.*?{pattern}.*$", "".join(f"{MARK}${i + 1}" for i in range(len(parts))))

        def judge(found: Column) -> Column:  # the text's parts at the marks; one part where nothing matched
            def group(part: str) -> Column:
                return F.get(found, F.lit(parts.index(part) + 1))

            def day(d: str, m: str, y: str) -> Column:
                zero = F.lit(0)
                stamp = F.try_make_timestamp_ntz(group(y).cast("int"), month_number(group(m)), group(d).cast("int"), zero, zero, zero.cast("decimal(8,6)"))
                return stamp.cast("date")

            first = day("d", "m", "y")
            second = day("D", "M" if "M" in parts else "m", "Y" if "Y" in parts else "y") if "D" in parts else F.lit(None).cast("date")
            good = first.isNotNull() & (second.isNotNull() if "D" in parts else F.lit(True))
            return F.when(good, F.struct(first.alias("date"), second.alias("until"), F.lit("o" in parts).alias("ongoing")))

        return _let(F.split(groups, MARK), lambda found: F.when(F.size(found) == len(parts) + 1, judge(found)))

    return F.coalesce(*[attempt(p, parts) for p, parts in _grammar()])


def microformat_date(text: Column) -> Column:
    """The first yyyy-mm-dd in a text as a timestamp; a year alone gives null."""
    return F.try_to_timestamp(F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")


def iso_timestamp(text: Column) -> Column:
    """A date or date and time in ISO form as a timestamp; null where it is neither."""
    return text.try_cast("timestamp_ntz")


CLOCK = r"(\d{1,2}):(\d{2})\s*(?:([ap])\.?m\.?)?"


def _minutes(hour: Column, minute: Column, half: Column) -> Column:
    h, m = hour.try_cast("int"), minute.try_cast("int")
    clock = F.when(F.lower(half) == "p", h % 12 + 12).when(F.lower(half) == "a", h % 12).otherwise(h)
    return F.when((clock < 24) & (m < 60), clock * 60 + m)


def parse_times(text: Column) -> Column:
    """struct(start_minute, end_minute, offset_minutes), or null without a clock time."""
    return _let(plain_dashes(text), _times)


def _times(value: Column) -> Column:
    both = rf"(?i){CLOCK}(?:[^\d:]{{0,3}}?\s*(?:-|and|to)\s*{CLOCK})?"
    group = lambda i: F.regexp_extract(value, both, i)
    start = _minutes(group(1), group(2), group(3))
    end = F.when(group(4) != "", _minutes(group(4), group(5), group(6)))
    zone = lambda i: F.regexp_extract(value, r"UTC\s*([+-])(\d{1,2})(?::(\d{2}))?", i)
    size = zone(2).try_cast("int") * 60 + F.coalesce(zone(3).try_cast("int"), F.lit(0))
    offset = F.when(zone(1) == "-", -size).otherwise(size)
    return F.when(start.isNotNull(), F.struct(start.alias("start_minute"), end.alias("end_minute"), offset.alias("offset_minutes")))


def combine(dates: Column, times: Column) -> Column:
    """struct(start, until, ongoing): a single date takes the times; spans and ongoing dates discard them."""

    def at(day: Column, minute: Column) -> Column:
        return F.timestamp_add("MINUTE", minute, day.cast("timestamp_ntz"))

    def both(x: Column) -> Column:
        d, t = x["d"], x["t"]
        single = d["until"].isNull() & ~d["ongoing"] & t.isNotNull()
        start = F.when(single, at(d["date"], t["start_minute"])).otherwise(d["date"].cast("timestamp_ntz"))
        until = F.when(single, at(d["date"], t["end_minute"])).otherwise(d["until"].cast("timestamp_ntz"))
        return F.when(d.isNotNull(), F.struct(start.alias("start"), until.alias("until"), d["ongoing"].alias("ongoing")))

    return _let(F.struct(dates.alias("d"), times.alias("t")), both)


def fill_timespan(microformats: Column, rows: Column) -> Column:
    """struct(start, until, ongoing) from struct(dtstart, dtend) and an array of combined date rows, filled in row order.

    Microformats go first; the first start and the first end found stay; an end
    keeps the ongoing flag out; a start alone is its own end unless ongoing.
    """
    none = F.lit(None).cast("timestamp_ntz")
    begin = _let(microformats, lambda m: F.struct(F.coalesce(m["dtstart"], none).alias("start"), F.coalesce(m["dtend"], none).alias("until"), F.lit(False).alias("ongoing")))

    def step(a: Column, r: Column) -> Column:
        ongoing = a["ongoing"] | (r["ongoing"] & a["until"].isNull())
        until = F.coalesce(a["until"], F.when(~ongoing, r["until"]))
        return F.struct(F.coalesce(a["start"], r["start"]).alias("start"), until.alias("until"), ongoing.alias("ongoing"))

    def closed(x: Column) -> Column:
        end = F.when(x["until"].isNull() & ~x["ongoing"], x["start"]).otherwise(x["until"])
        return F.struct(x["start"].alias("start"), end.alias("until"), x["ongoing"].alias("ongoing"))

    empty = F.array().cast("array<struct<start:timestamp_ntz,until:timestamp_ntz,ongoing:boolean>>")
    return _let(F.aggregate(F.coalesce(rows, empty), begin, step), closed)


def combine_row(text: Column, ending: bool = False) -> Column:
    """struct(start, until, ongoing) of an infobox's date row, or null without a date: :func:`combine` of what it says; in an ``ending`` row a single day is the end."""

    def turned(x: Column) -> Column:
        single = x["until"].isNull() & ~x["ongoing"]
        start, until = F.when(~single, x["start"]), F.when(single, x["start"]).otherwise(x["until"])
        return F.when(x.isNotNull(), F.struct(start.alias("start"), until.alias("until"), x["ongoing"].alias("ongoing")))

    found = combine(parse_dates(text), parse_times(text))
    return _let(found, turned) if ending else found


def _has_time(t: Column) -> Column:
    """A day's time is known if neither its hour nor its minute is 0."""
    return F.coalesce((F.hour(t) != 0) & (F.minute(t) != 0), F.lit(False))


def _set(t: Column, minute: Column) -> Column:
    return F.timestamp_add("MINUTE", minute, F.to_date(t).cast("timestamp_ntz"))


SPAN = "struct<start:timestamp_ntz,until:timestamp_ntz,ongoing:boolean,start_minute:int,end_minute:int,offset_minutes:int>"


def timespan(microformats: Column, date_rows: Column, time_rows: Column) -> Column:
    """struct(start, until, ongoing, start_minute, end_minute, offset_minutes): an article's time span from all its rows.

    ``microformats``: struct(dtstart, dtend); ``date_rows``: array of
    struct(start, until, ongoing) in row order; ``time_rows``: array of what
    :func:`parse_times` gives. Microformats go first. A row fills what is still
    open, and gives its time to a day that has none. Time rows then complete a start
    without an end; without any date they stand alone. A start alone is its own end
    unless ongoing. The first offset of a time row holds for the whole span.
    """
    minute = lambda t: F.when(_has_time(t), F.hour(t) * 60 + F.minute(t))
    none = F.lit(None)

    def made(start, until, ongoing, start_minute, end_minute, offset) -> Column:
        parts = {"start": start, "until": until, "ongoing": ongoing, "start_minute": start_minute, "end_minute": end_minute, "offset_minutes": offset}
        return F.struct(*[v.alias(k) for k, v in parts.items()]).cast(SPAN)

    begin = _let(microformats, lambda m: made(m["dtstart"], m["dtend"], F.lit(False), none, none, none))

    def better(old: Column, new: Column) -> Column:
        """The old day if there is one, with the new one's time if only that has any."""
        return F.when(old.isNull(), new).when(~_has_time(old) & _has_time(new), _set(old, minute(new))).otherwise(old)

    def by_date(a: Column, r: Column) -> Column:
        open_now = F.coalesce(r["ongoing"], F.lit(False)) & a["until"].isNull()
        until = F.when(~open_now & ~a["ongoing"] & r["until"].isNotNull(), better(a["until"], r["until"])).otherwise(a["until"])
        return made(better(a["start"], r["start"]), until, a["ongoing"] | open_now, none, none, none)

    def by_time(a: Column, r: Column) -> Column:
        half, free = a["start"].isNotNull() & a["until"].isNull(), a["start"].isNull() & a["until"].isNull()
        start = F.when(half & r["start_minute"].isNotNull() & ~_has_time(a["start"]), _set(a["start"], r["start_minute"])).otherwise(a["start"])
        until = F.when(half & r["end_minute"].isNotNull(), _set(a["start"], r["end_minute"])).otherwise(a["until"])
        first = lambda c: F.when(free, F.coalesce(a[c], r[c])).otherwise(a[c])
        return made(start, until, a["ongoing"], first("start_minute"), first("end_minute"), F.coalesce(a["offset_minutes"], r["offset_minutes"]))

    def closed(x: Column) -> Column:
        until = F.when(x["until"].isNull() & ~x["ongoing"], x["start"]).otherwise(x["until"])
        return made(x["start"], until, x["ongoing"], x["start_minute"], x["end_minute"], x["offset_minutes"])

    rows = F.coalesce(date_rows, F.array().cast("array<struct<start:timestamp_ntz,until:timestamp_ntz,ongoing:boolean>>"))
    times = F.coalesce(time_rows, F.array().cast("array<struct<start_minute:int,end_minute:int,offset_minutes:int>>"))
    return _let(F.aggregate(times, F.aggregate(rows, begin, by_date), by_time), closed)


def zone(offset_minutes: Column) -> Column:
    """An offset as in +02:00; null without one."""
    size = F.abs(offset_minutes)
    return F.when(offset_minutes.isNotNull(), F.format_string("%s%02d:%02d", F.when(offset_minutes < 0, "-").otherwise("+"), F.floor(size / 60).cast("int"), (size % 60).cast("int")))


def clock(minute: Column, offset_minutes: Column) -> Column:
    """Minutes of a day as in 13:05:00, with the offset behind if there is one."""
    return F.when(minute.isNotNull(), F.concat(F.format_string("%02d:%02d:00", F.floor(minute / 60).cast("int"), (minute % 60).cast("int")), F.coalesce(zone(offset_minutes), F.lit(""))))


def stamp(t: Column, offset_minutes: Column) -> Column:
    """ISO text of a date and time, with the offset behind if there is one."""
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.coalesce(zone(offset_minutes), F.lit("")))


def month_range(spark, first: str, last: str):
    """One row (month date, name) for each month from first to last (yyyy-MM), both included."""
    months = spark.range(1).select(F.explode(F.sequence(F.lit(f"{first}-01").cast("date"), F.lit(f"{last}-01").cast("date"), F.expr("interval 1 month"))).alias("month"))
    return months.select("month", F.date_format("month", "MMMM_yyyy").alias("name"))


def first_valid(*tries: Column) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), tries)
