"""Column expressions for keys, urls and other strings of the event graph."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIKI = "https://en.wikipedia.org/wiki/"


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def absolute(href: Column, host: str = "https://en.wikipedia.org") -> Column:
    """Site-relative links get the host in front; others stay."""
    return F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(host), href)).otherwise(href)


def form_encode(text: Column) -> Column:
    """application/x-www-form-urlencoded as Python writes it: ``~`` stays and ``*`` does not."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def plain_dashes(text: Column) -> Column:
    return F.translate(text, "–−", "--")


def strip(text: Column, also: str = "") -> Column:
    """Without white space (all of Unicode's) and the characters in ``also`` at both ends."""
    return F.regexp_replace(text, rf"(?U)^[\s{also}]+|[\s{also}]+$", "")


def citation_number(anchor: Column) -> Column:
    return F.element_at(F.split(anchor, "-"), -1).try_cast("int")


def linker_text(text: Column) -> Column:
    """Text as the entity linker wants it: no quotes, line ends as spaces."""
    return F.translate(text, "\n\"'", " ")


def is_article_url(url: Column, prefix: str = WIKI) -> Column:
    """Starts with the wiki prefix, and what follows is not a name space, a run of word characters before a colon."""
    rest = F.substring(url, F.lit(len(prefix) + 1), F.char_length(url))
    return F.coalesce(F.startswith(url, F.lit(prefix)) & ~rest.rlike(r"(?U)^\w+:"), F.lit(False))


def event_id(day: Column, index: Column) -> Column:
    return F.concat_ws("_", F.date_format(day, "yyyy-MM-dd"), index)


def topic_uri(article_id: Column, text: Column) -> Column:
    return F.when(article_id.isNotNull(), F.concat(F.lit("topic/article/"), article_id)).otherwise(F.concat(F.lit("topic/text/"), form_encode(text)))


def point_uri(lat: Column, lon: Column) -> Column:
    return F.concat(F.lit("point/"), form_encode(F.concat_ws("_", lat, lon)))


def timespan_uri(start: Column, end: Column, ongoing: Column, start_time: Column, end_time: Column, zone: Column) -> Column:
    """The present parts joined; an end keeps the ongoing flag out."""
    flag = F.when(end.isNull() & ongoing, F.lit("ongoing"))
    return F.concat(F.lit("timespan/"), form_encode(F.concat_ws("_", start, end, flag, start_time, end_time, zone)))


def template_names(report: Column) -> Column:
    """Distinct template names in a page's timing report."""
    return F.array_distinct(F.regexp_extract_all(report, F.lit(r"Template:([^\n\"\\]+)"), F.lit(1)))


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM_yyyy")


def without_suffix(text: Column, suffix: Column) -> Column:
    """A text without what it ends with; an empty or absent suffix takes nothing away."""
    ends = F.endswith(text, suffix) & (suffix != "")
    return F.when(ends, F.substring(text, F.lit(1), F.char_length(text) - F.char_length(suffix))).otherwise(text)
