"""Sentences and links in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentences(text: Column) -> Column:
    """Sentences as strings: cut after each full stop and space; a rest without a final stop is dropped unless it is all there is."""
    parts = F.split(text, r"(?<=\. )")
    closed = F.filter(parts, lambda p: F.endswith(p, F.lit(". ")))
    rest = F.element_at(parts, -1)
    ends = F.endswith(text, F.lit(".")) & ~F.endswith(rest, F.lit(". ")) & (rest != "")
    out = F.when(ends, F.concat(closed, F.array(rest))).otherwise(closed)
    return F.when(F.size(out) == 0, F.array(text)).otherwise(out)


def anchors(html: Column) -> Column:
    """The hrefs of a page's anchors in document order."""
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
