"""Portal pages (month, url, html) to events and topics.

A page is parsed once, in one task, because day counters need document order;
everything after that is set-based. A page may come as parts, one or more whole
days with what they cite in each, or numbered parts of a day, so that neither a
month nor a day of any size has a row of its size: counters start anew each day,
and go on from a day's part to its next. Decisions on known oddities: a
topic without links has no parents; of two equal headings on a day the last
counts; empty list items are skipped at every depth; links inside wrappers are
kept; text of source links goes to the source text while offsets move on.
"""

from __future__ import annotations

import calendar
import gc
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventweave.sources.dom import Node, parse_with_ids

HOST = "https://en.wikipedia.org"
LINK = "struct<href:string,text:string,start_pos:int,end_pos:int,external:boolean>"
EVENTS = (
    "month string, url string, date date, category string, event_index int, text string, source_text string, raw string, "
    f"parent_topics array<string>, links array<{LINK}>, source_links array<{LINK}>, "
    f"sentences array<struct<idx:int,text:string,start:int,end:int,links:array<{LINK}>>>, refs array<struct<nr:int,url:string,anchor_text:string>>"
)
#: Events, and topics, of a page that one row holds at most.
ROOM = 500
TOPICS = "month string, url string, date date, category string, topic_index int, text string, href string, raw string, parents array<string>"


def _href(value: str) -> str:
    return HOST + value if value.startswith("/") else value


def text_and_links(node: Node, skip: frozenset = frozenset({"sup", "ul"})) -> tuple[str, list[dict]]:
    """Text and links with code-point offsets, inner links before outer ones."""
    parts, links = [], []

    def go(n: Node, at: int) -> int:
        for c in n.children:
            if isinstance(c, str):
                parts.append(c)
                at += len(c)
            elif c.tag not in skip:
                start, before = at, len(parts)
                at = go(c, at)
                if c.tag == "a" and c.attrs.get("href"):
                    text = "".join(parts[before:])
                    links.append({"href": _href(c.attrs["href"]), "text": text, "start_pos": start, "end_pos": at, "external": "external" in c.classes()})
        return at

    go(node, 0)
    return "".join(parts), links


def is_source(link: dict) -> bool:
    return link["external"] and re.fullmatch(r"\s*\(.*\)\s*", link["text"], re.S) is not None


def split_sentences(text: str, links: list[dict]) -> list[dict]:
    """Cut after each full stop and space that no link strictly holds; each link goes to the first sentence that ends at or after it."""
    out, start, rest = [], 0, sorted(links, key=lambda x: (x["start_pos"], x["end_pos"]))

    def close(end: int) -> None:
        nonlocal start, rest
        mine = [x for x in rest if x["end_pos"] <= end]
        rest = [x for x in rest if x["end_pos"] > end]
        moved = [{**x, "start_pos": x["start_pos"] - start, "end_pos": x["end_pos"] - start} for x in mine]
        out.append({"idx": len(out), "text": text[start:end], "start": start, "end": end, "links": moved})
        start = end

    end = text.find(". ") + 2
    while end > 1:
        if not any(x["start_pos"] < end < x["end_pos"] for x in links):
            close(end)
        end = text.find(". ", end) + 2
    if text.endswith(".") and start < len(text) or not out:
        close(len(text))
    return out


def split_topics(text: str, links: list[dict]) -> list[tuple[str, str | None]]:
    """(label, href) for each topic of an item: one link has the whole text, more links share it out at commas outside links."""
    links = sorted(links, key=lambda x: (x["start_pos"], -x["end_pos"]))
    whole = text.strip().strip(":").strip()
    if len(links) < 2:
        return [(whole, links[0]["href"] if links else None)]
    commas = [i for i, c in enumerate(text) if c == "," and not any(x["start_pos"] <= i < x["end_pos"] for x in links)]
    if not commas:
        return [(whole, x["href"]) for x in links]
    cuts, at, begin, out = [*commas, len(text)], 0, 0, []
    for x in links:
        if x["end_pos"] > cuts[at] and at + 1 < len(cuts):
            begin, at = cuts[at] + 1, at + 1
        out.append((text[begin : cuts[at]].strip().strip(":").strip(), x["href"]))
    return out


def references(root: Node) -> dict[int, dict]:
    """Numbered news references of the page."""
    out = {}
    for box in root.find_all(cls="reflist"):
        for li in box.find_all("li"):
            ident = li.attrs.get("id", "")
            cite = next((c for c in li.find_all("cite") if "news" in c.classes()), None)
            link = next((a for a in cite.find_all("a") if "external" in a.classes()), None) if cite else None
            if ident.startswith("cite_note-") and link and ident.rsplit("-", 1)[-1].isdigit():
                nr = int(ident.rsplit("-", 1)[-1])
                out.setdefault(nr, {"nr": nr, "url": link.attrs.get("href"), "anchor_text": link.text()})
    return out


def _categories(body: Node) -> dict:
    kids = [c for c in body.children if isinstance(c, Node)]
    heads = [c for c in kids if c.tag == "p" and not c.attrs or c.tag == "div" and "current-events-content-heading" in c.classes()]
    out = {}
    for h in heads:
        nxt = next(h.following(), None)
        if nxt is not None and nxt.tag == "ul":
            out[h.text().strip()] = nxt
    if not heads:
        for c in kids:
            if c.tag == "ul":
                out[None] = c
    return out


def _day(boxes: dict[str, Node], year: int, month: int, day: int) -> Node | None:
    box = boxes.get(f"{year}_{calendar.month_name[month]}_{day}")
    if box is None:
        return None
    body = box.find(cls="description")
    if body is None:
        table = next((n for n in box.following() if n.tag == "table" and "vevent" in n.classes()), None)
        body = table.find(cls="description") if table else None
    if body is None:
        raise ValueError(f"no description for {year}-{month}-{day}")
    return body


def parse_page(month: str, url: str, html: str, seen: dict | None = None) -> tuple[list[dict], list[dict]]:
    """Events and topics of a page whose month is named like January_2022.

    ``seen`` has for each date the events and topics of the parts before, and gets those of this one.
    """
    seen = {} if seen is None else seen
    name, year = month.split("_")
    number = list(calendar.month_name).index(name)
    root, boxes = parse_with_ids(html)
    refs, events, topics = references(root), [], []
    for day in range(1, calendar.monthrange(int(year), number)[1] + 1):
        body = _day(boxes, int(year), number, day)
        if body is None:
            continue
        date = pd.Timestamp(int(year), number, day).date()
        n_events, n_topics = seen.get(date, (0, 0))
        for category, top in _categories(body).items():
            stack = [(li, []) for li in reversed([c for c in top.children if isinstance(c, Node) and c.tag == "li"])]
            while stack:
                li, parents = stack.pop()
                if "mw-empty-elt" in li.classes() or not li.has_text():
                    continue
                base = {"month": month, "url": url, "date": date, "category": category, "raw": li.html()}
                inner = li.find("ul")
                if inner is not None:
                    keys = []
                    text, links = text_and_links(li)
                    for label, href in split_topics(text, links):
                        key = href or label
                        topics.append({**base, "topic_index": n_topics, "text": label, "href": href, "parents": parents if href else []})
                        n_topics += 1
                        keys.append(key)
                    items = [c for c in inner.children if isinstance(c, Node) and c.tag == "li"]
                    stack.extend((c, keys) for c in reversed(items))
                else:
                    text, links = text_and_links(li)
                    sources = [x for x in links if is_source(x)]
                    plain, at = "", 0
                    for x in sorted(sources, key=lambda x: x["start_pos"]):
                        plain, at = plain + text[at : x["start_pos"]], max(at, x["end_pos"])
                    plain = (plain + text[at:]).strip()
                    own = [x for x in links if not is_source(x)]
                    cited = [int(s.attrs["id"].rsplit("-", 1)[-1]) for s in li.find_all("sup") if s.attrs.get("id", "").startswith("cite_ref-") and s.attrs["id"].rsplit("-", 1)[-1].isdigit()]
                    events.append({
                        **base, "event_index": n_events, "text": plain, "source_text": "".join(x["text"] for x in sources), "parent_topics": parents, "links": own,
                        "source_links": sources, "sentences": split_sentences(plain, own), "refs": [refs[c] for c in sorted(set(cited)) if c in refs],
                    })
                    n_events += 1
        seen[date] = n_events, n_topics
    return events, topics


def parse_pages(pages: DataFrame, strict: bool = False) -> DataFrame:
    """(month, url, error, events, topics) of pages or parts of pages (month, url, html): each is parsed once for both.

    A row has at most ``ROOM`` events and as many topics; a page with more has more
    rows. A page that cannot be parsed has one row with an error and neither events
    nor topics; with ``strict`` it fails the job. Where pages have the columns ``day``
    and ``part``, a row is a part of that day: a task gets all of a day's parts in
    order, holds one at a time, and numbers go on from one to the next.
    """
    events, topics = _names(EVENTS), _names(TOPICS)
    kind = lambda names: "array<struct<" + ",".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in names) + ">>"
    schema = f"month string, url string, error string, events {kind(events)}, topics {kind(topics)}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def one(month, url, html, seen) -> tuple:
        try:
            return (None, *parse_page(month, url, html, seen))
        except Exception as e:  # a page is outside input: whatever it breaks, the other months go on
            if strict:
                raise
            return f"{type(e).__name__}: {e}", [], []

    def run(batches):
        # a tree refers to itself, so it is the collector's; some trees at a time are cheaper than a look at each 700 nodes
        gc.set_threshold(100_000, 20, 20)
        of, seen = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                month, url, html, *day = (c[i].as_py() for c in batch.columns)
                if not day or (month, url, *day) != of:
                    of, seen = (month, url, *day), {}
                error, found, heads = one(month, url, html, seen)
                for at in range(0, max(len(found), len(heads), 1), ROOM):
                    row = {"month": month, "url": url, "error": error, "events": found[at : at + ROOM], "topics": heads[at : at + ROOM]}
                    yield pa.RecordBatch.from_pylist([row], arrow)

    spark = pages.sparkSession
    most = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(most).rstrip("bB")
    if not now.isdigit() or int(now) > 4 << 20:  # pages are large: a worker gets a few at a time
        spark.conf.set(most, str(4 << 20))
    if "part" not in pages.columns:
        return pages.select("month", "url", "html").mapInArrow(run, schema)
    # a part is much work for its bytes, so days are spread whatever the coalescing of small partitions thinks
    days = pages.repartition(8 * spark.sparkContext.defaultParallelism, "month", "url", "day").sortWithinPartitions("month", "url", "day", "part")
    return days.select("month", "url", "html", "day").mapInArrow(run, schema)


def page_status(parsed: DataFrame) -> DataFrame:
    """(month, status, pages, events, topics, error): a month is published if all its pages were parsed, else failed, with the first error."""
    return parsed.groupBy("month").agg(
        F.when(F.count("error") > 0, "failed").otherwise("published").alias("status"), F.count_distinct(F.coalesce("url", F.lit(""))).alias("pages"), F.sum(F.size("events")).alias("events"),
        F.sum(F.size("topics")).alias("topics"), F.min("error").alias("error"),
    )


def whole_months(parsed: DataFrame) -> DataFrame:
    """The pages of months without an error, which can be published."""
    return parsed.join(parsed.where("error IS NOT NULL").select("month").distinct(), "month", "left_anti")


def _names(schema: str) -> list[str]:
    out, depth, part = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(part.strip())
            part = ""
        else:
            part += c
    return [*out, part.strip()]


def one_a_row(parsed: DataFrame) -> DataFrame:
    """(month, url, error, event, topic) of what :func:`parse_pages` made, to be kept: a row has one event and one topic at most.

    Readers of files take rows by the thousand, so rows that hold many events each would not fit them.
    """
    return parsed.select("month", "url", "error", F.inline_outer(F.arrays_zip(F.col("events").alias("event"), F.col("topics").alias("topic"))))


def portal_events(pages: DataFrame) -> DataFrame:
    """The events of pages, or of what :func:`parse_pages`, then perhaps :func:`one_a_row`, made of them."""
    if "event" in pages.columns:
        return pages.where("event.event_index IS NOT NULL").select("event.*")
    parsed = parse_pages(pages) if "html" in pages.columns else pages
    return parsed.select(F.inline("events"))


def portal_topics(pages: DataFrame) -> DataFrame:
    """The topics of pages, or of what :func:`parse_pages`, then perhaps :func:`one_a_row`, made of them."""
    if "topic" in pages.columns:
        return pages.where("topic.topic_index IS NOT NULL").select("topic.*")
    parsed = parse_pages(pages) if "html" in pages.columns else pages
    return parsed.select(F.inline("topics"))
