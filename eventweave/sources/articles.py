"""Encyclopedia articles (url, html) to typed rows; each distinct url is parsed once."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.sources.dom import Node, parse
from eventweave.sources.portal import LINK, text_and_links

PREFIX = "https://en.wikipedia.org/wiki/"
# fixed values: infobox classes of places
PLACE_CLASSES = {"ib-settlement", "ib-country", "ib-islands", "ib-pol-div", "ib-school-district", "ib-uk-place"}
# fixed values: labels of infobox rows
BEGINS = ["Date", "Date(s)", "First outbreak", "Arrival Date", "Start Date"]
ENDS = ["End Date", "Duration"]
TIMES = ["Time"]
# fixed values: frequent entries of date rows that are places
NO_DATES = ["Wuhan, Hubei, China", "Wuhan, China"]
STORM = "Infobox_storm"

SCHEMA = (
    "url string, canonical string, name string, headline string, date_published string, date_modified string, entity string, templates array<string>, "
    f"classes array<string>, location_label string, location_text string, location_links array<{LINK}>, begin_texts array<string>, end_texts array<string>, "
    "time_texts array<string>, latitude_text string, longitude_text string, dtstart string, dtend string, infobox string"
)


def _is_article(url: str | None) -> bool:
    return bool(url) and url.startswith(PREFIX) and not re.match(r"\w+:", url[len(PREFIX) :])


def _report(root: Node) -> list[str]:
    for s in root.find_all("script"):
        m = re.search(r'"wgPageParseReport"\s*:\s*(\{.*\})', s.text(), re.S)
        if m:
            try:
                lines = json.JSONDecoder().raw_decode(m[1])[0].get("limitreport", {}).get("timingprofile", [])
            except ValueError:
                continue
            return sorted({n.strip() for line in lines for n in re.findall(r"Template:(.+)$", line)})
    return []


def parse_article(url: str, html: str) -> dict | None:
    """Null unless the url is an article's, the page describes itself, and its canonical url is an article's too."""
    if not _is_article(url):
        return None
    root = parse(html)
    about = None
    for s in root.find_all("script"):
        if s.attrs.get("type") == "application/ld+json":
            try:
                about = json.loads(s.text())
            except ValueError:
                about = None
    if not isinstance(about, dict) or not _is_article(canonical := (about.get("url") or "").split("#")[0]):
        return None
    out = {"url": url, "canonical": canonical, "templates": _report(root), "begin_texts": [], "end_texts": [], "time_texts": [], "classes": [], "location_links": []}
    out |= {"name": about.get("name"), "headline": about.get("headline"), "date_published": about.get("datePublished"), "date_modified": about.get("dateModified"), "entity": about.get("mainEntity")}
    box = next((t for t in root.find_all("table") if "infobox" in t.classes()), None)
    if box is not None:
        out |= {"classes": sorted(box.classes()), "infobox": box.html()}
        where = "Areas affected" if any(t.startswith(STORM) for t in out["templates"]) else "Location"
        for tr in box.find_all("tr"):
            th, td = tr.find("th"), tr.find("td")
            if th is None or td is None:
                continue
            label, value = th.text().strip(), td.text(frozenset({"sup"})).strip()
            if label == where and "infobox-label" in th.classes() and "location_text" not in out:
                cell = next((d for d in td.find_all("div") if "location" in d.classes()), td)
                text, links = text_and_links(cell, frozenset({"sup"}))
                out |= {"location_label": label, "location_text": text.strip(), "location_links": links}
            for names, key in ((BEGINS, "begin_texts"), (ENDS, "end_texts"), (TIMES, "time_texts")):
                if label in names and "as of" not in value and "As of" not in value and value not in NO_DATES:
                    out[key].append(value)
        if "vevent" in box.classes():
            for key in ("dtstart", "dtend"):
                span = box.find("span", key)
                found = re.search(r"\d{4}-\d{2}-\d{2}", span.text()) if span else None
                out[key] = found[0] if found else None
    spot = root.find(ident="coordinates")
    dms = spot.find(cls="geo-dms") if spot else None
    if dms is not None:
        for key, cls in (("latitude_text", "latitude"), ("longitude_text", "longitude")):
            part = dms.find(cls=cls)
            out[key] = part.text() if part else None
    return out


def articles(pages: DataFrame) -> DataFrame:
    """One row for each distinct url that is an article."""
    names = [c.split()[0] for c in re.split(r",\s*(?![^<]*>)", SCHEMA)]

    def run(batches):
        for pdf in batches:
            rows = [r for p in pdf.itertuples() if (r := parse_article(p.url, p.html))]
            if rows:
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows])

    return pages.select("url", "html").dropDuplicates(["url"]).mapInPandas(run, SCHEMA)


def location_flag(classes: Column, templates: Column, place_templates: Column) -> Column:
    """A place by its infobox's class or by a template among the place templates; coordinates do not count."""
    by_class = F.arrays_overlap(classes, F.array(*[F.lit(c) for c in sorted(PLACE_CLASSES)]))
    return by_class | F.arrays_overlap(templates, place_templates)


def place_templates(pages: DataFrame) -> DataFrame:
    """Distinct infobox templates named by the anchors of a template list page (html)."""

    def run(batches):
        for pdf in batches:
            found = {a.attrs.get("href", "").rsplit("/", 1)[-1] for h in pdf["html"] for a in parse(h).find_all("a") if a.text().startswith("Template:Infobox")}
            yield pd.DataFrame({"template": sorted(found)})

    return pages.select("html").mapInPandas(run, "template string").distinct()
