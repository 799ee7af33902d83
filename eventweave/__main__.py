"""Command line: ``python -m eventweave COMMAND``.

extract   a folder of cached portal pages to module files, months that are there already left out
merge     all months of a folder of module files as one dataset
turtle    module files to Turtle
load      module files into a store of named graphs; drop and list change and show it
query     a SPARQL query over a store's graphs, as JSON lines
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventweave.functions import datetimes
from eventweave.operators.closure import cut
from eventweave.sources import modules, pages, portal, triples


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventweave", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    x = sub.add_parser("extract")
    x.add_argument("pages")
    x.add_argument("folder")
    x.add_argument("-s", "--start", required=True, help="first month, yyyy-MM")
    x.add_argument("-e", "--end", required=True, help="last month, yyyy-MM")
    x.add_argument("--first-day", help="first day, yyyy-MM-dd")
    x.add_argument("--last-day", help="last day, yyyy-MM-dd")
    x.add_argument("--force", action="store_true", help="extract months that are there already")
    x = sub.add_parser("merge")
    x.add_argument("folder")
    x.add_argument("--name", default="Dataset_0000")
    x = sub.add_parser("turtle")
    x.add_argument("folder")
    x.add_argument("target")
    x.add_argument("--modules", nargs="*", default=["ohg", "osm"])
    x = sub.add_parser("load")
    x.add_argument("folder")
    x.add_argument("store")
    x = sub.add_parser("drop")
    x.add_argument("store")
    x.add_argument("months", nargs="+")
    x = sub.add_parser("list")
    x.add_argument("store")
    x = sub.add_parser("query")
    x.add_argument("store")
    x.add_argument("text")
    x.add_argument("--from", dest="months", nargs="*", default=[])
    return p


def extract(spark: SparkSession, a) -> int:
    """Publish the months that can be parsed; those that cannot are listed in ``_status`` and on stderr, stay unbuilt and so are tried again next time."""
    months = datetimes.month_range(spark, a.start, a.end)
    if not a.force:
        built = [r.name for r in months.collect() if modules.exists(spark, a.folder, r.name)]
        months = months.where(~F.col("name").isin(built)) if built else months
    snapshot = pages.portal_snapshot(pages.cached_pages(spark, a.pages), months)
    every = cut(portal.parse_pages(snapshot))
    status = portal.page_status(every)
    status.coalesce(1).write.mode("overwrite").json(f"{a.folder}/_status")  # a row a month
    failed = status.where("status = 'failed'").select("month", "error").collect()
    for r in failed:
        print(f"{r.month}: {r.error}", file=sys.stderr)
    parsed = portal.whole_months(every)
    first, last = a.first_day or f"{a.start}-01", a.last_day or "9999-12-31"
    events, topics = (pages.in_days(f(parsed), first, last) for f in (portal.portal_events, portal.portal_topics))
    modules.save(triples.event_triples(events).unionByName(triples.topic_triples(topics)).unionByName(triples.news_triples(events)), a.folder)
    return 1 if failed else 0


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("eventweave").getOrCreate()
    if a.command == "extract":
        return extract(spark, a)
    elif a.command == "merge":
        modules.save(modules.merged(modules.load(spark, a.folder), a.name), a.folder)
    elif a.command == "turtle":
        modules.turtle(modules.load(spark, a.folder), a.target, tuple(a.modules), grouped=True)
    elif a.command == "load":
        modules.Store(spark, a.store).load(modules.load(spark, a.folder))
    elif a.command == "drop":
        return 0 if all([modules.Store(spark, a.store).drop(m) for m in a.months]) else 1
    elif a.command == "list":
        print("\n".join(modules.Store(spark, a.store).graphs()))
    else:
        from eventweave.plans.sparql import sparql

        for line in sparql(modules.Store(spark, a.store).scan(*a.months), a.text).toJSON().toLocalIterator():
            print(line)
    return 0


if __name__ == "__main__":
    sys.exit(main())
