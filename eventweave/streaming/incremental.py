"""Incremental builds, an extension: new page files are built into the graph as they arrive.

A micro-batch replaces its months' partitions, so a batch that runs twice after a
failure leaves the same graph, and a page that arrives again updates its month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventweave.sources import portal, triples

PAGES = "month string, url string, html string"


def build(pages: DataFrame) -> DataFrame:
    """All triples of portal pages."""
    return triples.event_triples(portal.portal_events(pages)).unionByName(triples.topic_triples(portal.portal_topics(pages)))


def watch(spark: SparkSession, source: str, graph: str, checkpoint: str, **trigger):
    """Start a query that builds each new Parquet file of pages under ``source`` into ``graph``."""
    stream = spark.readStream.schema(PAGES).parquet(source)
    write = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: triples.write(build(df), graph))
    return write.trigger(**(trigger or {"availableNow": True})).start()
