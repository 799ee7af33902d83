"""Page snapshots: folders of cached pages, plain or zstd-compressed, as tables.

Executors never fetch; a snapshot is made elsewhere and read here. A page's key is
its file's name. Where a page is there in both forms, the compressed one counts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def article_key(url: Column) -> Column:
    """The part of an article's url after /wiki/ that names its cached page: up to the next slash, fragment and all."""
    return F.get(F.split(url, "/"), F.lit(4))


@F.pandas_udf(StringType())
def _plain(content: pd.Series) -> pd.Series:
    import zstandard

    reader = zstandard.ZstdDecompressor()
    return content.map(lambda b: None if b is None else reader.stream_reader(b).read().decode("utf-8", "replace"))


@F.pandas_udf(BinaryType())
def _packed(text: pd.Series) -> pd.Series:
    import zstandard

    writer = zstandard.ZstdCompressor()
    return text.map(lambda t: writer.compress((t or "").encode()))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    packed = F.endswith(name, F.lit(".zst"))
    key = F.regexp_replace(name, r"(\.html)?(\.zst)?$", "")
    return files.select(F.url_decode(key).alias("key"), packed.alias("packed"), "content")


def cached_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(key, html) of a folder of ``key.html`` and ``key.html.zst`` files, keys percent-encoded."""
    files = _files(spark, folder)
    # only the names are compared; contents are read once
    double = files.groupBy("key").agg(F.max("packed").alias("best"))
    best = files.join(double, "key").where(F.col("packed") == F.col("best"))
    return best.select("key", F.when(F.col("packed"), _plain(F.when(F.col("packed"), F.col("content")))).otherwise(F.decode("content", "UTF-8")).alias("html"))


def packed_table(pages: DataFrame) -> DataFrame:
    """(key, page): pages (key, html) as zstd bytes, the form that a snapshot table keeps."""
    return pages.select("key", _packed("html").alias("page"))


def unpacked_table(table: DataFrame) -> DataFrame:
    return table.select("key", _plain("page").alias("html"))


def upgraded(spark: SparkSession, folder: str, path: str, known: DataFrame | None = None) -> DataFrame:
    """Take a folder of cached pages into the snapshot table at ``path``; keys that ``known`` has are left as they are."""
    fresh = cached_pages(spark, folder)
    if known is not None:
        fresh = fresh.join(known.select("key"), "key", "left_anti")
    packed_table(fresh).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def portal_snapshot(table: DataFrame, months: DataFrame, first_day: int = 1, last_day: int = 31) -> DataFrame:
    """(month, url, html, first_day, last_day) of the portal pages of the months (name) asked for; a month without a page is left out."""
    url = F.concat(F.lit("https://en.wikipedia.org/wiki/Portal:Current_events/"), "key")
    met = table.join(months.select(F.col("name").alias("key")), "key", "left_semi")
    return met.select(F.col("key").alias("month"), url.alias("url"), "html", F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day"))


def article_snapshot(table: DataFrame, urls: DataFrame) -> DataFrame:
    """(url, html): each distinct url (url) with its cached page; urls that differ beyond the key share a page."""
    asked = urls.select("url").distinct().withColumn("key", article_key(F.col("url")))
    return asked.join(table, "key").select("url", "html")


def in_days(rows: DataFrame, first: str, last: str) -> DataFrame:
    """Rows (date) from the first to the last day, both included: a span inside a month or over several."""
    return rows.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def sample(rows: DataFrame, index: str, value: int) -> DataFrame:
    """The rows whose counter within their day has the value."""
    return rows.where(F.col(index) == value)


def refresh(known: DataFrame, fresh: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """A service's table after another run: misses only are filled, or with ``force`` every key asked for anew is replaced."""
    if force:
        return known.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)
    return known.unionByName(fresh.join(known.select(*keys).distinct(), keys, "left_anti"))
