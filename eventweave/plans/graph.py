"""The driver's star schema seen as an event graph: triples (module, month, s, p, o)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = "topic/region/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _facts(df: DataFrame, month, s, module: str, facts: list[tuple]) -> DataFrame:
    """Each row's facts (p, o) by one generator, so a source is scanned once."""
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), o.cast("string").alias("o")) for p, o in facts])
    return df.select(F.lit(module).alias("module"), month.alias("month"), s.alias("s"), F.inline(pairs)).where("o IS NOT NULL")


def key(kind: str, column: str):
    return F.concat(F.lit(f"{kind}/"), F.col(column).cast("string"))


def events(spark, sf_dir) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    facts = [
        ("type", F.lit("NewsSummary")), ("mentionDate", F.date_format("o_orderdate", "yyyy-MM-dd")), ("tag", F.col("o_orderpriority")),
        ("during", key("topic/customer", "o_custkey")),
    ]
    return _facts(table(spark, sf_dir, "orders"), month, key("event", "o_orderkey"), "base", facts)


def topics(spark, sf_dir) -> DataFrame:
    none = F.lit("")
    c = _facts(table(spark, sf_dir, "customer"), none, key("topic/customer", "c_custkey"), "base", [("type", F.lit("TextTopic")), ("label", F.col("c_name")), ("during", key("topic/nation", "c_nationkey"))])
    n = _facts(table(spark, sf_dir, "nation"), none, key("topic/nation", "n_nationkey"), "base", [("type", F.lit("ArticleTopic")), ("label", F.col("n_name")), ("during", key("topic/region", "n_regionkey")), ("article", key("article/nation", "n_nationkey"))])
    r = _facts(table(spark, sf_dir, "region"), none, key("topic/region", "r_regionkey"), "base", [("type", F.lit("ArticleTopic")), ("label", F.col("r_name")), ("article", key("article/region", "r_regionkey"))])
    rs = _facts(table(spark, sf_dir, "region"), none, key("article/region", "r_regionkey"), "base", [("source", F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.col("r_name")))])
    ns = _facts(table(spark, sf_dir, "nation"), none, key("article/nation", "n_nationkey"), "base", [("source", F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.col("n_name")))])
    return reduce(DataFrame.unionByName, [c, n, r, rs, ns])


def places(spark, sf_dir) -> DataFrame:
    none = F.lit("")
    s = _facts(table(spark, sf_dir, "supplier"), none, key("place/supplier", "s_suppkey"), "base", [("type", F.lit("Location")), ("label", F.col("s_name")), ("locatedIn", key("place/nation", "s_nationkey"))])
    n = _facts(table(spark, sf_dir, "nation"), none, key("place/nation", "n_nationkey"), "base", [("type", F.lit("Location")), ("label", F.col("n_name")), ("locatedIn", key("place/region", "n_regionkey"))])
    r = _facts(table(spark, sf_dir, "region"), none, key("place/region", "r_regionkey"), "base", [("type", F.lit("Location")), ("label", F.col("r_name"))])
    return reduce(DataFrame.unionByName, [s, n, r])


def entities(spark, sf_dir) -> DataFrame:
    """One-hop claims: each part is an entity with a class, and half of the parts have a size claim."""
    size = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size"))
    return _facts(table(spark, sf_dir, "part"), F.lit(""), key("entity", "p_partkey"), "ohg", [("type", F.col("p_type")), ("label", F.col("p_name")), ("size", size), ("brand", F.col("p_brand"))])


#: Classes and what they are subclasses of or similar to.
CLASSES = [("ECONOMY", "BUSINESS"), ("PROMO", "BUSINESS"), ("BUSINESS", "COMPANY"), ("STANDARD", "PRODUCT"), ("LARGE", "SIZE"), ("MEDIUM", "SIZE"), ("SMALL", "SIZE"), ("SIZE", "PRODUCT")]


def class_edges(spark) -> DataFrame:
    return spark.createDataFrame(CLASSES, "src string, dst string")


def links(spark, sf_dir) -> DataFrame:
    """(event, entity) by linked phrase."""
    return table(spark, sf_dir, "lineitem").select(key("event", "l_orderkey").alias("event"), key("entity", "l_partkey").alias("entity"), key("place/supplier", "l_suppkey").alias("place"))


def graph(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName, [events(spark, sf_dir), topics(spark, sf_dir), places(spark, sf_dir), entities(spark, sf_dir)])
