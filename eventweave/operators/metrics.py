"""Mergeable extraction metrics and classifier scores."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def average(total: Column, n: Column) -> Column:
    """The mean of a mergeable (sum, count) pair; -1 while it is empty."""
    return F.when(n > 0, total / n).otherwise(F.lit(-1.0))


def averages(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n")).withColumn("mean", average(F.col("total"), F.col("n")))


def combine_averages(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Merge rows (keys, total, n) of several runs."""
    return parts.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n")).withColumn("mean", average(F.col("total"), F.col("n")))


def histogram(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), value)


def hit_ratios(months: DataFrame) -> DataFrame:
    """(month, hits, misses) with each month's ratio and the ratio so far; null while nothing was asked. One row a month."""
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    asked = F.col("hits") + F.col("misses")
    return months.select(
        "month", F.try_divide(F.col("hits"), asked).alias("ratio"), F.try_divide(F.sum("hits").over(w), F.sum(asked).over(w)).alias("ratio_so_far")
    )


def deltas(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """What a cumulative counter grew by since the row before."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("delta", F.col(value) - F.coalesce(F.lag(value).over(w), F.lit(0)))


def merged_histograms(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, n) of several runs added up; the most frequent first, ties by key."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), *keys)


def with_alternatives(df: DataFrame, flags: list[str]) -> DataFrame:
    """Adds every OR of two or more of the flags, named by joining theirs with ``_or_``."""
    for size in range(2, len(flags) + 1):
        for some in combinations(flags, size):
            df = df.withColumn("_or_".join(some), reduce(lambda a, b: a | b, [F.col(c) for c in some]))
    return df


def confusion(df: DataFrame, truth: str, predictions: list[str], more_true: int = 0, more_false: int = 0) -> DataFrame:
    """One row for each predicate: tp, fp, fn, tn, support, precision, recall, accuracy, f1 (0 where a denominator is 0).

    ``more_true`` and ``more_false`` cases that nobody listed count as found rightly.
    """
    pairs = F.array(*[F.struct(F.lit(p).alias("predicate"), F.col(p).alias("said")) for p in predictions])
    long = df.select(F.col(truth).alias("t"), F.inline(pairs))
    count = lambda said, t: F.count_if((F.col("said") if said else ~F.col("said")) & (F.col("t") if t else ~F.col("t")))
    more = count(1, 1) + F.lit(more_true), count(0, 0) + F.lit(more_false)
    m = long.groupBy("predicate").agg(more[0].alias("tp"), count(1, 0).alias("fp"), count(0, 1).alias("fn"), more[1].alias("tn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    m = m.withColumns({"support": tp + fn, "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "accuracy": ratio(tp + tn, tp + fp + fn + tn)})
    p, r = F.col("precision"), F.col("recall")
    return m.withColumn("f1", ratio(2 * p * r, p + r))


def unlisted_counts(found: DataFrame, listed: DataFrame) -> DataFrame:
    """(is_place, n): distinct articles (name, is_place) by flag, without the names listed (name)."""
    return found.select("name", "is_place").distinct().join(listed.select("name").distinct(), "name", "left_anti").groupBy("is_place").agg(F.count("*").alias("n"))


def last_records(log: DataFrame, key: str = "name", order: str = "line") -> DataFrame:
    """Of each key's log lines the last: one partial aggregate."""
    others = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max(F.struct(order, *[c for c in others if c != order])).alias("row_")).select(key, *[F.col(f"row_.{c}").alias(c) for c in others if c != order])


def scan_lines(spark, path: str, schema: str) -> DataFrame:
    """JSON lines with their place in the file as ``line``; keys that a line lacks are null."""
    text = spark.read.text(path).select("value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("line"))
    return text.select("line", F.from_json("value", schema).alias("x")).select("line", "x.*")


def save_metrics(metrics: DataFrame, path: str, development: tuple[str, ...] = (), verbose: bool = False) -> None:
    """One JSON object for each row; development columns only with ``verbose``."""
    kept = [c for c in metrics.columns if verbose or c not in development]
    metrics.select(*kept).write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def load_metrics(spark, path: str, schema: str) -> DataFrame:
    """Metrics files under a schema; numbers that a file lacks are 0."""
    return spark.read.schema(schema).json(path).na.fill(0)


def in_units(df: DataFrame) -> DataFrame:
    """Columns that end in _ns, _s, _bytes with their values in ms, min and MB beside them."""
    made = {}
    for c in df.columns:
        for end, to, size in (("_ns", "_ms", 1e6), ("_s", "_min", 60.0), ("_bytes", "_mb", 1e6)):
            if c.endswith(end):
                made[c[: -len(end)] + to] = F.col(c) / size
    return df.withColumns(made) if made else df


def without_repeats(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from that of the row before."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    return rows.withColumn("keep_", first | ~F.col(value).eqNullSafe(before)).where("keep_").drop("keep_")
