"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    both are one process, gets a temporary folder instead.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="eventweave-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir()
    return base.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/eventweave/{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._eventweave_path = path
    if _scopes:
        _scopes[-1].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`saved` that no later step reads."""
    spark, path = df.sparkSession, df._eventweave_path
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    for scope in _scopes:
        scope[:] = [x for x in scope if x is not df]


_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables saved inside are deleted at the end, but for those given to the function that this yields.

    What a caller gets must be such a table or come from one, since DataFrames are
    lazy. Shuffle files of finished steps go too, as soon as the JVM has collected
    what refers to them.
    """
    mine: list[DataFrame] = []
    kept: list[DataFrame] = []
    _scopes.append(mine)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        _scopes.remove(mine)
        for df in list(mine):
            if not any(df is k for k in kept):
                discard(df)
        if _scopes:  # an outer scope may still delete what this one keeps
            _scopes[-1].extend(kept)
        tidy(spark)


@contextmanager
def leftovers():
    """Yields a list that ends with the tables saved inside and not deleted, for a caller who knows when their readers are done."""
    mine: list[DataFrame] = []
    _scopes.append(mine)
    try:
        yield mine
    finally:
        _scopes.remove(mine)
        if _scopes:
            _scopes[-1].extend(mine)


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each Spark context, and bound the session's Arrow batches.

    Rows here hold whole texts, so a batch is bounded by its bytes: Spark's own bound
    of 64 MB is held several times over, in the JVM and in each worker. A session
    that has set a smaller bound keeps it.
    """
    sc = spark.sparkContext
    now = spark.conf.get(BATCH).rstrip("bB")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    if getattr(sc, "_eventweave_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="eventweave-pkg-")) / "eventweave_pkg.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._eventweave_shipped = True


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone. Texts of one-byte characters take the JVM's fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def unit_uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns' values only."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
