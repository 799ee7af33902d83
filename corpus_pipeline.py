"""A corpus pipeline: five operators in a row over ``documents``, each stage written and read again.

A stage's rows are complete once they are written, and only then is the next stage
called; so each stage first deletes the tables that the one before it left behind.

Nulls, empty texts, repeated rows and rows that share a doc_id keep to the rules of
the operators: each row is judged by its own text, wordless rows are one group of
near-duplicates, and columns that no stage knows pass through unchanged.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from eventweave.llm import decontaminate, mixing, near_copies, quality, simhash, token_files
from eventweave.llm.common import discard, fresh_path, leftovers, table, tidy

_left: list[DataFrame] = []


def _stage(f):
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            discard(_left.pop())
        tidy(spark)
        with leftovers() as mine:
            out = f(spark, docs, sf_dir)
        _left.extend(mine)
        return out

    return run_stage


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality draw keeps."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts alike in 0.8 or more of their five-word shingles the document with the smallest doc_id."""
    return simhash.keep_one(docs, near_copies.classes)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no whole window of benchmark words occurs, nor shorter items in a twentieth of the words."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), whole_windows=True)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target takes it."""
    return mixing.mixed(docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document copy in the token files."""
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(docs, path)
    return token_files.token_files_summary(spark, path)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix),
    ("token files", tokens),
]

#: The classifier, the fingerprints and the rounding are beyond SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
