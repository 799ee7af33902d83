import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import centroids

SCHEMA = "cluster string, embedding array<float>, vec_id long, label int"


def brute(rows, k=40, rounds=5, dim=64, seed="2"):
    """The contract in plain Python integers; rows: (vec_id, vector)."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = [sum(d for _, d, j in last if j == c) for c in range(len(cents))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, inertia[j], sum(inertia), digest[j]) for i, d, j in last), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [[float(np.float32(x)) for x in rng.normal(size=4)] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(3, good[3]), (3, good[5]), (None, good[0]), (2**60 + 1, good[1]), (2**60 + 3, good[1])]  # repeats, one id twice, no id, large ids beside nulls
    rows += [(100, None), (101, []), (102, good[0][:3]), (103, [*good[0][:3], None]), (104, [*good[0][:3], float("nan")]), (105, [*good[0][:3], float("inf")])]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(300)]  # a hot vector
    df = spark.createDataFrame([("x", v, i, 1) for i, v in rows], SCHEMA)
    got = rows_of(centroids.clusters(df.repartition(5), k=6, rounds=4, dim=4))
    assert got == brute(rows, k=6, rounds=4, dim=4)


def test_ties_few_vectors_and_an_empty_cluster(spark):
    # equal starts: the second never wins a vector and stays as it is
    rows = [(i, [1.0, 0.0]) for i in range(4)] + [(9, [-1.0, 0.0])]
    df = spark.createDataFrame([("x", v, i, 1) for i, v in rows], SCHEMA)
    assert rows_of(centroids.clusters(df, k=40, dim=2)) == brute(rows, k=40, dim=2)
    assert rows_of(centroids.clusters(df, k=3, dim=2)) == brute(rows, k=3, dim=2)


def test_no_rows_and_too_wide_components(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert centroids.clusters(df).count() == 0
    assert centroids.clusters(spark.createDataFrame([("x", [1.0, 2.0], None, 1)], SCHEMA), dim=2).count() == 0
    with pytest.raises(Exception, match="do not fit 64 bits"):
        centroids.clusters(spark.createDataFrame([("x", [1.0, 1e9], 1, 1)], SCHEMA), dim=2).count()


def test_the_table_and_other_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert rows_of(centroids.clusters(df)) == want
    assert rows_of(centroids.clusters(df.repartition(13, F.col("vec_id") % 3))) == want
