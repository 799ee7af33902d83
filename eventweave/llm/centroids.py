"""Centroid clustering by plain Lloyd rounds in whole numbers.

Vectors are kept as whole numbers, so sums do not depend on their order and a
rerun, another partitioning or a lost executor change nothing. In a round every
task gets the centroids with its function (``k`` vectors, however many rows
there are), takes the squared differences to each of them, and gives its vectors
to the nearest, the smaller number in a tie. A task returns one row for each
cluster it met: a count and the sums of the components. These rows are grouped;
the driver sees ``k`` sums a round. Nothing else leaves a task, so neither a
cluster that holds most rows nor a vector that is repeated very often moves.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, ship, table

#: Whole components stay below this in size, so that squared distances fit 64 bits (up to 128 dimensions).
WIDEST = 1 << 27
SCALE = 256.0


def finite(vector: Column) -> Column:
    """The vector is not null and holds neither nulls nor numbers that are not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def whole(vector: Column) -> Column:
    """floor(256 * x) of each component of a vector of doubles, as 64-bit numbers."""
    floors = F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x).cast("long"))
    wide = F.exists(vector, lambda x: F.abs(x) >= WIDEST / SCALE)
    return F.when(wide, F.raise_error(F.lit(f"a component of {WIDEST // int(SCALE)} or more: scores do not fit 64 bits"))).otherwise(floors)


def matrix(column, dim: int) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(len(column), dim)


def nearest_centroid(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each vector's nearest centroid, the smaller in a tie, and the squared distance."""
    apart = np.empty((len(centres), len(x)), np.int64)
    for i, c in enumerate(centres):
        diff = x - c
        apart[i] = (diff * diff).sum(axis=1)
    near = apart.argmin(axis=0)
    return near.astype(np.int32), apart[near, np.arange(len(x))]


def partial_sums(frames, centres: np.ndarray):
    """Pandas frames (v) to one row for each cluster met: (cluster, n, sums)."""
    k, dim = centres.shape
    n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for frame in frames:
        for at in range(0, len(frame), 8192):
            x = matrix(frame["v"].iloc[at : at + 8192], dim)
            near, _ = nearest_centroid(x, centres)
            order = np.argsort(near, kind="stable")
            met, first = np.unique(near[order], return_index=True)
            sums[met] += np.add.reduceat(x[order], first, axis=0)
            n += np.bincount(near, minlength=k)
    met = np.flatnonzero(n)
    if len(met):
        yield pd.DataFrame({"cluster": met.astype(np.int32), "n": n[met], "sums": list(sums[met])})


def assigned(frames, centres: np.ndarray):
    """Pandas frames (vec_id, v) to (vec_id, cluster, distance). vec_id is text here: pandas would turn whole numbers beside nulls into floats."""
    for frame in frames:
        near, apart = nearest_centroid(matrix(frame["v"], centres.shape[1]), centres)
        yield pd.DataFrame({"vec_id": frame["vec_id"], "cluster": near, "distance": apart})


def starts(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of seed, colon and vec_id, in that order; equal ids by their vectors."""
    named = vectors.where("vec_id IS NOT NULL")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r.v for r in named.orderBy(order, "v").limit(k).select("v").collect()], np.int64)


def improved(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of each cluster's vectors; an empty cluster keeps its centroid."""
    parts = vectors.select("v").mapInPandas(lambda it: partial_sums(it, centres), "cluster int, n long, sums array<long>")
    sums = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = centres.copy()
    for r in sums.collect():  # a row for each component of each centroid at most
        out[r.cluster, r.d] = int(r.s) // r.n
    return out


def clusters(rows: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: str = "2", vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each vector of ``dim`` finite components.

    Other vectors take no part. Repeated rows are all clustered and returned. A
    row whose vec_id is null is clustered, but never starts as a centroid. Fewer
    vectors than ``k`` give as many centroids; without any, or if none has a
    vec_id, no row is returned. Components of 524,288 or more stop the job with a
    message, since the distances would not fit a long.
    """
    spark = rows.sparkSession
    ship(spark)
    with scratch(spark) as keep:
        picked = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        picked = picked.where(finite(F.col("v")) & (F.size("v") == dim))
        vectors = saved(picked.select("vec_id", whole(F.col("v")).alias("v")), "whole-vectors")
        centres = starts(vectors, k, seed)
        if not len(centres):
            return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        for _ in range(rounds):
            centres = improved(vectors, centres)
        named = vectors.select(F.col("vec_id").cast("string").alias("vec_id"), "v").mapInPandas(lambda it: assigned(it, centres), "vec_id string, cluster int, distance long")
        found = keep(saved(named.select(F.col("vec_id").cast("long").alias("vec_id"), "cluster", "distance"), "clusters"))
        sums = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    facts = spark.createDataFrame([(c, d, sum(sums.values()), digest[c]) for c, d in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clustering(spark, sf_dir):
    return clusters(table(spark, sf_dir, "embeddings"))


def _sql(k: int = 40, rounds: int = 5, dim: int = 64, seed: str = "2") -> str:
    """The same rounds in SQL: a ``near`` and a ``cents`` table for each."""
    dims = ", ".join(f"CAST(floor(sum(x.v[{i}]) / count(*)) AS BIGINT)" for i in range(1, dim + 1))
    apart = f"list_sum(list_transform(range(1, {dim + 1}), lambda i: (x.v[i] - c.c[i]) * (x.v[i] - c.c[i])))"

    def near(i: int) -> str:
        return f"""near{i} AS (
            SELECT n, vec_id, v, best.cluster AS cluster, best.d AS d FROM (
                SELECT x.n, x.vec_id, x.v, min(struct_pack(d := CAST({apart} AS BIGINT), cluster := c.cluster)) AS best
                FROM vecs x CROSS JOIN cents{i} c GROUP BY x.n, x.vec_id, x.v))"""

    steps = [
        f"""vecs AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cents0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c
            FROM (SELECT v, sha256('{seed}:' || vec_id) AS h FROM vecs WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds):
        steps += [
            near(i),
            f"""cents{i + 1} AS (SELECT c.cluster, coalesce(m.c, c.c) AS c FROM cents{i} c LEFT JOIN
                (SELECT cluster, [{dims}] AS c FROM near{i} x GROUP BY cluster) m USING (cluster))""",
        ]
    steps.append(near(rounds))
    return f"""WITH {", ".join(f"{s.split(' ', 1)[0]} AS MATERIALIZED {s.split(' AS ', 1)[1]}" for s in steps)}
        SELECT vec_id, x.cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY x.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM near{rounds} x JOIN cents{rounds} c ON x.cluster = c.cluster"""


ORACLE = _sql()
