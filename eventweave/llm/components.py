"""Connected components by alternating large-star and small-star rounds.

Edges stay distributed. Each round is written to the shared folder, so the
lineage is one round long and a lost executor costs that round's tasks only.
The driver sees two numbers a round: an edge count and an order-free checksum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import discard, saved

#: Edges that one task makes a forest of at a time.
ROOM = 1 << 20


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges but the smallest of its component, and beside it that smallest one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while (low[a] != low[b]).any():
        x, y = low[a], low[b]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    rest = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[rest], nodes[low[rest]]


def stars_of(batches):
    """Arrow batches (u, v) to edges (u, v) with the same components, fewer than the nodes; some ``ROOM`` edges are held besides."""
    held, n, most = [], 0, ROOM

    def star():
        return _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))

    for batch in batches:
        held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        n += batch.num_rows
        if n > most:
            held = [star()]
            n = len(held[0][0])
            most = n + ROOM
    if n:
        u, v = star()
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def forest(edges: DataFrame) -> DataFrame:
    """Edges (u, v: long) with the same components as ``edges``.

    Each task gives the edges that it reads as stars. That is done again in as many
    tasks as there are times ``ROOM`` edges left, while they become half as many: up
    to ``ROOM`` edges end as fewer than their nodes, however many pairs a group had.
    """
    now = saved(edges.mapInArrow(stars_of, "u long, v long"), "forest")
    n = now.count()
    while True:
        tasks = max(1, -(-n // ROOM))
        then = saved(now.coalesce(tasks).mapInArrow(stars_of, "u long, v long"), "forest")
        left = then.count()
        discard(now)
        if tasks == 1 or 2 * left > n:
            return then
        now, n = then, left


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    met = down.join(low, "u")
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: any one comparable type); root is the smallest node reachable.

    Loops and repeated edges do no harm. Nodes without edges are not returned.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        then = saved(_small_star(_large_star(now)), "edges")
        sums = then.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        discard(now)
        now = then
        if mark == (sums.n, sums.s):
            break
        mark = (sums.n, sums.s)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
