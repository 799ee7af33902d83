"""Approximate nearest neighbours by an adaptive dimension scan over probed lists.

Vectors are scaled to length 1 and turned by a fixed random rotation, so that
any first d of D coordinates estimate the whole squared distance. A bounded
sample fits the lists' centres; every vector is put into the list of its
nearest centre. A query visits the lists nearest to it. Inside a list the
candidates' coordinates are read in blocks: after each block a candidate whose
scaled partial distance is above the query's k-th best by more than the test's
margin is given up. What survives all blocks is scored in double precision on
the original vectors.

How many lists to visit is measured: for up to ``CALIBRATION`` vectors the true
neighbours are found among all rows, and as many lists are probed as hold the
share ``recall`` of them. Data without clusters need about half of the lists.

Vectors of one direction (equal, or multiples of each other) form one class with
its smallest vec_ids and are searched once, so any number of them neither slows
the search nor breaks ties. A list is dealt into chunks of bounded size, whichever
list is hot; each vector goes to one chunk once, and the queries that visit the
list stream past it in Arrow batches.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; nor do rows whose vec_id is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, ship, table, unit_uniform

SAMPLE = 20_000
MOST_LISTS = 1024
CALIBRATION = 96
#: Vectors of a list held by one task at a time, and queries compared with them at once.
CHUNK = 16_384
QUERIES = 512
#: Directions that agree to so many parts of one are the same.
GRID = 1 << 36
BLOCK = 16
#: The margin of the hypothesis test, in units of 1 / sqrt(dimensions read).
MARGIN = 2.1


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def stack(column, dim: int) -> np.ndarray:
    """An Arrow column of binary vectors, or a list of bytes, as a matrix."""
    values = column.to_pylist() if isinstance(column, pa.Array | pa.ChunkedArray) else list(column)
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dim)


def centres(sample: np.ndarray, lists: int, seed: int = 0, rounds: int = 10) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        near = (sample @ c.T).argmax(axis=1)
        for i in range(lists):
            mine = sample[near == i]
            if len(mine):
                c[i] = mine.mean(axis=0)
        c /= np.sqrt((c * c).sum(axis=1, keepdims=True)) + 1e-12
    return c


def scan(q: np.ndarray, c: np.ndarray, k: int, block: int = BLOCK, margin: float = MARGIN, step: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """For each rotated unit query the k nearest candidates found: (index, squared distance), -1 where there are fewer."""
    dim, nq = q.shape[1], len(q)
    best_d = np.full((nq, k), np.inf)
    best_i = np.full((nq, k), -1)
    for at in range(0, len(c), step):
        part = c[at : at + step]
        limit = best_d[:, -1]
        dist = np.zeros((nq, len(part)))
        alive = np.ones((nq, len(part)), bool)
        for d in range(0, dim, block):
            qb, cb = q[:, d : d + block], part[:, d : d + block]
            seen = min(d + block, dim)
            if alive.mean() > 0.25:
                dist += (qb * qb).sum(1)[:, None] + (cb * cb).sum(1) - 2 * (qb @ cb.T)
                judged = dist
                if seen < dim:
                    alive &= judged * (dim / seen) <= ((1 + margin / np.sqrt(seen)) ** 2 * limit)[:, None]
            else:
                i, j = np.nonzero(alive)
                if not len(i):
                    break
                diff = qb[i] - cb[j]
                dist[i, j] += (diff * diff).sum(1)
                if seen < dim:
                    alive[i, j] = dist[i, j] * (dim / seen) <= (1 + margin / np.sqrt(seen)) ** 2 * limit[i]
        dist[~alive] = np.inf
        both_d = np.concatenate([best_d, np.maximum(dist, 0)], axis=1)
        both_i = np.concatenate([best_i, np.broadcast_to(np.arange(at, at + len(part)), dist.shape)], axis=1)
        pick = np.argpartition(both_d, k - 1, axis=1)[:, :k]
        best_d, best_i = np.take_along_axis(both_d, pick, 1), np.take_along_axis(both_i, pick, 1)
        order = np.argsort(best_d, axis=1)
        best_d, best_i = np.take_along_axis(best_d, order, 1), np.take_along_axis(best_i, order, 1)
    best_i[~np.isfinite(best_d)] = -1
    return best_i, best_d


def _valid(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def pack(batches):
    """(vec_id, array of doubles) to (vec_id, v as 64-bit binary, d: 128 bits of its direction)."""
    for b in batches:
        flat = np.asarray(b.column(1).flatten(), np.float64)
        rows = flat.reshape(b.num_rows, -1) + 0.0 if b.num_rows else np.zeros((0, 1))
        grid = np.rint(unit(rows) * GRID).astype(np.int64) if b.num_rows else rows
        cols = [pa.array([r.tobytes() for r in rows], pa.binary()), pa.array([xxhash.xxh3_128_digest(g.tobytes()) for g in grid], pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["vec_id", "v", "d"])


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """(class_id, v, ids): directions with their ``keep`` smallest ids and the vector of the smallest, from rows (vec_id, v, d)."""
    n = vectors.count()
    salts = max(16, n // 50_000)
    few = F.slice(F.array_sort(F.collect_set("vec_id")), 1, keep)
    part = vectors.groupBy("d", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).alias("salt")).agg(few.alias("ids"), F.min(F.struct("vec_id", "v")).alias("first"))
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return part.groupBy("d").agg(ids.alias("ids"), F.min("first").alias("first")).select(F.col("first.vec_id").alias("class_id"), "d", F.col("first.v").alias("v"), "ids")


def assign(batches, dim: int, centre: np.ndarray):
    for b in batches:
        x = unit(stack(b.column(1), dim)) if b.num_rows else np.zeros((0, dim))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array((x @ centre.T).argmax(axis=1).astype(np.int32) if b.num_rows else np.zeros(0, np.int32))], ["class_id", "v", "list"]
        )


def visit(batches, dim: int, centre: np.ndarray, probes: int, sizes: np.ndarray, least: int):
    """(class_id, v) to one row for each probed list: ``probes`` lists, and further ones until they hold ``least`` vectors."""
    for b in batches:
        if not b.num_rows:
            continue
        order = np.argsort(-(unit(stack(b.column(1), dim)) @ centre.T), axis=1, kind="stable").astype(np.int32)
        enough = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
        counts = np.minimum(np.maximum(probes, enough), len(sizes))
        rows = np.repeat(np.arange(b.num_rows), counts)
        lists = order[rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)]
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)), pa.array(lists)], ["q_id", "v", "list"])


def true_lists(batches, dim: int, queries: np.ndarray, centre: np.ndarray, k: int):
    """The k best of a partition for each calibration query: (query, score, place of the list in the query's order)."""
    best: list = [[] for _ in queries]
    order = np.argsort(-(queries @ centre.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], 1)
    for b in batches:
        if not b.num_rows:
            continue
        x = unit(stack(b.column(0), dim))
        s, lists = queries @ x.T, (x @ centre.T).argmax(axis=1)
        for i, row in enumerate(s):
            top = np.argpartition(-row, min(k, len(row)) - 1)[:k]
            best[i] = sorted([*best[i], *((float(row[j]), int(place[i, lists[j]])) for j in top)], reverse=True)[:k]
    rows = [(i, s, p) for i, found in enumerate(best) for s, p in found]
    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.float64(), pa.int32()))], ["query", "score", "place"])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, free of overflow."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def stream_scan(batches, dim: int, k: int, turn: np.ndarray):
    """Arrow batches (list, chunk, side, id, v) sorted by list, chunk and side: a chunk's vectors (side 0), then the queries that visit it (side 1).

    Yields (q_id, class_id, score): the k nearest of the chunk for each query. One chunk is held at a time.
    """
    key, ids, held, chunk = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            if key != tuple(keys[at, :2]):
                key, ids, held, chunk = tuple(keys[at, :2]), [], [], None
            names, v = batch.column(3).slice(at, end - at).to_numpy(zero_copy_only=False), stack(batch.column(4).slice(at, end - at), dim)
            if keys[at, 2] == 0:
                ids.append(names)
                held.append(v)
                continue
            if not held:
                continue
            if chunk is None:
                ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                chunk = unit(held[0]) @ turn
            for q in range(0, len(v), QUERIES):
                some = v[q : q + QUERIES]
                found, _ = scan(unit(some) @ turn, chunk, k)
                i, j = np.nonzero(found >= 0)
                c = found[i, j]
                cols = [pa.array(names[q : q + QUERIES][i]), pa.array(ids[0][c]), pa.array(cosines(some[i], held[0][c]))]
                yield pa.RecordBatch.from_arrays(cols, ["q_id", "class_id", "score"])


def score_pairs(batches, dim: int):
    """(query_id, vec_id, near, a, b) to (query_id, vec_id, near, score)."""
    for b in batches:
        s = cosines(stack(b.column(3), dim), stack(b.column(4), dim)) if b.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(s)], ["query_id", "vec_id", "near", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, recall: float = 0.97, vec_id: str = "vec_id", vector: str = "embedding", seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that meets ``is_query`` its k nearest other rows found, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    ship(spark)
    with scratch(spark) as keep:
        return keep(saved(_nearest(vectors, is_query, k, recall, vec_id, vector, seed), "neighbours"))


def _nearest(vectors: DataFrame, is_query: Column, k: int, recall: float, vec_id: str, vector: str, seed: int) -> DataFrame:
    spark = vectors.sparkSession
    picked = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query"))
    picked = picked.where(F.col("vec_id").isNotNull() & _valid(F.col("v")))
    dims = picked.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    dim = dims.d
    rows = picked.where(F.size("v") == dim)
    packed = saved(rows.select("vec_id", "v").mapInArrow(pack, "vec_id long, v binary, d binary"), "vectors")
    queries = rows.where("is_query").select("vec_id").distinct()
    kinds = saved(classes(packed, k + 1), "classes")
    n = kinds.count()
    lists = int(max(1, min(MOST_LISTS, round(n**0.5 / 2))))
    # samples are chosen by hash; the second factor leaves room for chance
    sample = kinds.where(unit_uniform(F.lit(seed), "class_id") <= min(1.0, 0.9 * SAMPLE / n)).select("v").toPandas()
    base = unit(stack(sample["v"].tolist(), dim)) if len(sample) else None
    lists = min(lists, len(sample)) or 1
    centre = centres(base, lists, seed) if base is not None else np.ones((1, dim))
    some = kinds.where(unit_uniform(F.lit(seed + 1), "class_id") <= min(1.0, CALIBRATION / n)).select("v").toPandas()
    probes = lists
    if len(some) and lists > 1:
        asked = unit(stack(some["v"].tolist(), dim))
        seen = kinds.select("v").mapInArrow(lambda it: true_lists(it, dim, asked, centre, k + 1), "query int, score double, place int")
        best = seen.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(f"r > 1 AND r <= {k + 1}")
        places = np.sort(np.array([r.place for r in best.select("place").collect()]))
        if len(places):
            probes = int(min(lists, places[min(len(places) - 1, int(np.ceil(recall * len(places))))] + 1))
    turn = rotation(dim, seed)
    placed = saved(kinds.select("class_id", "v").mapInArrow(lambda it: assign(it, dim, centre), "class_id long, v binary, list int"), "lists")
    # every id of a query row with the class of its vector
    asked = packed.join(queries, "vec_id").join(kinds.select("d", "class_id"), "d").select("vec_id", "class_id").distinct()
    asked = saved(asked, "queries")
    wanted = kinds.join(asked.select("class_id").distinct(), "class_id").select("class_id", "v")
    per = saved(placed.groupBy("list").agg(F.count("*").alias("n")), "list-sizes")  # at most MOST_LISTS rows
    held = np.zeros(lists, np.int64)
    for r in per.collect():
        held[r.list] = r.n
    sizes = per.select("list", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int").alias("chunk")
    left = placed.join(sizes, "list").select("list", chunk, F.lit(0).alias("side"), F.col("class_id").alias("id"), "v")
    right = wanted.mapInArrow(lambda it: visit(it, dim, centre, probes, held, k + 2), "q_id long, v binary, list int").join(sizes, "list")
    right = right.select("list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("side"), F.col("q_id").alias("id"), "v")
    order = ["list", "chunk", "side"]
    met = left.unionByName(right).repartition("list", "chunk").sortWithinPartitions(*order).select(*order, "id", "v")
    found = met.mapInArrow(lambda it: stream_scan(it, dim, k + 1, turn), "q_id long, class_id long, score double")
    top = found.withColumn("r", F.row_number().over(Window.partitionBy("q_id").orderBy(F.desc("score"), "class_id"))).where(F.col("r") <= k + 1)
    named = top.join(kinds.select("class_id", "ids"), "class_id").select("q_id", F.col("score").alias("near"), F.explode("ids").alias("vec_id"))
    each = asked.select(F.col("vec_id").alias("query_id"), F.col("class_id").alias("q_id")).join(named, "q_id").where("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("near").alias("near"))
    # members of a class are as near as its first; ties go to the smaller vec_id
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    best = saved(each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "nearest")
    one = packed.groupBy("vec_id").agg(F.min("v").alias("v"))
    pairs = best.join(one.select(F.col("vec_id").alias("query_id"), F.col("v").alias("a")), "query_id").join(one.select("vec_id", F.col("v").alias("b")), "vec_id")
    exact = pairs.select("query_id", "vec_id", "near", "a", "b").mapInArrow(lambda it: score_pairs(it, dim), "query_id long, vec_id long, near double, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id"))
    return exact.select("query_id", rank.alias("rank"), "vec_id", "score")


def op7_nearest_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
