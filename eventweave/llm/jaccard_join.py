"""N-gram Jaccard join by grouped prefixes.

A text is the set of its distinct five-word shingles. Shingles have one global
order: by a class of frequency, rare first, then by hash. Two sets of similarity
t or more share a shingle among the first n - ceil(t n) + 1 of each, its prefix.
Sets with the same prefix and size form a group, so that what is equal there is
joined once: a group stands at each shingle of its prefix with its size and the
shingle's place. At a shingle, groups are compared by size and by place, since at
the first shingle that two prefixes share the rest bounds what is common; groups
that no other may join there are left out. The pairs that remain are expanded to
the groups' members, filtered by parity sketches and verified on whole sets, as
said in ``similar``.

The frequency class comes from counts of all shingles of all documents in a table
of ``CELLS`` cells, chosen by hash. The table has a fixed size; at a larger corpus
more shingles share a cell, so only more frequent ones are told from the rest.
The classes decide how large the buckets are, never what is found.

Equal sets are one set from the start. Texts are read three times and do not move;
prefixes do, and the sets of those that have a candidate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, ship, table, tidy
from eventweave.llm.similar import SIMILAR, TILE, connected, least_common, set_id, shingles, sketch, texts_at

#: Cells of the frequency table, and the blocks in which it is counted.
CELLS = 1 << 21
BLOCKS = 32
#: Parts in which a block's counts are added up first.
SALTS = 8
CELL_SHIFT = np.uint64(64 - 21)
#: Hashes counted at a time, and ids of sets that a task remembers as sent.
AT_ONCE = 1 << 20
SENT = 200_000
#: Groups at one shingle that a task compares with each other.
CROWD = 4096
#: Neighbours in a run of equal keys that are compared by their distance in the array.
NEAR = 32


def may_meet(size_a, pos_a, size_b, pos_b):
    """Whether sets may be similar whose first common shingle of the prefixes stands at these places (from 0)."""
    return np.minimum(size_a - pos_a, size_b - pos_b) >= least_common(size_a, size_b)


def prefix_length(n):
    """How many of n shingles, in the global order, a similar set must meet."""
    return n + SIMILAR[0] * -n // SIMILAR[1] + 1


def rows_and_counts(batches):
    """Arrow batches (doc_id, place, text) to (doc_id, place, sid, size, block, salt, counts): a row for each text, and at the end a task's counts, by block."""
    counts, waiting, n, id_type = np.zeros(CELLS, np.int64), [], 0, None

    def count():
        nonlocal counts, waiting, n
        if waiting:
            counts += np.bincount((np.concatenate(waiting) >> CELL_SHIFT).astype(np.int64), minlength=CELLS)
        waiting, n = [], 0

    names = ["doc_id", "place", "sid", "size", "block", "salt", "counts"]
    for whole in batches:
        id_type = whole.column(0).type
        for at in range(0, whole.num_rows, 1024):
            b = whole.slice(at, 1024)
            sids, sizes = [], []
            for x in b.column(2).cast(pa.binary()):
                found = shingles(x.as_py() or b"")
                sids.append(set_id(found))
                sizes.append(len(found))
                waiting.append(found)
                n += len(found)
                if n > AT_ONCE:
                    count()
            none = [pa.nulls(b.num_rows, t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sids, pa.int64()), pa.array(sizes, pa.int32()), *none], names)
    count()
    if id_type is None:
        return
    salt = TaskContext.get().partitionId() % SALTS
    for block, part in enumerate(np.split(counts, BLOCKS)):
        if part.any():
            none = [pa.nulls(1, t) for t in (id_type, pa.int64(), pa.int64(), pa.int32())]
            own = [pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([np.minimum(part, 0xFFFFFFFF).astype(np.uint32).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *own], names)


def summed(batches, turn):
    """Arrow batches (block, salt, counts) sorted by block and salt to the sums of each block and salt, as ``turn`` gives them in bytes."""
    key, total = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([turn(total)], pa.binary())], ["block", "salt", "counts"])

    for b in batches:
        for block, salt, x in zip(*(b.column(i) for i in range(3)), strict=True):
            if key != (block.as_py(), salt.as_py()):
                if key is not None:
                    yield row()
                key, total = (block.as_py(), salt.as_py()), np.zeros(CELLS // BLOCKS, np.int64)
            total += np.frombuffer(x.as_buffer(), np.uint32)
    if key is not None:
        yield row()


def frequency_classes(counts: DataFrame, shingles_in_all: int) -> np.ndarray:
    """A byte for each cell: 0 for the usual count, more by the logarithm of what is beyond."""
    usual = shingles_in_all / CELLS
    chance = 1 + 3 * usual**0.5

    def narrow(total):
        return np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()

    def classes(total):
        beyond = np.maximum(0, total - usual) / chance
        return np.minimum(255, 4 * np.log2(1 + beyond)).astype(np.uint8).tobytes()

    parts = counts.repartition("block", "salt").sortWithinPartitions("block", "salt").mapInArrow(lambda it: summed(it, narrow), "block int, salt int, counts binary")
    parts = parts.select("block", F.lit(0).alias("salt"), "counts").repartition("block").sortWithinPartitions("block")
    out = np.zeros((BLOCKS, CELLS // BLOCKS), np.uint8)
    for r in parts.mapInArrow(lambda it: summed(it, classes), "block int, salt int, counts binary").collect():  # BLOCKS rows
        out[r.block] = np.frombuffer(r.counts, np.uint8)
    return out.reshape(-1)


def prefixes(batches, classes: np.ndarray):
    """Arrow batches (text) to (kind, key, who, size, pos, bits): kind 0 is (group, set) with the set's sketch, kind 1 (shingle of the prefix, group)."""
    seen: set = set()
    groups: set = set()

    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            out, bits = [], []
            for x in whole.slice(at, 512).column(0).cast(pa.binary()):
                found = shingles(x.as_py() or b"")
                if not len(found) or (sid := set_id(found)) in seen:
                    continue
                order = np.argsort(classes[(found >> CELL_SHIFT).astype(np.int64)], kind="stable")
                first = found[order[: prefix_length(len(found))]]
                group = int(np.int64(np.uint64(xxhash.xxh64_intdigest(first.tobytes(), len(found))).view(np.int64)))
                seen.add(sid)
                out.append((np.zeros(1, np.int32), np.array([group]), np.array([sid]), np.array([len(found)]), np.zeros(1, np.int64)))
                bits.append(sketch(found))
                if group not in groups:
                    groups.add(group)
                    n = len(first)
                    bits += [None] * n
                    out.append((np.ones(n, np.int32), first.view(np.int64), np.full(n, group), np.full(n, len(found)), np.arange(n)))
            if len(seen) > SENT:
                seen.clear()
                groups.clear()
            if out:
                kind, key, who, size, pos = (np.concatenate(c) for c in zip(*out, strict=True))
                cols = [pa.array(kind), pa.array(key), pa.array(who), pa.array(size.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["kind", "key", "who", "size", "pos", "bits"])


def _joinable(start: np.ndarray, n: np.ndarray, size: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which rows some other row of their run may join; runs begin at ``start`` and are ``n`` long."""
    out = np.zeros(len(size), bool)
    for s, k in zip(start[n > NEAR].tolist(), n[n > NEAR].tolist(), strict=True):
        a, b = size[s : s + k], pos[s : s + k]
        for at in range(0, k, 256):
            may = may_meet(a[at : at + 256, None], b[at : at + 256, None], a, b)
            may[np.arange(len(may)), np.arange(at, at + len(may))] = False
            out[s + at : s + at + len(may)] |= may.any(axis=1)
    run = np.repeat(np.arange(len(n)), n)
    small = np.flatnonzero(np.repeat((n > 1) & (n <= NEAR), n))
    for lag in range(1, NEAR):
        i, j = small[:-lag], small[lag:]
        i, j = (x[run[i] == run[j]] for x in (i, j))
        if not len(i):
            break
        may = may_meet(size[i], pos[i], size[j], pos[j])
        out[i[may]] = out[j[may]] = True
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    h = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0xD6E8FEB86659FD93)


def met(batches):
    """Arrow batches (kind, key, who, size, pos, bits) sorted by key, kind and who to (kind, key, who, size, bits): (group, set), and of kind 1 (bucket, group).

    A bucket holds the groups that some other may join at a shingle and is named by
    them, so that near copies, which meet at many shingles, give one bucket. No
    more than ``CROWD`` rows of a key are held between batches; a larger run is a
    bucket as it is.
    """
    seen: set = set()

    def batch_of(key, who):
        n = len(key)
        return pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.array(key), pa.array(who), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], ["kind", "key", "who", "size", "bits"])

    def finished(cols, hot: bool):
        key, who, size, pos = cols
        new = np.r_[True, (key[1:] != key[:-1]) | (who[1:] != who[:-1])]
        key, who, size, pos = (c[new] for c in cols)
        if hot:
            return batch_of(key, who)
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at = np.flatnonzero(_joinable(start, np.diff(np.r_[start, len(key)]), size, pos))
        start = np.flatnonzero(np.r_[True, key[at][1:] != key[at][:-1]]) if len(at) else at
        n = np.diff(np.r_[start, len(at)])
        names = np.add.reduceat(_mixed(who[at]), start).view(np.int64) if len(at) else at
        fresh = np.array([x not in seen for x in names.tolist()], bool)
        if len(seen) > SENT:
            seen.clear()
        seen.update(names.tolist())
        return batch_of(np.repeat(names, n)[np.repeat(fresh, n)], who[at][np.repeat(fresh, n)])

    held, hot = None, None
    for b in batches:
        kind = b.column(0).to_numpy(zero_copy_only=False)
        if (kind == 0).any():
            own = b.filter(pa.array(kind == 0))
            yield pa.RecordBatch.from_arrays([own.column(i) for i in (0, 1, 2, 3, 5)], ["kind", "key", "who", "size", "bits"])
            b = b.filter(pa.array(kind == 1))
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3, 4)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        key = cols[0]
        if hot is not None:
            end = int(np.searchsorted(key, hot, "right"))
            if end:
                yield finished([c[:end] for c in cols], True)
            hot = hot if end == len(key) else None
            cols = [c[end:] for c in cols]
            key = cols[0]
        cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
        if cut:
            yield finished([c[:cut] for c in cols], False)
        held = [c[cut:] for c in cols]
        if len(held[0]) > CROWD:
            hot = held[0][0]
            yield finished(held, True)
            held = [c[:0] for c in held]
    if held is not None and len(held[0]):
        yield finished(held, False)


def sets_of(batches):
    """Arrow batches (text) to (sid, hashes), each set once for a while."""
    seen: set = set()
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            rows = []
            for x in whole.slice(at, 256).column(0).cast(pa.binary()):
                found = shingles(x.as_py() or b"")
                sid = set_id(found)
                if sid not in seen:
                    seen.add(sid)
                    rows.append((sid, found.tobytes()))
            if len(seen) > SENT:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary()))], ["sid", "hashes"])


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: the size of its set, and the smallest doc_id reachable by links.

    Texts link if their sets' similarity is 0.8 or more; equal sets are linked. A
    text without words, also null, has an empty set and is linked with nothing:
    its component is its own doc_id. A row whose doc_id is null gets its group's
    smallest id and never names a group; if no row of the group has an id,
    component_id is null. Repeated rows are all returned. How many links a row has
    is not returned: that takes all pairs of a group.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("place"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    with scratch(spark) as keep:
        judged = saved(texts.mapInArrow(rows_and_counts, f"doc_id {id_type}, place long, sid long, size int, block int, salt int, counts binary"), "set-rows")
        rows = judged.where("block IS NULL")
        facts = rows.agg(F.sum(F.col("size").cast("long")).alias("n")).first()
        classes = frequency_classes(judged.where("block IS NOT NULL").select("block", "salt", "counts"), facts.n or 0)
        sent = spark.sparkContext.broadcast(classes)  # a byte for each cell
        with scratch(spark) as keep_in:
            pairs = texts.select("text").mapInArrow(lambda it: prefixes(it, sent.value), "kind int, key long, who long, size int, pos int, bits binary")
            pairs = pairs.repartition("key").sortWithinPartitions("key", "kind", "who")
            found = saved(pairs.mapInArrow(met, "kind int, key long, who long, size int, bits binary"), "prefix-groups")
            del pairs
            tidy(spark)
            members = found.where("kind = 0").groupBy(F.col("key").alias("group"), F.col("who").alias("sid")).agg(F.first("size").alias("size"), F.first("bits").alias("bits"))
            members = saved(members, "members")
            at_shingles = saved(found.where("kind = 1").select(F.col("key").alias("bucket"), F.col("who").alias("group")).distinct(), "buckets-of-groups")
            many = saved(members.groupBy("group").agg(F.count("*").alias("n")).where("n > 1"), "groups")
            own = many.hint("merge").join(members, "group").select(F.col("group").alias("bucket"), "sid")
            whole = at_shingles.hint("merge").join(members.select("group", "sid"), "group").select("bucket", "sid")
            buckets = keep_in(saved(whole.unionByName(own), "buckets"))
            here = buckets.select("sid").distinct()
            facts = keep_in(saved(members.select("sid", "size", "bits").join(here.hint("merge"), "sid", "left_semi"), "sets-that-met"))
        tidy(spark)

        def sets(wanted: DataFrame) -> DataFrame:
            places = rows.select("sid", "place").hint("merge").join(wanted, "sid").groupBy("sid").agg(F.min("place").alias("place"))
            some = texts_at(texts.select("place", "text"), places, "place").select("text").mapInArrow(sets_of, "sid long, hashes binary")
            return some.groupBy("sid").agg(F.first("hashes").alias("hashes"))

        roots = connected(buckets, facts, sets, tile)
        named = rows.join(roots.hint("merge"), "sid", "left").select("doc_id", "size", F.coalesce("root", "sid").alias("class"))
        named = saved(named, "classes")
        # written first, so that the join deals both sides anew and Spark can split a class of very many rows
        least = saved(named.where("size > 0").groupBy("class").agg(F.min("doc_id").alias("component_id")), "class-ids")
        worded = named.where("size > 0").join(least, "class").select("doc_id", "size", "component_id")
        out = worded.unionByName(named.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id")))
        return keep(saved(out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id"), "similar-groups"))


def op11_ngram_jaccard_join(spark, sf_dir):
    return similar_groups(table(spark, sf_dir, "documents"))
