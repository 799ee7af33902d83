"""Near-duplicates by the exact Jaccard similarity of word shingles, met by SimHash.

Texts are sets of hashed five-word shingles, A-Z lower-cased; a text of one to
four words is one shingle. Two texts are linked if their sets' similarity is 0.8
or more. Candidates are found by SimHash and anchors, as in ``simhash``, with a
fingerprint wide enough for that similarity: at 0.8 about 15 of 100 bits differ,
too many for 64 bits at once. 2480 bits are cut into 80 segments of 31, the
length of the perfect Hamming code. In each segment a fingerprint goes to every
code word within 2 bits, so two that differ in at most 2 bits of a segment meet
there, since a code word is within 1 of the point halfway. Any two fingerprints
within 239 bits therefore meet; at similarity 0.8 (about 376 bits) a pair meets
in one segment in five, and in none of 80 for one pair in fifty million. Two that
meet are candidates within ``NEAR`` of ``CHECKED`` bits. Sets of at most nine
shingles have coarse fingerprints: they also meet at the sets with one shingle
less, which no similar pair with nine shingles in all can miss, so sets of at
most seven meet there alone, and sets of three or fewer have no similar other.

Equal sets are grouped first. What meets at an anchor is a cluster; a task gives
its clusters as the edges of a forest, so that a group of near copies, which
shares very many anchors, gives no more edges than members to any task. The
edges' components are the meeting groups: every pair of candidates is in one. In
these the similar pairs are found as said in ``similar``: hubs first, then what
may link different roots, filtered by size and parity sketch, then verified on
whole sets. A set is sent once for the group and tile, not for each anchor, so
rows grow with a group's size and not with the square of it. No anchor, group or
candidate is dropped. The segments take turns, so that only a few of them lie on
disk at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, ship, tidy
from eventweave.llm.components import components, forest, stars_of
from eventweave.llm.similar import TILE, connected, set_id, shingles, sketch, texts_at
from eventweave.llm.simhash import FLIPS, _syndromes

#: Bits of a segment, the length of the Hamming code, and segments of a fingerprint.
BITS, SEGMENTS = 31, 80
#: Segments whose anchors are met in one turn.
TURN = 4
#: Candidates differ in at most NEAR bits of the first CHECKED: at similarity 0.8 one pair in ten million does not.
CHECKED, NEAR = 186, 57
#: Sets up to this size also meet at the sets with one shingle less; up to the second they need no segments.
SHORT, ALONE = 9, 7
#: The smallest set that another one may be similar to: 4 of 5 shingles.
LEAST = 4
#: Fingerprints of an anchor that are compared at their distance in the array, and that one task searches for clusters.
FEW, CROWD = 32, 4096
FACTORS = np.random.default_rng(42).integers(0, 1 << 63, SEGMENTS // 2, np.uint64) << np.uint64(1) | np.uint64(1)
TIES = np.random.default_rng(43).integers(0, 2, SEGMENTS * 32)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The wide SimHash of a set of shingles, 31 bits of each 32-bit word; in a tie ``TIES`` decides."""
    ones = np.zeros(SEGMENTS * 32, np.int64)
    for at in range(0, len(hashes), 255):
        h = hashes[at : at + 255, None] * FACTORS
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
        bits = np.unpackbits(h.view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * ones + TIES > len(hashes), bitorder="little").view(np.uint32) & np.uint32((1 << BITS) - 1)


def short_keys(hashes: np.ndarray) -> list[int]:
    """Keys of a short set and of the sets with one shingle less, apart from the segments' anchors."""
    if not LEAST <= len(hashes) <= SHORT:
        return []
    near = [hashes, *(np.delete(hashes, i) for i in range(len(hashes)))] if len(hashes) > LEAST else [hashes]
    return [xxhash.xxh64_intdigest(x.tobytes()) >> 2 | 1 << 62 for x in near]


def set_rows(batches):
    """Arrow batches (rid, doc_id, text) to (rid, doc_id, sid, size, print, short, bits); sid stands for the set of shingles."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            sids, sizes, prints, short, bits = [], [], [], [], []
            for x in batch.column(2).cast(pa.binary()):
                found = shingles(x.as_py() or b"")
                sids.append(set_id(found))
                sizes.append(len(found))
                prints.append(fingerprint(found).tobytes() if len(found) >= LEAST else b"")
                short.append(short_keys(found))
                bits.append(sketch(found))
            cols = [pa.array(sids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(prints, pa.binary()), pa.array(short, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["rid", "doc_id", "sid", "size", "print", "short", "bits"])


def anchors(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code words within 2 bits of each 31-bit number, and beside each the index of its number."""
    part = part.astype(np.uint64)
    syn = _syndromes(part)
    mine = np.ones((len(part), FLIPS.shape[1]), bool)
    mine[syn == 0, 1:] = False  # a code word has no other within 2 bits
    return (part[:, None] ^ FLIPS[syn])[mine], np.nonzero(mine)[0]


def replicate(batches, segments):
    """Arrow batches (sid, print, short) to (anchor, sid, a, b, c): at each anchor of ``segments``, with the checked bits.

    With segment 0 also at the short sets' keys, where every two are candidates.
    """
    shift = np.uint64(BITS)
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            sid = batch.column(0).to_numpy(zero_copy_only=False)
            prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(sid), SEGMENTS)
            wide = prints[:, : CHECKED // BITS].astype(np.uint64)
            check = wide[:, ::2] | wide[:, 1::2] << shift
            short = batch.column(2)
            counts = short.value_lengths().to_numpy(zero_copy_only=False)
            long = np.flatnonzero((counts == 0) | (counts > ALONE + 1))
            out = []
            for s in segments:
                words, who = anchors(prints[long, s])
                out.append((words | np.uint64(s) << shift, long[who], check[long[who]]))
            if 0 in segments:
                keys = short.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                who = np.repeat(np.arange(len(sid)), counts)
                out.append((keys, who, np.zeros((len(keys), 3), np.uint64)))
            key, who, seen = (np.concatenate(x) for x in zip(*out, strict=True))
            cols = [key.view(np.int64), sid[who], *(seen[:, i].copy().view(np.int64) for i in range(3))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["anchor", "sid", "a", "b", "c"])


def _bits_apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


def _clusters(check: np.ndarray) -> list[np.ndarray]:
    """The indexes of each two or more rows that are connected by ``NEAR`` bits or fewer."""
    out, rest = [], np.arange(len(check))
    while len(rest):
        queue, cluster, rest = [rest[0]], [rest[0]], rest[1:]
        while queue and len(rest):
            near = _bits_apart(check[rest], check[queue.pop()]) <= NEAR
            queue += rest[near].tolist()
            cluster += rest[near].tolist()
            rest = rest[~near]
        if len(cluster) > 1:
            out.append(np.array(cluster))
    return out


def met_at_anchors(batches):
    """Arrow batches (anchor, sid, a, b, c), sorted by anchor, to edges (u, v) that connect each cluster.

    No more than one anchor's ``CROWD`` rows are held between batches. An anchor
    with more is taken as one cluster: what meets there is compared later on.
    """

    def batch_of(out):
        u, v = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def finished(key, sid, check):
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        out = []
        for s, n in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist(), strict=True):
            for at in [np.arange(n)] if n > CROWD else _clusters(check[s : s + n]):
                out.append((np.full(len(at) - 1, sid[s + at[0]]), sid[s + at[1:]]))
        small = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
        key, sid, check = key[small], sid[small], check[small]
        for lag in range(1, FEW):
            at = np.flatnonzero(key[lag:] == key[:-lag])
            if not len(at):
                break
            near = at[_bits_apart(check[at], check[at + lag]) <= NEAR]
            out.append((sid[near], sid[near + lag]))
        if sum(len(u) for u, _ in out):
            yield batch_of(out)

    held = (*(np.empty(0, np.int64) for _ in range(2)), np.empty((0, 3), np.uint64))
    hot = first = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        new = (*cols[:2], np.stack(cols[2:], axis=1).view(np.uint64))
        key, sid, check = (np.concatenate(x) for x in zip(held, new, strict=True))
        if hot is not None and len(key):
            end = int(np.searchsorted(key, hot, "right"))
            if end:
                yield batch_of([(np.full(end, first), sid[:end])])
            if end < len(key):
                hot = None
            key, sid, check = key[end:], sid[end:], check[end:]
        cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
        if cut:
            yield from finished(key[:cut], sid[:cut], check[:cut])
        held = key[cut:], sid[cut:], check[cut:]
        if len(held[0]) > CROWD:
            hot, first = held[0][0], held[1][0]
            yield batch_of([(np.full(len(held[1]), first), held[1])])
            held = tuple(x[:0] for x in held)
    if len(held[0]):
        yield from finished(*held)


def hash_rows(batches):
    """Arrow batches (sid, text) to (sid, hashes)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            found = [shingles(x.as_py() or b"").tobytes() for x in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["sid", "hashes"])


def _met(groups: DataFrame, segments: range) -> DataFrame:
    """Edges (u, v) between what meets in ``segments``, some at a time: each turn's shuffle goes before the next."""
    out = None
    for at in range(segments.start, segments.stop, TURN):
        turn = segments[at - segments.start : at - segments.start + TURN]
        rows = groups.mapInArrow(lambda it, turn=turn: replicate(it, turn), "anchor long, sid long, a long, b long, c long")
        rows = rows.repartition("anchor").sortWithinPartitions("anchor")
        found = saved(rows.mapInArrow(lambda it: stars_of(met_at_anchors(it)), "u long, v long"), "met")
        out = found if out is None else out.unionByName(found)
        del rows
        tidy(groups.sparkSession)
    return out


def _meeting(groups: DataFrame) -> DataFrame:
    """(node, root): the components of what meets in any segment.

    What meets in the first turn goes by one name in the others, so a group of near
    copies, which meets again in every segment, gives its edges once and not in every
    task of every turn. Renaming nodes to their roots leaves the components as they are.
    """
    spark = groups.sparkSession
    with scratch(spark) as keep:
        first = keep(saved(components(forest(_met(groups, range(TURN)))), "met-first"))
    to_root = first.select(F.col("node").alias("sid"), "root").hint("merge")
    named = saved(groups.join(to_root, "sid", "left").select(F.coalesce("root", "sid").alias("sid"), "print", "short"), "named")
    more = _met(named, range(TURN, SEGMENTS))
    return components(forest(first.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)))


def classes(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """(rid, doc_id, class) for every row of ``rows`` (rid, doc_id, text), which is read more than once and must not change.

    A text may be of any length; a task that compares holds the sets of two texts,
    and sketches of at most two tiles of a meeting group.
    """
    spark = rows.sparkSession
    ship(spark)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select("rid", "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    with scratch(spark) as keep:
        with scratch(spark) as keep_in:
            sets = saved(keyed.mapInArrow(set_rows, f"rid long, doc_id {id_type}, sid long, size int, print binary, short array<long>, bits binary"), "shingle-sets")
            groups = keep_in(saved(sets.groupBy("sid").agg(F.min("rid").alias("rid"), *(F.first(c).alias(c) for c in ("size", "print", "short", "bits"))), "distinct-sets"))
            members = keep_in(saved(sets.select("rid", "doc_id", "sid"), "members"))
        with scratch(spark) as keep_in:
            meeting = keep_in(saved(_meeting(groups.where(F.col("size") >= LEAST).select("sid", "print", "short")), "meeting-groups"))
        met = meeting.select(F.col("root").alias("bucket"), F.col("node").alias("sid"))
        facts = saved(groups.select("sid", "size", "bits").join(met.select("sid").hint("merge"), "sid", "left_semi"), "sets-that-met")

        def known(wanted: DataFrame) -> DataFrame:
            at = saved(groups.select("sid", "rid").join(wanted.hint("merge"), "sid"), "rows-of-sets")
            texts = texts_at(rows.select("rid", "text"), at, "rid").hint("merge").join(at, "rid").select("sid", "text")
            return texts.mapInArrow(hash_rows, "sid long, hashes binary")

        roots = connected(met, facts, known, tile)
        found = members.join(roots.hint("merge"), "sid", "left").select("rid", "doc_id", F.coalesce("root", "sid").alias("class"))
        return keep(saved(found, "classes"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs`` (with doc_id and text); component_id: the group's smallest doc_id.

    Texts without words, also null, are one group. A row whose doc_id is null
    gets its group's smallest id and never names a group; a group of such rows
    alone has component_id null. Repeated rows are all returned.
    """
    rows = saved(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), "rows")
    classed = classes(rows)
    least = saved(classed.groupBy("class").agg(F.min("doc_id").alias("component_id")), "class-ids")
    return classed.join(least, "class").select("doc_id", "component_id")
