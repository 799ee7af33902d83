"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are cut into three segments. Of two fingerprints that
differ in at most 4 bits, leaving out the segment with most differing bits
leaves two segments that differ in at most 2. So for each of the three pairs of
segments (42 or 43 bits) the anchors are the words of a covering code: the
perfect Hamming code on 31 bits times all words on the other bits, covering
radius 1. Two points within 2 bits have a point halfway, at most 1 from either,
and that point's anchor is at most 1 + 1 from both. Replicating each fingerprint
to all anchors within radius 1 + 2 / 2 therefore brings every linked pair
together at some anchor: half the threshold is enough where both sides are
replicated. About 28 anchors a pair, 84 in all, out of 2**38.

Exact copies never meet in pairs: equal fingerprints are grouped first, and only
distinct ones are replicated. At an anchor, links are found by growing clusters
from one fingerprint at a time against those not yet reached, which gives a
spanning forest instead of all pairs. An anchor with more than ``TILE``
fingerprints is dealt into tiles whose pairs are compared in separate tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, ship, table
from eventweave.llm.components import components

SHINGLE = 4
THRESHOLD = 4
#: Fingerprints compared in one task at one anchor; larger anchors are dealt into tiles.
TILE = 4096
#: The segments' first bits and lengths.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
PAIRS = ((0, 1), (0, 2), (1, 2))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text, A-Z lower-cased, over word shingles with repeats."""
    words = text.lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        return digest(join(words), 42)
    total = np.zeros(64, np.int64)
    last = len(words) - shingle + 1
    for at in range(0, last, 1 << 16):
        end = min(last, at + (1 << 16))
        h = np.fromiter((digest(join(words[i : i + shingle]), 42) for i in range(at, end)), np.uint64, end - at)
        total += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > last).tobytes(), "big")


def fingerprints_of(batches, shingle: int):
    """Arrow batches (keys..., text) to (keys..., fp as signed 64 bits)."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).cast(pa.binary())
        fps = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in texts), np.uint64, len(texts)).view(np.int64)
        cols = [batch.column(i) for i in range(batch.num_columns) if i != at]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(fps)], [*names, "fp"])


def _syndromes(x: np.ndarray) -> np.ndarray:
    """The exclusive or of the positions (from 1) of the set bits among the low 31: the Hamming syndrome."""
    out = np.zeros(len(x), np.uint8)
    for b in range(31):
        out ^= ((x >> np.uint64(b)) & np.uint64(1)).astype(np.uint8) * np.uint8(b + 1)
    return out


def _flips() -> np.ndarray:
    """For each syndrome the patterns of 1 or 2 bits that lead from it to a code word: 1 of one bit, 15 of two."""
    out = np.zeros((32, 16), np.uint64)
    for s in range(1, 32):
        pairs = [(a, a ^ s) for a in range(1, 32) if a < a ^ s]
        out[s] = [1 << (s - 1), *((1 << (a - 1)) | (1 << (b - 1)) for a, b in pairs)]
    return out


FLIPS = _flips()


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor keys of unsigned fingerprints and, beside each, the index of its fingerprint."""
    keys, owners = [], []
    every = np.arange(len(fps))
    for k, (i, j) in enumerate(PAIRS):
        (at, n), (bt, m) = SEGMENTS[i], SEGMENTS[j]
        low = (fps >> np.uint64(at)) & np.uint64((1 << n) - 1)
        x = low | (((fps >> np.uint64(bt)) & np.uint64((1 << m) - 1)) << np.uint64(n))
        syn = _syndromes(x)
        tag = np.uint64(k) << np.uint64(60)
        in_code = syn == 0
        rest = [np.uint64(1) << np.uint64(b) for b in range(31, n + m)]
        own, others, flips = x[in_code], x[~in_code], FLIPS[syn[~in_code]]
        home = others ^ flips[:, 0]
        for word, who in ((own, every[in_code]), (home, every[~in_code])):  # nearest anchor, then one other bit off
            for bit in (np.uint64(0), *rest):
                keys.append((word ^ bit) | tag)
                owners.append(who)
        # a code word has no other within 2 bits on the 31, but two other bits may differ
        for a in range(len(rest)):
            for b in range(a):
                keys.append((own ^ rest[a] ^ rest[b]) | tag)
                owners.append(every[in_code])
        for c in range(1, 16):
            keys.append((others ^ flips[:, c]) | tag)
            owners.append(every[~in_code])
    return np.concatenate(keys), np.concatenate(owners)


def replicate(batches):
    """Arrow batches (fp) to (anchor, fp)."""
    for batch in batches:
        all_fps = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(all_fps), 4096):
            fps = all_fps[at : at + 4096]
            keys, who = anchors(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(fps[who])], ["anchor", "fp"])


def _grow(x: np.ndarray, threshold: int) -> tuple[list, list]:
    """Links that connect what is within ``threshold`` bits, at most len(x) - 1 of them."""
    left, right = [], []
    rest = x[1:]
    queue = [x[0]]
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
            continue
        now = queue.pop()
        near = np.bitwise_count(rest ^ now) <= threshold
        if near.any():
            found = rest[near]
            left.append(np.full(len(found), now))
            right.append(found)
            queue.extend(found)
            rest = rest[~near]
    return left, right


def _between(x: np.ndarray, y: np.ndarray, threshold: int) -> tuple[list, list]:
    """Links between two tiles that connect what all such links do: a spanning forest, grown from either side in turn."""
    left, right = [], []
    rest_x, rest_y = x, y
    while len(rest_x) and len(rest_y):
        queue, rest_x = [(rest_x[0], True)], rest_x[1:]
        while queue:
            now, of_x = queue.pop()
            others = rest_y if of_x else rest_x
            near = np.bitwise_count(others ^ now) <= threshold
            if near.any():
                found = others[near]
                left.append(np.full(len(found), now))
                right.append(found)
                queue.extend((f, not of_x) for f in found)
                if of_x:
                    rest_y = others[~near]
                else:
                    rest_x = others[~near]
    return left, right


def _pairs_in_runs(key: np.ndarray, x: np.ndarray, threshold: int) -> tuple[list, list]:
    """Links inside runs of one key, small runs all at once by their distance in the array."""
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    for s, n in zip(starts[sizes > 32], sizes[sizes > 32], strict=True):
        a, b = _grow(x[s : s + n], threshold)
        left += a
        right += b
    small = np.repeat((sizes > 1) & (sizes <= 32), sizes)
    k, v = key[small], x[small]
    for lag in range(1, 32):
        if len(k) <= lag:
            break
        near = (k[lag:] == k[:-lag]) & (np.bitwise_count(v[lag:] ^ v[:-lag]) <= threshold)
        left.append(v[:-lag][near])
        right.append(v[lag:][near])
    return left, right


def links_at_anchors(batches, threshold: int, tile: int):
    """Arrow batches (anchor, fp), sorted by anchor, to rows (kind, u, v).

    Kind 0 is a link of two fingerprints. Kind 1 is (anchor, fingerprint) of an
    anchor with over ``tile`` fingerprints, left for the tiles. No more than one
    anchor's ``tile`` rows are held between batches.
    """
    held_k, held_x, hot = np.empty(0, np.int64), np.empty(0, np.uint64), None

    def rows(kind, u, v):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(u), pa.array(v)], ["kind", "u", "v"])

    def finished(k, x):
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        sizes = np.repeat(np.diff(np.r_[starts, len(k)]), np.diff(np.r_[starts, len(k)]))
        big = sizes > tile
        if big.any():
            yield rows(1, k[big], x[big].view(np.int64))
        left, right = _pairs_in_runs(k[~big], x[~big], threshold) if not big.all() else ([], [])
        if left and sum(map(len, left)):
            u, v = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
            yield rows(0, pairs[0], pairs[1])

    for batch in batches:
        k = np.r_[held_k, batch.column(0).to_numpy(zero_copy_only=False)]
        x = np.r_[held_x, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
        if hot is not None and len(k):
            end = int(np.searchsorted(k, hot, "right"))
            if end:
                yield rows(1, k[:end], x[:end].view(np.int64))
            if end < len(k):
                hot = None
            k, x = k[end:], x[end:]
        cut = int(np.searchsorted(k, k[-1], "left")) if len(k) else 0
        if cut:
            yield from finished(k[:cut], x[:cut])
        held_k, held_x = k[cut:], x[cut:]
        if len(held_k) > tile:
            hot = int(held_k[0])
            yield rows(1, held_k, held_x.view(np.int64))
            held_k, held_x = held_k[:0], held_x[:0]
    if len(held_k):
        yield from finished(held_k, held_x)


def links_between_tiles(batches, threshold: int):
    """Arrow batches (group, side, fp), sorted by group and side, to links between side 0 and side 1, or inside side 0 alone."""
    held: list = []

    def close():
        if not held:
            return
        side, x = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        a, b = x[side == 0], x[side == 1]
        left, right = _between(a, b, threshold) if len(b) and len(a) else _grow(a, threshold) if len(a) else ([], [])
        if left:
            u, v = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])
        held.clear()

    for batch in batches:
        g, s, x = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        x = x.view(np.uint64)
        edges = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else []
        for a, b in zip(edges, [*edges[1:], len(g)], strict=True):
            if held and held[0][0] != g[a]:
                yield from close()
            held.append((g[a], s[a:b], x[a:b]))
    yield from close()


def _tiled(rows: DataFrame, hot: DataFrame, tile: int, threshold: int) -> DataFrame:
    """Links at the anchors in ``hot`` (anchor, n): tile i meets tile j in the task of (anchor, i, j)."""
    dealt = rows.join(hot, "anchor").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("fp", "anchor"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    met = dealt.select("anchor", "mine", "fp", other)
    group = F.xxhash64("anchor", F.least("mine", "other"), F.greatest("mine", "other"))
    sides = met.select(group.alias("g"), F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).cast("int").alias("side"), "fp")
    sides = sides.repartition("g").sortWithinPartitions("g", "side")
    return sides.mapInArrow(lambda it: links_between_tiles(it, threshold), "u long, v long")


def links(fps: DataFrame, threshold: int = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect all distinct ``fp`` within ``threshold`` bits (4 at most): their components are those of all such pairs."""
    if threshold > THRESHOLD:
        raise ValueError("the segments and anchors are laid out for 4 differing bits at most")
    rows = fps.mapInArrow(replicate, "anchor long, fp long").repartition("anchor").sortWithinPartitions("anchor")
    found = saved(rows.mapInArrow(lambda it: links_at_anchors(it, threshold, tile), "kind int, u long, v long"), "links")
    members = found.where("kind = 1").select(F.col("u").alias("anchor"), F.col("v").alias("fp"))
    hot = members.groupBy("anchor").agg(F.count("*").alias("n"))
    return found.where("kind = 0").select("u", "v").unionByName(_tiled(members, hot, tile, threshold)).distinct()


def classes(rows: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(rid, doc_id, fp, class) for every row of ``rows`` (rid, doc_id, text); equal classes are one group."""
    ship(rows.sparkSession)
    keyed = rows.select("rid", "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    with scratch(rows.sparkSession) as keep:
        prints = saved(keyed.mapInArrow(lambda it: fingerprints_of(it, shingle), f"rid long, doc_id {id_type}, fp long"), "fingerprints")
        roots = saved(components(links(prints.select("fp").distinct(), threshold)), "fingerprint-roots")
        # most fingerprints have no link; those that have lead to their root
        found = prints.join(roots, F.col("fp") == F.col("node"), "left").select("rid", "doc_id", "fp", F.coalesce("root", "fp").alias("class"))
        return keep(saved(found, "classes"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    A text without words, also null, has fingerprint 0 and links like any other.
    A row whose doc_id is null gets a fingerprint and its group's smallest id,
    and never names a group; a group of such rows alone has component_id null.
    Repeated rows are all returned.
    """
    rows = docs.select(F.lit(0).cast("long").alias("rid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    classed = classes(rows, shingle, threshold)
    # written first, so that the join deals both sides anew and Spark can split a class of very many rows
    least = saved(classed.groupBy("class").agg(F.min("doc_id").alias("component_id")), "class-ids")
    named = classed.join(least, "class")
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, classed=classes) -> DataFrame:
    """``docs`` (with doc_id and text) without all but one row of each group: a row with the group's smallest doc_id.

    ``classed`` gives rows (rid, doc_id, text) their class. Rows are told apart
    by a number of their own, so two rows with one doc_id, or with none, are two
    rows. A row whose doc_id is null stays only where no row of its group has one.
    """
    numbered = saved(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row_")), "numbered")
    with scratch(docs.sparkSession) as keep:
        judged = classed(numbered.select("rid", F.col("row_.doc_id").alias("doc_id"), F.col("row_.text").alias("text")))
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
        kept = keep(saved(judged.groupBy("class").agg(first.alias("first")).select("first.rid"), "kept-rows"))
    # both sides grow with the corpus, so it is a sort-merge join at any size
    return numbered.join(kept.hint("merge"), "rid", "left_semi").select("row_.*")


def op2_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
