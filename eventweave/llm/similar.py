"""Groups of texts whose shingle sets are similar, from buckets in which every similar pair meets.

Shared by the operators that judge texts by the Jaccard similarity of their word
shingles. They differ in how similar texts come to one bucket; from there on:

* A set has a parity sketch: bit b says whether an odd number of its shingles fall
  on b. Two sketches differ in no more bits than the sets differ in shingles, so a
  pair whose sketches differ in more than a similar pair may is no link. Large
  sets have wider sketches (``WIDTHS``), which fold to narrower ones. Sizes rule
  out others. What is left are candidates; no link is lost.
* Two rounds of hubs: in each bucket the member with most candidates is paired
  with them, then the one with most of those left, and so on. Their sets are
  compared, and what is similar becomes one root.
* Last, all candidates of different roots are compared. Of a large group of near
  copies only the few that might belong to another root are left by then, so the
  pairs do not grow with the square of a group.

Buckets with more than ``TILE`` members are dealt into tiles, whose pairs are
searched in separate tasks. Sets are sent to the tasks that compare them once for
each of up to ``FAN`` pairs, never for each bucket. Joins of two tables that both
grow with the corpus are sort-merge joins at every size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import UPPER, saved, tidy
from eventweave.llm.components import components, forest

SHINGLE = 5
#: The least similarity of a link, as numerator and denominator.
SIMILAR = (4, 5)
#: Bits of a sketch, by the largest set that has so few.
WIDTHS = ((1024, 1024), (4096, 6144), (16384, 1 << 62))
#: Members of a bucket, or of a tile of a larger one, in one task.
TILE = 4096
#: Members of a bucket whose candidates are all listed in the first round.
FEW = 3
#: Candidates compared with one set in one task.
FAN = 2048
#: Bytes of a text that are hashed at a time.
AT_ONCE = 1 << 20
FACTORS = np.random.default_rng(5).integers(0, 1 << 63, SHINGLE, np.uint64) << np.uint64(1) | np.uint64(1)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where(np.isin(np.arange(256), np.frombuffer(UPPER.encode(), np.uint8)), np.arange(256) + 32, np.arange(256))
#: A number for each byte, A-Z as a-z and white space 0, and one for each place and its inverse.
_BYTES = np.where(_SPACE, np.uint64(0), np.random.default_rng(6).integers(1, 1 << 63, 256, np.uint64)[_LOWER] << np.uint64(1) | np.uint64(1) * ~_SPACE)
_BASE = 0x9FB21C651E98DF25
_PLACES, _BACK = _powers(AT_ONCE, _BASE), _powers(AT_ONCE, pow(_BASE, -1, 1 << 64))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of the text, A-Z lower-cased: a polynomial of its bytes with random coefficients."""
    out, at, room = [], 0, AT_ONCE
    while at < len(text):
        part = np.frombuffer(text, np.uint8, min(room, len(text) - at), at)
        space = _SPACE[part]
        if at + len(part) < len(text):  # cut after white space
            last = np.flatnonzero(space[::-1])[:1]
            if not len(last):
                room *= 2
                continue
            part, space = part[: len(part) - last[0]], space[: len(part) - last[0]]
        at, room = at + len(part), AT_ONCE
        starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
        if not len(starts):
            continue
        part, starts = part[starts[0] :], starts - starts[0]
        places, back = (_PLACES, _BACK) if len(part) <= AT_ONCE else (_powers(len(part), _BASE), _powers(len(part), pow(_BASE, -1, 1 << 64)))
        h = np.add.reduceat(_BYTES[part] * places[: len(part)], starts) * back[starts]
        h ^= h >> np.uint64(32)
        out.append(h * np.uint64(0xD6E8FEB86659FD93))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's five-word shingles, A-Z lower-cased; one to four words are one shingle."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, SHINGLE - n, np.uint64)
    for i in range(n):
        out += h[i : i + len(out)] * FACTORS[i]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


def set_id(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64))


def sketch(hashes: np.ndarray) -> bytes:
    """The parity sketch of a set."""
    bits = next(w for w, most in WIDTHS if len(hashes) <= most)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sketches at a width: a row number for each of them, -1 if it is narrower, and their rows of 64-bit words."""
    wide = np.array([len(x) * 8 for x in sketches], np.int64)
    out = np.full(len(wide), -1)
    out[wide >= bits] = np.arange((wide >= bits).sum())
    rows = np.empty((int((wide >= bits).sum()), bits // 64), np.uint64)
    for w in np.unique(wide[wide >= bits]):
        own = np.frombuffer(b"".join(x for x in sketches if len(x) * 8 == w), np.uint64).reshape(-1, int(w) // bits, bits // 64)
        rows[out[wide == w]] = np.bitwise_xor.reduce(own, axis=1)
    return out, rows


def alike(common, a, b):
    """common / (a + b - common) at least the limit, in whole numbers."""
    return common * (SIMILAR[0] + SIMILAR[1]) >= (a + b) * SIMILAR[0]


def least_common(a, b):
    """The fewest shingles that two similar sets of these sizes share."""
    return -(-(a + b) * SIMILAR[0] // (SIMILAR[0] + SIMILAR[1]))


class Members:
    """Columns of a bucket's members; ``wide`` has the sketches at each width beyond the least."""

    def __init__(self, sid, root, size, bits, wide=()):
        self.sid, self.root, self.size, self.bits, self.wide = sid, root, size, bits, wide

    @classmethod
    def of(cls, sid, root, size, sketches: list[bytes]) -> Members:
        return cls(sid, root, size, folded(sketches, WIDTHS[0][0])[1], [folded(sketches, w) for w, _ in WIDTHS[1:]])

    def __len__(self):
        return len(self.sid)

    def take(self, at) -> Members:
        return Members(self.sid[at], self.root[at], self.size[at], self.bits[at], [(place[at], rows) for place, rows in self.wide])


def _apart(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many bits the rows i of x and j of y differ."""
    out = np.zeros(len(i), np.int64)
    step = max(1, (1 << 19) // max(1, x.shape[1]))
    for at in range(0, len(i), step):
        s = slice(at, at + step)
        out[s] = np.bitwise_count(x[i[s]] ^ y[j[s]]).sum(axis=1, dtype=np.int64)
    return out


def candidates(x: Members, y: Members) -> np.ndarray:
    """For each of x and y whether they may be similar and have different roots."""
    out = x.root[:, None] != y.root
    out &= np.minimum(x.size[:, None], y.size) >= least_common(x.size[:, None], y.size)
    i, j = np.nonzero(out)
    most = x.size[i] + y.size[j] - 2 * least_common(x.size[i], y.size[j])
    may = _apart(x.bits, y.bits, i, j) <= most
    for (place_x, rows_x), (place_y, rows_y) in zip(x.wide, y.wide, strict=True):
        both = np.flatnonzero(may & (place_x[i] >= 0) & (place_y[j] >= 0))
        may[both] = _apart(rows_x, rows_y, place_x[i[both]], place_y[j[both]]) <= most[both]
    out[i, j] = may
    return out


def _blocks(x: Members, y: Members):
    for at in range(0, len(x), 256):
        yield at, candidates(x.take(slice(at, at + 256)), y)


def listed(x: Members, y: Members | None) -> tuple[np.ndarray, np.ndarray]:
    """All candidate pairs between x and y, or inside x."""
    left, right = [], []
    for at, found in _blocks(x, x if y is None else y):
        i, j = np.nonzero(found)
        i += at
        if y is None:
            i, j = i[i < j], j[i < j]
        left.append(x.sid[i])
        right.append((x if y is None else y).sid[j])
    return np.concatenate(left), np.concatenate(right)


def hubs(x: Members, y: Members | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the members of x with most candidates in y (or x) and these: each of y is paired with one hub, each of x with one of y."""
    if y is None and len(x) <= FEW:
        return listed(x, None)
    other = x if y is None else y
    found = np.concatenate([f for _, f in _blocks(x, other)])
    free = np.ones(len(other), bool)
    count = found.sum(axis=1)
    left, right, alone = [], [], count > 0

    def nearest(i, js):
        return js[np.bitwise_count(other.bits[js] ^ x.bits[i]).sum(axis=1, dtype=np.int64).argmin()]

    while count.any():
        hub = int(count.argmax())
        mine = found[hub] & free
        met = np.flatnonzero(found[hub] & ~free)
        pick = np.flatnonzero(mine)
        if len(met):
            pick = np.r_[pick, nearest(hub, met)]  # so that hubs of one group are linked
        left.append(np.full(len(pick), x.sid[hub]))
        right.append(other.sid[pick])
        if y is None:
            mine[hub] = free[hub]  # it stands in these pairs itself
        free &= ~mine
        alone[hub] = False
        count -= found[:, mine].sum(axis=1)
    if y is not None:
        rest = np.flatnonzero(alone)
        left.append(x.sid[rest])
        right.append(y.sid[[nearest(i, np.flatnonzero(found[i])) for i in rest]] if len(rest) else y.sid[:0])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def bucket_pairs(batches, every: bool):
    """Arrow batches (g, side, sid, root, size, bits) sorted by g to candidate pairs (u, v): all of different roots, or hubs."""
    held: list = []

    def close():
        side, sid, root, size = (np.concatenate(c) for c in zip(*(h[:4] for h in held), strict=True))
        x = Members.of(sid, root, size, [b for h in held for b in h[4]])
        held.clear()
        if not (x.root != x.root[0]).any():
            return None
        two = side.any() and not side.all()
        u, v = (listed if every else hubs)(x.take(side == 0) if two else x, x.take(side == 1) if two else None)
        return (np.minimum(u, v), np.maximum(u, v)) if every else (u, v)  # a hub's set is sent once

    def batch_of(found):
        found = [f for f in found if f is not None and len(f[0])]
        if found:
            pairs = np.unique(np.stack([np.concatenate(c) for c in zip(*found, strict=True)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    last = None
    for b in batches:
        if not b.num_rows:
            continue
        g, side, sid, root, size = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5))
        bits = b.column(5).to_pylist()
        cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
        found = []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if held and g[s] != last:
                found.append(close())
            last = g[s]
            held.append(tuple(c[s:e] for c in (side, sid, root, size, bits)))
        yield from batch_of(found)
    if held:
        yield from batch_of([close()])


def in_buckets(buckets: DataFrame, facts: DataFrame, roots: DataFrame | None, every: bool, tile: int = TILE) -> DataFrame:
    """Candidate pairs (u, v) of different roots in ``buckets`` (bucket, sid), with ``facts`` (sid, size, bits): hubs' pairs, or all."""
    rows = buckets
    if roots is None:
        rows = rows.withColumn("root", F.col("sid"))
    else:
        rows = rows.join(roots.hint("merge"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rows = saved(rows.select("bucket", "sid", "root"), "bucket-roots")
    many = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low <> high")
    many = saved(many.select("bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "open-buckets")
    dealt = rows.hint("merge").join(many, "bucket").withColumn("mine", F.pmod(F.xxhash64("sid", "bucket"), F.col("tiles")).cast("int"))
    dealt = dealt.hint("merge").join(facts, "sid")
    # one row goes to one task, but for the tiles of a large bucket
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    group = F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other"))
    side = F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).cast("int")
    sides = met.select(group.alias("g"), side.alias("side"), "sid", "root", "size", "bits").repartition("g").sortWithinPartitions("g")
    return saved(sides.mapInArrow(lambda it: bucket_pairs(it, every), "u long, v long").distinct(), "candidates")


def _set(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64) if value.is_valid else np.empty(0, np.uint64)


def compared(batches):
    """Arrow batches (u, v, part, hashes) sorted by u, part and v to the links (u, v): hashes are v's, and u's own where v is null, which comes first."""
    own = np.empty(0, np.uint64)
    for batch in batches:
        us, vs = [], []
        for u, v, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
            found = _set(h)
            if v is None:
                own = found.copy()
            elif len(own) and len(found):
                at = np.searchsorted(own, found)
                at[at == len(own)] = 0
                if alike(int((own[at] == found).sum()), len(own), len(found)):
                    us.append(u)
                    vs.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) whose ``sets`` (sid, hashes) are similar; the set of u is sent once for up to ``FAN`` of its pairs."""
    parts = saved(pairs.groupBy("u").agg(F.ceil(F.count("*") / FAN).cast("int").alias("parts")), "heads")
    own = parts.hint("merge").join(sets, F.col("u") == F.col("sid"))
    own = own.select("u", F.lit(None).cast("long").alias("v"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "hashes")
    others = pairs.hint("merge").join(parts, "u").hint("merge").join(sets, F.col("v") == F.col("sid"))
    others = others.select("u", "v", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), "hashes")
    rows = own.unionByName(others).repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())
    return saved(rows.mapInArrow(compared, "u long, v long"), "similar-pairs")


def joined(found: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(sid, root) of all that the links (u, v) connect, together with roots found before."""
    if roots is not None:
        found = found.unionByName(roots.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    return saved(components(forest(found)), "set-roots").withColumnRenamed("node", "sid")


#: Rows of places (two longs each) that are broadcast at most; more meet the texts in a sort-merge join.
SENT_ROWS = 1 << 20


def texts_at(texts: DataFrame, places: DataFrame, column: str) -> DataFrame:
    """The rows of ``texts`` whose ``column`` is among ``places``: a small table is sent to the texts, else both are shuffled."""
    wanted = saved(places.select(column).distinct(), "places")
    few = wanted.count() <= SENT_ROWS
    return texts.join(F.broadcast(wanted) if few else wanted.hint("merge"), column, "left_semi")


def connected(buckets: DataFrame, facts: DataFrame, sets_of, tile: int = TILE) -> DataFrame:
    """(sid, root) of every set that is similar to another.

    Every similar pair must meet in ``buckets`` (bucket, sid), with ``facts``
    (sid, size, bits) for all of them. ``sets_of`` gives the sets (sid, hashes) of
    a table (sid): it is asked for those alone that have a candidate, since in the
    first round each of them is in a pair.
    """
    pairs = in_buckets(buckets, facts, None, False, tile)
    wanted = saved(pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct(), "sets-with-candidates")
    sets = saved(sets_of(wanted), "sets")
    tidy(buckets.sparkSession)
    roots = joined(links(pairs, sets))
    some = saved(buckets.join(wanted.hint("merge"), "sid", "left_semi").select("bucket", "sid"), "buckets-with-candidates")
    known = saved(facts.join(wanted.hint("merge"), "sid", "left_semi").select("sid", "size", "bits"), "facts-with-candidates")
    roots = joined(links(in_buckets(some, known, roots, False, tile), sets), roots)
    return joined(links(in_buckets(some, known, roots, True, tile), sets), roots)
