import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import simhash


def brute(prints):
    """Smallest doc_id of each component, over all pairs."""
    ids = [d for d, _ in prints]
    x = np.array([f for _, f in prints], np.uint64)
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 4):
            root[find(i)] = find(int(j))
    least = {}
    for i in range(len(x)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: least[find(i)] for i in range(len(x))}


def near(rng, x, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        x ^= 1 << b
    return x


def test_every_pair_within_four_bits_shares_an_anchor():
    rng = random.Random(1)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = near(rng, a, 4)
        keys = [set(simhash.anchors(np.array([v], np.uint64))[0].tolist()) for v in (a, b)]
        assert keys[0] & keys[1]


@pytest.mark.parametrize("tile", [8, 4096])
def test_links_give_the_components_of_all_pairs(spark, tile):
    rng = random.Random(tile)
    values = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            x = near(rng, x, 3)
            values.add(x)
    values = sorted(values)
    want = brute(list(enumerate(values)))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, tile=tile)).collect()}
    got = {i: roots.get(v, v) for i, v in enumerate(signed)}
    same = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    assert same(got) == same(want)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = simhash.near_duplicates(docs).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    prints = {d: simhash.fingerprint(t.encode()) for d, t in texts.items()}
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in rows)
    assert {r.doc_id: r.component_id for r in rows} == brute(list(prints.items()))


def test_fingerprint_is_the_majority_of_spark_hashes(spark):
    text = "Ab cÉ d  e\tab cÉ D f\n"
    words = [w for w in text.translate(str.maketrans("ABCD", "abcd")).split() if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    hashes = [r[0] & (1 << 64) - 1 for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert simhash.fingerprint(text.encode()) == want


def test_edges_of_the_input(spark):
    long = "word%d " * 1
    rows = [(1, None, 7), (2, "", 7), (3, "a b", 7), (3, "a b", 7), (None, "a b", 7), (5, " ".join(long % i for i in range(200_000)), 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = sorted(((r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()))
    assert len(got) == 6
    assert {c for d, f, c in got if f == "0" * 16} == {1}
    assert {c for d, f, c in got if d in (0, 3)} == {3}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def parts(pairs):
    """The sets of values that pairs connect."""
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for u, v in pairs:
        root[find(u)] = find(v)
    return {frozenset(v for v in root if find(v) == r) for r in {find(v) for v in root}}


@pytest.mark.parametrize("size", [2, 20, 100, 300])
def test_links_between_two_tiles_connect_what_all_pairs_do(size):
    rng = np.random.default_rng(size)
    tiles = [([0xF << 40, 0xF], [0xFF, 0x0])]
    tiles += [np.array_split(rng.permutation(np.unique(rng.integers(0, 1 << 22, 2 * size, np.uint64))), 2) for _ in range(20)]
    for x, y in tiles:
        x, y = np.array(x, np.uint64), np.array(y, np.uint64)
        left, right = simhash._between(x, y, 4)
        got = list(zip(np.concatenate(left).tolist(), np.concatenate(right).tolist(), strict=True)) if left else []
        every = [(int(u), int(v)) for u in x for v in y[np.bitwise_count(y ^ u) <= 4]]
        assert parts(got) == parts(every)
        assert all((u ^ v).bit_count() <= 4 for u, v in got)
        assert len(got) == sum(len(p) - 1 for p in parts(every))
