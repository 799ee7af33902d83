import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from eventweave.llm import components, near_copies, similar, simhash
from tests.llm.test_simhash import parts

DIR = "/root/testdata/sf0.001"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Smallest doc_id of each component over all pairs of texts alike in 0.8 or more."""
    ids, sets = [d for d, _ in rows], [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: least[find(i)] for i in range(len(rows))}


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"edit{rng.randrange(10**9)}"
    return " ".join(out)


def test_the_stage_drops_edited_copies_beyond_four_bits(spark):
    rng = random.Random(6)
    rows = []
    for g in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        # four single words of 200 changed: about 180 of 220 shingles in common
        rows += [(10 * g + 1, " ".join(words)), *((10 * g + k, edited(rng, words, 4)) for k in (2, 3))]
    prints = {d: simhash.fingerprint(t.encode()) for d, t in rows}
    assert sum((prints[10 * g + 1] ^ prints[10 * g + 2]).bit_count() > 4 for g in range(30)) > 20
    want = brute(rows)
    assert set(want.values()) == {10 * g + 1 for g in range(30)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, DIR)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_groups_against_brute_force(spark):
    rng = random.Random(7)
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    # chains whose ends are unlike each other, and pairs a little above and below the limit
    words = [f"c{i}" for i in range(150)]
    for k in range(12):
        rows.append((10_000 + k, " ".join(words)))
        words[k * 12] = f"chain{k}"
    for k in range(60):
        words = [f"p{rng.randrange(9000)}" for _ in range(100)]
        rows += [(20_000 + 2 * k, " ".join(words)), (20_001 + 2 * k, edited(rng, words, rng.choice([1, 2, 3])))]
    rows += [(30_000, None), (30_001, ""), (30_002, "a b"), (30_003, "A  b")]
    got = near_copies.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows)


@pytest.mark.parametrize("tile", [300, 1 << 21])
def test_buckets_of_one_template_with_unlike_members(spark, tile):
    rng = random.Random(8)
    base = [f"t{i}" for i in range(120)]
    rows = [(k, edited(rng, base, rng.randrange(1, 12))) for k in range(150)]
    docs = spark.createDataFrame([(d, d, t) for d, t in rows], "rid long, doc_id long, text string")
    got = {r.doc_id: r["class"] for r in near_copies.classes(docs, tile).collect()}
    want = brute(rows)
    assert 3 < len(set(want.values())) < 140
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    assert groups(got) == groups(want)


def test_a_group_of_near_copies_gives_fewer_edges_than_members(spark, monkeypatch):
    rng = random.Random(10)
    base = [f"n{i}" for i in range(200)]
    # ten groups of 2 as well, so that not all edges are of one group
    rows = [(k, edited(rng, base, 1)) for k in range(60)]
    for k in range(10):
        words = [f"o{k}x{i}" for i in range(90)]
        rows += [(100 + 2 * k, " ".join(words)), (101 + 2 * k, edited(rng, words, 1))]
    counts, real = [], near_copies.components

    def counted(edges):
        counts.append(edges.count())
        return real(edges)

    monkeypatch.setattr(near_copies, "components", counted)
    got = near_copies.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows)
    assert counts and all(n <= 59 + 10 for n in counts)


@pytest.mark.parametrize("room", [40, 1 << 20])
def test_a_forest_connects_what_its_edges_do(spark, monkeypatch, room):
    monkeypatch.setattr(components, "ROOM", room)
    rng = random.Random(11)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)]
    edges += [(1000 + i, 1000 + j) for i in range(40) for j in range(i)]
    table = spark.createDataFrame(edges, "u long, v long")
    got = [(r.u, r.v) for r in components.forest(table.repartition(7)).collect()]
    linked = [(u, v) for u, v in edges if u != v]
    assert parts(got) == parts(linked)
    nodes = len({x for e in linked for x in e})
    assert len(got) < (nodes if room > len(edges) else len(edges) - 500)
    batches = pa.Table.from_pylist([{"u": u, "v": v} for u, v in edges]).to_batches(max_chunksize=9)
    stars = [e for out in components.stars_of(batches) for e in zip(*(c.to_pylist() for c in out.columns), strict=True)]
    assert parts(stars) == parts(linked) and len(stars) < nodes
    assert components.forest(table.limit(0)).count() == 0


def test_hubs_and_lists_of_a_bucket_leave_no_link_out():
    rng = np.random.default_rng(9)
    for n in (5, 12, 40):
        for _ in range(30):
            sets = [np.unique(np.r_[np.arange(40), rng.integers(40, 60, rng.integers(0, 9))]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(n)]
            x = similar.Members.of(np.arange(n), rng.integers(0, 9, n), np.array([len(s) for s in sets]), [similar.sketch(s) for s in sets])
            alike = lambda i, j: 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))
            side = rng.integers(0, 2, n)
            for y in (None, 1):
                one, two = (x, None) if y is None else (x.take(side == 0), x.take(side == 1))
                if not len(one) or (two is not None and not len(two)):
                    continue
                links = {(i, j) for i in range(n) for j in range(i) if alike(i, j) and x.root[i] != x.root[j] and (two is None or side[i] != side[j])}
                every = {(max(e), min(e)) for e in zip(*(v.tolist() for v in similar.listed(one, two)), strict=True)}
                assert every >= links and all(x.root[i] != x.root[j] for i, j in every)
                some = {(max(e), min(e)) for e in zip(*(v.tolist() for v in similar.hubs(one, two)), strict=True)}
                assert some <= every and {i for e in every for i in e} == {i for e in some for i in e}
                assert len(some) <= (28 if two is None and n <= 8 else 2 * n)


def test_sketches_of_sets_of_all_sizes_bound_their_difference():
    rng = np.random.default_rng(13)
    sets = []
    for n in (3, 900, 1024, 1025, 5000, 6144, 6145, 20000):
        base = rng.integers(0, 1 << 63, n, np.uint64)
        sets += [np.unique(base), np.unique(np.r_[base[: n - n // 12], rng.integers(0, 1 << 63, n // 12, np.uint64)]), np.unique(np.r_[base[: n // 2], rng.integers(0, 1 << 63, n // 2, np.uint64)])]
    x = similar.Members.of(np.arange(len(sets)), np.arange(len(sets)), np.array([len(s) for s in sets]), [similar.sketch(s) for s in sets])
    found = similar.candidates(x, x)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            common = len(np.intersect1d(a, b))
            if i != j and 5 * common >= 4 * (len(a) + len(b) - common):
                assert found[i, j]
    assert found.sum() <= 2 * len(sets)  # halves of other shingles are told apart at every size
    part = x.take(np.arange(len(sets))[::-2])
    assert (similar.candidates(part, x) == found[::-2]).all()


@pytest.mark.parametrize("copies", [100, 200, 400])
def test_rows_for_a_group_of_near_copies_grow_with_its_size(copies):
    """One group (200 words, 1 to 8 edits): the edges of its anchors, and the pairs that are compared, are at most a constant times its members."""
    rng = random.Random(12)
    base = [f"n{i}" for i in range(200)]
    texts = [edited(rng, base, rng.randrange(1, 9)) for _ in range(copies)]
    sets = [near_copies.shingles(t.encode()) for t in texts]
    ids = pa.array(range(copies), pa.int64())
    rows = pa.RecordBatch.from_arrays([ids, pa.array([near_copies.fingerprint(s).tobytes() for s in sets]), pa.array([[] for _ in sets], pa.list_(pa.int64()))], ["sid", "print", "short"])
    at = pa.Table.from_batches(list(near_copies.replicate([rows], range(8)))).sort_by("anchor")
    edges = sum(b.num_rows for b in components.stars_of(near_copies.met_at_anchors(at.to_batches())))
    assert 0 < edges < copies
    x = similar.Members.of(np.arange(copies), np.arange(copies), np.array([len(s) for s in sets]), [similar.sketch(s) for s in sets])
    plain = [frozenset(s.tolist()) for s in sets]
    alike = lambda i, j: 5 * len(plain[i] & plain[j]) >= 4 * len(plain[i] | plain[j])
    compared = 0
    for step in (similar.hubs, similar.hubs, similar.listed):
        pairs = set(zip(*(v.tolist() for v in step(x, None)), strict=True))
        compared += len(pairs)
        for i, j in pairs:
            if alike(i, j):
                x.root[x.root == max(x.root[i], x.root[j])] = min(x.root[i], x.root[j])
    assert compared < 6 * copies
    got = dict(enumerate(x.root.tolist()))
    want = brute([(k, t) for k, t in enumerate(texts)])
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    assert groups(got) == groups(want)


def test_rows_are_told_apart_and_one_of_each_group_stays(spark):
    rows = [(None, "one two three four five six", 1), (None, "other words here that stand alone", 2), (7, "a b c d e f g", 3), (7, "h i j k l m n", 4), (7, "a b c d e f g", 5)]
    docs = spark.createDataFrame([*rows, (9, "One two three four five six", 6), (None, None, 7), (None, " ", 8)], "doc_id long, text string, class int")
    for classed in (near_copies.classes, simhash.classes):
        kept = simhash.keep_one(docs, classed)
        assert kept.columns == docs.columns
        got = sorted(r["class"] for r in kept.collect())
        assert got[:3] == [2, got[1], 4] and got[1] in (3, 5) and got[3] == 6 and got[4] in (7, 8) and len(got) == 5
    assert simhash.keep_one(docs.limit(0), near_copies.classes).count() == 0


def test_what_met_once_gives_no_edges_in_later_turns(spark, monkeypatch):
    r = random.Random(11)
    words = [f"w{r.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(200):
        own = list(words)
        for _ in range(2):
            own[r.randrange(len(own))] = f"x{r.randrange(9999)}"
        rows.append((i, " ".join(own)))
    made, real = [], near_copies.saved

    def counted(df, what):
        out = real(df, what)
        if what == "met":
            made.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "saved", counted)
    got = near_copies.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.component_id for x in got.collect()} == {0}
    assert sum(made[1:]) < len(rows) // 4
