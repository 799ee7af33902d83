import random

import numpy as np
import pyarrow as pa
import pytest

from eventweave.llm import jaccard_join, similar

SCHEMA = "size string, text string, doc_id long, class int"


def brute(rows):
    """[(doc_id, n_shingles, component_id)] by all pairs of sets of word tuples."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def got_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def joined(spark, rows, **more):
    return got_of(jaccard_join.similar_groups(spark.createDataFrame([("x", t, d, 1) for d, t in rows], SCHEMA).repartition(3), **more))


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def test_groups_chains_and_pairs_at_the_limit(spark):
    rng = random.Random(3)
    rows = []
    base = [f"b{i}" for i in range(200)]
    rows += [(k, edited(rng, base, rng.randrange(0, 9))) for k in range(120)]  # a group of near copies with outliers
    words = [f"c{i}" for i in range(150)]
    for k in range(12):  # a chain whose ends are unlike each other
        rows.append((1000 + k, " ".join(words)))
        words[k * 12] = f"chain{k}"
    for k in range(60):  # pairs a little above and below the limit
        words = [f"p{rng.randrange(9000)}" for _ in range(100)]
        rows += [(2000 + 2 * k, " ".join(words)), (2001 + 2 * k, edited(rng, words, rng.choice([1, 2, 3])))]
    line = " ".join(f"l{i}" for i in range(60))  # a passage that many texts share
    rows += [(3000 + k, line + " " + " ".join(f"own{k}x{i}" for i in range(rng.randrange(5, 60)))) for k in range(80)]
    # 4 of 5 shingles in common, exactly the limit, and 3 of 4
    rows += [(4000, "a b c d e f g h i"), (4001, "a b c d e f g h"), (4002, "q r s t u v w x"), (4003, "q r s t u v w")]
    rng.shuffle(rows)
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 100
    assert joined(spark, rows) == want
    assert joined(spark, rows, tile=20) == want


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7000}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\x0btwo"), (6, "two one"), (7, "a b c d e"), (7, "A B C D E"), (None, "a b c d e"), (None, "alone in the world now"), (8, "x"), (8, "x"), (9, "é É é É é"), (10, "É é É é É"), (11, long), (12, long + " end"), (13, long.upper())]
    assert joined(spark, rows) == brute(rows)
    assert joined(spark, []) == []
    assert joined(spark, [(5, None)]) == [(5, 0, 5)]


def test_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got_of(jaccard_join.op11_ngram_jaccard_join(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_similar_sets_share_a_shingle_of_their_prefixes():
    rng = np.random.default_rng(4)
    for n in range(1, 60):
        p = jaccard_join.prefix_length(n)
        assert p == n - -(-4 * n // 5) + 1
    for _ in range(300):
        common, own, other = rng.integers(1, 200), *rng.integers(0, 30, 2)
        h = rng.permutation(common + own + other)
        a, b = np.sort(h[: common + own]), np.sort(h[own:])
        if 5 * common < 4 * len(h):
            continue
        pa_, pb = (x[: jaccard_join.prefix_length(len(x))] for x in (a, b))
        shared = np.intersect1d(pa_, pb)
        assert len(shared)
        i, j = (int(np.flatnonzero(x == shared[0])[0]) for x in (a, b))
        assert jaccard_join.may_meet(len(a), i, len(b), j)


@pytest.mark.parametrize("crowd", [3, 4096])
def test_runs_are_met_whole_whatever_the_batches(monkeypatch, crowd):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    rng = np.random.default_rng(5)
    rows = sorted((int(k), 1, int(g), 50, int(rng.integers(0, 3))) for k, g in {(int(rng.integers(0, 12)), int(rng.integers(0, 40))) for _ in range(200)})
    batch = pa.RecordBatch.from_pylist([{"kind": 1, "key": k, "who": g, "size": n, "pos": p, "bits": None} for k, _, g, n, p in rows], pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("who", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()), ("bits", pa.binary())]))
    for step in (1, 7, 500):
        buckets = {}
        for out in jaccard_join.met(iter([batch.slice(a, step) for a in range(0, len(rows), step)])):
            for k, w in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), strict=True):
                buckets.setdefault(k, set()).add(w)
        found = {(a, b) for m in buckets.values() for a in m for b in m if a < b}
        want = {(a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[2] < b[2]}
        assert found == want


def test_words_hash_alike_whatever_the_slices(monkeypatch):
    text = b" x  hello\tworld  LONGER-than-a-slice \n a\x0bb\x0cC \xc2\xa0q " + b"y" * 40
    want = similar.word_hashes(text)
    assert len(want) == len(text.split())
    assert (similar.word_hashes(text.replace(b"LONGER", b"longer")) == want).all()
    for n in (1, 3, 16):
        monkeypatch.setattr(similar, "AT_ONCE", n)
        assert (similar.word_hashes(text) == want).all()
