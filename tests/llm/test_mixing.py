import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from eventweave.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2)):
    """Share out by weight, again and again, what is above twice a source's size."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        goal = {s: 2.0 * sizes[s] if s in full else left * weight[s] / w for s in order}
        above = {s for s in order if goal[s] > 2 * sizes[s]} - full
        if not above:
            return goal
        full |= above


def check(rows, near):
    sizes, taken, goal = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        goal[r.source] = r.target
        assert r.taken <= 2 * r.size
        assert r.size == 0 or r.taken % r.size == 0
    want = plain_targets(sizes)
    for s in sizes:
        assert abs(goal[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - goal[s]) <= near(s)
    assert all(r.source_size == sizes[r.source] for r in rows)


def test_documents_meet_their_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text")
    rows = mixing.mixture(docs).collect()
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == sizes
    check(rows, lambda s: 60)
    again = mixing.mixture(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_rounding_keeps_each_expectation(spark):
    rng = random.Random(2)
    items = [(i, "a" if i % 3 else None, i * 7919, rng.randint(1, 50)) for i in range(400)]
    items = [(i, s, h, n, n * 0.3) for i, s, h, n in items]
    df = spark.createDataFrame(items, "rid long, source string, h long, size long, mass double")
    runs, taken = 30, Counter()
    for seed in range(runs):
        got = {r.rid: r.one for r in mixing.rounded(df, seed, fan=8).collect()}
        assert len(got) == 400
        for i, s, _, n, _ in items:
            taken[i] += got[i]
        for s in ("a", None):
            want = sum(m for _, t, _, _, m in items if t == s)
            assert abs(sum(n * got[i] for i, t, _, n, _ in items if t == s) - want) <= 26
    share = sum(taken.values()) / (400 * runs)
    assert 0.27 < share < 0.33
    assert max(taken.values()) < runs and min(taken.values()) >= 0


def test_every_document_of_a_small_source_has_a_chance(spark):
    sizes = [90, 80, 75, 70, 64, 33, 31, 20, 12, 5, 4, 3]
    df = spark.createDataFrame([(i, "few", i * 7919, n, n * 0.4) for i, n in enumerate(sizes)], "rid long, source string, h long, size long, mass double")
    taken, runs = Counter(), 40
    for seed in range(runs):
        got = {r.rid: r.one for r in mixing.rounded(df, seed).collect()}
        assert abs(sum(n * got[i] for i, n in enumerate(sizes)) - 0.4 * sum(sizes)) <= 5
        taken.update(i for i, one in got.items() if one)
    assert all(0 < taken[i] < runs for i in range(9)) and 0.3 < sum(taken[i] for i in range(9)) / (9 * runs) < 0.5


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, None, "a b"), (1, None, "a b"), (None, "s", None), (2, "s", ""), (3, "t", " x\ty\x0b"), (None, "t", "q")] + [(9, "u", "w " * 9)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("copies", F.lit(1)).withColumn("target", F.lit("x"))
    got = mixing.mixture(docs).collect()
    assert len(got) == len(rows)
    check(got, lambda s: 9)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.source] += len((r.text or "").split())
    for s in {r.source for r in got}:
        assert words[s] == sum(r.taken for r in got if r.source == s)
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.limit(0)).count() == 0
