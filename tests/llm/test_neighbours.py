import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import neighbours


def brute(vectors, queries, k=5):
    """{query: [(vec_id, score)]} over all pairs in double precision."""
    ids = np.array(list(vectors))
    x = np.array([vectors[i] for i in ids], float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    out = {}
    for q in queries:
        s = x @ x[np.flatnonzero(ids == q)[0]]
        order = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != q][:k]
        out[q] = order
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    got = result(neighbours.nearest(df, F.col("vec_id") % 50 == 0))
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.93 * sum(map(len, want.values()))
    for q, found in got.items():
        a = np.array(vectors[q], float)
        for i, s in found:
            b = np.array(vectors[i], float)
            assert s == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-12)


def test_the_scan_keeps_what_brute_force_finds():
    rng = np.random.default_rng(4)
    c, q = neighbours.unit(rng.normal(size=(5000, 64))), neighbours.unit(rng.normal(size=(40, 64)))
    turn = neighbours.rotation(64)
    found, _ = neighbours.scan(q @ turn, c @ turn, 5)
    want = np.argsort(-(q @ c.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found, want, strict=True)]) > 0.97


def test_copies_ties_and_unfit_vectors(spark):
    rng = np.random.default_rng(1)
    base = [rng.normal(size=8).tolist() for _ in range(40)]
    rows = [(i, base[i % 40], 1) for i in range(160)] + [(200 + i, base[0], 1) for i in range(300)]
    bad = [(900, None, 1), (950, [0.0] * 8, 1), (1000, [float("nan")] + [1.0] * 7, 1), (1050, [None] + [1.0] * 7, 1), (1100, [1.0, 2.0], 1), (None, base[1], 1)]
    schema = "vec_id long, embedding array<double>, score int"
    df = spark.createDataFrame(rows + bad, schema)
    got = result(neighbours.nearest(df, F.col("vec_id") % 50 == 0, recall=1.0))
    vectors = {i: v for i, v, _ in rows}
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    few = result(neighbours.nearest(spark.createDataFrame(rows[:3], schema), F.col("vec_id") == 0))
    assert [i for i, _ in few[0]] == [i for i, _ in brute({i: v for i, v, _ in rows[:3]}, [0])[0]]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_multiples_of_a_vector_tie_by_id(spark):
    rng = np.random.default_rng(5)
    one = rng.normal(size=16)
    rows = [(i, (one * (20 - i) * 0.37).tolist()) for i in range(20)] + [(100 + i, rng.normal(size=16).tolist()) for i in range(80)]
    got = result(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, recall=1.0))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    want = brute(dict(rows), [100, 150])
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in (100, 150))


def test_a_query_in_a_list_of_its_own_finds_enough(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(30, 32)) * 10
    rows = [(i, (centre[i % 29] + rng.normal(size=32) * 0.01).tolist()) for i in range(3000)] + [(3000, centre[29].tolist())]
    got = result(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 500 == 0))
    assert set(got) == set(range(0, 3001, 500)) and all(len(r) == 5 for r in got.values())


def test_queries_stream_past_chunks_however_batches_fall():
    rng = np.random.default_rng(7)
    import pyarrow as pa

    rows = [(lst, ch, 0, 1000 * lst + 100 * ch + i, rng.normal(size=8)) for lst in range(2) for ch in range(2) for i in range(30)]
    rows += [(lst, ch, 1, q, v) for q, v in enumerate(rng.normal(size=(5, 8))) for lst in range(2) for ch in range(2)]
    rows.sort(key=lambda r: r[:3])
    whole = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))] + [pa.array([r[4].tobytes() for r in rows])], ["list", "chunk", "side", "id", "v"])
    turn = neighbours.rotation(8)
    run = lambda step: sorted(x for b in neighbours.stream_scan((whole.slice(i, step) for i in range(0, whole.num_rows, step)), 8, 3, turn) for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
    want = run(1000)
    assert len(want) == 5 * 4 * 3 and all(run(step) == want for step in (1, 7, 33))
