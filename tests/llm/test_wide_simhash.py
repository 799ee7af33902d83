import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from eventweave.llm import near_copies


def met(sets, segments=range(near_copies.SEGMENTS)):
    """The pairs of indexes that meet at the anchors of ``segments`` and are candidates."""
    prints = [near_copies.fingerprint(s).tobytes() for s in sets]
    short = pa.array([near_copies.short_keys(s) for s in sets], pa.list_(pa.int64()))
    ids = pa.array(range(len(sets)), pa.int64())
    rows = pa.RecordBatch.from_arrays([ids, pa.array(prints, pa.binary()), short], ["sid", "print", "short"])
    found = set()
    for s in segments:
        at = pa.Table.from_batches(list(near_copies.replicate([rows], [s]))).sort_by("anchor")
        for out in near_copies.met_at_anchors(at.to_batches(max_chunksize=997)):
            found |= {(min(e), max(e)) for e in zip(*(c.to_pylist() for c in out.columns), strict=True)}
    return found


def test_numbers_within_two_bits_share_a_code_word():
    rng = np.random.default_rng(1)
    for _ in range(500):
        x = int(rng.integers(0, 1 << 31))
        y = x ^ sum(1 << int(b) for b in rng.choice(31, rng.integers(0, 3), replace=False))
        words = [set(near_copies.anchors(np.array([v], np.uint32))[0].tolist()) for v in (x, y)]
        assert words[0] & words[1]


def test_a_fingerprint_is_the_majority_of_its_shingles():
    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 9, 254, 255, 256, 700):
        hashes = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        plain = lambda x: np.unpackbits(near_copies.fingerprint(x).view(np.uint8), bitorder="little").astype(int)
        ones = [plain(h[None]) for h in hashes]
        total = 2 * sum(ones) - n
        want = np.where(total == 0, near_copies.TIES, total > 0)
        assert (plain(hashes) == want)[np.arange(len(want)) % 32 < 31].all()


@pytest.mark.parametrize("own, other, common", [(0, 1, 4), (1, 1, 8), (0, 2, 8), (0, 1, 8), (5, 5, 40), (20, 20, 160), (0, 40, 160)])
def test_simhash_brings_pairs_of_the_least_similarity_together(own, other, common):
    assert common * 5 >= (own + other + common) * 4
    rng = np.random.default_rng(common)
    sets = []
    for _ in range(300):
        h = rng.integers(0, 1 << 63, own + other + common, np.uint64)
        sets += [np.unique(h[: own + common]), np.unique(h[own:])]
    want = {(2 * k, 2 * k + 1) for k in range(300)}
    found = met(sets)
    assert found >= want and len(found) < 2 * len(want)


def test_the_stage_takes_its_candidates_from_simhash_anchors(spark, monkeypatch):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:99], "other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turns = []
    real = near_copies._met

    def without(groups, segments):
        turns.append(segments)
        return real(groups, segments[:1]).where("false")

    monkeypatch.setattr(near_copies, "_met", without)
    assert corpus_pipeline.keep_one_of_each_group(spark, docs, "").count() == 2
    assert [s for turn in turns for s in turn] == list(range(near_copies.SEGMENTS))
