import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import toxicity


def test_marginals_against_all_paths():
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(2, 2))
    lengths = np.array([1, 5, 0, 7, 2, 8])
    e = rng.normal(size=lengths.sum()) * 2
    got, at = toxicity.document_marginals(e, lengths, trans), 0
    for n in lengths:
        total, one = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            s = sum(e[at + i] for i in range(n) if tags[i]) + sum(trans[a, b] for a, b in itertools.pairwise(tags))
            total += math.exp(s)
            one += math.exp(s) * np.array(tags)
        assert np.allclose(got[at : at + n], one / total)
        at += n


def test_windows_do_not_show():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 3 * toxicity.WINDOW + 17, 40, toxicity.WINDOW + 1])
    e, trans = rng.normal(size=lengths.sum()) * 3 - 3, np.array([[0.0, -1.0], [-1.0, 2.0]])
    assert np.allclose(toxicity.document_marginals(e, lengths, trans), toxicity.marginals(e, lengths, trans), atol=1e-9)


def test_windows_and_pairs_are_exact_where_memory_is_long(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(toxicity, "WINDOW", 7)
    lengths = np.array([3, 29, 0, 7, 8, 100])
    for trans in (np.array([[0.0, -6.0], [-6.0, 0.0]]), np.array([[0.0, -3.0], [-3.0, 3.0]]), rng.normal(size=(2, 2)) * 3):
        e = rng.normal(size=lengths.sum()) * 0.01
        want, got = np.zeros((2, 2)), np.zeros((2, 2))
        a, b = toxicity.marginals(e, lengths, trans, pairs=want), toxicity.document_marginals(e, lengths, trans, got)
        assert np.allclose(a, b, atol=1e-12) and np.allclose(want, got, atol=1e-9)
        assert abs(want.sum() - sum(max(n - 1, 0) for n in lengths)) < 1e-9


def test_expected_pairs_against_all_paths():
    rng = np.random.default_rng(3)
    trans, e = rng.normal(size=(2, 2)), rng.normal(size=6)
    got, want, total = np.zeros((2, 2)), np.zeros((2, 2)), 0.0
    toxicity.marginals(e, np.array([6]), trans, pairs=got)
    for tags in itertools.product((0, 1), repeat=6):
        w = math.exp(sum(e[i] for i in range(6) if tags[i]) + sum(trans[a, b] for a, b in itertools.pairwise(tags)))
        total += w
        for a, b in itertools.pairwise(tags):
            want[a, b] += w
    assert np.allclose(got, want / total)


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    return read("documents").select("doc_id", "text"), read("labels")


def test_held_out_accuracy_and_spans(spark, tables):
    docs, labels = tables
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = toxicity.model_for(docs, labels.select("doc_id", "toxic"), held)
    got = toxicity.scored(docs.join(labels.where(held), "doc_id"), model, spans=True).collect()
    y, s = np.array([r.toxic for r in got]), np.array([r.score for r in got])
    rank = s.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.93  # some toxic labels here have no toxic word
    assert ((s >= 0.5) == (y == 1)).mean() > 0.97
    texts = {r.doc_id: r.text for r in docs.join(labels, "doc_id").collect()}
    marked = [texts[r.doc_id][x.start : x.end] for r in got if r.toxic for x in r.spans]
    assert marked and all(w.strip() for w in marked)
    assert sum(len(r.spans) > 0 for r in got if r.toxic) > 0.8 * y.sum()


def test_spans_are_offsets_of_the_text():
    text = "İİ bad word\nİ end bad"
    m = np.array([0, 0.9, 0.8, 0, 0, 0.7][: len(toxicity.WORD.findall(text.lower()))])
    words = toxicity.WORD.findall(text.lower())
    m = np.array([0.9 if w in ("bad", "word") else 0.0 for w in words])
    assert [text[s["start"] : s["end"]] for s in toxicity._spans(text, m)] == ["bad word", "bad"]


def test_nulls_long_texts_one_class_and_no_rows(spark, tables):
    docs, labels = tables
    few = docs.limit(300)
    model = toxicity.model_for(few, labels)
    odd = [(None, "you idiot", 1), (-1, None, 1), (-2, "", 1), (-2, "", 1), (-3, "word " * 400_000, 1)]
    out = toxicity.scored(spark.createDataFrame(odd, "doc_id long, text string, score int").drop("score"), model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    clash = spark.createDataFrame([(1, "a text", 7, "x")], "doc_id long, text string, score int, spans string")
    assert toxicity.scored(clash, model, spans=True).columns == ["doc_id", "score", "spans"]
    none = toxicity.model_for(docs, labels.limit(0))
    assert {r.score for r in toxicity.scored(few, none).collect()} == {0.0}
    clean = toxicity.model_for(docs, labels.withColumn("toxic", F.lit(0)))
    assert {r.score for r in toxicity.scored(few, clean).collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), model).count() == 0
