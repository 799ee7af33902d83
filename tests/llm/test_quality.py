import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import quality


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    return read("documents"), read("labels")


def test_radix_selection_is_exact(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 20) for _ in range(500)] + [3.5] * 40
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 30, 270, 539, 540):
        assert abs(quality.kth_largest(df, "x", k) - sorted(values)[-k]) < 1e-8
    assert quality.kth_largest(df, "x", 600) == -np.inf
    assert quality.kth_largest(df, "x", 0) is None


def test_counts_match_one_pass_in_memory(spark, tables):
    docs = tables[0].limit(200)
    want = sum(np.bincount(quality.ngrams(r.text), minlength=quality.BUCKETS) for r in docs.collect())
    assert (quality.counts(docs.repartition(5)) == want).all()


def test_held_out_accuracy(tables):
    docs, labels = tables
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    got = quality.resampled(docs, labels.where(~held)).join(labels.where(held), "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1]
    junk = [r.kept for r in got if r.quality == 0]
    assert len(good) > 80 and len(junk) > 10
    assert sum(good) >= 0.99 * len(good)
    assert sum(junk) <= 0.2 * len(junk)


def test_the_draw_is_a_top_k_of_noisy_odds_and_reruns_agree(tables):
    docs, labels = tables
    rows = quality.resampled(docs, labels).collect()
    assert len(rows) == docs.count()
    kept, left = [r.key for r in rows if r.kept], [r.key for r in rows if not r.kept]
    assert min(kept) > max(left)
    again = quality.resampled(docs.repartition(3), labels).collect()
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in again if r.kept}


def test_nulls_repeats_and_no_rows(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(None, "x"), (-1, None), (-2, ""), (-3, "word " * 300_000), (-4, "a"), (-4, "a")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd).withColumn("quality", F.lit(5)).withColumn("key", F.lit("k"))
    kept = quality.keep_good(both, labels)
    assert kept.columns == both.columns
    n = {r.doc_id: r["count"] for r in kept.where("doc_id < 0 or doc_id is null").groupBy("doc_id").count().collect()}
    assert n.get(-4, 2) == 2 and -3 not in n
    assert quality.keep_good(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_good(docs, labels.withColumn("quality", F.lit(None).cast("int"))).count() == docs.count()


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark, tables):
    docs, labels = tables
    judged = {r.doc_id: r for r in quality.resampled(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_odds = sorted(judged.values(), key=lambda r: r.log_odds)
    bad, good = texts[by_odds[0].doc_id], texts[by_odds[-1].doc_id]
    odd = spark.createDataFrame([(None, bad), (None, good), (-1, bad), (-1, good)], "doc_id long, text string")
    kept = quality.keep_good(docs.select("doc_id", "text").unionByName(odd), labels).where("doc_id is null or doc_id < 0")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(-1, good), (0, good)]


def test_weights_and_draw_against_a_plain_version(spark):
    rng = random.Random(4)
    good, junk = [f"g{i}" for i in range(12)], [f"j{i}" for i in range(12)]
    texts = {d: " ".join(rng.choices(good if d % 3 else junk, k=rng.randrange(20, 60)) + rng.choices(good + junk, k=10)) for d in range(400)}
    quality_of = {d: int(d % 3 > 0) for d in range(0, 400, 2)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame(list(quality_of.items()), "doc_id long, quality int")
    model = quality.target_model(docs, labels)
    count = lambda ids: np.sum([np.bincount(quality.ngrams(texts[d]), minlength=quality.BUCKETS) for d in ids], axis=0)
    smooth = lambda c: np.log((c + 0.5) / (c.sum() + 0.5 * quality.BUCKETS))
    want = smooth(count([d for d, q in quality_of.items() if q])) - smooth(count(texts))
    assert np.allclose(model["ratio"], want, atol=1e-12)
    rows = {r.doc_id: r for r in quality.resampled(docs, labels).collect()}
    uniform = {r.doc_id: r.u for r in docs.select("doc_id", quality.unit_uniform(F.lit(0), "doc_id").alias("u")).collect()}
    odds = {d: float(want.astype(np.float32)[quality.ngrams(t)].mean()) * model["slope"] + model["intercept"] for d, t in texts.items()}
    keys = {d: o - np.log(-np.log(uniform[d])) for d, o in odds.items()}
    assert all(abs(rows[d].log_odds - odds[d]) < 1e-4 and abs(rows[d].key - keys[d]) < 1e-4 for d in texts)
    k = sum(o >= 0 for o in odds.values())
    assert {d for d, r in rows.items() if r.kept} == set(sorted(keys, key=keys.get)[-k:]) and 0 < k < len(texts)
