import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from eventweave.llm import mixing
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_near_copies import brute as groups

DIR = "/root/testdata/sf0.001"


def test_each_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DIR)
        if i < 4:
            assert out.columns == columns
        out.write.parquet(f"file://{tmp_path}/{i}")
        docs = spark.read.parquet(f"file://{tmp_path}/{i}")
        seen.append(docs.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    good, unique, clean, mixed, tokens = seen
    first = {r.doc_id for r in good}
    labelled = [d in first for d, q in labels.items() if q == 1]
    assert sum(labelled) >= 0.95 * len(labelled)
    assert sum(d in first for d, q in labels.items() if q == 0) <= 0.5 * sum(q == 0 for q in labels.values())
    assert sorted(r.doc_id for r in unique) == sorted(set(groups([(r.doc_id, r.text) for r in good]).values()))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    hit = {d: n for d, _, n, _, _ in hits([(r.doc_id, r.text) for r in unique], items)}
    # all items have 13 words and more, so no window of one may be left
    assert sorted(r.doc_id for r in clean) == sorted(d for d, n in hit.items() if n == 0)
    size = {r.doc_id: len(re.findall(mixing.WORD, r.text or "")) for r in clean}
    copies = Counter(r.doc_id for r in mixed)
    assert max(copies.values()) <= 2
    assert abs(sum(size[d] * n for d, n in copies.items()) - 1.5 * sum(size.values())) < 0.05 * sum(size.values())
    assert Counter(r.doc_id for r in tokens) == copies
    ordered = sorted(tokens, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in ordered)
    assert ordered[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:], strict=False))


def test_odd_rows_and_no_rows_pass_through_all_stages(spark, tmp_path):
    """Null ids, texts and sources, repeated rows, one very long text, and a column whose name an operator uses itself."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumn("size", F.lit("x"))
    long = " ".join(f"long{i % 9973}" for i in range(120_000))
    odd = [(None, "null id one two three", None, None, 1), (None, "other null id four five", "en", "a", 2), (1, "same id other text six seven", "en", None, 3)]
    odd += [(-1, None, None, None, None), (-2, "", "", "", 0), (-3, long, "en", "a", 9), (-4, "twice twice", "en", "b", 1), (-4, "twice twice", "en", "b", 1)]
    odd = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").withColumn("size", F.lit("y"))
    for name, rows in (("odd", docs.unionByName(odd)), ("none", docs.limit(0))):
        columns = rows.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, DIR)
            if i < 4:
                assert out.columns == columns
            out.write.parquet(f"file://{tmp_path}/{name}-{i}")
            before, rows = rows, spark.read.parquet(f"file://{tmp_path}/{name}-{i}")
            if i == 1 and name == "odd":
                had, left = ([(r.doc_id, r.text) for r in x.where("doc_id IS NULL OR doc_id < 0").collect()] for x in (before, rows))
                # no row with a text of its own is lost, and repeats and wordless rows leave one each
                assert {t for _, t in left if t} == {t for _, t in had if t} and len({t for _, t in left}) == len(left)
        assert (rows.count() == 0) == (name == "none")
