import re

import pytest
from pyspark.sql import functions as F

from eventweave.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, n=13):
    out = []
    for d, text in docs:
        ws, hit, ids = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            k = min(n, len(iw))
            wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k and item is not None else set()
            for i in range(len(ws) - k + 1):
                if tuple(ws[i : i + k]) in wins:
                    hit.update(range(i, i + k))
                    ids.add(str(item))
        out.append((d, len(ws), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


ITEMS = [(1, "a b c d e f g h i j k l m n o"), (2, "short one"), (10, "É x"), (3, None), (4, "..."), (None, "p q r"), (2, "short one"), (5, "b c d e f g h i j k l m n"), (6, "solo")]
DOCS = [
    (1, "z A B c, d e f g h i j k l m n o A b c"), (2, "a short ONE, short one"), (3, "É x é X"), (4, None), (5, ""), (6, "..."), (7, "solo solo"),
    (8, "p q r"), (None, "Short, one"), (2, "a short ONE, short one"), (9, "w " * 50_000 + "a b c d e f g h i j k l m n o"),
]


@pytest.mark.parametrize("block", [200, 16 << 20])
def test_against_brute_force(spark, block):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(docs, items, block_bytes=block).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items), r.contaminated) for r in got), key=str) == brute(DOCS, ITEMS)
    assert all(r.n_items == len(r["items"]) for r in got)


def test_documents_and_spans_go(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("items", F.lit(7)).withColumn("n_words", F.lit("x"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 8, 9]
    strict = decontaminate.remove_documents(docs, items, whole_windows=True)
    assert sorted(r.doc_id for r in strict.collect()) == [4, 5, 6, 8]
    spans = decontaminate.remove_spans(docs, items)
    assert spans.columns == docs.columns
    texts = {r.doc_id: r.text for r in spans.collect()}
    assert words(texts[1]) == ["z", "a", "b", "c"] and words(texts[2]) == ["a"] and texts[8] == "p q r" and texts[4] is None
    assert all(b[2] == 0 for b in brute([(d, t) for d, t in texts.items() if d not in (1,)], ITEMS))


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}
