import random

from pyspark.sql import functions as F

from eventweave.llm import line_dedup, substring_dedup

SCHEMA = "doc_id long, text string, rank int"


def passage(rng, sentences):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9)))
    return " ".join(" ".join([word().capitalize(), *(word() for _ in range(9))]) + "." for _ in range(sentences))


def brute_spans(rows, min_words):
    """Runs of units that an earlier document, or the same one before, has too."""
    first, out = {}, []
    for d, text, _ in sorted(((r[0], r[1] or "", r) for r in rows), key=lambda r: r[0]):
        run = []
        for s, e, norm in [*substring_dedup.units(text), (0, 0, None)]:
            if norm is not None and norm in first:
                run.append((s, e, len(norm.split()), first[norm]))
                continue
            if sum(u[2] for u in run if u[2] >= substring_dedup.FIRM) >= min_words:
                out.append((d, run[0][0], run[-1][1], len(run), sum(u[2] for u in run), min(u[3] for u in run)))
            run = []
            if norm is not None:
                first[norm] = d
    return sorted(out)


def test_spans_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sorted(tuple(r) for r in substring_dedup.repeated_spans(docs).collect())
    assert got == brute_spans([(r.doc_id, r.text) for r in docs.collect()], substring_dedup.MIN_WORDS)


def test_passages_pasted_into_lines_are_caught_and_clean_documents_left(spark):
    rng = random.Random(3)
    shared = passage(rng, 6)
    rows = []
    for d in range(40):
        words = passage(rng, 12).split(" ")
        if d % 4 == 0:
            at = rng.randint(1, len(words) - 1)
            words[at:at] = [shared]
        rows.append((d, " ".join(words), 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    spans = substring_dedup.repeated_spans(docs).collect()
    assert sorted(r.doc_id for r in spans) == [d for d in range(4, 40, 4)]
    assert {r.kept_doc_id for r in spans} == {0}
    for r in spans:
        assert rows[r.doc_id][1][r.span_start : r.span_end] == shared
    clean = {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).collect()}
    assert sum(shared in t for t in clean.values()) == 1
    assert all(clean[d] == t for d, t, _ in rows if d % 4)


def test_substring_edges(spark):
    text = passage(random.Random(1), 5)
    rows = [(1, None, 1), (2, "", 1), (3, text, 1), (3, text, 1), (None, text, 1), (4, text + "\n" + text, 1), (5, "ab cd ef gh. " * 100_000, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id or 0, r.span_start, r.kept_doc_id) for r in substring_dedup.repeated_spans(docs).collect())
    # the second row of document 3 repeats the first
    assert got == [(0, 0, 3), (3, 0, 3), (4, 0, 3), (5, 13, 5)]
    assert substring_dedup.without_repeats(docs).columns == ["doc_id", "text", "rank", "removed"]
    assert substring_dedup.repeated_spans(docs.limit(0)).count() == 0


def test_chunks_do_not_depend_on_what_stands_before(spark):
    rng = random.Random(4)
    body = "\n".join(passage(rng, 1) for _ in range(60))
    texts = [body, "\n".join(passage(rng, 1) for _ in range(7)) + "\n" + body]
    rows = line_dedup.chunk_rows(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    a, b = ({c.chunk for c in r.chunks} for r in sorted(rows, key=lambda r: r.doc_id))
    assert len(a & b) >= len(a) - 2
    for r, t in zip(sorted(rows, key=lambda r: r.doc_id), texts, strict=True):
        assert "\n".join(c.chunk for c in r.chunks) == t


def test_line_dedup_edges_and_texts(spark):
    rng = random.Random(5)
    body = "\n".join(passage(rng, 1) for _ in range(40))
    rows = [(1, None, 1), (2, "", 1), (3, body, 1), (3, body, 1), (4, body, 1), (None, body, 1), (5, "one line " * 50_000, 1), (6, "x\n" * 20_000, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("rank", "removed")
    out = line_dedup.repeated_chunks(docs.select("doc_id", "text")).collect()
    assert len(out) == len(rows)
    gone = {(r.doc_id, len(r.removed) > 0) for r in out}
    assert {(3, False), (4, True), (None, True), (1, False), (2, False), (5, False)} <= gone
    assert all(r.n_lines == 0 and r.n_chunks == 0 for r in out if r.doc_id == 1)
    clean = line_dedup.without_repeats(docs.where("doc_id <> 3"))
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[4] == body and texts[2] == "" and texts[1] is None and texts[5] == rows[6][1]
    assert line_dedup.repeated_chunks(docs.select("doc_id", "text").limit(0)).count() == 0
    assert line_dedup.without_repeats(docs.limit(0)).count() == 0


def test_every_removed_chunk_stays_somewhere(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    chunks = {(r.doc_id, c.first): c.chunk for r in line_dedup.chunk_rows(docs).collect() for c in r.chunks}
    removed = {(r.doc_id, x.first) for r in line_dedup.repeated_chunks(docs).select("doc_id", F.col("removed")).collect() for x in r.removed}
    kept = {t for k, t in chunks.items() if k not in removed}
    assert removed and all(chunks[k] in kept for k in removed)


def test_rows_with_one_id_or_none_keep_their_own_texts(spark):
    rng = random.Random(6)
    shared, other, third, fourth = (passage(rng, 4) for _ in range(4))
    rows = [(1, shared, 0), (None, shared, 1), (None, other, 2), (2, third, 3), (2, fourth, 4), (2, third + " " + other, 5), (None, other, 6)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("removed", F.lit("x")).repartition(3)
    clean = substring_dedup.without_repeats(docs)
    assert clean.columns == ["doc_id", "text", "rank", "removed"]
    texts = {r.rank: r.text.strip() for r in clean.collect()}
    assert texts[0] == shared and texts[1] == "" and texts[4] == fourth
    # of the two null rows and of the rows with id 2 the first in the table keeps the text, whichever that is
    assert sorted([texts[3], texts[5]], key=len)[0] == "" or texts[5] == ""
    left = " ".join(texts.values())
    assert all(left.count(t) == 1 for t in (shared, other, third, fourth))
    lines = [(None, "\n".join(passage(rng, 1) for _ in range(30)), k) for k in range(3)] + [(5, "\n".join(passage(rng, 1) for _ in range(30)), k) for k in (3, 4)]
    docs = spark.createDataFrame([*lines, (4, lines[0][1], 5)], SCHEMA)
    texts = {r.rank: r.text for r in line_dedup.without_repeats(docs).collect()}
    assert all(texts[k] == t for _, t, k in lines[1:]) and texts[5] == lines[0][1] and len(texts[0]) < len(lines[0][1]) / 2
