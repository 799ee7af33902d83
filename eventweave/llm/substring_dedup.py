"""Substring dedup by hashed units.

A text's units are its lines, cut further after sentence ends and before a
capital that begins a word, so that a passage pasted into the middle of a line
is cut like the original. A unit of more than ``LONG`` words is cut further after
words that a hash of the word alone chooses, so that an edit inside a long
sentence spoils only its neighbourhood. Units are normalised (lower case, single
spaces) and hashed to 96 bits. For every digest in the corpus the earliest
document (by doc_id) keeps it; every later occurrence repeats it. Repeating units
that stand side by side form runs, and a run is removed, with its offsets in the
original text, if its units of ``FIRM`` words or more have ``min_words`` words.
Lesser runs are chance or common phrases.

A digest's grouping is combined on the map side, so a line that all documents
share costs one row a task; marking occurrences is a join that Spark splits
where one digest has very many rows.

Nulls: null and empty texts have no units; a null doc_id ranks last. Rows are
told apart by a number of their own: of rows with equal doc_id, or without one,
the earlier row of the table keeps a unit and the later ones repeat it.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, ship, table

MIN_WORDS = 20
FIRM = 4
LONG = 12
LAST = (1 << 63) - 1
CUT = regex.compile(r"\n|(?<=[.!?])\s|\s(?=\p{Lu}\p{Ll}|\p{Lu}\s)")


WORD = re.compile(r"\S+")


def _parts(text: str, at: int, end: int):
    words = text[at:end].lower().split()
    if len(words) <= LONG:
        if words:
            yield at, end, " ".join(words)
        return
    first = 0
    for i, m in enumerate(WORD.finditer(text, at, end)):
        if i + 1 == len(words):
            yield at, end, " ".join(words[first:])
        elif zlib.crc32(words[i].encode("utf-8", "surrogatepass")) % LONG == 0:
            yield at, m.end(), " ".join(words[first : i + 1])
            first, at = i + 1, m.end() + 1


def units(text: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised) of each unit that has a word."""
    out, at = [], 0
    for m in CUT.finditer(text):
        out.extend(_parts(text, at, m.start()))
        at = m.end()
    out.extend(_parts(text, at, len(text)))
    return out


def unit_batches(batches):
    """(rid, rank, text) to a row for each unit; ``again`` if an earlier unit of the same text is equal."""
    names = ["rid", "rank", "pos", "start", "end", "words", "h1", "h2", "again"]
    for b in batches:
        rows = [[] for _ in names]
        held = 0
        for rid, rank, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            seen = set()
            for pos, (start, end, norm) in enumerate(units(x.as_py() or "")):
                h = xxhash.xxh3_128_intdigest(norm.encode("utf-8", "surrogatepass"))
                for col, v in zip(rows, (rid, rank, pos, start, end, norm.count(" ") + 1, h >> 64, h & (1 << 32) - 1, h in seen), strict=True):
                    col.append(v)
                seen.add(h)
            held = len(rows[0])
            if held >= 50_000:
                yield _batch(rows, names)
                rows = [[] for _ in names]
        if rows[0]:
            yield _batch(rows, names)


def _batch(rows, names):
    kinds = [np.int64, np.int64, np.int32, np.int32, np.int32, np.int32]
    cols = [pa.array(np.array(c, k)) for c, k in zip(rows[:6], kinds, strict=True)]
    cols += [pa.array(np.array(rows[6], np.uint64).view(np.int64)), pa.array(np.array(rows[7], np.uint32).view(np.int32))]
    return pa.RecordBatch.from_arrays([*cols, pa.array(rows[8], pa.bool_())], names)


def row_spans(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(rid, rank, span_start, span_end, n_units, n_words, kept) of ``rows`` (rid, doc_id, text); ranks are doc_ids, ``LAST`` for null."""
    ship(rows.sparkSession)
    with scratch(rows.sparkSession) as keep:
        return keep(saved(_runs(rows, min_words), "spans"))


def _runs(rows: DataFrame, min_words: int) -> DataFrame:
    ranked = rows.select("rid", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"), "text")
    schema = "rid long, rank long, pos int, start int, `end` int, words int, h1 long, h2 int, again boolean"
    all_units = saved(ranked.mapInArrow(unit_batches, schema), "units")
    kept = all_units.groupBy("h1", "h2").agg(F.min("rank").alias("kept"), F.count("*").alias("n"))
    repeated = saved(kept.where("n > 1").select("h1", "h2", "kept"), "repeated-units")
    # the digest alone leads back to every occurrence; an equal unit before it in its own text, or in an earlier document, makes it a repeat
    met = all_units.join(repeated, ["h1", "h2"])
    columns = ["rid", "rank", "pos", "start", "end", "words", "kept"]
    marked = met.where("rank > kept OR again").select(*columns)
    # ranks that several rows have; none where doc_ids are unique
    several = saved(all_units.groupBy("rank").agg(F.min("rid").alias("low"), F.max("rid").alias("high")).where("low < high").select("rank"), "shared-ranks")
    if not several.isEmpty():
        own = met.where("rank = kept AND NOT again").join(several, "rank", "left_semi")
        first = saved(own.groupBy("h1", "h2").agg(F.min("rid").alias("first")), "first-rows")
        marked = marked.unionByName(own.join(first, ["h1", "h2"]).where("rid > first").select(*columns))
    run = F.col("pos") - F.row_number().over(Window.partitionBy("rid").orderBy("pos"))
    runs = marked.withColumn("run", run).groupBy("rid", "rank", "run").agg(
        F.min("start").alias("span_start"), F.max("end").alias("span_end"), F.count("*").alias("n_units"),
        F.sum("words").alias("n_words"), F.min("kept").alias("kept"), F.sum(F.when(F.col("words") >= FIRM, F.col("words"))).alias("firm"),
    )
    return runs.where(F.col("firm") >= min_words).drop("run", "firm")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, span_start, span_end, n_units, n_words, kept_doc_id): what is removed, in characters of the original text.

    kept_doc_id is the smallest document that keeps one of the run's units.
    """
    spans = row_spans(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"), min_words)
    real = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return spans.select(real("rank").alias("doc_id"), "span_start", "span_end", "n_units", "n_words", real("kept").alias("kept_doc_id"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated spans cut out of ``text`` and ``removed``, their offsets in the original, added in place of a column of that name."""
    numbered = saved(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row_")), "numbered")
    spans = row_spans(numbered.select("rid", F.col("row_.doc_id").alias("doc_id"), F.col("row_.text").alias("text")), min_words)
    cut = spans.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("span_start", "span_end"))).alias("removed_"))
    joined = numbered.join(cut, "rid", "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    text = F.col("row_.text")
    walked = F.aggregate(
        "removed_", start,
        lambda a, s: F.struct(s["span_end"].alias("at"), F.concat(a["text"], F.substring(text, a["at"] + 1, s["span_start"] - a["at"])).alias("text")),
        lambda a: F.concat(a["text"], F.substring(text, a["at"] + 1, F.char_length(text))),
    )
    clean = F.when(F.col("removed_").isNull(), text).otherwise(walked)
    none = F.array().cast("array<struct<span_start:int,span_end:int>>")
    others = [clean.alias(c) if c == "text" else F.col("row_")[c].alias(c) for c in docs.columns if c != "removed"]
    return joined.select(*others, F.coalesce("removed_", none).alias("removed"))


def op1_substring_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
