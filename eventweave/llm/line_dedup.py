"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of ``SPAN`` neighbouring lines closes a chunk
where it falls on a fixed residue, so boundaries depend on nearby lines alone
and shared runs of lines are cut alike wherever they stand. A chunk repeats if it
occurs before, by doc_id and then by place, in any document. Repeating chunks that
stand side by side are a run, and a run is removed if two or more of its lines have
text; so a chunk of one line goes with its neighbours but never alone. Chunks are
grouped by a 128-bit digest with their text, so chunks count as equal only where
their bytes are: a digest that stood for two texts would be left alone.

Everything is built-in Spark functions. Texts are shuffled once, already
combined by equal chunk on the map side, so a chunk that all documents share
costs one row a task.

Nulls: a null text has no lines; a null doc_id ranks last. Rows with equal
doc_id rank alike, so repeats between them stay; each row is cut by its own
number, so such rows keep their own lines. Empty lines are lines. Extra columns
are ignored by the query and kept by :func:`without_repeats`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.common import saved, scratch, table

SPAN = 2
#: One in so many lines closes a chunk.
EVERY = 2
FACTOR = 31
MULTI = 2
#: Stands between chunks while a text is cut.
MARK = "\x1e\x02\x1e"
LAST = (1 << 63) - 1


def line_hash(line: Column) -> Column:
    """32 bits of the line's MD5, which other engines can compute too."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunk_rows(docs: DataFrame, span: int = SPAN, every: int = EVERY) -> DataFrame:
    """(rid, doc_id, n_lines, chunks) per row with a text; chunks: array of (first, lines, text), first from 1. A column rid numbers the rows, if there is one."""
    rid = F.col("rid") if "rid" in docs.columns else F.monotonically_increasing_id().alias("rid")
    rows = docs.select(rid, "doc_id", "text", F.split("text", "\n").alias("ls"))
    hashed = rows.withColumn("hs", F.transform("ls", line_hash))

    def rolling(i: Column) -> Column:
        out = F.get("hs", i - 1)
        for back in range(1, span):
            out = out + F.coalesce(F.get("hs", i - 1 - back), F.lit(0)) * (FACTOR**back)
        return out

    n = F.size("ls")
    closes = lambda i: (i == n) | (rolling(i) % every == 0)
    # a text that holds the mark itself is one chunk
    whole = F.contains(F.col("text"), F.lit(MARK))
    last = F.when(whole, F.array(n)).otherwise(F.filter(F.sequence(F.lit(1), n), closes))
    ends = hashed.withColumn("ends", F.when(n > 0, last))
    # the mark in place of a chunk's last line end: one pass, where slicing the lines would copy them for each chunk
    joined = F.array_join(F.transform("ls", lambda l, i: F.concat(l, F.when(closes(i + 1), F.lit(MARK)).otherwise(F.lit("\n")))), "")
    texts = F.when(whole, F.array("text")).otherwise(F.split(joined, MARK))
    split = ends.withColumn("texts", F.when(n > 0, texts))
    begins = F.concat(F.array(F.lit(0)), F.slice("ends", F.lit(1), F.size("ends") - 1))
    zipped = F.arrays_zip(begins.alias("b"), F.col("ends").alias("e"), F.slice("texts", F.lit(1), F.size("ends")).alias("t"))
    chunks = F.transform(zipped, lambda x: F.struct((x["b"] + 1).alias("first"), (x["e"] - x["b"]).alias("lines"), x["t"].alias("chunk")))
    return split.select("rid", "doc_id", F.greatest(n, F.lit(0)).cast("long").alias("n_lines"), chunks.alias("chunks"))


def repeated_chunks(docs: DataFrame, span: int = SPAN, every: int = EVERY, multi: int = MULTI) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): rid, doc_id, n_lines, n_chunks, removed (array of (first, lines), one for each chunk)."""
    digests = lambda c: (F.xxhash64(c).alias("d1"), F.xxhash64(F.lit("second"), c).alias("d2"))
    with scratch(docs.sparkSession) as keep:
        rows = chunk_rows(docs, span, every)
        rank = F.coalesce(F.col("doc_id"), F.lit(LAST))
        # outer, or Spark would compute the chunks a second time to filter on their number
        texts = rows.select(rank.alias("rank"), F.explode_outer("chunks").alias("c")).where("c IS NOT NULL")
        equal = texts.select("rank", F.col("c.chunk").alias("chunk")).groupBy("chunk").agg(F.min("rank").alias("rank"), F.count("*").alias("n"))
        known = equal.select(*digests(F.col("chunk")), "rank", "n").groupBy("d1", "d2").agg(F.count("*").alias("texts"), F.min("rank").alias("kept"), F.sum("n").alias("n"))
        twice = saved(known.where("n > 1 AND texts = 1").select("d1", "d2", "kept"), "repeated-chunks")
        solid = lambda c: F.size(F.filter(F.split(c, "\n"), lambda l: F.trim(l) != ""))
        narrow = lambda c: F.struct(c["first"].alias("first"), c["lines"].alias("lines"), solid(c["chunk"]).alias("solid"), *digests(c["chunk"]))
        parts = saved(rows.select("rid", "doc_id", "n_lines", F.transform("chunks", narrow).alias("chunks")), "chunks")
        each = parts.select("rid", rank.alias("rank"), F.posexplode("chunks").alias("pos", "c")).select("rid", "rank", "pos", "c.*")
        # by row alone: a window over digests would keep the join's dealing, and a line that all share would be one task's
        inside = Window.partitionBy("rid").orderBy("d1", "d2", "first")
        again = (F.lag("d1").over(inside) == F.col("d1")) & (F.lag("d2").over(inside) == F.col("d2"))
        each = each.withColumn("again", F.coalesce(again, F.lit(False)))
        found = each.join(twice, ["d1", "d2"]).where("again OR rank > kept")
        run = F.col("pos") - F.row_number().over(Window.partitionBy("rid").orderBy("pos"))
        runs = found.select("rid", "pos", "first", "lines", "solid").withColumn("run", run)
        runs = runs.withColumn("all", F.sum("solid").over(Window.partitionBy("rid", "run"))).where(F.col("all") >= multi)
        removed = runs.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("first", "lines"))).alias("removed"))
        out = parts.select("rid", "doc_id", "n_lines", F.greatest(F.size("chunks"), F.lit(0)).cast("long").alias("n_chunks")).join(removed, "rid", "left")
        return keep(saved(out.withColumn("removed", F.coalesce("removed", F.array().cast("array<struct<first:int,lines:int>>"))), "line-runs"))


def without_repeats(docs: DataFrame, span: int = SPAN, every: int = EVERY, multi: int = MULTI) -> DataFrame:
    """``docs`` with repeated chunks of lines cut out of ``text``, all other columns unchanged."""
    numbered = saved(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*docs.columns).alias("row_")), "numbered")
    rows = numbered.select("rid", F.col("row_.doc_id").alias("doc_id"), F.col("row_.text").alias("text"))
    cut = repeated_chunks(rows, span, every, multi).where(F.size("removed") > 0).select("rid", "removed")
    joined = numbered.join(cut, "rid", "left")
    gone = F.flatten(F.transform("removed", lambda r: F.sequence(r["first"], r["first"] + r["lines"] - 1)))
    left = lambda ls: F.array_except(F.sequence(F.lit(1), F.size(ls)), gone)
    # the lines as a variable: as an expression they would be split again for each line
    joining = lambda ls: F.array_join(F.transform(left(ls), lambda i: F.get(ls, i - 1)), "\n")
    kept = F.element_at(F.transform(F.array(F.split("row_.text", "\n")), joining), 1)
    text = F.when(F.col("removed").isNull(), F.col("row_.text")).otherwise(kept)
    return joined.select(*[text.alias(c) if c == "text" else F.col("row_")[c].alias(c) for c in docs.columns])


def op10_line_dedup(spark, sf_dir):
    out = repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = F.aggregate("removed", F.lit(0), lambda a, r: a + r["lines"]).cast("long")
    ranges = F.array_join(F.transform("removed", lambda r: F.concat_ws("-", r["first"], r["first"] + r["lines"] - 1)), ",")
    return out.select("doc_id", "n_lines", "n_chunks", lines.alias("n_removed_lines"), ranges.alias("removed"))


ORACLE = r"""
WITH l AS (
  SELECT rid, doc_id, n, i, line, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h
  FROM (SELECT rid, doc_id, len(ls) AS n, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line
        FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
m AS (SELECT *, i = n OR (h + coalesce(lag(h) OVER w, 0) * 31) % 2 = 0 AS closes FROM l WINDOW w AS (PARTITION BY rid ORDER BY i)),
k AS (SELECT *, coalesce(sum(CAST(closes AS INT)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM m),
c AS (SELECT rid, doc_id, c, min(i) AS f, count(*) AS lines, count(*) FILTER (trim(line) <> '') AS solid, string_agg(line, chr(10) ORDER BY i) AS t FROM k GROUP BY rid, doc_id, c),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, f) AS nth FROM c),
g AS (SELECT *, f - sum(lines) OVER (PARTITION BY rid ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run FROM r WHERE nth > 1),
q AS (SELECT *, sum(solid) OVER (PARTITION BY rid, coalesce(run, f)) AS whole FROM g),
x AS (SELECT rid, sum(lines) AS gone, string_agg(f || '-' || (f + lines - 1), ',' ORDER BY f) AS removed FROM q WHERE whole >= 2 GROUP BY rid),
d AS (SELECT rid, doc_id, sum(lines) AS n_lines, count(*) AS n_chunks FROM c GROUP BY rid, doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, n_chunks, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed_lines, coalesce(removed, '') AS removed
FROM d LEFT JOIN x USING (rid)
UNION ALL SELECT doc_id, 0, 0, 0, '' FROM documents WHERE text IS NULL
"""
