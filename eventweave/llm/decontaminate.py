"""Benchmark decontamination by a broadcast hash table of test n-grams.

The benchmark's word windows become a table of (hash, window). Each document's
words are hashed once, every window position is hashed from them, and the
positions are probed against the broadcast table inside one scan; a hit counts
only after its words are compared. Everything is built-in Spark functions.

A broadcast never exceeds ``block_bytes``: a larger benchmark is dealt by hash
into blocks, and the documents are scanned once for each block.

Nulls: a null text has no words, a null item_id or item text is no item.
Repeated documents are kept as separate rows; repeated item rows count once.
Extra columns of either table are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.common import ascii_lower, saved, scratch

DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in text that has not been lower-cased.
RAW_DELIMITERS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), DELIMITERS), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _probe_hash(at, n: int) -> Column:
    """at(j): the hash of the window's j-th word, from 0. Reading elements singly keeps a document's cost linear: slice() copies the array."""
    return F.xxhash64(*[at(j) for j in range(n)], F.lit(n))


def benchmark_windows(benchmark: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, win, len, klen, h): all windows of ``n`` words; a shorter item is one window.

    Short windows are probed by a prefix of ``klen`` words and compared whole.
    """
    words = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("ws")).where(
        F.col("item_id").isNotNull() & (F.size("ws") > 0)
    )
    sized = words.withColumn("len", F.least(F.size("ws"), F.lit(n)))
    starts = F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1)
    wins = sized.select("item_id", "len", F.explode(F.transform(starts, lambda i: F.slice("ws", i, F.col("len")))).alias("part"))
    klen = F.when(F.col("len") == n, F.lit(n)).otherwise(F.least(F.col("len"), F.lit(3)))
    keyed = wins.withColumn("klen", klen)
    at = lambda j: F.xxhash64(F.get("part", F.lit(j)))
    h = F.coalesce(*[F.when(F.col("klen") == k, _probe_hash(at, k)) for k in sorted({n, *range(1, min(3, n) + 1)})])
    return keyed.select("item_id", F.concat_ws(" ", "part").alias("win"), "len", "klen", h.alias("h")).distinct()


def window_hits(docs: DataFrame, windows: DataFrame, n: int, block_bytes: int = 16 << 20) -> DataFrame:
    """One row (rid, pos 0) for each document, with its other columns and n_words, and one for each hit (rid, pos, len, win).

    ``docs`` has ``text``; its other columns come along on the pos 0 rows.
    """
    distinct = windows.select("win", "len", "klen", "h").distinct()
    facts = distinct.agg(
        F.collect_set("klen").alias("klens"), F.coalesce(F.sum(F.octet_length("win") + 48), F.lit(0)).alias("bytes")
    ).first()
    klens = sorted(facts.klens)
    blocks = max(1, -(-facts.bytes // block_bytes))
    carried = [c for c in docs.columns if c != "text"]
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), *carried, "text")
    if blocks > 1:  # read once for each block, so the numbers must stay
        numbered = saved(numbered, "numbered")
    words = numbered.select("rid", *carried, words_of(F.col("text")).alias("ws"))
    hashed = words.withColumn("hw", _hashes(F.col("ws")))

    def probes(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size("hw") - (k - 1), F.lit(1)))
        hash_at = lambda i: _probe_hash(lambda j: F.get("hw", i + (j - 1)), k)
        made = F.transform(starts, lambda i: F.struct(i.alias("pos"), hash_at(i).alias("h")))
        return F.when(F.size("hw") >= k, made).otherwise(F.array().cast("array<struct<pos:int,h:bigint>>"))

    first = F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("long").alias("h")))
    out = []
    for b in range(blocks):
        lists = [probes(k) for k in klens]
        probe = F.concat(first, *lists) if b == 0 else F.concat(*lists)
        rows = hashed.withColumn("probe", probe).select("rid", *carried, "ws", F.inline_outer("probe"))
        side = distinct.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == b).select(F.col("h").alias("wh"), "win", "len")
        met = rows.join(F.broadcast(side), rows.h == side.wh, "left")
        same = F.concat_ws(" ", F.slice("ws", F.col("pos"), F.col("len"))) == F.col("win")
        hit = F.when(F.col("win").isNotNull(), same).otherwise(F.col("pos") == 0)
        keep = [F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in carried]
        out.append(met.where(hit).select("rid", *keep, F.when(F.col("pos") == 0, F.size("ws").cast("long")).alias("n_words"), "pos", "len", "win"))
    return reduce(DataFrame.unionByName, out)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, block_bytes: int = 16 << 20) -> DataFrame:
    """Per document row: its other columns, n_words, n_hit, items (sorted item ids as strings), n_items, contaminated, whole_window.

    A document is contaminated if it has hit words and they are at least one in
    ``share``; ``whole_window`` tells whether a window of all ``n`` words occurs.
    """
    windows = saved(benchmark_windows(benchmark, n), "windows")
    with scratch(docs.sparkSession) as keep:
        found = keep(saved(window_hits(docs, windows, n, block_bytes), "hits"))
    hits = found.where("pos > 0").select("rid", "pos", "len", "win")
    end = F.col("pos") + F.col("len")
    before = Window.partitionBy("rid").orderBy("pos", "len").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        hits.select("rid", "pos", "len").distinct().withColumn("seen", F.coalesce(F.max(end).over(before), F.lit(0)))
        .groupBy("rid").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("pos", "seen"))).alias("n_hit"), F.max("len").alias("longest"))
    )
    items = (
        hits.select("rid", "win").distinct().join(windows.select("win", "item_id"), "win").select("rid", "item_id").distinct()
        .groupBy("rid").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    )
    rows = found.where("pos = 0").drop("pos", "len", "win")
    joined = rows.join(covered, "rid", "left").join(items, "rid", "left")
    none = F.array().cast("array<string>")
    full = joined.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"), "items": F.coalesce("items", none)})
    return full.withColumns(
        {
            "n_items": F.size("items").cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")),
            "whole_window": F.coalesce(F.col("longest") >= n, F.lit(False)),
        }
    ).drop("rid", "longest")


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, block_bytes: int = 16 << 20, whole_windows: bool = False) -> DataFrame:
    """``docs`` without its contaminated rows, all columns unchanged.

    With ``whole_windows`` rows that hold any window of all ``n`` words go too: a
    long document can hold a whole benchmark passage in far less than one
    ``share``-th of its words. Items of fewer than ``n`` words, which ordinary text
    holds by chance, count by share alone.
    """
    whole = F.struct(*docs.columns).alias("row_")
    judged = contamination(docs.select(whole, "text"), benchmark, n, share, block_bytes)
    bad = F.col("contaminated") | F.col("whole_window") if whole_windows else F.col("contaminated")
    return judged.where(~bad).select("row_.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` with every hit word cut out of ``text``; what stands between words stays."""
    windows = saved(benchmark_windows(benchmark, n), "windows")
    whole = F.struct(*docs.columns).alias("row_")
    found = saved(window_hits(docs.select(whole, "text"), windows, n, block_bytes), "hits")
    spots = F.transform(F.sequence(F.lit(0), F.col("len") - 1), lambda k: F.col("pos") + k)
    cut = found.where("pos > 0").select("rid", F.explode(spots).alias("spot")).groupBy("rid").agg(F.collect_set("spot").alias("cut"))
    rows = found.where("pos = 0").select("rid", "row_").join(cut, "rid", "left")
    pieces = F.regexp_extract_all("row_.text", F.lit(f"({RAW_WORDS}|{RAW_DELIMITERS})"), F.lit(1))
    first_is_word = F.element_at("pieces", 1).rlike(f"^{RAW_WORDS}")
    word_at = lambda i: F.when(first_is_word & (i % 2 == 0), (i / 2 + 1).cast("int")).when(~first_is_word & (i % 2 == 1), ((i + 1) / 2).cast("int"))
    drop = lambda i: F.coalesce(F.array_contains("cut", word_at(i)), F.lit(False))
    clean = F.array_join(F.filter("pieces", lambda p, i: ~drop(i)), "")
    text = F.when(F.col("cut").isNull(), F.col("row_.text")).otherwise(clean)
    made = rows.withColumn("pieces", pieces).withColumn("text_", text)
    return made.select(*[F.col("text_").alias("text") if c == "text" else F.col("row_")[c].alias(c) for c in docs.columns])


def op9_benchmark_decontamination(spark, sf_dir):
    """Contract columns for every row of ``documents`` against ``benchmark``."""
    from eventweave.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(list_slice(ws, p, p + least(13, len(ws)) - 1), ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM b WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, p, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS win
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, ns WHERE len(ws) >= n)),
h AS (SELECT dw.rid, dw.p, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hw AS (SELECT rid, count(DISTINCT w) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS w FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""
