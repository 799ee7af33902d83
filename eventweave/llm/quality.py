"""Quality classifier by importance resampling of hashed n-gram models.

Two bag-of-n-grams models over the same hash buckets, words and word pairs: one
of target text (documents labelled good), one of all raw text. A document's
weight is the ratio of its probabilities under the two, taken per n-gram so that
length does not decide; a bounded sample of labelled rows turns it into
log odds of being target text. Documents are drawn without replacement by
Gumbel top-k: log odds plus Gumbel noise from a hash of the doc_id, the k
largest stay, and k is the number of documents whose odds of being target text
are at least even. The k-th largest key is found by radix selection over counts
of key prefixes, so no sort of all documents and no collection of keys.

Raw counts cover every document. Labelled rows are bounded by ``most_labels``
(the rows with the smallest hash of their doc_id).

Nulls: a null text counts as empty; empty texts have no n-grams and odds of the
prior. A null label or doc_id in the labels teaches nothing. Ties at the k-th
key all stay. Repeated rows are drawn together. An empty table gives no rows; if
either label is absent, every document has even odds and all are kept.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from eventweave.llm.common import saved, scratch, ship, table, unit_uniform

BUCKETS = 1 << 16
MOST_LABELS = 40_000
#: Words remembered inside a task.
MEMO = 150_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
_words: dict[str, int] = {}
_shapes: dict[str, int] = {}


def ngrams(text: str) -> np.ndarray:
    """Bucket of every word, run of signs, and pair of neighbours in a text; letters keep their case."""
    if len(_words) > MEMO:
        _forget()
    words = TOKEN.findall(text)
    for w in set(words).difference(_words):
        _words[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 7)
        _shapes[w] = _shape(w)
    h = np.array([_words[w] for w in words], np.uint64)
    pairs = h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1]
    pairs ^= pairs >> np.uint64(29)
    same = h[1:] == h[:-1]  # a repeated word is one feature whatever the word
    pairs[same] = 1
    shapes = np.array([_shapes[w] for w in words], np.uint64)
    return np.concatenate([h, pairs, shapes]) % np.uint64(BUCKETS)


def _forget() -> None:
    """Workers outlive tasks; what they remember would stay beside later stages."""
    _words.clear()
    _shapes.clear()


def _shape(word: str) -> int:
    if word.isupper() and len(word) > 1:
        return 2
    if word.isalpha():
        return 3 if word.islower() else 4
    return 5 if word.isdigit() else 6


def count_batches(batches, column: int = 0):
    total = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for x in b.column(column):
            if text := x.as_py():
                total += np.bincount(ngrams(text), minlength=BUCKETS)
    _forget()
    hit = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])


def counts(texts: DataFrame) -> np.ndarray:
    """N-gram counts of all rows (text): at most ``BUCKETS`` rows reach the driver."""
    rows = texts.select("text").mapInArrow(count_batches, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS)
    for r in rows:
        out[r.bucket] = r.n
    return out


def score_batches(batches, ratio: np.ndarray, keep_text: bool = False):
    """(keys..., text) to (keys..., ratio), and the text if asked: mean log ratio per n-gram, 0 without any."""
    for b in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
        at = b.schema.get_field_index("text")
        out = np.zeros(b.num_rows)
        for i, x in enumerate(b.column(at)):
            if (text := x.as_py()) and len(g := ngrams(text)):
                out[i] = ratio[g].mean()
        keep = [i for i in range(b.num_columns) if i != at or keep_text]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(out)], [*(b.schema.names[i] for i in keep), "ratio"])
    _forget()


def fit_odds(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x by Newton steps: (slope, intercept)."""
    if len(set(y.tolist())) < 2:
        return 0.0, 0.0
    mean, spread = x.mean(), x.std() or 1.0
    z = np.stack([(x - mean) / spread, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    ridge = np.diag([1e-2, 1e-6]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, quality) of at most ``most`` labelled documents, chosen by hash of doc_id."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = known.count()
    if n > most:
        known = known.where(unit_uniform(F.lit("labels"), "doc_id") <= 0.98 * most / n)
    # ``most`` rows of two numbers at most, so the texts need no shuffle
    return docs.select("doc_id", "text").join(F.broadcast(saved(known, "label-sample")), "doc_id")


def target_model(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS) -> dict:
    """The log ratio of each bucket and the logistic map to log odds."""
    ship(docs.sparkSession)
    with scratch(docs.sparkSession):
        return _fitted(docs, labels, most_labels)


def _fitted(docs: DataFrame, labels: DataFrame, most_labels: int) -> dict:
    known = saved(labelled(docs, labels, most_labels), "labelled")
    raw = counts(docs)
    # the map is fitted on other documents than the target model
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    good = F.col("quality") == 1
    smooth = lambda c: np.log((c + 0.5) / (c.sum() + 0.5 * BUCKETS))
    parts = counts(known.where(half & good)), counts(known.where(~half & good))
    slope = intercept = 0.0
    xs, ys = [], []
    for target, others in ((parts[0], known.where(~half)), (parts[1], known.where(half))):
        ratio = smooth(target) - smooth(raw)
        got = others.select("quality", "text").mapInArrow(lambda it, r=ratio: score_batches(it, r), "quality int, ratio double").toPandas()
        xs.append(got.ratio.to_numpy())
        ys.append((got.quality.to_numpy() == 1).astype(float))
    x, y = np.concatenate(xs), np.concatenate(ys)
    if len(x):
        slope, intercept = fit_odds(x, y)
    return {"ratio": smooth(parts[0] + parts[1]) - smooth(raw), "slope": slope, "intercept": intercept}


def weighted(docs: DataFrame, model: dict, keep_text: bool = False) -> DataFrame:
    """(columns but text unless asked, log_odds) for rows with a text column."""
    ratio = model["ratio"].astype(np.float32)
    fields = [f for f in docs.schema if f.name != "text" or keep_text]
    rows = docs.mapInArrow(lambda it: score_batches(it, ratio, keep_text), StructType([*fields, StructField("ratio", DoubleType())]))
    return rows.withColumn("log_odds", F.col("ratio") * model["slope"] + model["intercept"])


def kth_largest(rows: DataFrame, column: str, k: int, bits: int = 13) -> float | None:
    """The k-th largest value of a double column, by counting key prefixes; at most 2 ** ``bits`` counts reach the driver at a time."""
    if k <= 0:
        return None
    scaled = F.round(F.col(column) * F.lit(float(1 << 30))).cast("long")
    shifted = rows.select((scaled + F.lit(1 << 50)).alias("key"))
    shifted = shifted.select(F.greatest(F.lit(0), F.least("key", F.lit((1 << 51) - 1))).alias("key"))
    prefix, low = 0, 52
    while low > 0:
        step = min(bits, low)
        low -= step
        part = shifted.where(F.shiftright("key", low + step) == prefix).groupBy(F.shiftright("key", low).alias("p")).count().collect()
        for r in sorted(part, key=lambda r: -r.p):
            if r["count"] >= k:
                prefix = r.p
                break
            k -= r["count"]
        else:
            return -math.inf  # fewer than k rows: all stay
    return (prefix - (1 << 50)) / float(1 << 30)


def drawn(rows: DataFrame, model: dict, seed: int = 0, even: float = 0.5, keep_text: bool = False) -> DataFrame:
    """``rows`` (doc_id, text, others), text only if asked, with log_odds, key and kept."""
    scored = weighted(rows, model, keep_text).drop("ratio")
    # noise depends on the document alone, so reruns agree and repeated rows go together
    noise = -F.log(-F.log(unit_uniform(F.lit(seed), "doc_id")))
    keyed = saved(scored.withColumn("key", F.col("log_odds") + noise), "weighted")
    if model["slope"] == 0.0:
        return keyed.withColumn("kept", F.lit(True))
    k = keyed.agg(F.count_if(1 / (1 + F.exp(-F.col("log_odds"))) >= even).alias("k")).first().k
    cut = kth_largest(keyed, "key", k)
    scaled = F.round(F.col("key") * F.lit(float(1 << 30)))
    return keyed.withColumn("kept", scaled >= F.lit(cut * float(1 << 30)) if cut is not None else F.lit(False))


def resampled(docs: DataFrame, labels: DataFrame, seed: int = 0, most_labels: int = MOST_LABELS, even: float = 0.5) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, log_odds, key, kept."""
    return drawn(docs.select("doc_id", "text"), target_model(docs, labels, most_labels), seed, even)


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 0, most_labels: int = MOST_LABELS) -> DataFrame:
    """``docs`` without the documents that the draw rejects, all columns unchanged.

    Each row is judged by its own text and carried along, so rows that share a
    doc_id, or have none, keep their own verdicts.
    """
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row_")
    rows = drawn(docs.select("doc_id", others, "text"), target_model(docs, labels, most_labels), seed, keep_text=True).where("kept")
    return rows.select(*["text" if c == "text" else F.col("row_")[c].alias(c) for c in docs.columns])


def op6_quality_resampling(spark, sf_dir):
    """The drawn documents: doc_id, log_odds, key."""
    out = resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.where("kept").select("doc_id", "log_odds", "key")
