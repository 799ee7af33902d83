"""Toxicity: a linear-chain conditional random field over words.

Tags are 0 (clean) and 1 (toxic). A word's emission score is the sum of weights
of hashed features (the word, its first 4 to 8 letters), and two
neighbouring tags have a weight for each pair. Forward-backward gives each
word's marginal of tag 1; a document's score is a logistic function of its
largest marginal, the sum of its marginals and its number of words, and its spans are the runs of
words with marginals of at least one half, by character offsets.

Only documents carry labels, so the words' labels for training are projected
from them: every word of a clean document is clean; a word of a toxic document
is toxic if one of its features is found in toxic documents far more often than
in clean ones. The field then weighs all features together.

The model is fitted on the driver from at most ``most_docs`` labelled documents
(chosen by hash, toxic ones up to a third) and ``most_words`` of their words in
whole documents: gradient steps on feature and pair weights alike, by the
difference between the tags' counts and those expected under forward-backward.
Scoring covers every word of every document. Long texts run as windows of
``WINDOW`` words side by side, and the chain's messages are carried over the
windows' edges, so marginals are those of the whole text.

Nulls: null and empty texts have no words and get the score of a document with
no evidence. A null label or doc_id in ``labels`` teaches nothing. Repeated rows
are each scored. Columns named like the results are replaced by them. Where one
class is missing, scores are the share of toxic labels, or 0 without labels.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import saved, ship, table, unit_uniform

FEATURES = 1 << 18
MOST_DOCS = 9_000
MOST_WORDS = 1_000_000
WINDOW = 2048
MEMO = 1_000_000
WORD = re.compile(r"\w+")
PER_WORD = 6
#: Log odds, and squared deviation from chance over chance, that a feature needs to mark words for training.
ODDS, SUPPORT = 2.0, 20.0


def features(word: str) -> list[int]:
    parts = (word, *(f"{n}<{word[:n]}" if len(word) > n else "" for n in (4, 5, 6, 7, 8)))
    return [xxhash.xxh32_intdigest(p) % (FEATURES - 1) + 1 if p else 0 for p in parts]


def _odds(e: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(e, -60, 60))


def marginals(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None, pairs: np.ndarray | None = None) -> np.ndarray:
    """Marginals of tag 1 for sequences laid end to end; ``e``: log odds of tag 1 by word, ``trans``: weights of tag pairs.

    ``enter`` and ``leave`` are messages from before and after a sequence, as ratios
    of tag 1 to tag 0; where nothing stands before, ``enter`` is NaN, and where
    nothing follows, ``leave`` is 1. The expected numbers of tag pairs inside
    sequences are added to ``pairs``. Sequences of alike length run side by side,
    one step at a time.
    """
    a = np.exp(trans)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    out = np.zeros(len(e))
    size = np.ceil(np.log2(np.maximum(lengths, 1))).astype(int)
    for s in np.unique(size[lengths > 0]):
        mine = np.flatnonzero((size == s) & (lengths > 0))
        width = int(lengths[mine].max())
        at = np.arange(width)[:, None] + starts[mine][None, :]
        inside = np.arange(width)[:, None] < lengths[mine][None, :]
        odds = _odds(np.where(inside, e[np.minimum(at, len(e) - 1)], 0))
        ahead = np.empty_like(odds)
        r = odds[0]
        if enter is not None:
            came = enter[mine]
            r = np.where(np.isnan(came), r, r * (a[0, 1] + a[1, 1] * came) / (a[0, 0] + a[1, 0] * came))
        ahead[0] = r
        for t in range(1, width):
            r = odds[t] * (a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r)
            ahead[t] = r
        last = np.ones(len(mine)) if leave is None else leave[mine]
        back = last
        for t in range(width - 1, -1, -1):
            both = ahead[t] * back
            ahead[t] = both / (1 + both)
            if t:
                nxt = odds[t] * back
                if pairs is not None:
                    r = ahead[t - 1]
                    p = np.stack([np.full_like(r, a[0, 0]), a[0, 1] * nxt, a[1, 0] * r, a[1, 1] * r * nxt])
                    pairs += ((p / p.sum(0)) @ inside[t]).reshape(2, 2)
                step = (a[1, 0] + a[1, 1] * nxt) / (a[0, 0] + a[0, 1] * nxt)
                # past its end a sequence keeps the message from after its last word
                back = np.where(inside[t], step, last)
        out[at[inside]] = ahead[inside]
    return out


def _through(e: np.ndarray, first: np.ndarray, size: np.ndarray, head: np.ndarray, a: np.ndarray) -> np.ndarray:
    """For each window the product of its words' steps, up to a factor; a text's first word (``head``) is no step."""
    out = np.tile(np.eye(2), (len(first), 1, 1))
    for t in range(int(size.max())):
        o = _odds(e[np.minimum(first + t, len(e) - 1)])
        step = np.empty((len(first), 2, 2))
        step[:, 0, 0], step[:, 0, 1], step[:, 1, 0], step[:, 1, 1] = a[0, 0], a[1, 0], o * a[0, 1], o * a[1, 1]
        live = (t < size) & ~(head & (t == 0))
        made = step @ out
        made /= made.max(axis=(1, 2), keepdims=True)
        out = np.where(live[:, None, None], made, out)
    return out


def document_marginals(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """:func:`marginals` of whole documents, long ones cut into windows that are joined by exact messages."""
    if not len(e):
        return np.zeros(0)
    if lengths.max() <= WINDOW:
        return marginals(e, lengths, trans, pairs=pairs)
    a = np.exp(trans)
    parts = np.maximum(-(-lengths // WINDOW), 1)
    doc = np.repeat(np.arange(len(lengths)), parts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    size = np.minimum(WINDOW, lengths[doc] - nth * WINDOW)
    first = (np.cumsum(lengths) - lengths)[doc] + nth * WINDOW
    enter, leave = np.full(len(doc), np.nan), np.ones(len(doc))
    cut = np.flatnonzero(parts[doc] > 1)
    through = _through(e, first[cut], size[cut], nth[cut] == 0, a)
    for i, w in enumerate(cut):  # forward over the windows of each text
        f = np.array([1.0, _odds(e[first[w]])]) if nth[w] == 0 else f  # noqa: F821
        if nth[w]:
            enter[w] = f[1] / f[0]
        f = through[i] @ f
        f = f / f.max()
    for i in range(len(cut) - 1, -1, -1):  # and backward
        w = cut[i]
        if nth[w] == parts[doc[w]] - 1:
            b = np.ones(2)
        leave[w] = b[1] / b[0]
        b = through[i].T @ b
        b = b / b.max()
    inner = None if pairs is None else np.zeros((2, 2))
    out = marginals(e, size, trans, enter, leave, inner)
    if pairs is not None:
        pairs += inner
        for w in np.flatnonzero(nth > 0):  # the pair over each edge
            o = _odds(e[first[w]])
            # the message after the window's first word follows from its marginal
            ahead = o * (a[0, 1] + a[1, 1] * enter[w]) / (a[0, 0] + a[1, 0] * enter[w])
            nxt = o * (out[first[w]] / max(1 - out[first[w]], 1e-300)) / ahead
            p = np.array([[a[0, 0], a[0, 1] * nxt], [a[1, 0] * enter[w], a[1, 1] * enter[w] * nxt]])
            pairs += p / p.sum()
    return out


def evidence(m: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each document the log odds of its largest marginal, the logs of the sum of its marginals and of its number of words."""
    out = np.full((len(lengths), 3), -16.0)
    full = np.flatnonzero(lengths > 0)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[full].astype(np.int64)
        top = np.clip(np.maximum.reduceat(m, starts), 1e-7, 1 - 1e-7)
        out[full, 0] = np.log(top / (1 - top))
        out[full, 1] = np.log(np.maximum(np.add.reduceat(m, starts), 1e-7))
    out[:, 2] = np.log1p(lengths)
    return np.maximum(out, -16.0)


class Model:
    """Weights, and emission scores of words as far as remembered."""

    def __init__(self, weights, trans, link, prior=None):
        self.weights, self.trans, self.link, self.prior, self.bias, self.memo = weights, trans, link, prior, 0.0, {}

    def __getstate__(self):
        return {**self.__dict__, "memo": {}}

    def emissions(self, words: list[str]) -> list[float]:
        known = self.memo.get
        out = list(map(known, words))
        if None in out:
            if len(self.memo) > MEMO:
                self.memo.clear()
            new = list({w for w, x in zip(words, out, strict=True) if x is None})
            values = (self.weights[np.array([features(w) for w in new])].sum(axis=1) + self.bias).tolist()
            fresh = dict(zip(new, values, strict=True))
            out = [fresh[w] if x is None else x for w, x in zip(words, out, strict=True)]
            self.memo.update(fresh)
        return out

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, marginals of all words, words of each text)."""
        words = [WORD.findall(t.lower()) for t in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        if self.prior is not None:
            return np.full(len(texts), self.prior), np.zeros(int(lengths.sum())), lengths
        e = np.array([x for w in words for x in self.emissions(w)], np.float64)
        m = document_marginals(e, lengths, self.trans)
        z = evidence(m, lengths) @ self.link[:3] + self.link[3]
        return 1 / (1 + np.exp(-z)), m, lengths


def fit_link(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by damped Newton steps on scaled columns, lightly held to zero; the last weight is the intercept."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([0.1] * x.shape[1] + [1e-4])

    def loss(w):
        return np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ ridge @ w / 2

    now = loss(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        size = 1.0
        while size > 1e-4 and (then := loss(w + size * step)) > now:
            size /= 2
        if size <= 1e-4 or now - then < 1e-9:
            break
        w, now = w + size * step, then
    w[:-1] /= spread
    w[-1] -= w[:-1] @ mean
    return w


def pair_counts(tags: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Counts of neighbouring tags inside sequences."""
    ends = np.cumsum(lengths)[:-1]
    inside = np.ones(max(len(tags) - 1, 0), bool)
    inside[ends[(ends > 0) & (ends < len(tags))] - 1] = False
    code = (tags[:-1] * 2 + tags[1:])[inside].astype(np.int64)
    return np.bincount(code, minlength=4).reshape(2, 2).astype(float)


def fit(texts: list[str], labels: list[int], most_words: int = MOST_WORDS, rounds: int = 40) -> Model:
    """A model from whole documents and their labels."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(None, None, None, float(y.mean()) if len(y) else 0.0)
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in WORD.findall(t.lower())], np.int64) for t in texts]
    feats = np.array([features(w) for w in index] or [[0] * PER_WORD])
    # documents of each class that hold a feature
    held = np.zeros((2, FEATURES))
    for ids, label in zip(docs, labels, strict=True):
        held[int(label), np.unique(feats[np.unique(ids)])] += 1
    n = np.array([len(y) - y.sum(), y.sum()])
    odds = np.log((held[1] + 0.5) / (n[1] + 1)) - np.log((held[0] + 0.5) / (n[0] + 1))
    chance = (held[0] + held[1]) * n[1] / n.sum()
    marks = (odds >= ODDS) & ((held[1] - chance) ** 2 >= SUPPORT * np.maximum(chance, 1e-9))
    marks[0] = False
    marked = marks[feats].any(axis=1)
    # whole documents, classes in turn, until the bound on words
    order = [i for pair in zip(np.flatnonzero(y == 1), np.flatnonzero(y == 0), strict=False) for i in pair]
    chosen, total = [], 0
    for i in order:
        if total and total + len(docs[i]) > most_words:
            continue
        chosen.append(i)
        total += len(docs[i])
    lengths = np.array([len(docs[i]) for i in chosen], np.int64)
    words = np.concatenate([docs[i] for i in chosen]) if chosen else np.zeros(0, np.int64)
    tags = (marked[words] & (np.repeat(y[chosen], lengths) == 1)).astype(np.int64)
    # pair weights start from smoothed log ratios of the tags' neighbours, against their chance by the tags alone
    seen = pair_counts(tags, lengths)
    pairs = seen + 1.0
    trans = np.log(pairs / pairs.sum()) - np.log(pairs.sum(1, keepdims=True) / pairs.sum()) - np.log(pairs.sum(0, keepdims=True) / pairs.sum())
    trans = np.clip(trans - trans[0, 0], -3, 3)
    weights, grown, speed = np.zeros(FEATURES), np.zeros(FEATURES), 1.5
    trans_grown = np.zeros((2, 2))
    bias = float(np.log((tags.sum() + 1) / (len(tags) - tags.sum() + 1)))
    for _ in range(rounds):
        score = weights[feats].sum(axis=1) + bias
        expected = np.zeros((2, 2))
        m = document_marginals(score[words], lengths, trans, expected)
        by_word = np.bincount(words, weights=tags - m, minlength=len(index))
        grad = np.bincount(feats.reshape(-1), weights=np.repeat(by_word, PER_WORD), minlength=FEATURES) - 0.02 * weights
        grad[0] = 0
        grown += grad * grad
        weights += speed * grad / (np.sqrt(grown) + 1e-8)
        pair_grad = seen - expected - 0.02 * trans
        trans_grown += pair_grad * pair_grad
        trans = np.clip(trans + 0.3 * pair_grad / (np.sqrt(trans_grown) + 1e-8), -6, 6)
    model = Model(weights, trans, np.zeros(4))
    model.bias = bias
    all_lengths = np.array([len(d) for d in docs], np.int64)
    score = weights[feats].sum(axis=1) + bias
    parts = []
    for at in range(0, len(docs), 500):
        some = docs[at : at + 500]
        e = score[np.concatenate(some)] if sum(map(len, some)) else np.zeros(0)
        parts.append(evidence(document_marginals(e, all_lengths[at : at + 500], trans), all_lengths[at : at + 500]))
    model.link = fit_link(np.concatenate(parts), y)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, most: int, held_out: Column | None) -> list:
    """(text, toxic) of at most ``most`` labelled documents with a text, toxic ones up to a third, chosen by hash of doc_id."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if held_out is not None:
        known = known.where(~held_out)
    known = saved(known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")), "toxic-labels")
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    # a tenth less than the bound leaves room for chance
    part = {t: min(1.0, 0.9 * (most // 3 if t else most - most // 3) / n[t]) for t in n}
    share = F.when(F.col("toxic") == 1, part.get(1, 0.0)).otherwise(part.get(0, 0.0))
    picked = saved(known.where(unit_uniform(F.lit("toxic"), "doc_id") <= share), "toxic-sample")
    # ``most`` rows of two numbers at most, so the texts need no shuffle
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
    # unordered rows would give another order of summing, and other last digits, at each run
    return sorted(((r.doc_id, r.text, r.toxic) for r in rows.toLocalIterator()), key=lambda r: (r[0], r[1]))


def score_batches(batches, model: Model, spans: bool):
    for b in batches:
        at = b.schema.get_field_index("text")
        keep = [i for i in range(b.num_columns) if i != at]
        texts = [x or "" for x in b.column(at).to_pylist()]
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (size < 1 << 21 or end == begin):
                size += len(texts[end])
                end += 1
            some = texts[begin:end]
            scores, m, lengths = model.judge(some)
            cols = [b.column(i).slice(begin, end - begin) for i in keep] + [pa.array(scores)]
            names = [b.schema.names[i] for i in keep] + ["score"]
            if spans:
                ends = np.cumsum(lengths)
                found = [_spans(t, m[e - n : e]) for t, e, n in zip(some, ends, lengths, strict=True)]
                cols.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(cols, names)
            begin = end


def _spans(text: str, m: np.ndarray) -> list[dict]:
    """Character offsets of runs of words with marginals of at least one half."""
    hit = m >= 0.5
    if not hit.any():
        return []
    lower = text.lower()
    at = [x.span() for x in WORD.finditer(lower)]
    if len(lower) != len(text):  # a letter that lower-cases to two moves what follows
        back = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
        at = [(int(back[a]), int(back[b - 1]) + 1) for a, b in at] if len(back) == len(lower) else at
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in edges.reshape(-1, 2)]


def model_for(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, most_docs: int = MOST_DOCS, most_words: int = MOST_WORDS) -> Model:
    """A model from labelled documents; rows of ``labels`` that meet ``held_out`` are not seen."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, most_docs, held_out)
    return fit([r[1] for r in rows], [r[2] for r in rows], most_words)


def scored(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """(columns but text, score, and spans of (start, end) if asked) for every row of ``docs``; columns of these names are replaced."""
    spark = docs.sparkSession
    ship(spark)
    keys = [f for f in docs.schema if f.name not in ("text", "score", "spans")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys), "score double"] + ["spans array<struct<start:int,end:int>>"] * spans)
    shared = spark.sparkContext.broadcast(model)  # FEATURES weights, whatever the corpus
    return docs.select(*[f.name for f in keys], "text").mapInArrow(lambda it: score_batches(it, shared.value, spans), schema)


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = model_for(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), held_out)
    out = scored(docs, model, spans=True)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
