"""Token counts: lengths only, in Arrow functions.

Texts longer than ``piece_bytes`` are split where no token can span the cut, the
pieces are packed into batches of about ``batch_bytes``, each batch is encoded
once, and only the lengths come back. One very long text is thus many pieces
over several batches instead of one call.

The safe boundary for the sentencepiece vocabulary: between a character that is
neither white space nor the word mark and a space. No piece holds the word mark
after another character (checked when the model is loaded; a model that has
such a piece is not split), merges only ever build pieces, and so none crosses
the cut. The first piece of a text gets the model's own dummy prefix; the later
ones begin with a space that the cut moves into that prefix.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import ship, table

MARK = "▁"
PIECE_BYTES = 32 << 10
BATCH_BYTES = 1 << 20
_loaded: dict = {}


def _model(name: str):
    """The loaded model and whether its texts can be split; kept for the life of the worker."""
    if name not in _loaded:
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        inner = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))
        probes = ("ab cd", "a b", " b", "x.\ny z", "é ü")
        steady = all(sp.encode(p + " " + q) == sp.encode(p) + sp.encode(q) for p in probes for q in probes if not q.startswith(" "))
        _loaded[name] = (sp, steady and not inner)
    return _loaded[name]


def split_safely(text: str, limit: int) -> list[str]:
    """Pieces of about ``limit`` characters whose token counts add up to the text's.

    Each cut drops one space that stands between a character other than white
    space or the word mark and one that is no white space or mark either; the
    dummy prefix of the next piece stands for it.
    """
    if len(text) <= limit:
        return [text]
    cut = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")
    out, start = [], 0
    while len(text) - start > limit:
        found = cut.search(text, start + limit)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.end()
    out.append(text[start:])
    return out


def lengths(texts, model: str, piece: int = PIECE_BYTES, batch: int = BATCH_BYTES) -> list[int]:
    """Token counts of whole texts (None: 0)."""
    sp, can_split = _model(model)
    counts = [0] * len(texts)
    parts: list[str] = []
    owners: list[int] = []
    size = 0

    def encode():
        for i, ids in zip(owners, sp.encode(parts, num_threads=1), strict=True):
            counts[i] += len(ids)
        parts.clear()
        owners.clear()

    for i, text in enumerate(texts):
        if not text:
            continue
        for part in split_safely(text, piece) if can_split else [text]:
            parts.append(part)
            owners.append(i)
            size += len(part) if part.isascii() else len(part.encode("utf-8", "surrogatepass"))
            if size >= batch:
                encode()
                size = 0
    if parts:
        encode()
    return counts


def count_batches(batches, model: str, piece: int, batch: int):
    for b in batches:
        at = b.schema.get_field_index("text")
        counts = lengths(b.column(at).to_pylist(), model, piece, batch)
        keep = [i for i in range(b.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in keep), pa.array(counts, pa.int64())], [*(b.schema.names[i] for i in keep), "n_tokens"]
        )


def token_counts(
    docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, doc_id: str = "doc_id", text: str = "text",
    piece_bytes: int = PIECE_BYTES, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; a null text counts as empty. Repeated rows and null ids are returned as they are."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(lambda it: count_batches(it, model, piece_bytes, batch_bytes), f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
