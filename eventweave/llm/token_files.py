"""Token files: frequency-ranked ids in a byte-aligned code with separate control bytes.

A token file set is a folder of two Parquet tables, so that any store Spark
writes to will do and commits are atomic:

``ranks``   (rank, id): ids by falling count in this corpus, ties by id.
``blocks``  one row for each run of documents, in ascending doc_id order:
            (part, block, first, doc_ids, n_ids, control, data). ``part`` and
            ``block`` order the rows, ``first`` counts the ids before the block
            in its part, ``n_ids`` has each document's number of ids.

Each id is stored as its rank in 1 to 4 little-endian bytes in ``data``; four
ids share a byte of ``control``, two bits each, lowest first, holding the number
of bytes less one. Decoding looks lengths up by control byte in a table.

The encoder is the tokenizers library. A text is cut before every space that
follows a character other than white space: byte-level pre-tokens never reach
over such a place, so chunks encode alone exactly as they do in the text. Equal
chunks are encoded once a worker and remembered up to a bound.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.common import fresh_path, ship, table

#: Chunks remembered in a worker, characters encoded at a time, ids in a block.
MEMO = 250_000
TEXT_AT_ONCE = 6 << 20
BLOCK_IDS = 1 << 20
END = 0
_encoders: dict = {}
#: White space in any reading; letters and digits of Latin and Cyrillic, then signs; lines of pieces without white space.
WHITE = r"\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD_AND_SIGNS = r"^(?P<word>[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2af}\x{400}-\x{481}\x{48a}-\x{52f}]+)(?P<signs>[!-/:-@\[-`{-~]+)\z"
LINES = rf"^[^{WHITE}]+(\n[^{WHITE}]+)+\z"
EMPTY = pa.scalar(b"", pa.large_binary())


def _strings(x: list) -> pa.Array:
    return pa.array(x, pa.large_string())


def _binaries(x: list) -> pa.Array:
    return pa.array(x, pa.large_binary())



class Encoder:
    """Whole texts to little-endian ids (16-bit where the vocabulary allows, else 32-bit), by the tokenizers library."""

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        kind = repr(self.tokenizer.pre_tokenizer)
        self.splits = kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and self.tokenizer.normalizer is None
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Which ids begin with a space.
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        #: Ids of what begins a text, and of chunks that follow a space; ``odd`` chunks are left to whole texts.
        self.bare: dict[str, bytes] = {}
        self.keys, self.parts, self.odd = _strings([""]), _binaries([b""]), np.array([True])
        newline = self._encode(["\n"])[0]
        self.newline = np.frombuffer(newline, f"<u{self.width}")
        self.splits &= len(self.newline) == 1

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _alone(self, texts: list[str]) -> list[bytes]:
        new = sorted(set(texts).difference(self.bare))
        ids = dict(zip(new, self._encode(new), strict=True)) if new else {}
        if len(self.bare) + len(ids) <= MEMO:
            self.bare.update(ids)
        return [ids.get(t) or self.bare.get(t, b"") for t in texts]

    def _joined(self, pieces: pa.Array, sign: str) -> pa.Array:
        """The ids of pieces that stand after a space or a newline. They are encoded in one text and told apart by it."""
        if not len(pieces):
            return _binaries([])
        text = sign.join(pieces.to_pylist())
        ids = np.frombuffer(self._encode([" " + text if sign == " " else text])[0], f"<u{self.width}")
        if sign == " ":
            starts = np.flatnonzero(self.spaced[ids])
        else:
            kept = ids != self.newline[0]
            starts = np.r_[0, np.cumsum(kept)[~kept]]
            ids = ids[kept]
        if len(starts) != len(pieces):
            return _binaries(self._encode([sign * (sign == " ") + p for p in pieces.to_pylist()]))
        ends = np.r_[starts, len(ids)].astype(np.int64) * self.width
        return pa.Array.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.tobytes())])

    def _pieces(self, pieces: pa.Array, sign: str) -> pa.Array:
        """The ids of pieces without white space; signs at the end of a word are a pre-token of their own."""
        coded = pieces.dictionary_encode()
        cut = pc.extract_regex(coded.dictionary, WORD_AND_SIGNS)
        stems = pc.coalesce(pc.struct_field(cut, 0), coded.dictionary).dictionary_encode()
        signs = pc.fill_null(pc.struct_field(cut, 1), "").dictionary_encode()
        if sign == " ":
            at = pc.fill_null(pc.index_in(stems.dictionary, value_set=self.keys), -1).to_numpy(zero_copy_only=False).copy()
        else:
            at = np.full(len(stems.dictionary), -1)
        new = np.flatnonzero(at < 0)
        at[new] = len(self.keys) + np.arange(len(new))
        ids = pa.concat_arrays([self.parts, self._joined(stems.dictionary.take(pa.array(new)), sign)]).take(pa.array(at)).take(stems.indices)
        tails = _binaries(self._alone(signs.dictionary.to_pylist())).take(signs.indices)
        return pc.binary_join_element_wise(ids, tails, EMPTY).take(coded.indices)

    def _learn(self, chunks: pa.Array) -> pa.Array:
        """The ids of chunks that follow a space: without white space, or lines of such pieces, or anything."""
        lines = pc.match_substring_regex(chunks, LINES).to_numpy(zero_copy_only=False)
        plain = ~lines & ~pc.match_substring_regex(chunks, f"[{WHITE}]").to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~lines & ~plain)
        out = [self._pieces(chunks.filter(pa.array(plain)), " "), _binaries(self._encode([" " + c for c in chunks.take(pa.array(rest)).to_pylist()]))]
        if lines.any():
            lists = pc.split_pattern(chunks.filter(pa.array(lines)), "\n")
            begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.values.slice(lists.offsets[0].as_py(), int(begin[-1]))
            first = np.zeros(len(flat), bool)
            first[begin[:-1]] = True
            later = pc.binary_join_element_wise(pa.scalar(self.newline.tobytes(), pa.large_binary()), self._pieces(flat.filter(pa.array(~first)), "\n"), EMPTY)
            both = pa.concat_arrays([self._pieces(flat.filter(pa.array(first)), " "), later])
            order = np.empty(len(flat), np.int64)
            order[np.flatnonzero(first)] = np.arange(first.sum())
            order[np.flatnonzero(~first)] = np.arange(first.sum(), len(flat))
            laid = both.take(pa.array(order))
            ends = np.frombuffer(laid.buffers()[1], np.int64)[begin]
            out.append(pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), laid.buffers()[2]]))
        place = np.empty(len(chunks), np.int64)
        place[np.r_[np.flatnonzero(plain), rest, np.flatnonzero(lines)]] = np.arange(len(chunks))
        return pa.concat_arrays(out).take(pa.array(place))

    def encode(self, texts) -> list[bytes]:
        """The ids of each text of a list or an Arrow column (null: empty)."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = pc.fill_null(texts, "")
        apart = pc.equal(pc.binary_length(texts), 0)
        for a in self.added:
            apart = pc.or_(apart, pc.match_substring(texts, a))
        apart = apart.to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        whole = np.flatnonzero(apart if self.splits else np.ones(len(out), bool)).tolist()
        if self.splits and not apart.all():
            whole += self._split(texts.filter(pa.array(~apart)), np.flatnonzero(~apart), out)
        some = [texts[i].as_py() for i in whole]
        for i, ids in zip(whole, self._encode(some), strict=True):
            out[i] = ids
        return out

    def _split(self, texts: pa.Array, places: np.ndarray, out: list[bytes]) -> list[int]:
        """Encode texts by chunks to their ``places`` in ``out``; returns the places of those with a space after white space, which are left."""
        # Arrow splits the texts and looks the chunks up, so that Python sees each new chunk of the batch once
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        heads = offsets[:-1]
        codes = pc.fill_null(pc.index_in(flat, value_set=self.keys), -1).to_numpy(zero_copy_only=False).copy()
        codes[heads] = 0  # a text's first chunk has no space before it
        unknown = codes < 0
        met = flat.filter(pa.array(unknown)).dictionary_encode()
        chunks = met.dictionary
        odd = pc.match_substring_regex(chunks, f"(^|[{WHITE}])\\z").to_numpy(zero_copy_only=False)
        new = self._learn(pc.if_else(pa.array(odd), "", chunks))  # those are not used
        codes[unknown] = met.indices.to_numpy() + len(self.keys)
        parts, odds = pa.concat_arrays([self.parts, new]), np.r_[self.odd, odd]
        first = flat.take(pa.array(heads)).to_pylist()
        left = odds[codes]
        left[heads] = [not c or c[-1].isspace() for c in first]
        left = np.logical_or.reduceat(left, heads)
        if len(parts) <= MEMO:
            self.keys, self.parts, self.odd = pa.concat_arrays([self.keys, chunks]), parts, odds
        laid = parts.take(pa.array(codes))
        _, ends, data = laid.buffers()
        cut = np.frombuffer(ends, np.int64)[offsets].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        for i, head, a, b, skip in zip(places.tolist(), self._alone(first), cut[:-1], cut[1:], left.tolist(), strict=True):
            if not skip:
                out[i] = head + raw[a:b]
        return places[left].tolist()


def encoder(name: str) -> Encoder:
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def encode_batches(batches, name: str):
    """(doc_id, text) to (doc_id, ids with the end id, counts): a partition's last row has no ids but its counts of all ids, 64-bit."""
    enc = encoder(name)
    kind = f"<u{enc.width}"
    end_id = np.array([END], kind).tobytes()
    total, id_type = np.zeros(len(enc.spaced), np.int64), None
    names = ["doc_id", "ids", "counts"]
    for b in batches:
        id_type = b.column(0).type
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + TEXT_AT_ONCE, "right")))
            ids = [x + end_id for x in enc.encode(b.column(1).slice(at, end - at))]
            total += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=len(total))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), pa.array(ids, pa.binary()), pa.nulls(end - at, pa.binary())], names)
            at = end
    if id_type is not None:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names)


def unpack_counts(batches):
    for b in batches:
        for x in b.column(0):
            n = np.frombuffer(x.as_py(), np.int64)
            ids = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[ids])], ["id", "n"])


def encode_ranks(values: np.ndarray) -> tuple[bytes, bytes]:
    """Unsigned 32-bit values to (control, data)."""
    v = values.astype("<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = extra
    four = codes.reshape(-1, 4)
    control = four[:, 0] | (four[:, 1] << 2) | (four[:, 2] << 4) | (four[:, 3] << 6)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


#: For each control byte the lengths of its four values.
LENGTHS = np.stack([((np.arange(256) >> shift) & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.uint8)


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    raw = np.frombuffer(data, np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = sizes > k
        if not more.any():
            break
        out[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


BLOCKS = "part int, block int, first long, doc_ids array<{id}>, n_ids array<long>, control binary, data binary"


def write_blocks(batches, rank_of: np.ndarray, width: int):
    """(doc_id, ids) in file order to rows of blocks; a block ends with the document that brings it to ``BLOCK_IDS``."""
    part, block, first = TaskContext.get().partitionId(), 0, 0
    names = ["part", "block", "first", "doc_ids", "n_ids", "control", "data"]
    held: list = []

    def row(docs, n, values):
        control, data = encode_ranks(values)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), x) for x in (docs, pa.array(n))]
        whole = [pa.array([x], t) for x, t in ((part, pa.int32()), (block, pa.int32()), (first, pa.int64()))]
        return pa.RecordBatch.from_arrays([*whole, *lists, pa.array([control], pa.binary()), pa.array([data], pa.binary())], names)

    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column(1)
        ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        n = np.diff(ends).astype(np.int64) // width
        values = rank_of[np.frombuffer(ids.buffers()[2], f"<u{width}")[ends[0] // width : ends[-1] // width]]
        held.append((b.column(0), n, values))
        docs, n, values = held[0] if len(held) == 1 else (pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2)))
        ends, at, done = np.cumsum(n), 0, 0
        while done + BLOCK_IDS <= len(values):
            end = int(np.searchsorted(ends, done + BLOCK_IDS)) + 1
            yield row(docs.slice(at, end - at), n[at:end], values[done : ends[end - 1]])
            block, first = block + 1, first + int(ends[end - 1]) - done
            at, done = end, int(ends[end - 1])
        held = [(docs.slice(at), n[at:], values[done:])] if at < len(n) else []
    if held:
        yield row(*held[0])


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every row's whole text (null: empty), add the end id, and write the file set to ``path``.

    Rows with equal doc_id stand side by side in an order fixed by their ids; a null doc_id stands first.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    width = encoder(tokenizer).width
    encoded = rows.mapInArrow(lambda it: encode_batches(it, tokenizer), f"doc_id {id_type}, ids binary, counts binary")
    raw = fresh_path(spark, "ids")
    encoded.write.option("compression", "zstd").parquet(raw)
    written = spark.read.schema(encoded.schema).parquet(raw)
    counts = written.select("counts").where("counts IS NOT NULL").mapInArrow(unpack_counts, "id long, n long")
    counted = counts.groupBy("id").agg(F.sum("n").alias("n"))
    ids = written.select("doc_id", "ids").where("ids IS NOT NULL")
    # at most one row for each entry of the vocabulary
    order = [r.id for r in sorted(counted.collect(), key=lambda r: (-r.n, r.id))]
    spark.createDataFrame(list(enumerate(order)), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max(order, default=0) + 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tie = F.xxhash64("ids")
    sort = [F.col("doc_id"), tie]
    ordered = ids.repartitionByRange(n, "doc_id", tie).sortWithinPartitions(*sort)
    ordered.mapInArrow(lambda it: write_blocks(it, rank_of, width), BLOCKS.format(id=id_type)).write.option("compression", "zstd").parquet(f"{path}/blocks")
    jvm = spark.sparkContext._jvm
    old = jvm.org.apache.hadoop.fs.Path(raw)
    old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def read_blocks(batches, base: dict[int, int], id_of: np.ndarray):
    """Rows of blocks to (doc_id, start, ids as little-endian 32-bit)."""
    for b in batches:
        cols = [b.column(i) for i in range(b.num_columns)]
        for part, first, docs, sizes, control, data in zip(*cols, strict=True):
            n = np.array(sizes.as_py(), np.int64)
            ids = id_of[decode_ranks(control.as_py(), data.as_py(), int(n.sum()))].astype("<u4")
            ends = np.cumsum(n)
            starts = base[part.as_py()] + first.as_py() + ends - n
            parts = [ids[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)]
            yield pa.RecordBatch.from_arrays([docs.values, pa.array(starts), pa.array(parts, pa.binary())], ["doc_id", "start", "ids"])


def _opened(spark, path: str):
    """The blocks table and what is needed to decode it: two small maps, one entry a part or vocabulary entry."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks) + 1, np.uint32)
    id_of[[r.rank for r in ranks]] = [r.id for r in ranks]
    size = F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = sorted(blocks.groupBy("part").agg(F.sum(size).alias("n")).collect(), key=lambda r: r.part)
    base, at = {}, 0
    for r in totals:
        base[r.part] = at
        at += r.n
    return blocks.select("part", "first", "doc_ids", "n_ids", "control", "data"), base, id_of


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in a file set; ids are little-endian unsigned 32-bit integers."""
    ship(spark)
    blocks, base, id_of = _opened(spark, path)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(lambda it: read_blocks(it, base, id_of), f"doc_id {id_type}, start long, ids binary")


def summaries(batches, base, id_of):
    for b in read_blocks(batches, base, id_of):
        ids = [x.as_py() for x in b.column(2)]
        n, crc = [len(x) // 4 for x in ids], [zlib.crc32(x) for x in ids]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
        )


def token_files_summary(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    ship(spark)
    blocks, base, id_of = _opened(spark, path)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(lambda it: summaries(it, base, id_of), f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def op3_token_files(spark, sf_dir):
    path = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files_summary(spark, path)
