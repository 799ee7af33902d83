import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from eventweave.llm import token_counts, token_files

ODD = ["a  b " * 50, "\n a\t b " * 60, " lead", "trail ", "x  y 　 z" * 60, "a<|endoftext|> b <|endoftext|>", "\x1c a b\x1c", "it's 12 é ü's", "▁a ▁ b" * 40]


def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate([*ODD, None, "", "y " * 300_000])], "doc_id long, text string")
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(odd).repartition(5)


def test_chunks_encode_as_whole_texts():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = token_files.encoder("byte_bpe_50k.json")
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab 'st1.,!\n\t é ") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert enc.splits
    got = [np.frombuffer(x, f"<u{enc.width}").tolist() for x in enc.encode(texts)]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_ranks_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_ranks(v)
        assert len(control) == -(-n // 4)
        assert token_files.decode_ranks(control, data, n).tolist() == v.tolist()


def test_token_files_against_the_library(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = f"file://{tmp_path}/set"
    token_files.write_token_files(docs, path)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_files_summary(spark, path).collect()}
    at, want = 0, {}
    for d, text in sorted(rows(docs)):
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want[d] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want


def test_token_files_of_repeated_null_and_no_rows(spark, tmp_path):
    some = spark.createDataFrame([(2, "b c", 1), (None, "z", 1), (2, "b c", 1), (2, "a", 1), (1, None, 1)], "doc_id long, text string, start int")
    path = f"file://{tmp_path}/some"
    token_files.write_token_files(some, path)
    got = sorted(((r.start, r.doc_id, r.n_tokens) for r in token_files.token_files_summary(spark, path).collect()))
    assert [g[1] for g in got] == [None, 1, 2, 2, 2]
    assert [g[2] for g in got][:2] == [2, 1]
    assert sorted(g[2] for g in got[2:]) == [2, 3, 3]
    assert [g[0] for g in got] == [sum(g[2] for g in got[:i]) for i in range(5)]
    path = f"file://{tmp_path}/none"
    token_files.write_token_files(some.limit(0), path)
    assert token_files.token_files_summary(spark, path).count() == 0


@pytest.mark.parametrize("piece", [10, 32 << 10])
def test_counts_against_the_library(spark, docs, piece):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: (len(t.encode()), len(sp.encode(t))) for d, t in rows(docs)}
    out = token_counts.token_counts(docs, piece_bytes=piece).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in out} == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in out)


def test_counts_of_repeated_null_and_no_rows(spark):
    some = spark.createDataFrame([(None, "a b", 1), (2, None, 1), (2, None, 1)], "doc_id long, text string, n_tokens int")
    out = token_counts.token_counts(some)
    assert sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect())) == [(0, 3, 2, False), (2, 0, 0, False), (2, 0, 0, False)]
    assert token_counts.token_counts(some.limit(0)).count() == 0
