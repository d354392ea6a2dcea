import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD
from quotemill.llm import token_files
from quotemill.llm.queries import QUERIES
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_query_against_the_library(spark, documents, tokenizer):
    rows = ODD + [(i, f"Text  number {i}\n\n it's {i * i}.") for i in range(-30, -10)]
    got = QUERIES["op10_token_files"](spark, documents(rows)).collect()
    want, start = Counter(), 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = ids_of(tokenizer, text)
        want[doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


def test_many_blocks_a_file(spark, documents, tokenizer, monkeypatch):
    folder = documents([(i, f"document {i} " * (i % 40)) for i in range(500)])
    docs = spark.read.parquet(folder + "/documents.parquet")
    docs = docs.selectExpr("doc_id", "text", "1 as start", "2 as n_tokens")
    path = token_files.write(docs, PATH, end=7)
    got = sorted(token_files.read(spark, path).collect())
    start = 0
    for i, r in enumerate(got):
        want = [*tokenizer.encode(f"document {i} " * (i % 40), add_special_tokens=False).ids, 7]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, start, len(want), want)
        start += len(want)


def test_chunks_cross_batches(spark, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 50)
    batches = spark.range(600).selectExpr("id as doc_id", "if(id % 5 = 0, null, repeat('x', id % 9)) as text").toArrow().to_batches(100)
    chunks = list(token_files._chunks(batches))
    assert [i for doc_ids, _ in chunks for i in doc_ids] == list(range(600)) and len(chunks) > 4
    assert [t for _, texts in chunks for t in texts.to_pylist()] == [None if i % 5 == 0 else "x" * (i % 9) for i in range(600)]


def test_empty_table(spark, documents):
    assert QUERIES["op10_token_files"](spark, documents([], files=1)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.'é𝄞1\n\t \r\u00a0\u2003\u2028\x85\x0b\x1f!", max_size=30), max_size=6))
def test_cut_texts_encode_as_whole_ones(texts):
    encoder = token_files._encoder(PATH)
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))] == whole


def test_special_tokens_are_text(tokenizer):
    encoder = token_files._encoder(PATH)
    texts = ["a <|endoftext|> b", "one two three four five", None, "", " one two six", "one "]
    assert [x.tolist() for x in encoder.encode(pa.array(texts, pa.string()))] == [ids_of(tokenizer, t)[:-1] for t in texts]
    assert 50256 not in encoder.encode(pa.array(["a <|endoftext|> b"]))[0]


def test_known_words_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files.Encoder, "KNOWN", 3)
    encoder = token_files.Encoder(PATH)
    for text in ("x one two three four five", "x four six seven", "x one one", "x " + " ".join(2 * [*map(str, range(50))])):
        assert encoder.encode(pa.array([text]))[0].tolist() == ids_of(tokenizer, text)[:-1]
    encoder.encode(pa.array(["last words last words"]))
    words, ids, begins, sizes = encoder.known
    assert words.to_pylist() == ["2", "last", "words"] and len(ids) == sum(sizes) and len(begins) == 3


ID = st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.lists(ID, max_size=40)), max_size=8))
def test_block_round_trip(documents):
    doc_ids, ids = [d for d, _ in documents], [np.array(x, np.uint32) for _, x in documents]
    block = token_files.pack_block(doc_ids, ids) + b"\n"
    for content, times in ((block, 1), (block * 3, 3)):
        found = list(token_files.unpack_blocks(content))
        assert len(found) == times
        for got_ids, got in found:
            assert got_ids == doc_ids and [x.tolist() for x in got] == [x.tolist() for x in ids]
    if documents:
        heads = list(token_files.block_heads(block * 2))
        n = sum(map(len, ids))
        assert heads == [(0, n, doc_ids[0]), (1, n, doc_ids[0])]


def test_ranks_of_all_lengths():
    ids = np.arange(70_000, dtype=np.uint32) * 3
    ids = np.concatenate([ids, ids[:1000], ids[:10]])
    block = token_files.pack_block([5], [ids])
    assert len(block) < 70_000 * 4 + (256 + 2 * 65_280 + 3 * 4_464) * 1.4
    ((_, (got,)),) = token_files.unpack_blocks(block + b"\n")
    assert np.array_equal(got, ids)


@pytest.mark.parametrize("at", [0, 40, -6, -1])
def test_damage_is_noticed(at):
    block = bytearray(token_files.pack_block([1, 2], [np.arange(9, dtype=np.uint32)] * 2) + b"\n")
    block[at] ^= 1
    with pytest.raises(ValueError):
        list(token_files.unpack_blocks(bytes(block)))


def test_query_against_the_unmodified_library(spark, documents):
    plain = Tokenizer.from_file(PATH)
    texts = ["one <|endoftext|> two three", "in<|endoftext|>side one two", "<|endoftext|><|endoftext|>", "<|endoftext|", "one two three", None]
    got = QUERIES["op10_token_files"](spark, documents(list(enumerate(texts)))).collect()
    want, start = [], 0
    for i, text in enumerate(texts):
        ids = ids_of(plain, text)
        assert (50256 in ids) == (i < 3)
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
