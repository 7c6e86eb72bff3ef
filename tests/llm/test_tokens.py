import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, tokencount

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "a", " ", "\n\n  x\t y  ", "It's we'll 'S Élève naïve 北京 12345 ½   z", "x" * 3000 + " " * 500 + "é" * 200, "tail space ", "<|endoftext|>a<|endoftext|><|endoftext|> <|endoftext", "same words same words", "same words same words", "\x1c\x1d\x85 control \r\n\r\n", "🙂🙃🙂 !!! ...---...", "\x00\x01"]


@pytest.fixture(scope="module")
def docs(spark, small):
    real = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    own = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return real.unionByName(own).selectExpr("doc_id", "text", "1 as block", "2 as ids", "3 as words")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("block_chars", [500, 32_000_000])
def test_encoding_equals_the_library_and_decodes(spark, docs, block_chars):
    ranks = bpe.read_ranks(RANKS)
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, block_chars=block_chars)
    got = {r.doc_id: r for r in bpe.decode(encoded, ranks).collect()}
    enc = library()
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        want = enc.encode_ordinary(r.text or "")
        assert got[r.doc_id].ids == want, r.text[:80]
        assert bytes(got[r.doc_id].decoded) == (r.text or "").encode()


def test_digests(spark):
    ranks = bpe.read_ranks(RANKS)
    docs = spark.createDataFrame([(1, None), (2, "hello world")], "doc_id long, text string")
    rows = {r.doc_id: r for r in bpe.digests(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)).collect()}
    ids = library().encode_ordinary("hello world")
    assert rows[2].n_tokens == len(ids)
    assert rows[2].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert rows[2].decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    assert rows[1].n_tokens == 0 and rows[1].ids_sha256 == hashlib.sha256(b"").hexdigest() == rows[1].decoded_sha256


def test_repeated_and_missing_rows(spark):
    ranks = bpe.read_ranks(RANKS)
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a"), (3, "")], "doc_id long, text string")
    assert bpe.encode(docs, ranks, public_tokenizers.PATTERN).count() == 4
    assert bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    assert tokencount.count_tokens(docs, JSON).count() == 4
    assert tokencount.count_tokens(docs.limit(0), JSON).count() == 0


@pytest.mark.parametrize("block_chars", [500, 32_000_000])
def test_counts_equal_the_library(docs, block_chars):
    t = Tokenizer.from_file(JSON)
    got = {r.doc_id: r for r in tokencount.count_tokens(docs, JSON, block_chars=block_chars).collect()}
    for r in docs.collect():
        want = len(t.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id].n_tokens == want
        assert got[r.doc_id].over_limit == (want > 1024)
        assert got[r.doc_id].n_bytes == len((r.text or "").encode())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é\n'st 1!"), max_size=120))
def test_merge_with_and_without_heap(text):
    ranks = bpe.read_ranks(RANKS) if not hasattr(test_merge_with_and_without_heap, "ranks") else test_merge_with_and_without_heap.ranks
    test_merge_with_and_without_heap.ranks = ranks
    data = text.encode()
    rank = lambda a, b: ranks.get(a + b)
    if data:
        assert bpe._merge_long([data[i : i + 1] for i in range(len(data))], rank) == _plain(data, rank)


def _plain(data, rank):
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = [(r, i) for i in range(len(parts) - 1) if (r := rank(parts[i], parts[i + 1])) is not None]
        if not found:
            break
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts
