"""Token counts and byte-level BPE against the libraries the files are made for."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from airq.llm import byte_bpe, token_count
from airq.llm.queries import QUERIES
from tokenizers import Tokenizer

COUNTED = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def odd_texts():
    rng = random.Random(3)
    signs = [chr(i) for i in [*range(256), 0x3B1, 0x4E2D, 0x1F600, 0x200D, 0x2028, 0x180E, 0x3000, 0x661, 0x2167, 0x301, 0x1D7D8]]
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    out += ["".join(rng.choice("aeth \n's09.!") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    out += ["<|endoftext|>", " <|endoftext|> a", "a<|endoftext|><|endoftext|>b", "<|endoftext", "a" * 3000, " " * 3000, "\n" * 500]
    return out + ["", "ab" * 2000, "é" * 700, "the cat"]


@pytest.fixture(scope="module")
def encoding():
    ranks = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_as_the_library():
    tokenizer = Tokenizer.from_file(COUNTED)
    counter = token_count.TokenCounter(token_count.read_merges(COUNTED))
    for text in odd_texts():
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text[:80])


def test_ids_as_the_library_and_back(encoding):
    codec = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    texts = odd_texts()
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids == encoding.encode_ordinary(text), repr(text[:80])
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("widest", [2, 5, 128])
def test_matrices_and_heap_agree(monkeypatch, widest):
    monkeypatch.setattr(byte_bpe, "WIDEST", widest)
    monkeypatch.setattr(byte_bpe, "CELLS", 256)
    codec = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(11)
    words = [w for t in odd_texts() for w in codec.split(t) if w]
    words += ["".join(rng.choice(letters) for _ in range(rng.randint(100, 900))) for letters in ("ab", "the", "aeinrst", "éèα中") for _ in range(20)]

    def pair(key):
        rank = codec.ranks.get(codec.tokens[key >> token_count.SHIFT] + codec.tokens[key & token_count.LOW])
        return None if rank is None else rank << token_count.SHIFT | rank

    def heap(word):
        return tuple(token_count.merge_by_heap([codec.ranks[bytes([b])] for b in word], pair))

    assert codec.encode_words(words) == [(codec.ranks[w.encode()],) if w.encode() in codec.ranks else heap(w.encode()) for w in words]


def test_bounded_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(token_count, "KEPT_WORDS", 3)
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", 3)
    counter = token_count.TokenCounter(token_count.read_merges(COUNTED))
    codec = byte_bpe.Codec(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    texts = ["one two three four five", "six seven one two", "one"]
    tokenizer = Tokenizer.from_file(COUNTED)
    assert [counter.count(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [codec.decode(codec.encode([t])[0]).decode() for t in texts] == texts


def test_queries(spark, folder, encoding):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    tokenizer = Tokenizer.from_file(COUNTED)
    counted = QUERIES["op8_token_count"](spark, folder).collect()
    assert len(counted) == len(rows)
    for r in counted:
        n = len(tokenizer.encode(rows[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(rows[r.doc_id].encode()), n, n > 512)
    encoded = QUERIES["op3_byte_bpe"](spark, folder).collect()
    assert len(encoded) == len(rows)
    for r in encoded:
        ids = encoding.encode_ordinary(rows[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()


def test_edges(spark):
    rows = [(None, "a b", 1), (1, None, 2), (2, "", 3), (3, "x" * 200_000, 4), (3, "x" * 200_000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    counts = token_count.count_tokens(df, COUNTED).collect()
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in counts) == [(0, True), (1, False), (2, False), (3, True), (3, True)]
    ids = byte_bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN).collect()
    assert [bytes(r.decoded).decode() for r in ids] == [t or "" for _, t, _ in rows]
    assert token_count.count_tokens(df.limit(0), COUNTED).collect() == []
    assert byte_bpe.digest_documents(df.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
