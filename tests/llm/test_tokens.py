"""Encoding and counting against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings, strategies as st

from loadgauge.llm import byte_bpe, pretokens, token_count

RANKS, FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 5000, "ab" * 999, "it's we'll 'S ' s", "\x1c\x85\xa0  x", "½²٣中文😀́e", " \n\n  x\t\t", "\r\n\x0b\x0c"]
ODD += ["".join(random.Random(i).choices("abcdehinorst é", k=200)) for i in range(100)]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.Bpe(byte_bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def counter():
    with open(FILE, encoding="utf-8") as source:
        return token_count.Counter(source.read())


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_pattern_is_the_public_one():
    assert pretokens.PUBLIC == public_tokenizers.PATTERN


def test_encodes_like_the_library(bpe, library):
    for x in ODD:
        assert ids(bpe.encode(x)) == library.encode_ordinary(x), ascii(x[:50])
        assert bpe.decode(bpe.encode(x)) == x.encode()


def test_every_character_is_split_like_the_library(bpe, library):
    for start in range(0, 0x30000, 97):
        x = " ".join(chr(c) + "a" + chr(c) for c in range(start, start + 97) if not 0xD800 <= c < 0xE000)
        assert ids(bpe.encode(x)) == library.encode_ordinary(x), hex(start)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_round_trip_and_counts(bpe, counter, library, text):
    assert ids(bpe.encode(text)) == library.encode_ordinary(text)
    assert counter.count([text]) == [len(tokenizer().encode(text, add_special_tokens=False).ids)]


def tokenizer(made=[]):  # noqa: B006
    if not made:
        made.append(tokenizers.Tokenizer.from_file(FILE))
    return made[0]


def test_counts_like_the_library(counter):
    assert counter.count(ODD) == [len(tokenizer().encode(x, add_special_tokens=False).ids) for x in ODD]


def test_overlapping_merges():
    m = token_count.Merges(open(FILE, encoding="utf-8").read())
    words = [b"a" * n for n in range(1, 40)] + [b"", b"\xff\xfe"]
    want = [len(tokenizer().encode(w.decode(), add_special_tokens=False).ids) for w in words[:39]]
    assert m.count(words).tolist() == [*want, 0, 2]
    assert m.count([]).tolist() == []


def test_frames(docs_of, empty):
    docs = docs_of([None, "", "hello world", "x" * 100_000, "hello world"])
    got = {r[0]: tuple(r)[1:] for r in byte_bpe.encode(docs, RANKS, decode=True).select("row.doc_id", "n_tokens", "decoded").collect()}
    assert got[0] == (0, bytearray()) and got[1] == got[0] and got[2] == (2, bytearray(b"hello world")) == got[4]
    assert hashlib.sha256(got[3][1]).digest() == hashlib.sha256(b"x" * 100_000).digest()
    encoded = byte_bpe.encode(docs, RANKS)
    back = {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decode(encoded.select("row.doc_id", "ids"), RANKS).collect()}
    assert back[2] == "hello world" and back[0] == ""
    counts = {r[0]: tuple(r)[1:] for r in token_count.token_counts(docs, FILE).select("row.doc_id", "n_bytes", "n_tokens").collect()}
    assert counts[0] == (0, 0) and counts[2] == (11, 2) and counts[3][1] == got[3][0]
    assert byte_bpe.encode(empty, RANKS).count() == 0 and token_count.token_counts(empty, FILE).count() == 0
    assert byte_bpe.encode(docs, RANKS).select("row.*").columns == docs.columns
