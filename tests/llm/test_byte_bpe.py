"""Byte-level BPE against the tokenizer library."""

import base64
import hashlib

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import bpe_codec

from .conftest import SMALL, edge_rows


@pytest.fixture(scope="module")
def library():
    ranks = bpe_codec.read_ranks(bpe_codec.default_ranks())
    return tiktoken.Encoding("own", pat_str=bpe_codec.default_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.ByteCodec(bpe_codec.default_ranks(), bpe_codec.default_pattern())


def ids_of(codec, text):
    return [i for part in codec.encode(text) for i in part]


def digests(ids, text):
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_library(spark, small_docs, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe_codec.op12_byte_bpe(spark, SMALL).collect()}
    assert got == {d["doc_id"]: digests(library.encode_ordinary(d["text"] or ""), d["text"] or "") for d in small_docs}


def test_edges(spark, edge_docs, no_docs, library):
    want = sorted((repr(r[0]), library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in edge_rows())
    got = [(repr(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in bpe_codec.encode_decode(edge_docs).collect()]
    assert sorted(got) == want
    assert sorted((repr(r["doc_id"]), *tuple(r)[1:]) for r in bpe_codec.digest(edge_docs).collect()) == sorted(
        (i, *digests(ids, text.decode())) for i, ids, text in want
    )
    assert bpe_codec.digest(no_docs).collect() == [] and bpe_codec.encode_decode(no_docs).collect() == []


def test_every_character(codec, library):
    # Between letters, digits, signs and blanks, so that a wrong class shows as another cut.
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 4096):
        text = "".join(f"a{c}{c}1{c} {c}!{c}\n{c}" for c in every[at : at + 4096])
        assert ids_of(codec, text) == library.encode_ordinary(text), hex(ord(every[at]))


def test_long_text_in_chunks(codec, library, monkeypatch):
    text = ("It's 12 o'clock;  \n\n we'll \t go… " + "ab" * 40 + " ") * 300 + "z" * 20000 + " " * 5000
    want = library.encode_ordinary(text)
    monkeypatch.setattr(bpe_codec, "CHUNK", 7)
    monkeypatch.setattr(bpe_codec, "CACHE_CHARS", 50)
    assert ids_of(codec, text) == want and codec.decode(want) == text.encode()
    odd = chr(next(iter(codec.odd))) + text
    assert ids_of(codec, odd) == library.encode_ordinary(odd)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    own, lib = _both()
    ids = ids_of(own, text)
    assert ids == lib.encode_ordinary(text) and own.decode(ids) == text.encode()


def _both(made=[]):
    if not made:
        ranks = bpe_codec.read_ranks(bpe_codec.default_ranks())
        made.append(bpe_codec.ByteCodec(bpe_codec.default_ranks(), bpe_codec.default_pattern()))
        made.append(tiktoken.Encoding("own", pat_str=bpe_codec.default_pattern(), mergeable_ranks=ranks, special_tokens={}))
    return made


def write_ranks(path, tokens):
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in tokens.items()))
    return str(path)


def test_other_vocabularies(tmp_path):
    # Ranks with gaps, merges that block each other, and a token that no merges reach.
    tokens = {bytes([b]): 3 * b for b in range(256)} | {b"bc": 1000, b"ab": 1001, b"abc": 1002, b"aa": 1003, b"aaaa": 1010, b"hello": 1020}
    path = write_ranks(tmp_path / "ranks", tokens)
    own = bpe_codec.ByteCodec(path, bpe_codec.default_pattern())
    lib = tiktoken.Encoding("t", pat_str=bpe_codec.default_pattern(), mergeable_ranks=tokens, special_tokens={})
    for text in ("abc", "abcabc bcab", "aaaaaaa", "hello", "hellohello", " hello", "é\x00ÿ", "aab" * 50):
        ids = ids_of(own, text)
        assert ids == lib.encode_ordinary(text) and own.decode(ids) == text.encode()
    del tokens[b"\x07"]
    with pytest.raises(ValueError, match="single bytes"):
        bpe_codec.serialize(tokens)
