"""Byte and word substring dedup against brute force."""

import pytest

from basketry.llm import fm_dedup, suffix_dedup
from basketry.llm.repeats import BUCKET_BYTES, HOT

from . import brute
from .conftest import SMALL, edge_rows

#: Production settings, and settings that send almost everything through the split of crowded anchors.
SETTINGS = [{"hot": HOT, "bucket_bytes": BUCKET_BYTES}, {"hot": 1, "bucket_bytes": 20_000}]


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("settings", SETTINGS, ids=["plain", "crowded"])
@pytest.mark.parametrize("window,shingle", [(400, 64), (50, 16), (9, 3)])
def test_edge_bytes(edge_docs, settings, window, shingle):
    rows = edge_rows()
    want = [(r[0], *c) for r, c in zip(rows, brute.cut_bytes([r[1] for r in rows], window), strict=True)]
    got = suffix_dedup.dedup_substrings(edge_docs, window, shingle, with_text=False, **settings)
    assert rows_of(got, BYTES) == sorted(want, key=repr)


@pytest.mark.parametrize("settings", SETTINGS, ids=["plain", "crowded"])
def test_edge_words(edge_docs, settings):
    rows = edge_rows()
    got = fm_dedup.dedup_word_windows(edge_docs, with_text=False, **settings)
    assert rows_of(got, WORDS) == sorted(brute.cut_words([r[:2] for r in rows], 13), key=repr)


def test_texts_and_spans(spark, edge_docs):
    got = {r["doc_id"]: r for r in suffix_dedup.dedup_substrings(edge_docs.where("doc_id in (1, 11, 14)")).collect()}
    texts = {r[0]: r[1].encode() for r in edge_rows() if r[1] is not None}
    for i, r in got.items():
        left, at = b"", 0
        for a, b in zip(r["span_starts"], r["span_ends"], strict=True):
            left, at = left + texts[i][at:a], b
        assert bytes(r["kept"]) == left + texts[i][at:] and brute.sha(bytes(r["kept"])) == r["kept_sha256"]
    got = {r["doc_id"]: r for r in fm_dedup.dedup_word_windows(edge_docs.where("doc_id in (1, 11, 14)")).collect()}
    for i, r in got.items():
        w = brute.words(texts[i].decode())
        gone = {x for a, b in zip(r["span_starts"], r["span_ends"], strict=True) for x in range(a, b)}
        assert r["kept_text"] == " ".join(x for n, x in enumerate(w) if n not in gone)


def test_whole_table(spark, small_docs):
    want = [(d["doc_id"], *c) for d, c in zip(small_docs, brute.cut_bytes([d["text"] for d in small_docs], 400), strict=True)]
    assert rows_of(suffix_dedup.op2_suffix_dedup(spark, SMALL), BYTES) == sorted(want, key=repr)
    want = brute.cut_words([(d["doc_id"], d["text"]) for d in small_docs], 13)
    assert rows_of(fm_dedup.op4_fm_dedup(spark, SMALL), WORDS) == sorted(want, key=repr)


def test_empty(no_docs):
    assert suffix_dedup.dedup_substrings(no_docs).collect() == []
    assert fm_dedup.dedup_word_windows(no_docs).collect() == []


def test_difference_cover():
    pairs = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert pairs == set(range(suffix_dedup.PERIOD))


def test_fm_index_counts():
    import numpy as np

    symbols = np.array([1, 2, 1, 2, 3, 0, 2, 1, 2, 3, 0, 1, 2, 1, 0])
    index = fm_dedup.FMIndex(symbols, 4, 3)
    ends = np.array([i + 3 for i in range(len(symbols) - 2) if 0 not in symbols[i : i + 3]])
    which, low, high = index.search(symbols, ends, 3)
    windows = [tuple(symbols[e - 3 : e]) for e in ends]
    assert {int(i): int(h - a) for i, a, h in zip(which, low, high, strict=True)} == {i: windows.count(w) for i, w in enumerate(windows) if windows.count(w) > 1}
