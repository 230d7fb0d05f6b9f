"""Substring dedup over words with compressed FM-indexes.

Words that lie in a window of 13 words which also starts in a document with a smaller id are taken
out.  ``repeats`` routes segments of word fingerprints to shards; each shard gets an FM-index:
the Burrows-Wheeler transform of its segments in a wavelet matrix (bit vectors with a count every 64 bits).  The
segments are streamed through it by backward search, all at once: after each word the interval of
suffixes that match so far; a window is given up as soon as only its own suffix matches.  What is left after
13 words are the windows whose matching statistic reaches the threshold, and
the least document of the interval decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.common import read_table
from basketry.llm.repeats import LAST, Bucket, Found, Segments, find_repeats, runs_of
from basketry.llm.suffix_dedup import dense_rank

WINDOW, SHINGLE = 13, 5


class BitVector:
    """Bits with a count before every 64 of them."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(counts, dtype=np.uint32) - counts

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence of small numbers."""

    def __init__(self, symbols: np.ndarray, n_symbols: int) -> None:
        self.levels, self.zeros = [], []
        self.bits = max(1, int(n_symbols - 1).bit_length())
        rest = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (rest >> level) & 1
            self.levels.append(BitVector(bit.astype(np.uint8)))
            self.zeros.append(int(len(bit) - bit.sum()))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])
        every = np.arange(n_symbols)
        self.base = self.descend(every, np.zeros(n_symbols, np.int64))

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, (vector, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = vector.ones(at)
            at = np.where((symbol >> (self.bits - 1 - i)) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self.descend(symbol, at) - self.base[symbol]


class FMIndex:
    """Index of a sequence of symbols 1..n (0 separates); patterns up to ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, depth: int) -> None:
        # Suffixes in the order of their first ``depth`` symbols, by doubling.
        rank, span = symbols.astype(np.int64), 1
        while span < depth:
            step = min(span, depth - span)
            later = np.zeros_like(rank)
            later[: len(rank) - step] = rank[step:]
            rank = dense_rank(rank * (int(rank.max(initial=0)) + 1) + later)
            span += step
        self.suffixes = np.argsort(rank, kind="stable")
        before = symbols[self.suffixes - 1]
        self.wavelet = WaveletMatrix(before, n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])

    def search(self, symbols: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of ``length`` symbols before ``ends`` that occur more than once: ``(which, low, high)`` of their intervals."""
        which = np.arange(len(ends))
        c = symbols[ends - 1]
        low, high = self.first[c], self.first[c + 1]
        for back in range(2, length + 1):
            live = high - low > 1
            which, low, high = which[live], low[live], high[live]
            c = symbols[ends[which] - back]
            low, high = self.first[c] + self.wavelet.rank(c, low), self.first[c] + self.wavelet.rank(c, high)
        live = high - low > 1
        return which[live], low[live], high[live]


def fm_index(segments: Segments, window: int, by_doc: bool = True) -> Found:
    """Windows that another segment holds (``by_doc``: one of a smaller doc): ``(segment, first, last)`` runs of window numbers."""
    n = len(segments.lengths)
    words, ids = np.unique(segments.data, return_inverse=True)
    ends = np.cumsum(segments.lengths)
    owner = np.repeat(np.arange(n), segments.lengths)
    # One separator after each segment.
    symbols = np.zeros(len(ids) + n, np.int64)
    symbols[np.arange(len(ids)) + owner] = ids + 1
    starts = ends - segments.lengths + np.arange(n)
    index = FMIndex(symbols, len(words) + 1, window)
    windows = segments.lengths - window + 1
    segment = np.repeat(np.arange(n), windows)
    number = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    which, low, high = index.search(symbols, starts[segment] + number + window, window)
    if by_doc:
        holder = np.append(np.repeat(segments.docs, segments.lengths + 1), LAST)
        doc = np.append(holder[index.suffixes], LAST)
        heads, group = np.unique(low, return_inverse=True)
        tails = np.zeros(len(heads), np.int64)
        tails[group] = high
        least = np.minimum.reduceat(doc, np.stack([heads, tails], axis=1).reshape(-1))[::2] if len(heads) else heads
        which = which[least[group] < segments.docs[segment[which]]] if len(which) else which
    which = np.sort(which)
    return runs_of(segment[which], number[which])


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, span_starts array<long>, span_ends array<long>"
NAMES = [x.strip().split()[0] for x in SCHEMA.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _rows(with_text: bool):
    width = len(NAMES) if with_text else 4

    def finish(b: Bucket | None, covered: np.ndarray | None) -> pa.Table:
        columns: list[list] = [[] for _ in range(width)]
        if b is not None:
            # The kept words of all texts, each with a space after it.
            kept = np.flatnonzero(~covered)
            length = (b.word_ends - b.word_starts)[kept]
            at = np.cumsum(length + 1) - (length + 1)
            out = np.full(int((length + 1).sum()), 0x20, np.uint8)
            moved = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            out[np.repeat(at, length) + moved] = b.data[np.repeat(b.word_starts[kept], length) + moved]
            cuts = np.append(at, len(out))[np.searchsorted(kept, b.unit_bounds)]
            raw = out.tobytes()
            gone = np.concatenate([[0], np.cumsum(covered)])
            for i, doc in enumerate(b.docs.tolist()):
                lo, hi = int(b.unit_bounds[i]), int(b.unit_bounds[i + 1])
                left = raw[cuts[i] : max(cuts[i], cuts[i + 1] - 1)]
                row = [None if doc == LAST else doc, hi - lo, int(gone[hi] - gone[lo]), hashlib.sha256(left).hexdigest()]
                if with_text:
                    edges = np.diff(np.concatenate([[0], covered[lo:hi].astype(np.int8), [0]]))
                    row += [left.decode("utf-8", "replace"), np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()]
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=False)], names=NAMES[:width])

    return finish


def dedup_word_windows(docs: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, with_text: bool = True, **settings) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, ``with_text``, the kept words joined by spaces and the removed word spans.

    Every word in a window of ``window`` words that also starts in a document with a smaller ``doc_id`` goes; windows are judged on the
    input.  Null texts have no words; rows with one id are no smaller than one another, so they don't cut each other; rows without
    an id come after all others; an empty table gives an empty result; other columns are ignored."""
    schema = SCHEMA if with_text else SCHEMA.split(", kept_text")[0]
    return find_repeats(docs, window, min(shingle, window), True, True, fm_index, _rows(with_text), schema, **settings)


def op4_fm_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_word_windows(read_table(spark, sf_dir, "documents"), with_text=False)
