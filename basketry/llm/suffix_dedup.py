"""Substring dedup with a blockwise suffix array over a difference cover.

Bytes of texts that lie in a 400-byte string which also starts elsewhere are taken out.
``repeats`` routes text segments to shards; a shard's index is built here:

* Positions whose residue modulo 7 lies in the difference cover {0, 1, 3} are the sample.  The
  sample suffixes are ranked first, by their first 7 bytes and then by doubling (a
  sample position plus a multiple of 7 is a sample position).
* All suffixes are then sorted one bucket at a time (residue and first byte).  A suffix is compared by its few
  bytes before the next sample position and after that by the sample's rank, so long ties cost
  no more than short ones and memory is one bucket beside the sample.
* Segments are laid out with their anchors on multiples of 7: equal strings then have equal residues,
  and the offset at which both meet the sample is the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.common import read_table
from basketry.llm.repeats import Bucket, Found, Segments, find_repeats, runs_of

WINDOW, SHINGLE = 400, 64
#: Difference cover: every difference modulo PERIOD is one between two of its members.
PERIOD, COVER = 7, (0, 1, 3)


def dense_rank(key: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct values."""
    order = np.argsort(key)
    new = np.zeros(len(key), dtype=np.int64)
    new[1:] = key[order][1:] != key[order][:-1]
    out = np.empty(len(key), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


class CoverRanks:
    """Ranks of the sample suffixes of ``text`` by their first ``depth`` bytes (a multiple of PERIOD)."""

    def __init__(self, text: np.ndarray, longest: int) -> None:
        self.n = -(-len(text) // PERIOD) + longest // PERIOD + 2
        padded = np.zeros(self.n * PERIOD + 8, np.uint8)
        padded[: len(text)] = text
        self.text = padded
        # Sample position PERIOD * q + COVER[c] is stored at [c, q].
        head = np.stack([self.word(np.arange(self.n) * PERIOD + c, PERIOD) for c in COVER])
        self.levels = [dense_rank(head.reshape(-1)).reshape(head.shape)]
        while 2 * PERIOD << (len(self.levels) - 1) <= longest:
            self.levels.append(self.paired(self.levels[-1], 1 << (len(self.levels) - 1)))

    def word(self, at: np.ndarray, width: int) -> np.ndarray:
        """``width`` (up to 8) bytes from each place, as one number."""
        out = np.zeros(at.shape, np.uint64)
        for i in range(width):
            out = out << np.uint64(8) | self.text[np.minimum(at + i, len(self.text) - 1)]
        return out

    def paired(self, rank: np.ndarray, shift: int) -> np.ndarray:
        """Ranks of two stretches, the second ``shift`` periods on."""
        later = np.zeros_like(rank)
        later[:, : rank.shape[1] - shift] = rank[:, shift:]
        return dense_rank((rank * (rank.max() + 1) + later).reshape(-1)).reshape(rank.shape)

    def at_depth(self, periods: int) -> np.ndarray:
        """Ranks by the first ``periods`` periods: two overlapping stretches of a power of two."""
        level = periods.bit_length() - 1
        shift = periods - (1 << level)
        return self.paired(self.levels[level], shift) if shift else self.levels[level]


def suffix_index(segments: Segments, window: int, by_doc: bool = False) -> Found:
    """Windows of distinct segments that are equal: ``(segment, first, last)`` runs of window numbers."""
    # Lay segments out with anchors on multiples of PERIOD.
    lead = (-segments.offsets) % PERIOD
    room = lead + segments.lengths
    room += -room % PERIOD
    base = np.cumsum(room) - room + lead
    text = np.zeros(int(room.sum()), np.uint8)
    ends = np.cumsum(segments.lengths)
    text[np.arange(len(segments.data)) + np.repeat(base - (ends - segments.lengths), segments.lengths)] = segments.data
    ranks = CoverRanks(text, window)
    windows = segments.lengths - window + 1
    segment = np.repeat(np.arange(len(windows)), windows)
    number = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = base[segment] + number
    hits, memo = [], {}
    residue = start % PERIOD
    for r in range(PERIOD):
        ahead = next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER)
        periods = (window - ahead) // PERIOD
        if periods and periods not in memo:
            memo[periods] = ranks.at_depth(periods)
        after = window - ahead - periods * PERIOD
        mine = np.flatnonzero(residue == r)
        first_byte = ranks.text[start[mine]]
        order = np.argsort(first_byte, kind="stable")
        cuts = np.searchsorted(first_byte[order], np.arange(257))
        for byte in range(256):
            block = mine[order[cuts[byte] : cuts[byte + 1]]]
            if len(block) < 2:
                continue
            i = start[block]
            keys = [ranks.word(i, ahead), ranks.word(i + window - after, after)]
            if periods:
                at = i + ahead
                keys.append(memo[periods][[COVER.index((r + ahead) % PERIOD)] * len(at), at // PERIOD].astype(np.uint64))
            if ahead + after <= 8:
                keys = [keys[0] << np.uint64(8 * after) | keys[1] if after < 8 else keys[1], *keys[2:]]
            place = np.lexsort(keys)
            same = np.ones(len(place) - 1, dtype=bool)
            for k in keys:
                same &= k[place][1:] == k[place][:-1]
            tie = np.append(same, False) | np.append(False, same)
            hits.append(block[place[tie]])
    hit = np.sort(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
    return runs_of(segment[hit], number[hit])


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, span_starts array<long>, span_ends array<long>"
NAMES = [x.strip().split()[0] for x in SCHEMA.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _rows(with_text: bool):
    width = len(NAMES) if with_text else 5

    def finish(b: Bucket | None, covered: np.ndarray | None) -> pa.Table:
        columns: list[list] = [[] for _ in range(width)]
        for i in range(0 if b is None else len(b.docs)):
            lo, hi = b.bounds[i], b.bounds[i + 1]
            gone = covered[lo:hi]
            left = b.data[lo:hi][~gone].tobytes()
            edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            row = [None if b.docs[i] == np.iinfo(np.int64).max else int(b.docs[i]), int(hi - lo), int(gone.sum()), len(starts), hashlib.sha256(left).hexdigest()]
            for c, v in zip(columns, [*row, left, starts.tolist(), ends.tolist()] if with_text else row, strict=True):
                c.append(v)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=False)], names=NAMES[:width])

    return finish


def dedup_substrings(docs: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, with_text: bool = True, **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, ``with_text``, the kept bytes and removed spans.

    Every byte in a ``window``-byte string that also starts elsewhere goes, in the same text too, overlaps included; strings are judged on the
    input.  Null texts are empty; shorter texts stay whole; rows repeated with one id are texts of their own (so
    they lose what they share); rows without an id keep a null id; an empty table gives an empty result; other columns are ignored."""
    schema = SCHEMA if with_text else SCHEMA.split(", kept binary")[0]
    return find_repeats(docs, window, min(shingle, window), False, False, suffix_index, _rows(with_text), schema, **settings)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(read_table(spark, sf_dir, "documents"), with_text=False)
