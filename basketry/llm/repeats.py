"""Where do windows of a corpus repeat?  The distributed frame of the substring operators.

A text is a sequence of units (bytes, or words); a window is ``window`` consecutive units of one text.
Windows are routed by content: the shingle of ``shingle`` units with the least hash inside a
window is its anchor, so equal windows have equal anchors.  A maximal run of windows with one anchor occurrence
is a segment.

1. ``entries`` of a bucket of texts: each distinct (anchor, segment), pre-aggregated.
2. ``judge`` for a shard of anchors: a segment that occurs again needs no further look (all its windows repeat); a segment
   that shares its anchor with other segments goes to the index of its shard, one copy of it.
3. the operator's index finds windows that distinct segments share, and
4. every text is cut by what 2 and 3 found.

Anchors with more than ``HOT`` distinct segments (the surroundings of a passage that
a large part of the corpus holds) would fill one shard; their segments are split into single windows,
dealt by the window's own fingerprint.

Texts are shuffled once (one exchange that steps 1, 3 and 4 reuse); what travels besides is packed
arrays: some bytes an anchor, and the segments that need an index.  Nothing is collected, and each step is a
pure function of its rows, so lost tasks are simply run again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import RollingHash, mix64, text_blocks, word_spans

#: Distinct segments of one anchor above which they are split into windows.
HOT = 512
#: Text in a bucket, the most for a huge corpus, and the number of buckets that calls for larger ones.
BUCKET_BYTES, BUCKET_BYTES_MOST, MANY_BUCKETS = 2 << 20, 64 << 20, 200_000
#: Units hashed at a time.
CHUNK = 1 << 18
LAST = np.iinfo(np.int64).max
OWNER, SIBLINGS, CROWDED, AGAIN = 1, 2, 4, 8
LOW = np.uint64(0xFFFFFFFF)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling spans."""
    span, out = 1, x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Bucket:
    """The texts of one bucket, cut into units, with their segments.

    Segment ``i`` begins at unit ``start[i]``, holds ``count[i]`` windows and has its anchor at unit
    ``at[i]``; ``entry[i]`` is the number of its entry, in the order of (shard, key)."""

    docs: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    units: np.ndarray
    unit_bounds: np.ndarray
    word_starts: np.ndarray | None
    word_ends: np.ndarray | None
    start: np.ndarray
    count: np.ndarray
    at: np.ndarray
    text: np.ndarray
    entry: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    least_doc: np.ndarray
    several: np.ndarray
    shard: np.ndarray


class Cutter:
    """Cuts a bucket's texts into units and segments, always the same way."""

    def __init__(self, window: int, shingle: int, words: bool, shards: int) -> None:
        self.window, self.shingle, self.words, self.shards = window, shingle, words, shards
        self.bytes, self.units = RollingHash(21), RollingHash(22)

    def runs(self, units: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(start, count, at, anchor, segment)`` of consecutive texts."""
        n, w, k = len(units), self.window, self.shingle
        nothing = np.zeros(0, np.int64)
        if n < w:
            return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
        prefix = self.units.prefix(units)
        shingles = mix64((prefix[k:] - prefix[:-k]) * self.units.inverse[: n - k + 1])
        packed = (shingles & ~LOW) | np.arange(n - k + 1, dtype=np.uint64)
        least = (sliding_min(packed, w - k + 1) & LOW).astype(np.int64)
        place = np.arange(n - w + 1)
        inside = np.repeat(bounds[1:], np.diff(bounds))[: n - w + 1] >= place + w
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
        stops = np.append(np.flatnonzero(new | ~inside), n - w + 1)
        start = np.flatnonzero(new)
        count = stops[np.searchsorted(stops, start) + 1] - start
        at = least[start]
        return start, count, at, shingles[at], self.units.windows(prefix, start, start + count - 1 + w)

    def __call__(self, docs: pa.Array, texts: pa.Array) -> Bucket:
        ids = docs.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        blocks = list(text_blocks(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, 1 << 40))
        _, _, data, bounds = blocks[0] if blocks else (0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64))
        starts = ends = None
        units, unit_bounds = data, bounds
        if self.words:
            starts, ends, owner = word_spans(data, bounds)
            units = self.bytes.windows(self.bytes.prefix(data), starts, ends)
            unit_bounds = np.searchsorted(owner, np.arange(len(bounds)))
        found, first = [], 0
        while first < len(unit_bounds) - 1:
            last = max(first + 1, int(np.searchsorted(unit_bounds, unit_bounds[first] + CHUNK, side="right")) - 1)
            a, b = unit_bounds[first], unit_bounds[last]
            s, c, at, anchor, segment = self.runs(units[a:b], unit_bounds[first : last + 1] - a)
            found.append((s + a, c, at + a, anchor, segment))
            first = last
        start, count, at, anchor, segment = (np.concatenate(x) for x in zip(*found, strict=True)) if found else self.runs(units[:0], unit_bounds[:1])
        text = np.searchsorted(unit_bounds, start, side="right") - 1
        key = mix64(anchor + mix64(segment))
        shard = (anchor % np.uint64(self.shards)).astype(np.int32)
        order = np.lexsort((key, shard))
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[order][1:] != key[order][:-1]
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        lead = order[heads]
        doc = ids[text]
        least_doc = np.minimum.reduceat(doc[order], heads) if len(heads) else doc[:0]
        several = np.diff(np.append(heads, len(order))) > 1
        return Bucket(ids, data, bounds, units, unit_bounds, starts, ends, start, count, at, text, entry, anchor[lead], key[lead], least_doc, several, shard[lead])


def cut_by_shard(shard: np.ndarray) -> list[tuple[int, slice]]:
    """Runs of a sorted array of shards."""
    if not len(shard):
        return []
    heads = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return [(int(shard[a]), slice(int(a), int(b))) for a, b in zip(heads, np.append(heads[1:], len(shard)), strict=True)]


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The packed arrays of a column, back to back."""
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) if x.is_valid else np.zeros(0, dtype) for c in column.chunks for x in c] or [np.zeros(0, dtype)])


def sizes_of(column: pa.ChunkedArray, width: int) -> list[int]:
    return [len(x.as_buffer()) // width if x.is_valid else 0 for c in column.chunks for x in c]


#: A packed row: kind 0 carries the codes of a bucket, 1 segments for an index, 2 single windows, 3 what was found.
PACKED = "shard int, bucket int, kind int, entries binary, lengths binary, offsets binary, docs binary, data binary"
PACKED_ARROW = pa.schema(
    [("shard", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32())] + [(x, pa.binary()) for x in ("entries", "lengths", "offsets", "docs", "data")]
)


def packed_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(PACKED_ARROW)
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, PACKED_ARROW, strict=True)], schema=PACKED_ARROW)


#: What an index answers: for every entry with shared windows, runs ``[first, last)`` of window numbers.
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Segments:
    """Segments of one shard: ``data`` (units) cut by ``lengths``; ``offsets`` are the anchors' places in them."""

    lengths: np.ndarray
    offsets: np.ndarray
    docs: np.ndarray
    data: np.ndarray


def runs_of(owner: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive numbers of each owner (both sorted): ``(owner, first, last)``."""
    if not len(owner):
        return owner, number, number
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(owner)) - 1
    return owner[heads], number[heads], number[tails] + 1


def find_repeats(
    docs: DataFrame,
    window: int,
    shingle: int,
    words: bool,
    by_doc: bool,
    index: Callable[[Segments, int, bool], Found],
    finish: Callable[[Bucket, np.ndarray], pa.Table],
    schema: str,
    hot: int = HOT,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Applies ``finish(bucket, covered)`` to every bucket of texts of ``docs`` (``doc_id, text``).

    ``covered`` says for every unit whether a window over it also starts elsewhere (``by_doc``: in a document
    with a smaller ``doc_id``).  ``index(segments, window, by_doc)`` finds windows that distinct segments share
    (``by_doc``: with a segment of a smaller doc)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    each = min(max(bucket_bytes, -(-size // MANY_BUCKETS)), max(BUCKET_BYTES_MOST, bucket_bytes))
    buckets = shards = max(1, -(-size // each))
    unit = np.uint64 if words else np.uint8
    width = np.dtype(unit).itemsize
    # Rows without an id are dealt like others; documents of one id meet in one bucket.
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.pmod(F.xxhash64(F.lit("bucket"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(buckets)).cast("int").alias("bucket"),
    )

    def cutter() -> Cutter:
        return Cutter(window, shingle, words, shards)

    def list_entries(table: pa.Table) -> pa.Table:
        b = cutter()(table.column("doc_id").combine_chunks(), table.column("text"))
        number = table.column("bucket")[0].as_py()
        rows = []
        for shard, at in cut_by_shard(b.shard):
            docs_ = b.least_doc[at].tobytes() if by_doc else None
            rows.append((shard, number, 1, b.anchor[at].tobytes(), b.key[at].tobytes(), b.several[at].tobytes(), docs_, None))
        return packed_table(rows)

    def judge(table: pa.Table) -> pa.Table:
        anchor, key = joined(table.column("entries"), np.uint64), joined(table.column("lengths"), np.uint64)
        several = joined(table.column("offsets"), np.bool_)
        sizes = sizes_of(table.column("entries"), 8)
        numbers = table.column("bucket").to_numpy()
        doc = joined(table.column("docs"), np.int64) if by_doc else np.repeat(numbers, sizes).astype(np.int64)
        order = np.lexsort((doc, key, anchor))
        a, k = anchor[order], key[order]
        new_anchor = np.append(True, a[1:] != a[:-1])
        new = new_anchor | np.append(True, k[1:] != k[:-1])
        group = np.cumsum(new) - 1
        total = np.bincount(group)
        again = (total > 1) | (np.bincount(group, weights=several[order]) > 0)
        family = np.cumsum(new_anchor) - 1
        distinct = np.bincount(family[new])[family]
        code = OWNER * new + SIBLINGS * (distinct > 1) + CROWDED * (distinct > hot) + AGAIN * again[group]
        out = np.empty(len(order), np.uint8)
        out[order] = code
        ends = np.cumsum(sizes)
        shard = table.column("shard")[0].as_py()
        return packed_table([(shard, int(x), 0, out[e - n : e].tobytes(), None, None, None, None) for x, n, e in zip(numbers, sizes, ends, strict=True)])

    def codes_of(b: Bucket, table: pa.Table) -> np.ndarray:
        """The codes of the bucket's entries, from the answers of all shards."""
        code = np.zeros(len(b.key), np.uint8)
        kind = table.column("kind").to_numpy() if table.num_rows else np.zeros(0, np.int32)
        place = dict(cut_by_shard(b.shard))
        shard, blobs = table.column("shard").to_pylist(), table.column("entries")
        for i in np.flatnonzero(kind == 0):
            x = np.frombuffer(blobs[int(i)].as_buffer(), np.uint8)
            if shard[i] < 0:
                return x
            code[place[shard[i]]] = x
        return code

    def send(texts_: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts_.num_rows:
            return packed_table([])
        b = cutter()(texts_.column("doc_id").combine_chunks(), texts_.column("text"))
        number = texts_.column("bucket")[0].as_py()
        code = codes_of(b, answers)
        rows: list[tuple] = [(number % shards, number, 0, code.tobytes(), None, None, None, None)]
        # One occurrence of each entry that needs an index.
        wanted = ((code & (OWNER | SIBLINGS)) == (OWNER | SIBLINGS))[b.entry] if len(b.entry) else np.zeros(0, bool)
        if by_doc and len(b.entry):
            wanted &= b.docs[b.text] == b.least_doc[b.entry]
        chosen = np.flatnonzero(wanted)
        chosen = chosen[np.unique(b.entry[chosen], return_index=True)[1]]
        entry = b.entry[chosen]
        crowded = (code[entry] & CROWDED) > 0
        for many in (False, True):
            own, num = chosen[crowded == many], entry[crowded == many]
            if not len(own):
                continue
            if many:
                size = b.count[own]
                segment = np.repeat(np.arange(len(own)), size)
                offset = np.arange(len(segment)) - np.repeat(np.cumsum(size) - size, size)
                hashes = window_hashes(b, b.start[own][segment] + offset)
                shard = (hashes % np.uint64(shards)).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                for s, at in cut_by_shard(shard[order]):
                    x = order[at]
                    rows.append((s, number, 2, num[segment[x]].astype(np.uint32).tobytes(), hashes[x].tobytes(), offset[x].astype(np.uint32).tobytes(), b.least_doc[num[segment[x]]].tobytes(), None))
            else:
                for s, at in cut_by_shard(b.shard[num]):
                    x, length = own[at], b.count[own[at]] + window - 1
                    first = b.start[x]
                    place = np.arange(length.sum()) + np.repeat(first - (np.cumsum(length) - length), length)
                    rows.append((
                        s, number, 1, num[at].astype(np.uint32).tobytes(), length.astype(np.uint32).tobytes(),
                        (b.at[x] - first).astype(np.uint32).tobytes(), b.least_doc[num[at]].tobytes(), b.units[place].tobytes(),
                    ))
        return packed_table(rows)

    def window_hashes(b: Bucket, start: np.ndarray) -> np.ndarray:
        hasher = RollingHash(23)
        prefix = hasher.prefix(b.units)
        return hasher.windows(prefix, start, start + window)

    def search(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        out: list[tuple] = []
        for i in np.flatnonzero(kind == 0):
            row = {c: table.column(c)[int(i)].as_py() for c in ("bucket", "entries")}
            out.append((-1, row["bucket"], 0, row["entries"], None, None, None, None))
        for which in (1, 2):
            own = table.filter(pa.array(kind == which))
            if not own.num_rows:
                continue
            entry = joined(own.column("entries"), np.uint32)
            bucket = np.repeat(own.column("bucket").to_numpy(), sizes_of(own.column("entries"), 4))
            doc = joined(own.column("docs"), np.int64)
            if which == 1:
                segments = Segments(
                    joined(own.column("lengths"), np.uint32).astype(np.int64), joined(own.column("offsets"), np.uint32).astype(np.int64), doc, joined(own.column("data"), unit)
                )
                segment, first, last = index(segments, window, by_doc)
            else:
                value, number = joined(own.column("lengths"), np.uint64), joined(own.column("offsets"), np.uint32).astype(np.int64)
                _, group, times = np.unique(value, return_inverse=True, return_counts=True)
                if by_doc:
                    least = np.full(len(times), LAST)
                    np.minimum.at(least, group, doc)
                    hit = np.flatnonzero(least[group] < doc)
                else:
                    hit = np.flatnonzero(times[group] > 1)
                order = np.lexsort((number[hit], entry[hit], bucket[hit]))
                hit = hit[order]
                name = bucket[hit].astype(np.int64) << 32 | entry[hit]
                _, first, last = runs_of(name, number[hit])
                segment = hit[np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (number[hit][1:] != number[hit][:-1] + 1)))] if len(hit) else hit
            order = np.argsort(bucket[segment], kind="stable")
            segment, first, last = segment[order], first[order], last[order]
            for x, at in cut_by_shard(bucket[segment].astype(np.int32)):
                out.append((0, x, 3, entry[segment[at]].tobytes(), first[at].astype(np.uint32).tobytes(), last[at].astype(np.uint32).tobytes(), None, None))
        return packed_table(out)

    def cut(texts_: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts_.num_rows:
            return finish(None, None)
        b = cutter()(texts_.column("doc_id").combine_chunks(), texts_.column("text"))
        code = codes_of(b, answers)
        whole = (code[b.entry] & AGAIN) > 0
        if by_doc:
            whole = ((code[b.entry] & OWNER) == 0) | (b.docs[b.text] > b.least_doc[b.entry])
        edge = np.zeros(len(b.units) + 1, np.int64)
        np.add.at(edge, b.start[whole], 1)
        np.subtract.at(edge, b.start[whole] + b.count[whole] - 1 + window, 1)
        told = answers.filter(pa.array(answers.column("kind").to_numpy() == 3)) if answers.num_rows else answers
        if told.num_rows:
            entry, first, last = (joined(told.column(c), np.uint32).astype(np.int64) for c in ("entries", "lengths", "offsets"))
            order = np.argsort(entry, kind="stable")
            entry, first, last = entry[order], first[order], last[order]
            rest = np.flatnonzero(~whole)
            lo, hi = np.searchsorted(entry, b.entry[rest]), np.searchsorted(entry, b.entry[rest], side="right")
            times = hi - lo
            x = np.repeat(rest, times)
            run = np.arange(len(x)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
            np.add.at(edge, b.start[x] + first[run], 1)
            np.subtract.at(edge, b.start[x] + last[run] - 1 + window, 1)
        return finish(b, np.cumsum(edge)[:-1] > 0)

    listed = texts.groupBy("bucket").applyInArrow(list_entries, PACKED)
    judged = listed.groupBy("shard").applyInArrow(judge, PACKED)
    sent = texts.groupBy("bucket").cogroup(judged.groupBy("bucket")).applyInArrow(send, PACKED)
    found = sent.groupBy("shard").applyInArrow(search, PACKED)
    return texts.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(cut, schema)
