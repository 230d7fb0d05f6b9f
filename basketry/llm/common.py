"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.session import fresh_dir, ship_package

#: Bytes of text that one Python task holds expanded at a time (a single longer text is one block).
BLOCK_BYTES = 4 << 20

#: White space that separates words: space and U+0009..U+000D (fixed values of the contract).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage through a new Parquet folder below the shared checkpoint folder."""
    spark = df.sparkSession
    ship_package(spark)
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)  # the operators' Python workers import it
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column into runs of rows of about ``block_bytes``.

    Yields ``(first_row, last_row, data, bounds)``: ``data`` is the UTF-8 bytes
    of the rows back to back, row ``i`` of the run being
    ``data[bounds[i]:bounds[i + 1]]``.  Null texts are empty."""
    column = column.fill_null("").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, bounds: np.ndarray, separates: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row each belongs to; ``separates`` marks the bytes between words."""
    inside = ~separates[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    start[cut] = inside[cut]
    end[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RollingHash:
    """64-bit polynomial fingerprints of any substring, from prefix sums.

    ``of(data)`` gives the prefix sums; the fingerprint of ``data[i:j]`` is
    ``(P[j] - P[i]) * base**-i`` mod 2**64, mixed.  Equal substrings have equal
    fingerprints in every block, task and run."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, seed: int = 1) -> None:
        self.values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed))
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def reserve(self, n: int) -> None:
        if len(self.power) <= n:
            size = max(n + 1, 2 * len(self.power))
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """``symbols``: bytes, or 64-bit values (such as word fingerprints)."""
        n = len(symbols)
        self.reserve(n)
        values = self.values[symbols] if symbols.dtype == np.uint8 else symbols
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.power[:n], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((prefix[end] - prefix[start]) * self.inverse[start])


#: Estimated bytes up to which a counted table is broadcast; beyond it, joins shuffle both sides.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted rows times ``row_bytes`` stay within ``limit``, else ``df`` itself.

    ``df`` should be materialised (it is counted).  The result of the join is the same either way."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() * row_bytes <= limit else df
