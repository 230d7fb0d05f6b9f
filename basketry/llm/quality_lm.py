"""Quality rules with n-gram perplexity.

A character 4-gram model per label is counted by Spark over every text of the corpus and smoothed by
interpolated modified Kneser-Ney.  The alphabet is open (every code point is its own symbol) and nothing
bounds the number of n-grams.  Every document gets its perplexity under its own label's model; documents
outside the label's band (around the median, by robust deviations and the document's length) are
rejected, next to simple base rules.

An n-gram that only one distinct text of its label holds is no evidence for that text, so such n-grams
count as unseen: junk does not become likely by being part of the corpus.

How it runs:

1. the documents, as they lie in the input, are blocks of about ``PACK_BYTES`` of text; a task reduces each
   to its distinct 4-grams with counts, and Spark sums them by label and 4-gram;
2. continuation counts, discounts and back-off weights are grouped sums over the n-grams, order by order,
   and every 4-gram of the corpus gets its log probability by joins with its context and its suffix;
3. the documents are read again and scored from a sorted hash array of log probabilities: that of all
   4-grams, broadcast, up to a checked size; else each block, compressed, meets those of its own 4-grams in a shuffle.

Texts are never written, and only shuffled for a model that is too large to broadcast.  What a task holds is bounded by
a block (a longer text is one block) and that size.  A common n-gram costs one row a block, whatever the share of its source or label.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import BROADCAST_BYTES, IS_SPACE, RollingHash, materialize, mix64, read_table, small_side, text_blocks, word_spans

ORDER = 4
#: Room below and above the middle of a label's band, in units of its noise over the square root of words (see ``perplexity_bands``).
#: Names, numbers and code make clean texts dearer, seldom cheaper: the upper side is wider.
LOWER_NOISE, UPPER_NOISE = 4.0, 8.0
#: Least noise of a label, for labels of a few documents.
LEAST_NOISE = 0.3
#: Steps of the histograms from which medians are taken.
STEP = 1e-4
STATS_BYTES, PACK_BYTES = 1 << 19, 24 << 20
#: Distinct 4-grams of single steps that a block's counts hold before they are merged.
HELD_GRAMS = 1 << 18
#: Compression of blocks that are shuffled, and bytes of a 4-gram in a broadcast model (hash and log probability).
PACK_LEVEL, MODEL_BYTES = 6, 16
#: Characters counted as symbols (fixed values of the contract).
SYMBOL_BYTES = np.zeros(256, dtype=bool)
SYMBOL_BYTES[list(b"#*$%&|<>")] = True
REPEAT_WORDS, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
SPACE, NO_CHARACTER = 0x20, 0xFFFD


def text_grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(symbols, at, text)``: the symbols of all texts, the place of each symbol that ends a 4-gram, and its text.

    A symbol is a code point; runs of white space are one space, none leads a text, and every text
    begins after spaces.  U+0000 is read as U+FFFD."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    space = (points < 128) & IS_SPACE[np.minimum(points, 255)]
    keep = ~space
    keep[1:] |= ~space[:-1]
    heads = starts[:-1][starts[:-1] < starts[1:]]
    keep[heads] = ~space[heads]
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[keep]
    at = np.arange(len(text)) + (ORDER - 1) * (text + 1)
    symbols = np.full(len(text) + (ORDER - 1) * len(starts), SPACE, dtype=np.uint32)
    symbols[at] = np.where(space, SPACE, np.where(points == 0, NO_CHARACTER, points))[keep]
    return symbols, at, text


def gram_keys(symbols: np.ndarray, at: np.ndarray, label: np.ndarray) -> np.ndarray:
    """64-bit hash of (label, 4-gram) for every 4-gram; ``label`` is its label's hash."""
    mixed = mix64(symbols.astype(np.uint64) + np.uint64(1))
    rolled = mixed.copy()
    for back in range(1, ORDER):
        # the window's oldest symbols get the highest powers
        rolled[back:] += mixed[:-back] * np.uint64(pow(RollingHash.BASE, back, 1 << 64))
    return mix64(rolled[at] ^ mix64(label.view(np.uint64)))


class GramCounts:
    """Distinct 4-grams of one block: key, label, symbols, occurrences, least and greatest text hash."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, symbols: np.ndarray, at: np.ndarray, label: np.ndarray, text_key: np.ndarray) -> None:
        """The texts come in the order of their hashes."""
        if not len(at):
            return
        code, key = pd.factorize(gram_keys(symbols, at, label))
        place = np.arange(len(code))
        first, last = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        first[code[::-1]] = place[::-1]
        last[code] = place
        grams = symbols[at[first][:, None] + np.arange(1 - ORDER, 1)]
        self.parts.append((key, label[first], grams, np.bincount(code), text_key[first], text_key[last]))
        self.held += len(key)
        if self.held > HELD_GRAMS:
            self.parts, self.held = [self.merged()], 0

    def merged(self) -> tuple[np.ndarray, ...]:
        key, label, grams, n, least, most = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        one = order[first]
        return key[first], label[one], grams[one], np.add.reduceat(n[order], first), np.minimum.reduceat(least[order], first), np.maximum.reduceat(most[order], first)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        key, label, grams, n, least, most = self.merged()
        text = np.ascontiguousarray(grams).view(f"<U{ORDER}")[:, 0]
        for a in range(0, len(key), 1 << 17):
            b = slice(a, a + (1 << 17))
            columns = [
                pa.array(np.full(len(key[b]), block, np.int64)),
                pa.array(key[b].view(np.int64)),
                pa.array(label[b]),
                pa.array(text[b], pa.string()),
                pa.array(n[b]),
                pa.array(least[b], mask=least[b] != most[b]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "key", "label", "gram", "n", "only_text"])


def text_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, lang, label, text``."""
    lang = F.col("lang").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), lang.alias("lang"), F.xxhash64(lang).alias("label"), "text")


def block_parts(batches: Iterable[pa.RecordBatch], pack_bytes: int, step_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """``(block, part)``: the rows of a task as they come, about ``step_bytes`` of text a part and ``pack_bytes`` a block."""
    block, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for first, last, data, _ in text_blocks(batch.column(4), step_bytes):
            yield block, batch.slice(first, last - first)
            size += len(data)
            if size >= pack_bytes:
                block, size = block + 1, 0


def pack_documents(rows: DataFrame, pack_bytes: int = PACK_BYTES, step_bytes: int = STATS_BYTES) -> DataFrame:
    """``block, payload``: the documents (see ``text_rows``) as they lie in the input, in compressed blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=PACK_LEVEL))
        for block, parts in groupby(block_parts(batches, pack_bytes, step_bytes), lambda x: x[0]):
            out, writer = pa.BufferOutputStream(), None
            for _, part in parts:
                writer = writer or pa.ipc.new_stream(out, part.schema, options=options)
                writer.write_batch(part)
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["block", "payload"])

    return rows.mapInArrow(pack, "block long, payload binary")


def unpacked(payload: bytes) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(payload) as reader:
        yield from reader


def count_grams(rows: DataFrame, pack_bytes: int = PACK_BYTES, step_bytes: int = STATS_BYTES) -> DataFrame:
    """``block, key, label, gram, n, only_text``: a block's distinct 4-grams; ``only_text`` is null for those of several texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, parts in groupby(block_parts(batches, pack_bytes, step_bytes), lambda x: x[0]):
            counts = GramCounts()
            for _, part in parts:
                part = part.take(pa.array(np.argsort(part.column(1).to_numpy())))
                text_key, label = part.column(1).to_numpy(), part.column(3).to_numpy()
                for first, last, data, bounds in text_blocks(part.column(4), step_bytes):
                    symbols, at, text = text_grams(data, bounds)
                    counts.add(symbols, at, label[first:last][text], text_key[first:last][text])
            yield from counts.rows(block)

    return materialize(rows.mapInArrow(count, "block long, key long, label long, gram string, n long, only_text long"), "quality-counts")


def gram_levels(counts: DataFrame) -> list[DataFrame]:
    """``label, gram, n, c`` of every order from 1: ``n`` is the occurrences at the highest order and below it the number of
    distinct left extensions; ``c`` is the same without n-grams of a single text.

    The highest also has ``key``."""
    several = (F.count_if(F.col("only_text").isNull()) > 0) | (F.min("only_text") != F.max("only_text"))
    top = counts.groupBy("label", "gram", "key").agg(F.sum("n").alias("n"), F.when(several, F.sum("n")).otherwise(F.lit(0)).cast("long").alias("c"))
    levels = [materialize(top, "quality-grams")]
    while len(levels) < ORDER:
        shorter = levels[0].groupBy("label", F.expr("substring(gram, 2)").alias("gram")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c") > 0).alias("c"))
        levels.insert(0, materialize(shorter, "quality-grams"))
    return levels


def discounts(levels: list[DataFrame]) -> DataFrame:
    """``order, label, d1, d2, d3``: modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the counts of all
    n-grams; 0.5 where the formula gives none between 0 and the count."""
    numbered = [x.select(F.lit(k).alias("order"), "label", "n") for k, x in enumerate(levels, 1)]
    every = numbered[0]
    for x in numbered[1:]:
        every = every.unionByName(x)
    n = every.groupBy("order", "label").agg(*[F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.expr("n1 / nullif(n1 + 2 * n2, 0)")

    def within(value, k: int):
        return F.when((value > 0) & (value <= k), value).otherwise(F.lit(0.5))

    d = [within(k - (k + 1) * y * F.expr(f"n{k + 1} / nullif(n{k}, 0)"), k).alias(f"d{k}") for k in (1, 2, 3)]
    return n.select("order", "label", *d)


def smoothed(levels: list[DataFrame]) -> DataFrame:
    """``key, logp``: the interpolated probability of the last symbol of every 4-gram of the corpus after the others.

    What n-grams of a single text held goes to the lower order, with the discounts."""
    d = small_side(materialize(discounts(levels), "quality-discounts"), 64)
    # Below order 1: an equal share for each symbol of the label and one for all others.
    lower = levels[0].groupBy("label").agg((1 / (F.count(F.lit(1)) + 1)).alias("p_lower")).withColumn("suffix", F.lit(""))
    held = F.when(F.col("c") == 0, F.lit(0.0)).when(F.col("c") == 1, 1 - F.col("d1")).when(F.col("c") == 2, 2 - F.col("d2")).otherwise(F.col("c") - F.col("d3"))
    for order, level in enumerate(levels, 1):
        own = level.join(d.where(F.col("order") == order), "label").withColumn("held", held)
        own = own.withColumn("context", F.substring("gram", 1, order - 1)).withColumn("suffix", F.expr("substring(gram, 2)"))
        contexts = own.groupBy("label", "context").agg(F.sum("n").alias("total"), (1 - F.sum("held") / F.sum("n")).alias("backoff"))
        joined = own.join(contexts, ["label", "context"]).join(lower, ["label", "suffix"])
        p = F.col("held") / F.col("total") + F.col("backoff") * F.col("p_lower")
        if order == len(levels):
            return joined.select("key", F.log(p).alias("logp"))
        lower = materialize(joined.select("label", F.col("gram").alias("suffix"), p.alias("p_lower")), "quality-model")
    raise ValueError("no order")


def text_stats(data: np.ndarray, bounds: np.ndarray, hasher: RollingHash) -> dict[str, np.ndarray]:
    """The base figures of every text of a block."""
    n = len(bounds) - 1

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64)

    starts, ends, owner = word_spans(data, bounds)
    prefix = hasher.prefix(data)
    inside = ~IS_SPACE[data]
    out = {
        "n_words": np.bincount(owner, minlength=n).astype(np.int64),
        "word_chars": per_text(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(SYMBOL_BYTES[data]),
    }
    # Lines, cut at line ends and between texts.
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    line_end = np.sort(np.concatenate([bounds[1:], breaks]), kind="stable")
    line_owner = np.searchsorted(bounds, line_start, side="right") - 1
    line_owner = np.minimum(line_owner, n - 1)
    worded = np.concatenate([[0], np.cumsum(inside)])
    real = worded[line_end] > worded[line_start]
    line_start, line_end, line_owner = line_start[real], line_end[real], line_owner[real]
    key = mix64(hasher.windows(prefix, line_start, line_end) + line_owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    out["n_dup_lines"] = np.bincount(line_owner, minlength=n) - np.bincount(line_owner[np.unique(key, return_index=True)[1]], minlength=n)
    # Word windows.
    words = hasher.windows(prefix, starts, ends)
    m = len(words) - REPEAT_WORDS + 1
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if m > 0:
        at = np.flatnonzero(owner[:m] == owner[REPEAT_WORDS - 1 :])
        key = mix64(hasher.windows(hasher.prefix(words), at, at + REPEAT_WORDS) + owner[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        in_order = np.sort(key)
        twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
        if len(twice):
            place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            again = at[twice[place] == key]
            covered[again] += 1
            np.subtract.at(covered, again + REPEAT_WORDS, 1)
    out["n_repeat_words"] = np.bincount(owner, weights=np.cumsum(covered)[:-1] > 0, minlength=n).astype(np.int64)
    return out


SCORES = "doc_id long, text_key long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_read long, log_perplexity double"


def sorted_model(known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, logp)`` of a table ``key, logp``, by key."""
    keys, logp = known.column("key").to_numpy().view(np.uint64), known.column("logp").to_numpy()
    order = np.argsort(keys)
    return keys[order], logp[order]


def score_part(part: pa.RecordBatch, keys: np.ndarray, logp: np.ndarray, hasher: RollingHash, step_bytes: int) -> Iterator[pa.RecordBatch]:
    """The columns of ``SCORES`` for rows of ``text_rows``."""
    names = [x.split()[0] for x in SCORES.split(", ")]
    label = part.column(3).to_numpy()
    for first, last, data, bounds in text_blocks(part.column(4), step_bytes):
        stats = text_stats(data, bounds, hasher)
        symbols, at, text = text_grams(data, bounds)
        code, mine = pd.factorize(gram_keys(symbols, at, label[first:last][text]))
        place = np.searchsorted(keys, mine)
        if len(mine) and (not len(keys) or (keys[np.minimum(place, len(keys) - 1)] != mine).any()):
            raise RuntimeError("a text has n-grams that were not counted: the documents, or how they are dealt to tasks, changed between two reads")
        found = logp[place][code] if len(at) else np.zeros(0)
        size = np.bincount(text, minlength=last - first)
        value = -np.bincount(text, weights=found, minlength=last - first) / np.maximum(size, 1)
        columns = [part.column(i).slice(first, last - first) for i in (0, 1, 2)]
        columns += [pa.array(stats[c]) for c in names[3:8]]
        columns += [pa.array(size.astype(np.int64)), pa.array(value, mask=size == 0)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def score_documents(docs: DataFrame, pack_bytes: int = PACK_BYTES, step_bytes: int = STATS_BYTES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, text_key, lang``, the base figures, ``n_read`` and ``log_perplexity`` (null for texts without characters).

    A model of more than ``broadcast_bytes`` isn't broadcast; the result is the same either way."""
    rows = text_rows(docs)
    counts = count_grams(rows, pack_bytes, step_bytes)
    model = materialize(smoothed(gram_levels(counts)), "quality-model")
    if model.count() * MODEL_BYTES <= broadcast_bytes:
        shared = docs.sparkSession.sparkContext.broadcast(sorted_model(model.toArrow().combine_chunks()))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (keys, logp), hasher = shared.value, RollingHash(5)
            for batch in batches:
                yield from score_part(batch, keys, logp, hasher, step_bytes)

        return rows.mapInArrow(score, SCORES)

    def score_block(packed: pa.Table, known: pa.Table) -> pa.Table:
        (keys, logp), hasher = sorted_model(known), RollingHash(5)
        parts = (part for payload in packed.column("payload") for part in unpacked(payload.as_buffer()))
        return pa.Table.from_batches([scored for part in parts for scored in score_part(part, keys, logp, hasher, step_bytes)])

    of_block = counts.select("block", "key").join(model, "key").select("block", "key", "logp")
    return pack_documents(rows, pack_bytes, step_bytes).groupBy("block").cogroup(of_block.groupBy("block")).applyInArrow(score_block, SCORES)


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """``band_lang`` and the median of every column by label, exact on histograms of ``STEP``: the same however the rows are dealt."""
    out = None
    for c in columns:
        steps = df.groupBy(F.col("lang").alias("band_lang"), F.round(F.col(c) / STEP).cast("long").alias("step")).agg(F.count(F.lit(1)).alias("n"))
        one = steps.groupBy("band_lang").agg((F.percentile("step", 0.5, F.col("n")) * STEP).alias(c))
        out = one if out is None else out.withColumnRenamed("band_lang", "other").join(one, F.col("other").eqNullSafe(F.col("band_lang"))).drop("other")
    return out


def perplexity_bands(scored: DataFrame) -> DataFrame:
    """``band_lang, log_cost, spread, noise`` of each label's documents (base failures left out; null labels are one group).

    ``log_cost``: median of the logarithm of nats a word; ``spread``: median absolute deviation from it;
    ``noise``: median of the deviation times the square root of words (a document's mean over n words varies with 1/sqrt(n))."""
    fit = scored.where("not base_failed and log_cost is not null")
    middle = materialize(medians(fit, ["log_cost"]).withColumnRenamed("log_cost", "middle"), "quality-middles")
    off = fit.join(small_side(middle, 64), F.col("lang").eqNullSafe(F.col("band_lang"))).withColumn("spread", F.abs(F.col("log_cost") - F.col("middle")))
    off = materialize(off.select("lang", "spread", (F.col("spread") * F.sqrt("n_words")).alias("noise")), "quality-deviations")
    widths = medians(off, ["spread", "noise"]).withColumnRenamed("band_lang", "width_lang")
    return middle.join(widths, F.col("band_lang").eqNullSafe(F.col("width_lang"))).drop("width_lang")


def judge_documents(docs: DataFrame, lower_noise: float = LOWER_NOISE, upper_noise: float = UPPER_NOISE) -> DataFrame:
    """Base figures, perplexity and verdict of every row of ``docs`` (``doc_id, lang, text``).

    ``perplexity`` is that of a word (the log probabilities of the characters summed over its letters and the space before
    the next): marks added to words make them dearer, where an average over characters would fall.  Null texts
    are empty: no words, so the base rules fail and there is no perplexity.  Every label has its own model and band; null is a
    label of its own.  Texts no longer than the context are judged like others.  Repeated rows are rows of
    their own and count as such in the model, but as one text where n-grams of a single text are told apart.  An empty
    table gives an empty result; other columns are ignored."""
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    cost = F.expr("log_perplexity * n_read / nullif(n_words, 0)")
    scored = score_documents(docs).withColumns({"base_failed": base, "cost": cost}).withColumn("log_cost", F.log(F.greatest("cost", F.lit(1e-9))))
    scored = materialize(scored.withColumn("log_cost", F.when(F.col("cost").isNotNull(), F.col("log_cost"))), "quality-scores")
    bands = materialize(perplexity_bands(scored), "quality-bands")
    unit = F.greatest(F.col("noise"), F.lit(LEAST_NOISE)) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    lower = F.col("middle") - F.col("spread") - F.lit(lower_noise) * unit
    upper = F.col("middle") + F.col("spread") + F.lit(upper_noise) * unit
    judged = scored.join(small_side(bands, 64), F.col("lang").eqNullSafe(F.col("band_lang")), "left")
    inside = F.coalesce(F.col("log_cost").between(lower, upper), F.lit(False))
    return judged.withColumns({"kept": ~F.col("base_failed") & inside, "perplexity": F.exp("cost"), "lower_band": F.exp(F.exp(lower)), "upper_band": F.exp(F.exp(upper))}).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity", "lower_band", "upper_band", "text_key"
    )


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the rules keep.  Rows are told apart by id and text."""
    verdicts = judge_documents(docs, **settings).where("not kept")
    gone = materialize(verdicts.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct(), "quality-gone")
    same = docs["doc_id"].eqNullSafe(F.col("gone_id")) & (F.xxhash64(docs["text"]) == F.col("gone_key"))
    return docs.join(small_side(gone, 32), same, "left_anti")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge_documents(read_table(spark, sf_dir, "documents")).drop("text_key")
