"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of labelled
text.  A text is parsed into phrases, each the longest string that occurs in the
sample (the automaton is followed until it has no way on; the next phrase starts
there).  The fewer phrases a language needs per character, the closer the
text is to it; the language with the fewest normalised phrases wins.

Letters of all planes are lower-cased and kept as they are; runs of anything else are one
space.  A letter that a language's sample lacks is a phrase of its own there.  Texts are parsed whole, in
pieces of ``PIECE`` characters that are parsed side by side with numpy (a piece
starts a new phrase; this costs every language the same).

The sample is made of short passages, chosen by a hash of document and place from all over the whole labelled
texts, so that no part of a text (such as a masthead) stands for the rest.  The automata are
broadcast: their size is bounded by the sample parameters below, whatever the corpus.  No shuffle but for
the sample, one Arrow pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import read_table, text_blocks

#: The bounds of the labelled sample: passages a language (about) and their characters; passages over all languages.
SAMPLE_PASSAGES, PASSAGE, ALL_PASSAGES = 400, 80, 40_000
#: Labels that are learned at most (the most frequent; far more than there are languages).
MAX_LANGS = 4096
#: Characters parsed as one piece, bytes of text in one block, bytes of transition tables over all languages.
PIECE, PARSE_BYTES, TABLE_BYTES = 256, 1 << 20, 64 << 20
UNDETERMINED = "und"


def letters_table() -> np.ndarray:
    """Code point -> lower-case code point for letters of the basic plane, 0 for the rest."""
    table = np.zeros(0x10000, dtype=np.uint32)
    for c in range(0x10000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


LETTERS = letters_table()


def fold(points: np.ndarray) -> np.ndarray:
    """Lower-cased letters as code points; 0 for anything else."""
    out = LETTERS[np.minimum(points, 0xFFFF)]
    far = points > 0xFFFF
    if far.any():
        every, place = np.unique(points[far], return_inverse=True)
        lower = [x.lower() if x.isalpha() else "" for x in map(chr, every.tolist())]
        out[far] = np.array([ord(x) if len(x) == 1 else int(c) if x else 0 for x, c in zip(lower, every, strict=True)], np.uint32)[place]
    return out


def squeeze(folded: np.ndarray) -> np.ndarray:
    """Keeps one of each run of non-letters (mask)."""
    keep = folded > 0
    keep[1:] |= folded[:-1] > 0
    return keep


class SuffixAutomaton:
    """Suffix automaton of a string of letters (0: space); the root is state 1.

    ``letters`` are those of the string in order, symbol ``i + 1`` stands for ``letters[i]`` and symbol 0 for any other.
    Transitions are a table, or, where that would take more than ``table_bytes``, a sorted list; both give the same moves."""

    def __init__(self, string: np.ndarray, table_bytes: int = TABLE_BYTES) -> None:
        self.letters, symbols = np.unique(string, return_inverse=True)
        self.width = len(self.letters) + 1
        rows: list[dict[int, int]] = [{}, {}]
        link, depth = [0, 0], [0, 0]
        last = 1
        for c in (symbols + 1).tolist():
            rows.append({})
            new = len(rows) - 1
            depth.append(depth[last] + 1)
            link.append(1)
            p = last
            while p and c not in rows[p]:
                rows[p][c] = new
                p = link[p]
            if p:
                q = rows[p][c]
                if depth[q] == depth[p] + 1:
                    link[new] = q
                else:
                    rows.append(dict(rows[q]))
                    clone = len(rows) - 1
                    depth.append(depth[p] + 1)
                    link.append(link[q])
                    while p and rows[p].get(c) == q:
                        rows[p][c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
        key = np.array([state * self.width + c for state, row in enumerate(rows) for c in sorted(row)], np.int64)
        to = np.array([row[c] for row in rows for c in sorted(row)], np.uint16 if len(rows) < 1 << 16 else np.uint32)
        self.start = np.zeros(self.width, np.int64)
        self.start[list(rows[1])] = list(rows[1].values())
        self.table = self.key = None
        if len(rows) * self.width * to.itemsize <= table_bytes:
            self.table = np.zeros(len(rows) * self.width, to.dtype)
            self.table[key] = to
        else:
            # A last entry that no state has, so that every search ends inside.
            self.key, self.to = np.append(key, len(rows) * self.width), np.append(to, to.dtype.type(0))

    def moves(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        wanted = state * self.width + symbol
        if self.table is not None:
            return self.table[wanted].astype(np.int64)
        at = np.searchsorted(self.key, wanted)
        return np.where(self.key[at] == wanted, self.to[at], 0).astype(np.int64)

    def phrases(self, pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each piece: column ``i`` of ``pieces`` (position by piece) has ``lengths[i]`` symbols, longest first."""
        n = len(lengths)
        state = np.ones(n, dtype=np.int64)
        count = np.zeros(n, dtype=np.int64)
        live = np.searchsorted(-lengths, -np.arange(len(pieces)), side="left")  # pieces longer than the position
        for at in range(len(pieces)):
            m = live[at]
            symbol = pieces[at, :m]
            to = self.moves(state[:m], symbol)
            first = self.start[symbol]
            stuck = to == 0
            # The phrase so far ends; a symbol that the sample doesn't hold is one of its own, back at the root.
            count[:m] += stuck & (state[:m] != 1)
            count[:m] += first == 0
            state[:m] = np.where(stuck, np.maximum(first, 1), to)
        return count + (state != 1)


class CrossParser:
    """The automata of all languages."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.langs = sorted(samples)
        self.automata = []
        for lang in self.langs:
            parts = []
            for text in samples[lang]:
                symbols = fold(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
                parts += [symbols[squeeze(symbols)], np.zeros(1, np.uint32)]
            string = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            self.automata.append(SuffixAutomaton(string[squeeze(string)], TABLE_BYTES // max(1, len(samples))))
        #: Every letter of any sample; a letter's number is its place from 1 on, 0 stands for all others.
        self.letters = np.unique(np.concatenate([np.zeros(0, np.uint32), *[a.letters for a in self.automata]]))
        self.symbol = []
        for a in self.automata:
            own = np.zeros(len(self.letters) + 1, np.int64)
            own[np.searchsorted(self.letters, a.letters) + 1] = np.arange(len(a.letters)) + 1
            self.symbol.append(own)
        self.near = np.zeros(0x10000, np.int32)
        near = self.letters[self.letters < 0x10000]
        self.near[near] = np.arange(len(near)) + 1

    def numbers(self, folded: np.ndarray) -> np.ndarray:
        """The letters' numbers."""
        out = self.near[np.minimum(folded, 0xFFFF)]
        far = np.flatnonzero(folded > 0xFFFF)
        if len(far):
            at = np.minimum(np.searchsorted(self.letters, folded[far]), max(0, len(self.letters) - 1))
            known = self.letters[at] == folded[far] if len(self.letters) else np.zeros(len(far), bool)
            out[far] = np.where(known, at + 1, 0)
        return out

    def phrase_rates(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per character, text by language, and which texts have letters."""
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        bounds = before[bounds]
        folded = fold(points)
        keep = squeeze(folded)
        keep[bounds[:-1][bounds[:-1] < len(keep)]] = True
        ends = np.concatenate([[0], np.cumsum(keep)])[bounds]
        letters = np.concatenate([[0], np.cumsum(folded > 0)])
        has = letters[bounds[1:]] > letters[bounds[:-1]]
        symbols = self.numbers(folded[keep])
        size = np.diff(ends)
        count = -(-size // PIECE)
        owner = np.repeat(np.arange(len(size)), count)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = ends[:-1][owner] + rank * PIECE
        length = np.minimum(ends[1:][owner] - start, PIECE)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        width = int(length[0]) if len(length) else 0
        at = np.minimum(start[None, :] + np.arange(width)[:, None], max(len(symbols) - 1, 0))
        pieces = symbols[at] if width else np.zeros((0, 0), np.int32)
        rates = np.zeros((len(size), len(self.langs)))
        for j, automaton in enumerate(self.automata):
            rates[:, j] = np.bincount(owner, weights=automaton.phrases(self.symbol[j][pieces], length), minlength=len(size))
        return rates / np.maximum(size, 1)[:, None], has


def labelled_sample(labelled: DataFrame, passages: int = SAMPLE_PASSAGES, passage: int = PASSAGE) -> dict[str, list[str]]:
    """About ``passages`` passages of ``passage`` characters a language, from all over its texts.

    Texts are cut into passages throughout; a passage is taken if a hash of its document and place falls below its
    language's share, so each has the same chance. With very many labels they share ``ALL_PASSAGES``. Only
    training takes passages; what is predicted is read whole."""
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    pieces = F.ceil(F.length("text") / passage)
    rows = rows.withColumn("pieces", pieces.cast("int")).where("pieces > 0")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("pieces").alias("pieces"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not counts:
        return {}
    each = max(1, min(passages, ALL_PASSAGES // len(counts)))
    span = 1 << 30
    shares = labelled.sparkSession.createDataFrame([(r["lang"], min(span, -(-span * each // r["pieces"]))) for r in counts], "lang string, share long")
    hashed = lambda i: F.pmod(F.xxhash64(F.lit("sample"), "doc_id", i), F.lit(span))
    # One row a learned label: MAX_LANGS at most.
    taken = rows.join(F.broadcast(shares), "lang").withColumn("places", F.filter(F.sequence(F.lit(0), F.col("pieces") - 1), lambda i: hashed(i) < F.col("share")))
    chosen = taken.select("lang", "doc_id", "text", F.explode("places").alias("place")).select(
        "lang", hashed(F.col("place")).alias("at"), F.substring(F.col("text"), F.col("place") * passage + 1, F.lit(passage)).alias("text")
    )
    out: dict[str, list[str]] = {}
    for row in sorted(chosen.collect(), key=lambda r: (r["lang"], r["at"], r["text"])):
        out.setdefault(row["lang"], []).append(row["text"])
    return out


def detect_language(docs: DataFrame, samples: dict[str, list[str]]) -> DataFrame:
    """``doc_id, lang_pred, score, phrase_rate`` for every row of ``docs`` (columns ``doc_id, text``).

    ``score`` is the winner's share of the inverse phrase rates (1 with one language), ``phrase_rate``
    its phrases per character.  Ties go to the smaller label.  ``und`` with score 0 for null texts, texts
    without a letter, and if nothing was learned.  Repeated rows and ids stay separate rows."""
    parser = docs.sparkSession.sparkContext.broadcast(CrossParser(samples))
    schema = "doc_id long, lang_pred string, score double, phrase_rate double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = parser.value
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(1), PARSE_BYTES):
                keys = batch.column(0).slice(first, last - first)
                if model.langs:
                    rates, has = model.phrase_rates(data, bounds)
                    best = rates.argmin(axis=1)
                    near = 1.0 / np.maximum(rates, 1e-9)
                    score = np.where(has, near[np.arange(len(best)), best] / near.sum(axis=1), 0.0)
                    rate = np.where(has, rates.min(axis=1), 0.0)
                    pred = [model.langs[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
                else:
                    score = rate = np.zeros(last - first)
                    pred = [UNDETERMINED] * (last - first)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(pred, pa.string()), pa.array(score), pa.array(rate)], names=["doc_id", "lang_pred", "score", "phrase_rate"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    found = detect_language(docs, labelled_sample(docs.where(fold_of != 0)))
    return found.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))).select(
        "doc_id", "held_out", "lang_pred", "score", "phrase_rate"
    )
