"""Ranked lexical search by a dual-tree descent.

A document's score for an item is the sum, over the item's distinct terms, of the
term's weight times a damped term frequency, all in integers.  So an item is a set of
terms and a document a sparse vector of impacts.

One Arrow pass counts the items' terms in every whole document; only those counts
travel.  Documents are dealt to shards and items to tiles, both of bounded size, and each
cell of that grid is searched by itself:

* documents and items are each arranged in a binary hierarchy (halved along the main
  axis of their vectors, level by level); a node holds the maxima of its members' coordinates;
* both hierarchies are descended together.  The bound of a node pair is the product of its maxima;
  if it is below the weakest k-th score among the node's items, no document below can enter any of their
  results and the pair goes, with all pairs under it;
* the leaf pairs left are scored by falling bound, and each raises the k-th scores that the next must reach.

Bounds never undercut a score and equal scores stay, so the result is exact.  The
k-th scores that a first shard reaches are lower bounds for all: the other shards start with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import RollingHash, materialize, read_table, text_blocks, word_spans
from basketry.session import fresh_dir

#: Terms are the maximal matches, with A-Z lower-cased (fixed values of the contract).
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of the items' distinct terms that one scan of the documents looks for.
VOCABULARY_BYTES = 8 << 20
#: Counts (document, term) in a shard, documents in the smallest shards, items in a tile.
SHARD_COUNTS, LEAST_SHARD_DOCS, TILE_ITEMS = 1 << 21, 2048, 256
#: Numbers in one level of node maxima, documents and items in a leaf, documents scored at a time and terms
#: multiplied at a time, candidates kept before they are cut.
NODE_CELLS, LEAF_DOCS, LEAF_ITEMS, SCORED_DOCS, COLUMNS, CANDIDATES = 1 << 22, 4, 1, 256, 1 << 13, 1 << 20
#: Steps of the power iteration behind a split.
AXIS_STEPS = 3

_CASE = np.arange(256, dtype=np.uint8)
_CASE[65:91] += 32
_BETWEEN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM_PATTERN), F.lit(0))


class Vocabulary:
    """Numbered terms, found in bytes by fingerprint and compared byte by byte."""

    def __init__(self, terms: list[str], first: int) -> None:
        encoded = [t.encode() for t in terms]
        self.first, self.seed, found = first, 0, np.zeros(0, np.uint64)
        length = np.array([len(t) for t in encoded], np.int64)
        start = np.cumsum(length) - length
        data = np.frombuffer(b"".join(encoded), np.uint8)
        while len(np.unique(found)) < len(terms):  # another seed if two terms share a fingerprint
            self.seed += 1
            roll = RollingHash(self.seed)
            found = roll.windows(roll.prefix(data), start, start + length)
        order = np.argsort(found)
        self.prints, self.data, self.start, self.length, self.number = found[order], data, start[order], length[order], order

    def count(self, data: np.ndarray, bounds: np.ndarray, roll: RollingHash) -> tuple[np.ndarray, ...]:
        """Terms of every row, and the rows, terms and frequencies of those in the vocabulary (sorted by row)."""
        data = _CASE[data]
        starts, ends, rows = word_spans(data, bounds, _BETWEEN)
        n = np.bincount(rows, minlength=len(bounds) - 1)
        prints = roll.windows(roll.prefix(data), starts, ends)
        at = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
        hit = np.flatnonzero((self.prints[at] == prints) & (self.length[at] == ends - starts))
        at, starts, rows = at[hit], starts[hit], rows[hit]
        length = self.length[at]
        own = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        same = data[np.repeat(starts, length) + own] == self.data[np.repeat(self.start[at], length) + own]
        if not same.all():
            good = np.logical_and.reduceat(same, np.cumsum(length) - length)
            at, rows = at[good], rows[good]
        pairs, tf = np.unique(rows * len(self.prints) + self.number[at], return_counts=True)
        return n, pairs // len(self.prints), pairs % len(self.prints) + self.first, tf


def count_terms(docs: DataFrame, vocabulary: Vocabulary, part: int) -> DataFrame:
    """``doc, doc_id, n, terms, tfs, part``: documents with a term at all (part 0) or with one of the vocabulary (later parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash(vocabulary.seed)
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(2)):
                n, rows, terms, tf = vocabulary.count(data, bounds, roll)
                size = np.bincount(rows, minlength=last - first)
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, tf)]
                columns = [c.slice(first, last - first) for c in batch.columns[:2]]
                columns += [pa.array(n, pa.int64()), *lists, pa.array(np.full(last - first, part), pa.int32())]
                out = pa.RecordBatch.from_arrays(columns, names=["doc", "doc_id", "n", "terms", "tfs", "part"])
                yield out.filter(pa.array((size if part else n) > 0))

    return docs.select("doc", "doc_id", "text").mapInArrow(run, "doc long, doc_id long, n long, terms array<int>, tfs array<int>, part int")


def term_counts(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``term, number`` of every term, and ``doc, doc_id, n, terms, tfs, part`` of the documents (see :func:`count_terms`).

    ``terms`` has the distinct ``term`` strings.  They are looked for in slices of bounded size, a scan each."""
    spark = docs.sparkSession
    terms = materialize(terms, "lexical-terms")
    total = terms.agg(F.sum(F.octet_length("term"))).head()[0] or 0
    slices = -(-total // VOCABULARY_BYTES)
    docs = docs.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    if slices > 1:  # every scan must see the same numbers
        docs = materialize(docs, "lexical-docs")
    numbers, counts, first = fresh_dir(spark, "lexical-numbers"), fresh_dir(spark, "lexical-counts"), 0
    for part in range(max(1, slices)):
        own = terms.where(F.pmod(F.xxhash64("term"), F.lit(max(1, slices))) == part).orderBy("term")
        listed = [r["term"] for r in own.collect()]  # within VOCABULARY_BYTES or so
        numbered = [(t, first + j) for j, t in enumerate(listed)]
        spark.createDataFrame(numbered, "term string, number int").write.mode("append").parquet(numbers)
        # A blank is in no term: without any, the documents' own figures remain.
        count_terms(docs, Vocabulary(listed or [" "], first), part).write.mode("append").parquet(counts)
        first += len(listed)
    return spark.read.parquet(numbers), spark.read.parquet(counts)


def halved(row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int, width: int, depth: int) -> np.ndarray:
    """Rows of a sparse matrix in the order of a binary hierarchy with ``2**depth`` leaves.

    Each level halves every node along the main axis of its rows (a few steps of power
    iteration); node ``i`` of level ``l`` is the places from ``i * n >> l`` on."""
    place = np.arange(n)
    value = value / max(value.max(initial=0), 1)
    start = np.random.default_rng(0).normal(size=width)
    for level in range(depth):
        nodes = 1 << level
        bounds = (np.arange(nodes + 1) * n) >> level
        node = np.searchsorted(bounds, place, side="right") - 1
        members = np.maximum(np.bincount(node, minlength=nodes), 1)
        axis, cell = np.tile(start, (nodes, 1)), node[row] * width + col
        for _ in range(AXIS_STEPS):
            along = np.bincount(row, value * axis.ravel()[cell], minlength=n)
            along -= (np.bincount(node, along, minlength=nodes) / members)[node]
            axis = np.bincount(cell, value * along[row], minlength=nodes * width).reshape(nodes, width)
            axis /= np.maximum(np.linalg.norm(axis, axis=1, keepdims=True), 1e-300)
        order = np.lexsort((place, np.bincount(row, value * axis.ravel()[cell], minlength=n), node))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
    return np.argsort(place)


def node_maxima(row: np.ndarray, col: np.ndarray, value: np.ndarray, order: np.ndarray, width: int, depth: int, kind) -> list[np.ndarray]:
    """The coordinate maxima of every node, a matrix a level, the root first."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    leaf = np.searchsorted((np.arange((1 << depth) + 1) * len(order)) >> depth, place, side="right") - 1
    out = [np.zeros((1 << depth, width), kind)]
    np.maximum.at(out[0].reshape(-1), leaf[row] * width + col, value.astype(kind))
    while len(out[0]) > 1:
        out.insert(0, np.maximum(out[0][::2], out[0][1::2]))
    return out


def depth_of(n: int, leaf: int, width: int) -> int:
    return max(0, min(max(1, n // leaf).bit_length(), max(1, NODE_CELLS // max(1, width)).bit_length(), max(1, n).bit_length()) - 1)


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every list entry."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), size), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


class Cell:
    """A tile of items and a shard of documents; ``search`` gives item, document and score of the k best of each item."""

    def __init__(self, items: pa.Table, docs: pa.Table, n_docs: int, n_terms: int) -> None:
        _, whole, part_of = np.unique(docs["doc"].to_numpy(), return_index=True, return_inverse=True)
        parts, docs = docs, docs.take(pa.array(whole))
        self.docs, self.n_items, self.n_docs = docs, len(items), len(docs)
        self.item, term = flat(items["terms"])
        weight = flat(items["weights"])[1]
        self.vocabulary, self.item_col = np.unique(term, return_inverse=True)
        self.width = len(self.vocabulary)
        by_term = np.zeros(max(1, self.width), np.int64)
        by_term[self.item_col] = weight
        doc, term = flat(parts["terms"])
        tf = flat(parts["tfs"])[1]
        col = np.minimum(np.searchsorted(self.vocabulary, term), max(0, self.width - 1))
        known = self.vocabulary[col] == term if self.width else np.zeros(len(term), bool)
        self.doc, self.doc_col, tf = part_of[doc[known]], col[known], tf[known]
        m = 50 + (50 * docs["n"].to_numpy() * n_docs) // max(1, n_terms)
        self.impact = by_term[self.doc_col] * (1_000_000_000 * tf // (1000 * tf + 20 * m[self.doc]))
        self.weight = weight
        seed = items["seed"].fill_null(1).to_numpy()
        self.kth = np.maximum(seed, 1)
        ids = docs["doc_id"].combine_chunks()
        self.tie = np.lexsort((docs["doc"].to_numpy(), ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)))
        self.tie = np.argsort(self.tie)  # place of a document among equal scores
        #: Leaf pairs, and those that were scored.
        self.pairs = self.scored = 0

    def _best(self, found: list[np.ndarray], k: int) -> np.ndarray:
        """Of rows (item, document, score) the k best a item."""
        rows = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        rows = rows[:, rows[2] >= self.kth[rows[0]]]
        rows = rows[:, np.lexsort((self.tie[rows[1]], -rows[2], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        return rows[:, np.arange(rows.shape[1]) - first < k]

    def search(self, k: int) -> np.ndarray:
        if not self.n_items or not len(self.impact):
            return np.zeros((3, 0), np.int64)
        total = np.zeros(self.width, np.int64)
        np.maximum.at(total, self.doc_col, self.impact)
        exact = np.float64 if np.bincount(self.item, total[self.item_col].astype(float)).max() < 2**53 else np.int64
        item_depth, doc_depth = depth_of(self.n_items, LEAF_ITEMS, self.width), depth_of(self.n_docs, LEAF_DOCS, self.width)
        items = halved(self.item, self.item_col, self.weight.astype(float), self.n_items, self.width, item_depth)
        docs = halved(self.doc, self.doc_col, self.impact.astype(float), self.n_docs, self.width, doc_depth)
        item_nodes = node_maxima(self.item, self.item_col, np.ones(len(self.item)), items, self.width, item_depth, exact)
        doc_nodes = node_maxima(self.doc, self.doc_col, self.impact, docs, self.width, doc_depth, exact)
        item_at = (np.arange((1 << item_depth) + 1) * self.n_items) >> item_depth
        doc_at = (np.arange((1 << doc_depth) + 1) * self.n_docs) >> doc_depth

        def weakest(depth: int) -> np.ndarray:
            return np.minimum.reduceat(self.kth[items], (np.arange(1 << depth) * self.n_items) >> depth)

        # Down both hierarchies at once; the shallower one waits at its leaves.
        alive, bound = np.ones((1, 1), bool), np.zeros((1, 1), exact)
        for level in range(max(item_depth, doc_depth) + 1):
            a, b = min(level, item_depth), min(level, doc_depth)
            alive = np.repeat(np.repeat(alive, len(item_nodes[a]) // alive.shape[0], 0), len(doc_nodes[b]) // alive.shape[1], 1)
            left, right = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
            bound = np.full(alive.shape, -1, exact)
            bound[np.ix_(left, right)] = item_nodes[a][left] @ doc_nodes[b][right].T
            alive &= bound >= weakest(a)[:, None]
        self.pairs = alive.size
        return self._score(k, items, docs, item_at, doc_at, np.where(alive, bound, -1), exact)

    def _score(self, k, items, docs, item_at, doc_at, bound, exact) -> np.ndarray:
        place = np.empty(self.n_docs, np.int64)
        place[docs] = np.arange(self.n_docs)
        by_place = np.argsort(place[self.doc], kind="stable")
        doc, col, impact = place[self.doc][by_place], self.doc_col[by_place], self.impact[by_place].astype(exact)
        held = np.searchsorted(doc, doc_at)
        by_term = np.argsort(self.item_col, kind="stable")
        item_col, item = self.item_col[by_term], self.item[by_term]

        def sets(lo: int) -> np.ndarray:
            """Which items have the terms from ``lo`` on."""
            out = np.zeros((min(COLUMNS, self.width - lo), self.n_items), exact)
            a, b = np.searchsorted(item_col, [lo, lo + COLUMNS])
            out[item_col[a:b] - lo, item[a:b]] = 1
            return out

        only = sets(0) if self.width <= COLUMNS else None

        def scores(places: np.ndarray, entries: np.ndarray, wanted: np.ndarray) -> np.ndarray:
            row_of = np.empty(self.n_docs, np.int64)
            row_of[places] = np.arange(len(places))
            row, own, value = row_of[doc[entries]], col[entries], impact[entries]
            out = np.zeros((len(places), len(wanted)), exact)
            for lo in range(0, self.width, COLUMNS):
                have = sets(lo) if only is None else only
                inside = (own >= lo) & (own < lo + COLUMNS)
                matrix = np.zeros((len(places), len(have)), exact)
                matrix[row[inside], own[inside] - lo] = value[inside]
                out += matrix @ have[:, wanted]
            return out.astype(np.int64)

        at_once = max(1, SCORED_DOCS * len(doc_at[1:]) // self.n_docs)
        leaf_of_item = np.searchsorted(item_at, np.arange(self.n_items), side="right") - 1
        top = np.zeros((self.n_items, k), np.int64)
        found: list[np.ndarray] = []
        size = 0
        best = bound.max(axis=0)
        order = np.argsort(-best, kind="stable")
        for at in range(0, len(order), at_once):
            leaves = order[at : at + at_once]
            leaves = leaves[best[leaves] >= 0]
            lowest = np.minimum.reduceat(self.kth[items], item_at[:-1])
            pairs = bound[:, leaves] >= lowest[:, None]
            leaves, pairs = leaves[pairs.any(0)], pairs[:, pairs.any(0)]
            if not len(leaves):
                continue
            self.scored += int(pairs.sum())
            wanted = items[pairs.any(1)[leaf_of_item]]
            places = np.concatenate([np.arange(doc_at[d], doc_at[d + 1]) for d in leaves])
            entries = np.concatenate([np.arange(held[d], held[d + 1]) for d in leaves])
            score = scores(places, entries, wanted)
            d, i = np.nonzero(score >= self.kth[wanted])
            if not len(d):
                continue
            found.append(np.stack([wanted[i], docs[places[d]], score[d, i]]))
            size += len(d)
            new = np.unique(i)
            merged = np.concatenate([top[wanted[new]], score[:, new].T], axis=1)
            top[wanted[new]] = -np.partition(-merged, k - 1, axis=1)[:, :k]
            self.kth[wanted[new]] = np.maximum(self.kth[wanted[new]], top[wanted[new]].min(axis=1))
            if size > CANDIDATES:
                found = [self._best(found, k)]
                size = found[0].shape[1]
        return self._best(found, k)


def search_cell(items: pa.Table, docs: pa.Table, k: int, n_docs: int, n_terms: int) -> pa.Table:
    cell = Cell(items, docs, n_docs, n_terms)
    item, doc, score = cell.search(k)
    of_docs = cell.docs.select(["doc", "doc_id"]).take(pa.array(doc))
    return pa.table({"item": items["item"].take(pa.array(item)), "doc": of_docs["doc"], "doc_id": of_docs["doc_id"], "score": pa.array(score, pa.int64())})


def weighted_items(items: DataFrame, numbers: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """``item, terms, weights``: the items' terms that documents hold, by number, with their weights."""
    held = counts.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (F.lit(2.0) * F.col("df") + F.lit(1.0))
    weights = held.join(numbers, "number").select("term", "number", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("weight"))
    pairs = items.select("item", F.explode("terms").alias("term")).join(weights, "term")
    lists = pairs.groupBy("item").agg(F.collect_list(F.struct("number", "weight")).alias("own"))
    return lists.select("item", F.col("own.number").alias("terms"), F.col("own.weight").alias("weights"))


def ranked(documents: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 of every item.

    ``documents`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns are ignored.  Null,
    empty and term-free texts take no part.  Repeated rows on either side stay rows of their own, so a
    repeated item has its results twice.  A null ``doc_id`` comes after others of its score, equal rows in no
    fixed order.  Empty tables give an empty result."""
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.array_distinct(terms_of(F.col("text"))).alias("terms"))
    items = materialize(items.where("size(terms) > 0"), "lexical-items")
    numbers, counts = term_counts(documents, items.select(F.explode("terms").alias("term")).distinct())
    totals = counts.agg(
        F.count_if(F.col("part") == 0).alias("docs"),
        F.sum(F.when(F.col("part") == 0, F.col("n"))).alias("terms"),
        F.sum(F.size("terms")).alias("entries"),
    ).head()
    n_docs, n_terms, entries = totals["docs"], totals["terms"] or 0, totals["entries"] or 0
    tiled = materialize(weighted_items(items, numbers, counts, n_docs), "lexical-weights")
    tiles = max(1, -(-tiled.count() // TILE_ITEMS))
    shards = max(1, -(-entries // SHARD_COUNTS), min(64, n_docs // LEAST_SHARD_DOCS))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("item"), F.lit(tiles)))
    dealt = counts.where("size(terms) > 0").withColumn("shard", F.pmod(F.xxhash64("doc"), F.lit(shards)))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return search_cell(a, b, k, n_docs, n_terms)

    def search(seeded: DataFrame, first: int, last: int) -> DataFrame:
        """The best of shards ``first`` to ``last - 1`` for every item."""
        left = seeded.withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
        right = dealt.where(F.col("shard").between(first, last - 1)).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        key = (F.col("tile") * shards + F.col("shard")).alias("cell")
        left, right = left.select(key, "item", "terms", "weights", "seed"), right.select(key, "doc", "doc_id", "n", "terms", "tfs")
        return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(cell, "item long, doc long, doc_id long, score long")

    found = materialize(search(tiled.withColumn("seed", F.lit(None).cast("long")), 0, 1), "lexical-first")
    if shards > 1:
        seeds = found.groupBy("item").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("seed"))
        found = found.union(search(tiled.join(seeds, "item", "left"), 1, shards))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "doc")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return top.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM_PATTERN}') AS ws FROM documents
), s AS (
  SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS terms FROM d WHERE len(ws) > 0
), f AS (
  SELECT doc, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc, doc_id, len(ws)::BIGINT AS n, unnest(ws) AS term FROM d) GROUP BY ALL
), i AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM_PATTERN}')) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM benchmark))
), w AS (
  SELECT term, floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM f WHERE term IN (SELECT term FROM i) GROUP BY term), s
), p AS (
  SELECT item, item_id, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * s.docs) // s.terms))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN f USING (term), s GROUP BY item, item_id, doc, doc_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, doc)::INTEGER AS rank FROM p WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
