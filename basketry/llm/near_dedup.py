"""Near-duplicate documents by consistent weighted sampling.

A text is a weighted set of five-word shingles: occurrences times a damped
inverse document frequency.  Improved consistent weighted sampling (one sample: the shingle
and the quantised weight that win a race with gamma-distributed variates drawn from the
shingle's hash) gives a signature; two texts agree in a sample with the
probability of their weighted Jaccard similarity.  Signatures are cut into bands; texts that share a
band are candidates, and a candidate counts only if the exact weighted Jaccard
similarity of the two whole texts reaches the threshold.

* Document frequencies are counted over all documents into 2**18 hashed slots (1 MB of weights, broadcast).
* Texts that are equal are one node from the start; a hot group of copies is one row a task.
* First each text is compared with the least text of its band's group, and with the least text of each finer
  group that shares further samples with it (``REFINE``): this links groups of copies in linear work.
* Then every two texts of a group that aren't in one class by then are compared.  Groups of up to ``PAIRED`` texts give
  pairs; larger ones are dealt over tiles of two blocks each, a tile compared by matrix products.  Texts of the class
  that most of a group belongs to meet only the others, so a group costs the others times its size.
* Links are closed to classes by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import RollingHash, materialize, mix64, read_table, small_side, text_blocks, word_spans
from basketry.llm.graph import connected_components

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Slots of the document frequencies (the default width of Spark's own hashed term frequencies).
SLOTS = 1 << 18
#: A shingle in one document weighs 1 + IDF_SHARE, one in all documents 1.
IDF_SHARE = 0.25
BANDS, ROWS = 8, 2
SAMPLES = BANDS * ROWS
#: Further samples (cyclic distance after the band) that cut a band's group finer.
REFINE = (2, 5, 9)
#: Entries of the tables of random variates.
VARIATES = 1 << 16
OWNER_BITS, HASH_BITS = 20, 44
BLOCK = 1 << 20
#: Texts of a group that is compared pair by pair; texts and bytes of a block of a larger one; columns multiplied at a time.
PAIRED, BLOCK_ROWS, BLOCK_TEXT, COLUMNS = 8, 1024, 4 << 20, 4096


class Shingler:
    """The distinct shingles of texts and how often each occurs."""

    def __init__(self) -> None:
        self.hasher = RollingHash(11)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, shingle, occurrences)`` sorted by text and shingle.  A text of one to four words is one shingle."""
        starts, ends, owner = word_spans(data, bounds)
        words = self.hasher.windows(self.hasher.prefix(data), starts, ends)
        n = len(bounds) - 1
        count = np.bincount(owner, minlength=n)
        first = np.cumsum(count) - count
        rank = np.arange(len(words)) - first[owner]
        at = np.flatnonzero((rank + SHINGLE_WORDS <= count[owner]) | ((rank == 0) & (count[owner] < SHINGLE_WORDS)))
        to = np.minimum(at + SHINGLE_WORDS, (first + count)[owner[at]])
        hashes = self.hasher.windows(self.hasher.prefix(words), at, to)
        out = []
        # Texts of a block are packed with their number; 2**20 texts at a time.
        for a in range(0, max(n, 1), 1 << OWNER_BITS):
            mine = (owner[at] >= a) & (owner[at] < a + (1 << OWNER_BITS))
            key = np.sort(((owner[at][mine] - a).astype(np.uint64) << np.uint64(HASH_BITS)) | (hashes[mine] >> np.uint64(64 - HASH_BITS)))
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            place = np.flatnonzero(new)
            key = key[place]
            times = np.diff(np.append(place, len(new)))
            out.append(((key >> np.uint64(HASH_BITS)).astype(np.int64) + a, key & np.uint64((1 << HASH_BITS) - 1), times))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def slot(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(SLOTS - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per hashed slot, and documents with words, over all rows of ``docs`` (``text``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table, total = Shingler(), np.zeros(SLOTS, dtype=np.int64), 0
        for batch in batches:
            for _, _, data, bounds in text_blocks(batch.column(0), BLOCK):
                owner, shingle, _ = shingler(data, bounds)
                table += np.bincount(slot(shingle), minlength=SLOTS)
                total += len(np.unique(owner))
        seen = np.flatnonzero(table)
        for a in range(0, len(seen), 1 << 16):
            part = seen[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(table[part])], names=["slot", "n"])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([total], pa.int64())], names=["slot", "n"])

    counts = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(SLOTS + 1, dtype=np.int64)
    table[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    return table[:SLOTS], int(table[SLOTS])


def slot_weights(frequency: np.ndarray, n_docs: int, idf_share: float = IDF_SHARE) -> np.ndarray:
    """Weight of one occurrence of a shingle, by slot: between 1 and 1 + ``idf_share``."""
    most = max(np.log(n_docs + 1), 1e-9)
    idf = np.log((n_docs + 1) / (np.minimum(frequency, n_docs) + 1)) / most
    return (1 + idf_share * np.clip(idf, 0, 1)).astype(np.float32)


class WeightedSampler:
    """Improved consistent weighted sampling: ``SAMPLES`` samples of each weighted set."""

    def __init__(self, seed: int = 3) -> None:
        draw = np.random.Generator(np.random.PCG64(seed))
        self.r = draw.gamma(2.0, 1.0, VARIATES)
        self.log_c = np.log(draw.gamma(2.0, 1.0, VARIATES))
        self.beta = draw.random(VARIATES)
        self.salt = draw.integers(1, 1 << 62, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, starts: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Signatures (set by sample); set ``i`` has the elements from ``starts[i]`` on."""
        out = np.zeros((len(starts), SAMPLES), dtype=np.uint64)
        if not len(starts):
            return out
        size = np.diff(np.append(starts, len(shingle)))
        log_w = np.log(weight.astype(np.float64))
        for k in range(SAMPLES):
            x = mix64(shingle * self.salt[k] + np.uint64(k))
            draw = (x >> np.uint64(48)).astype(np.int64)
            r, beta = self.r[draw], self.beta[draw]
            t = np.floor(log_w / r + beta)
            # log of c / (y e^r), y = e^(r (t - beta)); the last bits of the hash decide among equal draws
            race = self.log_c[draw] - r * (t - beta) - r + (x & np.uint64(0xFFFFFFFF)).astype(np.float64) * 1e-17
            least = np.minimum.reduceat(race, starts)
            win = np.flatnonzero(race == np.repeat(least, size))
            first = win[np.searchsorted(win, starts)]
            out[:, k] = mix64(shingle[first] * np.uint64(0x9E3779B97F4A7C15) + t[first].astype(np.int64).astype(np.uint64))
        return out


def signatures(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, text_key, n_bytes, signature`` (array of ``SAMPLES`` longs, null for texts without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sampler = Shingler(), WeightedSampler()
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(3), BLOCK):
                owner, shingle, times = shingler(data, bounds)
                held, starts = np.unique(owner, return_index=True)
                found = sampler(starts, shingle, shared.value[slot(shingle)] * times)
                full = np.zeros((last - first, SAMPLES), dtype=np.int64)
                full[held] = found.view(np.int64)
                empty = np.ones(last - first, dtype=bool)
                empty[held] = False
                lists = pa.ListArray.from_arrays(pa.array(np.arange(last - first + 1, dtype=np.int32) * SAMPLES), pa.array(full.reshape(-1)), mask=pa.array(empty))
                kept = [batch.column(i).slice(first, last - first) for i in (0, 1, 2)]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=["doc_id", "text_key", "n_bytes", "signature"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_key"), F.octet_length(text).cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key string, n_bytes long, signature array<long>")


def band_keys() -> Column:
    return F.array(*[F.xxhash64(F.lit(i), *[F.col("signature")[ROWS * i + j] for j in range(ROWS)]) for i in range(BANDS)])


def candidate_pairs(nodes: DataFrame) -> DataFrame:
    """``a, b`` (a < b): each text of ``nodes`` (``node, signature``) and the least text of every group it shares."""
    rows = nodes.select("node", "signature", F.posexplode(band_keys()).alias("band", "key"))
    shared = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a")).where("n > 1")
    rows = materialize(
        rows.join(shared, ["band", "key"]).select(
            "node", "band", "key", "a", F.array(*[F.element_at("signature", ((F.col("band") * ROWS + d) % SAMPLES + 1).cast("int")) for d in REFINE]).alias("further")
        ),
        "near-bands",
    )
    pairs = rows.select("a", F.col("node").alias("b"))
    finer = rows.select("node", "band", "key", F.posexplode("further").alias("level", "sample"))
    least = finer.groupBy("band", "key", "level", "sample").agg(F.min("node").alias("a"))
    finer = finer.join(least, ["band", "key", "level", "sample"]).select("a", F.col("node").alias("b"))
    return pairs.union(finer).where("a < b").distinct()


def verify_pairs(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, weights: np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """``a, b, similarity`` of the pairs whose whole texts reach the similarity."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    keys = nodes.select("node", "text_key")
    left = pairs.join(keys.select(F.col("node").alias("a"), F.col("text_key").alias("a_key")), "a").join(
        keys.select(F.col("node").alias("b"), F.col("text_key").alias("b_key")), "b"
    )
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    rows = left.join(one, "a").where(F.md5("a_text") == F.col("a_key")).join(two, "b").where(F.md5("b_text") == F.col("b_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()

        def sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            for first, last, data, bounds in text_blocks(column, BLOCK):
                owner, shingle, times = shingler(data, bounds)
                weight = shared.value[slot(shingle)].astype(np.float64) * times
                cuts = np.searchsorted(owner, np.arange(last - first + 1))
                for i in range(last - first):
                    yield first + i, shingle[cuts[i] : cuts[i + 1]], weight[cuts[i] : cuts[i + 1]]

        for batch in batches:
            values = np.zeros(batch.num_rows)
            for (i, x, u), (_, y, v) in zip(sets(batch.column(2)), sets(batch.column(3)), strict=True):
                both, at, to = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                common = np.minimum(u[at], v[to]).sum() if len(both) else 0.0
                values[i] = common / max(u.sum() + v.sum() - common, 1e-12)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], names=["a", "b", "similarity"])
            yield out.filter(pa.array(values >= similarity - 1e-9))

    return rows.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long, similarity double")


def unsettled_members(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, n_bytes, keys, component, band, key, n, main, ...`` of the members of every group of three or more that
    holds several classes of ``links``; ``main`` is the class most of the group is in, counted and weighed beside the rest."""
    classes = connected_components(links).select("node", "component")
    rows = nodes.select("node", "n_bytes", band_keys().alias("keys")).join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = materialize(rows, "near-classes").select("*", F.posexplode("keys").alias("band", "key"))
    parts = rows.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("size"), F.min("node").alias("least"))
    groups = parts.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.min("least").alias("least"),
        F.max(F.struct("n", "size", "component")).alias("top"),
    )
    groups = groups.where("n > 2 and n_classes > 1").select(
        "band", "key", "n", "least", F.col("top.component").alias("main"), F.col("top.n").alias("n_main"), F.col("top.size").alias("main_size"),
        (F.col("n") - F.col("top.n")).alias("n_rest"), (F.col("size") - F.col("top.size")).alias("rest_size"),
    )
    return rows.join(groups, ["band", "key"])


def small_group_pairs(members: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``a, b`` (a < b): the pairs of different classes in groups of up to ``paired`` texts that the least text isn't in."""
    few = members.where((F.col("n") <= paired) & (F.col("node") != F.col("least"))).select("band", "key", "node", "component")
    one = few.withColumnsRenamed({"node": "a", "component": "a_class"})
    two = few.withColumnsRenamed({"node": "b", "component": "b_class"})
    return one.join(two, ["band", "key"]).where("a < b and a_class <> b_class").select("a", "b").distinct()


def tile_members(members: DataFrame, paired: int = PAIRED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``band, key, i, j, block, node, component, keys``: members of larger groups dealt over tiles of blocks ``i <= j``.

    The rest's blocks come first; every one of them meets itself, the rest's others and those of the main class."""
    blocks = [F.greatest(F.ceil(F.col(n) / block_rows), F.ceil(F.col(size) / BLOCK_TEXT)).cast("int") for n, size in (("n_rest", "rest_size"), ("n_main", "main_size"))]
    rows = members.where(F.col("n") > paired).withColumn("own", F.col("component") == F.col("main")).withColumn("rest", blocks[0]).withColumn("mains", blocks[1])
    dealt = F.xxhash64("node")
    rows = rows.withColumn("block", F.when(F.col("own"), F.col("rest") + F.pmod(dealt, F.col("mains"))).otherwise(F.pmod(dealt, F.col("rest"))).cast("int"))
    others = F.sequence(F.lit(0), F.col("rest") - 1 + F.when(F.col("own"), 0).otherwise(F.col("mains")))
    rows = rows.withColumn("other", F.explode(others))
    return rows.select("band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "keys")


def common_weight(left: np.ndarray, right: np.ndarray, owner: np.ndarray, element: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight that each text of ``left`` has in common with each of ``right``: elements are in a text once."""
    out = np.zeros((len(left), len(right)))
    _, column, count = np.unique(element, return_inverse=True, return_counts=True)
    met = np.cumsum(count > 1) - 1
    held = count[column] > 1
    owner, column, weight = owner[held], met[column[held]], weight[held]
    order = np.argsort(column, kind="stable")
    owner, column, weight = owner[order], column[order], weight[order]
    n = int(owner.max(initial=-1)) + 1
    places = [np.full(max(n, int(side.max(initial=-1)) + 1), -1) for side in (left, right)]
    for place, side in zip(places, (left, right), strict=True):
        place[side] = np.arange(len(side))
    for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        parts = []
        for place, side in zip(places, (left, right), strict=True):
            row = place[owner[a:b]]
            part = np.zeros((len(side), COLUMNS))
            part[row[row >= 0], column[a:b][row >= 0] - first] = weight[a:b][row >= 0] if not parts else 1.0
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def verify_tiles(tiles: DataFrame, docs: DataFrame, nodes: DataFrame, weights: np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """``a, b, similarity``: verified pairs that join the classes of each tile as far as its similar texts do.

    Pairs of one class and pairs that meet in an earlier band already are left out; of the others, as many as join classes are told."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    wanted = materialize(tiles.select("node").distinct(), "near-wanted").join(nodes.select("node", "text_key"), "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").where("node is not null and text is not null")
    texts = texts.join(wanted, "node").where(F.md5("text") == F.col("text_key")).select("node", "text")

    def run(table: pa.Table) -> pa.Table:
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})
        # A row may be repeated in the documents.
        _, once = np.unique(table.column("node").to_numpy(), return_index=True)
        table = table.take(pa.array(once)).combine_chunks()
        node, component, block = (table.column(c).to_numpy() for c in ("node", "component", "block"))
        keys = np.array(table.column("keys").to_pylist(), dtype=np.int64).reshape(len(node), BANDS)
        band, i, j = (table.column(c)[0].as_py() for c in ("band", "i", "j"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        open_ = component[left][:, None] != component[right][None, :]
        if i == j:
            open_ &= left[:, None] < right[None, :]
        for e in range(band):
            open_ &= keys[left, e][:, None] != keys[right, e][None, :]
        left, right, open_ = left[open_.any(axis=1)], right[open_.any(axis=0)], open_[open_.any(axis=1)][:, open_.any(axis=0)]
        if not open_.any():
            return empty
        shingler, total, parts = Shingler(), np.zeros(len(node)), []
        used = np.zeros(len(node), dtype=bool)
        used[left] = used[right] = True
        column = pa.array([x if u else None for x, u in zip(table.column("text").to_pylist(), used, strict=True)], pa.string())
        for first, _, data, bounds in text_blocks(column, BLOCK):
            owner, shingle, times = shingler(data, bounds)
            # The k-th occurrence of a shingle is an element of its own, so the lesser count is what two texts share.
            again = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            element = mix64(np.repeat(shingle, times) + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            weight = np.repeat(shared.value[slot(shingle)].astype(np.float64), times)
            owner = np.repeat(owner, times) + first
            total += np.bincount(owner, weights=weight, minlength=len(node))
            parts.append((owner, element, weight))
        common = common_weight(left, right, *(np.concatenate(x) for x in zip(*parts, strict=True)))
        near = common / np.maximum(total[left][:, None] + total[right][None, :] - common, 1e-12)
        x, y = np.nonzero(open_ & (near >= similarity - 1e-9))
        up: dict[int, int] = {}

        def root(c: int) -> int:
            while up.get(c, c) != c:
                c = up[c]
            return c

        kept = []
        for at, (p, q) in enumerate(zip(component[left[x]].tolist(), component[right[y]].tolist(), strict=True)):
            p, q = root(p), root(q)
            if p != q:
                up[max(p, q)] = min(p, q)
                kept.append(at)
        if not kept:
            return empty
        x, y = x[kept], y[kept]
        a, b = node[left[x]], node[right[y]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "similarity": near[x, y]})

    rows = tiles.join(texts, "node")
    return rows.groupBy("band", "key", "i", "j").applyInArrow(run, "a long, b long, similarity double")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies, kept`` for every row of ``docs`` (``doc_id, text``).

    ``class_id`` is the least ``doc_id`` of the class, ``n_links`` the verified links of the row's text to
    other texts (pairs that one class held already aren't compared), ``n_copies`` the rows with exactly its text, ``kept`` whether the row is its class's first.
    Texts without a word (null, empty, white space) and rows without an id are classes of their own.
    Rows with one id count as one document in the classes and share a verdict.  An empty
    table gives an empty result; other columns are ignored."""
    frequency, n_docs = document_frequencies(docs)
    weights = slot_weights(frequency, n_docs)
    signed = materialize(signatures(docs, weights), "near-signatures")
    held = signed.where("signature is not null and doc_id is not null")
    nodes = held.groupBy("text_key").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n_copies"), F.first("n_bytes").alias("n_bytes"), F.first("signature").alias("signature"))
    nodes = materialize(nodes, "near-nodes")
    links = materialize(verify_pairs(candidate_pairs(nodes), docs, nodes, weights, similarity), "near-links").distinct()
    members = materialize(unsettled_members(nodes, links), "near-unsettled")
    few = materialize(small_group_pairs(members), "near-few")
    links = links.union(materialize(verify_pairs(few, docs, nodes, weights, similarity), "near-few-links"))
    tiles = materialize(tile_members(members), "near-tiles")
    links = materialize(links.union(verify_tiles(tiles, docs, nodes, weights, similarity)).distinct(), "near-all-links")
    classes = connected_components(links).select(F.col("node"), "component")
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    known = nodes.select("text_key", "node", "n_copies").join(classes, "node", "left").join(degree, "node", "left")
    known = known.select("text_key", "n_copies", "n_links", F.coalesce("component", "node").alias("component"))
    own = F.col("signature").isNotNull() & F.col("doc_id").isNotNull()
    out = signed.withColumn("text_key", F.when(own, F.col("text_key"))).join(known, "text_key", "left")
    class_id = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are the first of their class."""
    gone = near_duplicates(docs, **settings).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(small_side(materialize(gone, "near-gone"), 24), docs["doc_id"] == F.col("gone_id"), "left_anti")


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
