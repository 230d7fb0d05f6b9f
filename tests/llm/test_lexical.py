"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest

from basketry.llm import lexical

from .conftest import SMALL, edge_rows

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=50):
    """(item_id, rank, doc_id, score), documents given as (doc_id, text)."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def read(name, *columns):
    return [tuple(r.values()) for r in ds.dataset(f"{SMALL}/{name}.parquet").to_table(columns=list(columns)).to_pylist()]


def test_query_equals_brute_force(spark):
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    df = lexical.op13_ranked_search(spark, SMALL)
    assert df.columns == ["item_id", "rank", "doc_id", "score"] and rows(df) == want and len(want) > 500


def test_edges(spark, edge_docs, no_docs):
    items = [(1, "the River of STONE"), (1, "the River of STONE"), (2, None), (3, " .,! "), (None, "word 日本語 straße"), (4, "a" * 5000), (5, "nowhere"), (6, edge_rows()[6][1])]
    bench = spark.createDataFrame([(i, t, "own", "own") for i, t in items], "item_id long, text string, doc_id string, terms string")
    docs = [(r[0], r[1]) for r in edge_rows()]
    assert rows(lexical.ranked(edge_docs, bench)) == brute(docs, items)
    assert rows(lexical.ranked(edge_docs, bench, k=2)) == brute(docs, items, 2)
    assert lexical.ranked(no_docs, bench).collect() == [] and lexical.ranked(edge_docs, bench.limit(0)).collect() == []


@pytest.fixture(scope="module")
def crowd():
    """Four vocabularies, a third of all rows copies of one text, many equal scores."""
    draw = random.Random(5)
    words = [[f"{chr(97 + g)}{i}" for i in range(120)] for g in range(4)]
    docs = [(i, " ".join(draw.choices(words[i % 4], k=draw.randint(3, 60)))) for i in range(900)]
    docs += [(2000 + i, docs[0][1]) for i in range(450)]
    items = [(i, " ".join(draw.choices(words[i % 4], k=12))) for i in range(40)] + [(100, docs[0][1])]
    return docs, items


def test_slices_tiles_and_shards(spark, crowd, monkeypatch):
    docs, items = crowd
    for name, value in {"VOCABULARY_BYTES": 300, "SHARD_COUNTS": 3000, "TILE_ITEMS": 15, "COLUMNS": 32, "NODE_CELLS": 4096, "CANDIDATES": 200}.items():
        monkeypatch.setattr(lexical, name, value)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows(lexical.ranked(d, spark.createDataFrame(items, "item_id long, text string"), k=10)) == brute(docs, items, 10)


def tables(docs, items):
    """A cell's two tables, made without Spark."""
    counted = [Counter(terms(t)) for _, t in docs]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, x in items for t in terms(x)}))}
    n, total = len(docs), sum(c.total() for c in counted)
    df = Counter(t for c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in vocabulary}
    left = pa.table({"item": list(range(len(items))), "terms": [[vocabulary[t] for t in dict.fromkeys(terms(x))] for _, x in items],
                     "weights": [[weight[t] for t in dict.fromkeys(terms(x))] for _, x in items], "seed": pa.array([None] * len(items), pa.int64())})
    right = pa.table({"doc": list(range(n)), "doc_id": [i for i, _ in docs], "n": [c.total() for c in counted],
                      "terms": [[vocabulary[t] for t in c if t in vocabulary] for c in counted], "tfs": [[v for t, v in c.items() if t in vocabulary] for c in counted]})
    return left, right, n, total


def test_pairs_are_pruned(crowd):
    docs, items = crowd
    left, right, n, total = tables(docs, items)
    cell = lexical.Cell(left, right, n, total)
    item, doc, score = cell.search(10)
    got = [(items[i][0], docs[d][0], int(s)) for i, d, s in zip(item, doc, score, strict=True)]
    assert sorted(got) == sorted((a, c, d) for a, _, c, d in brute(docs, items, 10))
    assert 0 < cell.scored < 0.5 * cell.pairs, (cell.scored, cell.pairs)


def test_bounds_never_undercut(crowd):
    docs, items = crowd
    left, right, n, total = tables(docs, items)
    cell = lexical.Cell(left, right, n, total)
    order = lexical.halved(cell.doc, cell.doc_col, cell.impact.astype(float), cell.n_docs, cell.width, 4)
    assert sorted(order) == list(range(cell.n_docs))
    levels = lexical.node_maxima(cell.doc, cell.doc_col, cell.impact, order, cell.width, 4, np.int64)
    dense = np.zeros((cell.n_docs, cell.width), np.int64)
    dense[cell.doc, cell.doc_col] = cell.impact
    for level, nodes in enumerate(levels):
        at = (np.arange((1 << level) + 1) * cell.n_docs) >> level
        for i, node in enumerate(nodes):
            assert (node == dense[order[at[i] : at[i + 1]]].max(axis=0)).all()
