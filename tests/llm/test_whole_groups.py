"""Pairs inside large groups of texts that are alike but not alike enough."""

import numpy as np

from basketry.llm import near_dedup

from . import brute


def template_family(n: int, hidden: int, seed: int = 1) -> list[tuple[int, str]]:
    """``n`` texts that share most of a page (similarity about 0.78) and, under the highest ids, changed copies of the ``hidden`` ones before."""
    draw = np.random.default_rng(seed)
    page = " ".join(f"page{x}" for x in draw.integers(0, 10**6, 304))

    def own(words):
        return page + " " + " ".join(f"own{x}" for x in words)

    words = [draw.integers(0, 10**9, 34).tolist() for _ in range(n)]
    rows = [(i, own(w)) for i, w in enumerate(words)]
    for k in range(hidden):
        rows.append((n + k, own(words[n - hidden + k][:-10] + draw.integers(0, 10**9, 10).tolist())))
    return rows


def test_pairs_hidden_in_a_template_family(spark):
    n, hidden = 2500, 250
    df = spark.createDataFrame(template_family(n, hidden), "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()}
    want = {i: i for i in range(n)} | {n + k: n - hidden + k for k in range(hidden)}
    assert got == want


def test_tiles_find_what_all_pairs_find(spark):
    """Small blocks, so that groups are dealt over many tiles; similarities of every kind."""
    draw = np.random.default_rng(4)
    base, rows = [f"w{x}" for x in range(200)], []
    for i in range(160):
        words = list(base)
        for at in draw.integers(0, 200, draw.integers(1, 9)):
            words[at] = f"x{draw.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    frequency, n_docs = near_dedup.document_frequencies(df)
    weights = near_dedup.slot_weights(frequency, n_docs)
    nodes = near_dedup.materialize(
        near_dedup.signatures(df, weights).selectExpr("doc_id as node", "text_key", "n_bytes", "signature"), "test-nodes"
    )
    # No links yet: every pair of a band's group is open.
    members = near_dedup.unsettled_members(nodes, spark.createDataFrame([], "a long, b long"))
    few = near_dedup.small_group_pairs(members).collect()
    tiles = near_dedup.tile_members(members, block_rows=16)
    found = [(r["a"], r["b"]) for r in near_dedup.verify_tiles(tiles, df, nodes, weights).collect()]
    pairs = near_dedup.verify_pairs(nodes.selectExpr("node as a").crossJoin(nodes.selectExpr("node as b")).where("a < b"), df, nodes, weights)
    links = {(r["a"], r["b"]) for r in pairs.collect()}
    assert links and set(found) <= links
    keys = {r["node"]: set(r["keys"]) for r in nodes.select("node", near_dedup.band_keys().alias("keys")).collect()}
    met = [(a, b) for a, b in links if keys[a] & keys[b]]
    firsts = [(r["a"], r["b"]) for r in near_dedup.candidate_pairs(nodes).collect() if (r["a"], r["b"]) in links]
    few = [(r["a"], r["b"]) for r in few if (r["a"], r["b"]) in links]
    assert brute.classes(range(160), found + few + firsts) == brute.classes(range(160), met)
