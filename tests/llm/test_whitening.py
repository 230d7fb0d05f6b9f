"""Whitening against numpy on whole small tables."""

import numpy as np
import pyarrow.dataset as ds

from basketry.llm import whitening

from .conftest import SMALL


def brute(rows, components=32):
    """n, trace share, and by row: id, deviation, |whitened| of every component."""
    fit = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in fit)
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in fit], dtype=object)
    n, sums = len(fit), x.sum(axis=0)
    gaps = n * x - sums
    deviation = (gaps**2).sum(axis=1)
    c = gaps.astype(float) / n
    e, axes = np.linalg.eigh(c.T @ c / n)
    e, axes = e[::-1], axes[:, ::-1]
    kept = min(components, int((e > 1e-10 * e[0]).sum()))
    white = c @ axes[:, :kept] / np.sqrt(e[:kept])
    return n, e / e.sum(), [(i, int(d), np.abs(w)) for (i, _), d, w in zip(fit, deviation, white, strict=True)]


def compare(got, rows):
    n, share, want = brute(rows)
    k = len(want[0][2])
    assert len(got) == len(want) * k and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-4
    assert all(abs(r["explained"] - share[r["component"] - 1]) <= 1e-6 * r["explained"] for r in got)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], [round(x, 5) for x in r[2]])
    mine = {}
    for r in got:
        mine.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(abs(r["whitened"]))
    own = []
    for (i, d), by in mine.items():
        assert sorted(by) == list(range(1, k + 1))
        own += [(i, d, np.array([by[c][j] for c in range(1, k + 1)])) for j in range(len(by[1]))]
    for a, b in zip(sorted(own, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and np.allclose(a[2], b[2], atol=1e-6)


def test_query_equals_numpy(spark):
    table = ds.dataset(f"{SMALL}/embeddings.parquet").to_table(columns=["vec_id", "embedding"]).to_pylist()
    compare(whitening.op11_whitening(spark, SMALL).collect(), [(r["vec_id"], r["embedding"]) for r in table])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "own", 1) for i, v in rows], "vec_id long, embedding array<double>, `index` string, n int")


def test_edges(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in draw.normal(size=6) * [9, 7, 5, 3, 2, 1]]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan")] * 6), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (104, [])]
    rows += [(105, [4.0, -3.0]), (None, rows[0][1]), (1, rows[1][1]), (1, rows[1][1]), (2, rows[5][1])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == {*range(60), 104, 105, None}
    compare(got, rows)


def test_small_blocks(spark, monkeypatch):
    # Many row and column blocks and partial products; and a dimension that never varies.
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    monkeypatch.setattr(whitening, "BLOCK_COLS", 3)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 2)
    draw = np.random.default_rng(4)
    rows = [(i, [*map(float, draw.normal(size=7) * np.arange(1, 8)), 0.5]) for i in range(150)]
    compare(whitening.whiten(frame(spark, rows).repartition(9)).collect(), rows)


def test_far_entries_stay_exact(spark):
    # n * x - S in decimals, its squares beyond 64 bits for one row.
    rows = [(i, [float(i % 5), float(i % 3) * 7]) for i in range(20)]
    big = [(50, [2.0**40, 3.0]), (51, [-(2.0**20), 1.0])]
    got = {r["vec_id"]: r for r in whitening.whiten(frame(spark, rows + big), 1).collect()}
    x = {i: [int(np.floor(64 * c)) + 1_000_000 for c in v] for i, v in rows + big}
    sums = [sum(v[j] for v in x.values()) for j in (0, 1)]
    for i, v in x.items():
        want = sum((len(x) * v[j] - sums[j]) ** 2 for j in (0, 1))
        assert got[i]["deviation"] == (want if want < 1 << 63 else None)


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = whitening.whiten(frame(spark, rows))
        assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert df.collect() == []
