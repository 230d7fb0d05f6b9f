"""Line dedup against brute force."""

import pytest
from pyspark.sql import functions as F

from basketry.llm import line_dedup

from . import brute
from .conftest import SMALL, edge_rows

COLUMNS = ("n_lines", "n_exact", "n_near", "n_links", "kept_sha256")


def test_edit_distance(spark):
    words = ["", "a", "ab", "abc", "xabc", "kitten sitting", "kitten sittin", "kittens itting", "acb", "日本語", "日本", "ba", "bxa"]
    pairs = [(a, b) for a in words for b in words]
    df = spark.createDataFrame(pairs, "a string, b string")
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    for edits in (1, 2, 3):
        got = df.select("a", "b", line_dedup.edit_distance(chars("a"), chars("b"), edits).alias("d")).collect()
        assert all(r["d"] == min(edits + 1, brute.edit_distance(r["a"], r["b"])) for r in got)


def test_letter_counts_never_overstate_the_distance(spark):
    import random

    draw = random.Random(4)
    pairs = []
    for _ in range(300):
        a = "".join(draw.choice("etaoin shrdlu,xyzé") for _ in range(draw.randrange(0, 400)))
        b = list(a)
        edits = draw.randrange(0, 4)
        for _ in range(edits):
            at = draw.randrange(0, len(b) + 1)
            b[at : at + draw.randrange(0, 2)] = draw.choice(["", "e", "q"])
        pairs.append((a, "".join(b), edits))
    df = spark.createDataFrame(pairs, "a string, b string, edits int")
    counts = [line_dedup.letter_counts(F.col(c)) for c in "ab"]
    got = df.withColumns({"x": counts[0], "y": counts[1]}).select("edits", line_dedup.counts_differ(F.col("x"), F.col("y")).alias("d"))
    assert all(r["d"] <= 2 * r["edits"] for r in got.collect())


def test_middles_have_the_distance_of_the_lines(spark, workdir):
    texts = ["the old bridge", "the new bridge", "the old bridges", "he old bridge", "", "aaaa", "aaa", "日本語です", "日本です", "the old bridge the old bridge"]
    pairs = [(a, b, a, b, a[::-1], b[::-1]) for a in texts for b in texts]
    spark.createDataFrame(pairs, "a_key string, b_key string, a_text string, b_text string, a_back string, b_back string").write.parquet(f"{workdir}/pairs")
    line_dedup.middles(spark.read.parquet(f"{workdir}/pairs")).write.parquet(f"{workdir}/middles")
    middles = spark.read.parquet(f"{workdir}/middles")
    got = middles.withColumn("d", line_dedup.edit_distance(F.col("a_chars"), F.col("b_chars"), 3)).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert r["d"] == min(4, brute.edit_distance(r["a_key"], r["b_key"]))
        assert r["a_key"] != r["b_key"] or not r["a_chars"] and not r["b_chars"]


def test_pieces_never_rule_out_near_lines(spark):
    lines = ["the quiet river carries old names under the bridge", "he quiet river carries old name under the bridge", "the quiet river carries old names under tha bridg", "thee quiet rivers carries old names under the bridge", "another line of the same kind and quite other words"]
    df = spark.createDataFrame([(a, b) for a in lines for b in lines], "a string, b string")
    for r in df.withColumn("may", line_dedup.may_be_near(F.col("a"), F.col("b"))).collect():
        assert r["may"] or brute.edit_distance(r["a"], r["b"]) > line_dedup.EDITS


def test_edge_lines(edge_docs):
    want = brute.line_rows([r[:2] for r in edge_rows()], line_dedup.EDITS, line_dedup.MIN_CHARS)
    got = line_dedup.line_report(edge_docs).collect()
    assert len(got) == len(edge_rows())
    assert [(r["doc_id"], *[r[c] for c in COLUMNS]) for r in got if want[r["doc_id"]] != tuple(r[c] for c in COLUMNS)] == []


def test_whole_table(spark, small_docs):
    want = brute.line_rows([(d["doc_id"], d["text"]) for d in small_docs], line_dedup.EDITS, line_dedup.MIN_CHARS)
    got = line_dedup.op9_line_dedup(spark, SMALL).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want


@pytest.mark.parametrize("hot", [1, 3, 32])
def test_crowded_segments(spark, hot):
    """Many lines that share most segments: the split by levels finds the same pairs."""
    lines = [f"entry {i:05d} of the long register of quiet rivers and old names" for i in range(0, 120, 3)]
    lines += [f"entry {i} of the long register of quiet rivers and new names" for i in range(10, 40)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "line long, s string")
    pairs = {(r["a"], r["b"]) for r in line_dedup.candidate_links(df, hot=hot)[0].collect()}
    near = {(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if brute.edit_distance(lines[a], lines[b]) <= line_dedup.EDITS}
    assert near and near <= pairs


def test_dedup_keeps_columns_and_drops_emptied(edge_docs):
    out = line_dedup.dedup_lines(edge_docs, min_repeats=2)
    assert out.columns == edge_docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 1 in ids and 7 not in ids and 2 in ids and 3 in ids  # 7 repeats 1; null and empty texts stay


def test_empty(no_docs):
    assert line_dedup.line_report(no_docs).collect() == []
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_native_plan(spark):
    plan = line_dedup.op9_line_dedup(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
