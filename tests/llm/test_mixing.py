"""Mixing to targets: SQL, invariants and edges."""

import duckdb
import pyarrow.dataset as ds
from pyspark.sql import functions as F

from basketry.llm import mixing

from . import brute
from .conftest import SMALL, edge_rows


def test_equals_sql(spark):
    con = duckdb.connect()
    con.register("documents", ds.dataset(f"{SMALL}/documents.parquet").to_table())
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    want = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({mixing.ORACLE_SQL})").fetchall())
    got = sorted(tuple(r[c] for c in columns) for r in mixing.op3_mix_sources(spark, SMALL).collect())
    assert got == want


def test_edges_and_targets(edge_docs):
    got = mixing.mix_sources(edge_docs).collect()
    rows = edge_rows()
    assert sorted((repr(r["doc_id"]), r["size"]) for r in got) == sorted((repr(r[0]), len(brute.words(r[1]))) for r in rows)
    by_source = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        assert own[0]["target"] <= 3 * own[0]["source_size"]
    assert abs(sum(own[0]["target"] for own in by_source.values()) - sum(r["size"] for r in got)) < 1e-3
    again = mixing.mix_sources(edge_docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_water_level_clamps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.mixing_targets(sizes).collect()}
    assert got["a"] == 30.0 and abs(got["b"] - 1980 * 2 / 3) < 1e-9 and abs(got["c"] - 1980 / 3) < 1e-9


def test_documents_follow_the_mix(edge_docs):
    unique = edge_docs.dropDuplicates(["doc_id"])
    mixed = mixing.mixed_documents(unique)
    assert mixed.columns == unique.columns
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(unique).collect()}
    got = {r["doc_id"]: r["w"] for r in mixed.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("w")).collect()}
    assert got == {k: v for k, v in taken.items() if v}


def test_parts_are_beginnings_of_texts(spark):
    text = {i: "\n ".join(f"w{j}\t{i}  x" for j in range(20 + i)) + ("\n" if i % 2 else "") for i in range(12)}
    docs = spark.createDataFrame([(i, t, f"s{i % 4}", len(t)) for i, t in text.items()], "doc_id long, text string, source string, n_chars long")
    parts = [r for r in mixing.mixed_documents(docs).collect() if r["text"] != text[r["doc_id"]]]
    assert parts and any("\n" in r["text"] for r in parts)
    for r in parts:
        assert text[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) and not r["text"][-1].isspace()


def test_empty(no_docs):
    assert mixing.mix_sources(no_docs).collect() == []
    assert mixing.mixed_documents(no_docs).collect() == []


def test_native_plan(spark):
    plan = mixing.op3_mix_sources(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
