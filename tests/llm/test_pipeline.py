"""The corpus pipeline, stage by stage on what each stage reads."""

import corpus_pipeline
import pytest

from basketry.llm import mixing, sp_codec
from basketry.llm.common import materialize

from . import brute
from .conftest import SMALL
from .test_near import want_classes


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SMALL), f"test-{name.replace(' ', '-')}"))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "source mix", "sentencepiece"]
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(stages):
    kept = {r["doc_id"] for r in stages[1].collect()}
    for r in stages[0].collect():
        f = brute.base_figures(r["text"])
        if f[0] < 20 or 100 * f[4] > 30 * f[0]:
            assert r["doc_id"] not in kept


def test_line_stage(stages):
    before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in stages[1:3])
    first, count = {}, {}
    for i in sorted(before):
        for p, x in enumerate(before[i].split("\n")):
            if brute.WORD.search(x):
                first.setdefault(x, (i, p))
                count[x] = count.get(x, 0) + 1
    links = brute.line_links(list(first), 2, 32)
    lead = brute.classes(first.values(), [(first[a], first[b]) for a, b in links])
    size: dict = {}
    for x, f in first.items():
        size[lead[f]] = size.get(lead[f], 0) + count[x]
    want = {}
    for i, t in before.items():
        kept = [x for p, x in enumerate(t.split("\n")) if not brute.WORD.search(x) or size[lead[first[x]]] < corpus_pipeline.LINE_REPEATS or lead[first[x]] == (i, p)]
        if brute.words("\n".join(kept)):
            want[i] = "\n".join(kept)
    assert after == want


def test_near_stage(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages[2].collect())
    classes = want_classes(rows)
    assert {r["doc_id"] for r in stages[3].collect()} == {i for i, c in classes.items() if i == c}


def test_mix_stage(stages):
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(stages[3]).collect()}
    got: dict = {}
    for r in stages[4].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(brute.words(r["text"]))
    assert got == {i: n for i, n in taken.items() if n}


def test_last_stage_and_run(spark, stages):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_model())
    want = sorted((r["doc_id"], len(ids := model.encode(r["text"])), brute.sha(",".join(map(str, ids)))) for r in stages[4].collect())
    columns = ("doc_id", "n_tokens", "ids_sha256")
    assert sorted(tuple(r[c] for c in columns) for r in stages[5].collect()) == want
    assert sorted(tuple(r[c] for c in columns) for r in corpus_pipeline.run(spark, SMALL).collect()) == want


def test_empty(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []


def test_entry_lists_all_queries():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names
