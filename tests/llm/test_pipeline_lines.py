"""The pipeline's line stage takes out every repeated line, whatever its count."""

import corpus_pipeline

from .conftest import SMALL


def test_lines_that_occur_a_few_times(spark):
    twice = "a passage of one line that only two documents have in common"
    six = "a footer of a small site that stands below six of its pages 2024"
    rows = [(i, f"only document number {i} of this table has the line {'abcdefgh'[i] * 9}") for i in range(8)]
    rows = [(i, x + (f"\n{twice}" if i in (1, 6) else "") + (f"\n{six[:-1]}{i}" if i < 6 else "")) for i, x in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: "\n".join(x for x in t.split("\n") if not (x == twice and i == 6) and not (x.startswith(six[:-1]) and i > 0)) for i, t in rows}
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.line_repeats(spark, df, SMALL).collect()} == want
