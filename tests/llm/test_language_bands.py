"""Every label has a perplexity band of its own, however many labels there are."""

import random

from basketry.llm import quality_lm

from .conftest import prose


def test_rare_labels_keep_their_own_bands(spark):
    rows = [(100 * k + i, prose(100 * k + i, 80), f"l{k:02d}") for k in range(15) for i in range(20)]
    rows += [(5000 + i, prose(5000 + i, 80), "xa") for i in range(12)]
    draw = random.Random(3)
    other = [" ".join("".join(draw.choice("qxzkvjwy") for _ in range(6)) for _ in range(80)) for _ in range(6)]
    rows += [(6000 + i, t, "xb") for i, t in enumerate(other)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_lm.judge_documents(df).collect()}
    assert len(got) == len(rows) and not any(r["base_failed"] for r in got.values())
    assert got[6000]["lower_band"] > got[5000]["upper_band"]
    assert sum(got[6000 + i]["kept"] for i in range(6)) >= 5
