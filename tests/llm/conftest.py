import random

import pytest

SMALL = "/root/testdata/sf0.001"

#: Names that the operators use inside; tables may hold columns of these names.
CLASHES = ("size", "line", "lines", "key", "row", "kept", "entry", "n", "bucket", "label", "a", "b", "node", "copy", "words", "target", "model", "t")


@pytest.fixture(scope="session")
def small_docs():
    import pyarrow.dataset as ds

    return ds.dataset(f"{SMALL}/documents.parquet").to_table().to_pylist()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    vocabulary = ["the", "river", "stone", "of", "light", "carries", "old", "names", "under", "bridge", "and", "winter", "bread", "quiet", "song"]
    out = []
    for i in range(n):
        out.append(draw.choice(vocabulary) + (draw.choice("abcdefgh") if draw.random() < 0.3 else ""))
        out.append("\n" if i % 12 == 11 else " ")
    return "".join(out).strip()


def edge_rows() -> list[tuple]:
    one = prose(1, 200)
    return [
        (1, one, "en", "s1"),
        (2, None, None, None),
        (3, "", "en", "s1"),
        (4, " \t\n \r", "fr", None),
        (None, prose(2, 60), "en", "s2"),
        (5, "12345 --- !!! 67", "en", "s2"),
        (6, prose(3, 20000), "en", "s1"),
        (7, one, "en", None),
        (7, one, "en", None),
        (8, "日本語 テキスト é ü 😀 straße\n" * 20, "ja", "s3"),
        (9, "a" * 5000, None, "s3"),
        (10, "x y " * 3000, "en", "s1"),
        (11, one.replace("river", "rivers", 1), "en", "s2"),
        (12, prose(2, 60), "de", "s2"),
        (13, "word", "en", "s1"),
        (14, one[:300] + "\n" + prose(5, 100) + "\n" + one[500:1100], "en", "s4"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), *[f"own {i}"] * len(CLASHES)) for i, r in enumerate(edge_rows())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
