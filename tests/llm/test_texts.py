"""Language, quality and tokenisation operators."""

import itertools
import zlib

import numpy as np
import pytest

from basketry.llm import langid, quality_lm, site_quality, sp_codec

from . import brute
from .conftest import SMALL, edge_rows


# -- language ---------------------------------------------------------------


def phrases_brute(sample: str, text: str) -> int:
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at, n = max(at + 1, end - 1), n + 1
    return n


@pytest.mark.parametrize("table_bytes", [1 << 20, 0])
def test_cross_parsing_counts_phrases(table_bytes):
    for sample in ("abracadabra", "a", "abcabcbacb" * 4):
        texts = ["abra", "cadabraabra", "zzz", "abrac", "dabz", "a", "raca" * 9, "zazbz", "cabzzacb"]
        code = lambda x: np.array([ord(c) for c in x], np.uint32)
        automaton = langid.SuffixAutomaton(code(sample), table_bytes)
        assert (automaton.table is None) == (table_bytes == 0)
        texts.sort(key=len, reverse=True)
        pieces = np.zeros((len(texts[0]), len(texts)), np.int64)
        for i, t in enumerate(texts):
            at = np.minimum(np.searchsorted(automaton.letters, code(t)), len(automaton.letters) - 1)
            pieces[: len(t), i] = np.where(automaton.letters[at] == code(t), at + 1, 0)
        got = automaton.phrases(pieces, np.array([len(t) for t in texts]))
        assert got.tolist() == [phrases_brute(sample, t) for t in texts]


def test_parsing_of_whole_texts_counts_phrases():
    samples = {"x": ["The river, the old bridge", "stone & light 42"], "y": ["日本語の本", "𐐷𐑂𐐮 日本", "Straße"]}
    parser = langid.CrossParser(samples)
    texts = ["the bridge", "Light RIVERS", "日本語 river", "𐐏𐑂𐐮", "  ", "", "ß", "qqq 𐐷", "old " * 60]
    fold = lambda x: " ".join("".join(c if c.isalpha() else " " for c in x.lower()).split(" ")) if x else ""
    import re as regex

    norm = lambda x: regex.sub(" +", " ", fold(x))
    blob = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, blob)])
    rates, has = parser.phrase_rates(np.frombuffer(b"".join(blob), np.uint8), bounds)
    assert has.tolist() == [any(c.isalpha() for c in t) for t in texts]
    for j, lang in enumerate(parser.langs):
        whole = norm(" ".join([*samples[lang], ""]))
        for i, t in enumerate(texts):
            n = norm(t)
            want = sum(phrases_brute(whole, n[k : k + langid.PIECE]) for k in range(0, len(n), langid.PIECE))
            assert rates[i, j] == pytest.approx(want / max(1, len(n))), (t, lang)


def scripts(spark, langs, n=60, head=""):
    """Documents of random words, a language an alphabet."""
    draw = __import__("random").Random(4)
    rows = []
    for lang, letters in langs.items():
        words = ["".join(draw.choices(letters, k=draw.randint(1, 6))) for _ in range(300)]
        rows += [(len(rows) + i, head + " ".join(draw.choices(words, k=120)), lang) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def accuracy(docs):
    fold_of = __import__("pyspark.sql.functions", fromlist=["x"]).expr("crc32(cast(cast(doc_id as string) as binary)) % 5")
    found = langid.detect_language(docs.where(fold_of == 0), langid.labelled_sample(docs.where(fold_of != 0)))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    return sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows), len(rows)


def test_languages_of_many_letters_and_a_shared_masthead(spark):
    ideographs = [chr(c) for c in range(0x4E00, 0x4E00 + 800)]
    langs = {"la": "abcdefghijklm", "lb": "nopqrstuvwxyz", "ci": "абвгдежзик", "ia": ideographs[:400], "ib": ideographs[400:], "far": [chr(c) for c in range(0x10428, 0x10450)]}
    head = "welcome to the one page that every site here has at its top " * 15
    share, n = accuracy(scripts(spark, langs, head=head))
    assert n > 40 and share >= 0.97


def test_three_hundred_labels(spark):
    draw = __import__("random").Random(8)
    langs = {f"l{i:03d}": draw.sample([chr(c) for c in range(0x3B1, 0x3B1 + 600) if chr(c).isalpha() and chr(c).lower() == chr(c)], 12) for i in range(300)}
    share, n = accuracy(scripts(spark, langs, n=8))
    assert n > 300 and share >= 0.97


def test_language_held_out(spark, small_docs):
    got = {r["doc_id"]: r for r in langid.op1_language_id(spark, SMALL).collect()}
    assert set(got) == {d["doc_id"] for d in small_docs}
    assert all(got[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) for d in small_docs)
    held = [d for d in small_docs if got[d["doc_id"]]["held_out"] and d["lang"] and d["text"]]
    assert sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_edges(edge_docs, no_docs):
    samples = langid.labelled_sample(edge_docs)
    got = langid.detect_language(edge_docs, samples).collect()
    assert len(got) == len(edge_rows())
    by = {r["doc_id"]: r for r in got}
    assert by[2]["lang_pred"] == by[3]["lang_pred"] == by[4]["lang_pred"] == by[5]["lang_pred"] == "und"
    assert by[1]["lang_pred"] == "en" and by[8]["lang_pred"] == "ja" and by[2]["score"] == 0
    assert langid.detect_language(no_docs, samples).collect() == []
    assert {r["lang_pred"] for r in langid.detect_language(edge_docs, langid.labelled_sample(no_docs)).collect()} == {"und"}


# -- quality rules ----------------------------------------------------------

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def failed(figures: tuple) -> bool:
    return figures[0] < 20 or 100 * figures[4] > 30 * figures[0]


def test_base_figures(spark, small_docs, edge_docs):
    got = {r["doc_id"]: r for r in quality_lm.op5_quality_rules(spark, SMALL).collect()}
    for d in small_docs:
        want = brute.base_figures(d["text"])
        assert tuple(got[d["doc_id"]][c] for c in BASE) == want and got[d["doc_id"]]["base_failed"] == failed(want)
        assert not (got[d["doc_id"]]["kept"] and got[d["doc_id"]]["base_failed"])
    rows = quality_lm.judge_documents(edge_docs).collect()
    want = sorted((repr(r[0]), *brute.base_figures(r[1])) for r in edge_rows())
    assert sorted((repr(r["doc_id"]), *[r[c] for c in BASE]) for r in rows) == want


def test_quality_keeps_clean_documents(spark):
    docs = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{docs}/labels.parquet").collect()}
    got = [r for r in quality_lm.op5_quality_rules(spark, docs).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good, bad = ([r["kept"] for r in got if labels[r["doc_id"]] == q] for q in (1, 0))
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_keep_good(edge_docs, no_docs):
    out = quality_lm.keep_good(edge_docs)
    assert out.columns == edge_docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 2 not in ids and 3 not in ids and 13 not in ids
    assert quality_lm.judge_documents(no_docs).collect() == [] and quality_lm.keep_good(no_docs).collect() == []


# -- site quality -----------------------------------------------------------


def test_site_quality_held_out(spark):
    docs = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{docs}/labels.parquet").collect()}
    got = [r for r in site_quality.op8_site_quality(spark, docs).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["kept"] == bool(labels[r["doc_id"]]) for r in got) >= 0.93 * len(got)


def test_sites_shrink(spark):
    """A site with few documents stays near the global rate, a large poor one goes to its own."""
    rows = [(i, "good", "x", 0.9) for i in range(400)] + [(i, "poor", "x", 0.2) for i in range(400, 600)] + [(600, "tiny", "x", 0.2), (601, None, None, 0.9)]
    df = spark.createDataFrame(rows, "doc_id long, level_0 string, level_1 string, doc_prob double")
    got = {r["doc_id"]: r for r in site_quality.site_posteriors(df, 2).collect()}
    assert len(got) == 602
    rate = sum(r[3] for r in rows) / len(rows)
    assert got[0]["posterior_0"] > 0.85 and got[450]["posterior_0"] < 0.25
    assert abs(got[600]["posterior_0"] - rate) < 0.01 and got[450]["posterior"] < 0.2 < got[600]["posterior"] + 0.05


def test_site_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (9, 0), (None, 1), (6, None), (1, 0)], "doc_id long, quality int")
    out = site_quality.classify_quality(edge_docs, labels, ["source", "lang"]).collect()
    assert len(out) == len(edge_rows()) and all(0 < r["posterior"] < 1 for r in out)
    none = site_quality.classify_quality(edge_docs, labels.limit(0), ["source", "lang"]).collect()
    assert {round(r["doc_prob"], 6) for r in none} == {0.5} and all(r["kept"] for r in none)
    assert site_quality.classify_quality(no_docs, labels, ["source", "lang"]).collect() == []


def test_url_levels(spark):
    df = spark.createDataFrame([("http://A.example.com/en/12?x=1",), ("https://b.example/",), (None,), ("no url",)], "url string")
    host, path = site_quality.url_levels(df["url"])
    assert [tuple(r) for r in df.select(host, path).collect()][0] == ("a.example.com", "en")


# -- SentencePiece ----------------------------------------------------------


@pytest.fixture(scope="module")
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_model())


def digest_of(processor, text):
    ids = processor.encode(text or "")
    return len(ids), brute.sha(",".join(map(str, ids))), brute.sha(processor.decode(ids))


def test_digests(spark, small_docs, processor):
    got = {r["doc_id"]: r for r in sp_codec.op6_sentencepiece(spark, SMALL).collect()}
    for d in small_docs:
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digest_of(processor, d["text"]) and r["spans_tile"]


def test_edges_and_spans(edge_docs, no_docs, processor):
    rows = edge_rows()
    got = sp_codec.digest(edge_docs).collect()
    want = sorted((repr(r[0]), *digest_of(processor, r[1])) for r in rows)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    for r in sp_codec.encode_decode(edge_docs).collect():
        raw, at = texts[r["doc_id"]], 0
        pieces = processor.id_to_piece(r["ids"]) if r["ids"] else []
        for piece, end in zip(pieces, r["piece_ends"], strict=True):
            own = raw[at:end]
            if piece.startswith("<0x"):
                assert own == bytes([int(piece[3:5], 16)])
            else:
                assert own == piece.replace("▁", " ").encode() or at == 0 and own == piece.replace("▁", " ")[1:].encode()
            at = end
        assert at == len(raw) if pieces else not raw
    assert sp_codec.digest(no_docs).collect() == [] and sp_codec.encode_decode(no_docs).collect() == []


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
@pytest.mark.parametrize("trim", [True, False])
def test_normalizer_equals_library(rule, trim):
    """The character map walker against the library's own normaliser, offsets included."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=trim)
    spec = sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec
    own = sp_codec.Normalizer(spec)
    texts = ["ＡＢ ｶﾞ ﬁ  x", "  Ünïcode  ㌔ ½ Ⅳ ", "plain text", "", "   ", "ẞtraße İ ﷺ", "áb​\tc\n", "日本語　です", "é" * 3, "😀 ok"]
    for text in texts:
        want, offsets = library.normalize(text, with_offsets=True)
        out, source = own(np.frombuffer(text.encode(), np.uint8))
        assert out.tobytes().decode() == want, (rule, text)
        # The library's offsets are characters of the original, one for each character of the result.
        starts = [len(text.encode()[: source[i]].decode("utf-8", "ignore")) for i, c in enumerate(out) if c & 0xC0 != 0x80]
        assert starts == list(offsets)[: len(starts)], (rule, text)


def test_long_text_is_one_piece_of_work(spark, processor):
    text = "straße und Brücke " * 40000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = sp_codec.digest(df).collect()[0]
    assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digest_of(processor, text) and r["spans_tile"]


def test_word_spans_do_not_cross_texts():
    from basketry.llm.common import word_spans

    data = np.frombuffer("ab cdé fg".encode(), np.uint8)
    starts, ends, owner = word_spans(data, np.array([0, 2, 2, 5, len(data)]))
    assert [(int(a), int(b), int(o)) for a, b, o in zip(starts, ends, owner, strict=True)] == [(0, 2, 0), (3, 5, 2), (5, 7, 3), (8, 10, 3)]
    assert list(itertools.pairwise([1, 2])) == [(1, 2)]
