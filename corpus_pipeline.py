"""A corpus pipeline of five training-data operators, each stage written as Parquet and read again.

1. quality rules: documents that fail the base rules or lie outside their language's perplexity band go;
2. line dedup: lines that occur more than once (near repeats counted) stay only where they come first;
   a document with no word left goes;
3. near-dedup: one document of each class of near-duplicates stays;
4. mixing: documents are taken as often as their source's target says;
5. SentencePiece: token counts and digests of every document of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import line_dedup, mixing, near_dedup, quality_lm, sp_codec
from basketry.llm.common import materialize, read_table

#: Occurrences from which on a line is a repeat, as in ``op9_line_dedup``.
LINE_REPEATS = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_lm.keep_good(docs)


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, min_repeats=LINE_REPEATS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp_codec.digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_repeats),
    ("near dedup", near_duplicates),
    ("source mix", source_mix),
    ("sentencepiece", sentencepiece),
]

#: Perplexity, consistent sampling and tokenisation have no SQL form; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
