"""Mixing sources to target weights: capped water-filling and seeded repetition.

Every source gets a share of the word budget in proportion to its weight, but
no more than ``max_epochs`` times its own size.  Sources above that are clamped
there and their excess is dealt to the others by weight until none is above.

A source whose target is ``f`` times its size takes every document
``floor(f)`` times; the fractional repetition is sampled: documents are put in
seeded random order inside small seeded buckets of the source, and whole
documents are taken until the bucket's quota is full (the one that crosses the
quota is taken in part), so a source's words come to its target up to one half word
a bucket.

DataFrame operations only.  Only ids and sizes are shuffled, never texts.  A
hot source is split over its buckets.  The loop that finds the water level moves two
numbers a round to the driver; it ends after at most one round a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD_PATTERN, materialize, read_table, small_side

#: The places between a word and the white space after it.
AFTER_WORD = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"
#: Documents in a sampling bucket, on average.
BUCKET_DOCS = 256


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, budget: float) -> float:
    """Words a unit of weight gets, given columns ``weight`` and ``ceiling``.

    Starts with every source open; a source whose share reaches above its
    ceiling is clamped there, and the rest of the budget is dealt over the open
    ones.  Shares only grow, so a clamped source stays clamped."""
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("ceiling")
        row = sources.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, F.col("ceiling")).otherwise(0)).alias("taken"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == clamped or not row["weight"]:
            return level if level is not None else 0.0
        clamped = row["n"]
        level = (budget - row["taken"]) / row["weight"]


def mixing_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """One row a source: ``source, source_size, n_docs, weight, ceiling, target``.

    ``sizes`` has ``source`` and ``size``.  Sources in code-point order, null
    last, carry the weights in turn.  The rank is taken over one row a source.
    A source without words has the target 0."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    sources = materialize(
        totals.withColumn("weight", weight).withColumn("ceiling", F.lit(max_epochs) * F.col("source_size")), "mix-sources"
    )
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, budget if share == 1.0 else share * budget)
    return sources.withColumn(
        "target", F.least(F.col("weight") * F.lit(float(level)), F.col("ceiling").cast("double"))
    )


def mix_sources(
    docs: DataFrame, weights=(5, 2, 1), share: float = 1.0, max_epochs: int = 3, seed: int = 7, bucket_docs: int = BUCKET_DOCS
) -> DataFrame:
    """``doc_id, source, size, source_size, target, whole, extra, taken`` per row of ``docs``.

    ``taken = whole * size + extra`` words; ``extra < size`` only for the document that
    fills its bucket's quota.  Null or empty texts have size 0 and take
    nothing; null sources are a source of their own; rows repeated with the same
    ``doc_id`` are separate rows; an empty table gives an empty result; other
    columns of ``docs`` are ignored."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = mixing_targets(sizes, weights, share, max_epochs).select("source", "source_size", "n_docs", "target")
    rows = (
        sizes.withColumnRenamed("source", "own_source")
        .join(targets, F.col("own_source").eqNullSafe(F.col("source")))
        .drop("own_source")
        .withColumn("seeded", order)
    )
    buckets = F.ceil(F.col("n_docs") / bucket_docs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (
        rows.withColumn("bucket", F.conv(F.substring("seeded", 1, 8), 16, 10).cast("long") % buckets)
        .withColumn("whole", F.floor(epochs).cast("long"))
        .withColumn("part", epochs - F.floor(epochs))
    )
    group = Window.partitionBy("source", "bucket")
    running = group.orderBy("seeded", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quota = F.floor(F.col("part") * F.sum("size").over(group) + 0.5)
    before = F.sum("size").over(running) - F.col("size")
    rows = rows.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), quota - before)).cast("long"))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "whole", "extra",
        (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents themselves, repeated as the mix takes them, with the columns of ``docs``; those without words aren't taken.

    A row appears ``whole`` times, once more for a full ``extra``, and once with its text up to its
    ``extra``-th word, white space as it stands, if the extra is a part (``n_chars`` follows if present).  Rows with equal ``doc_id``, source and size
    get the same number of repetitions (the least)."""
    taken = (
        mix_sources(docs, **settings)
        .groupBy("doc_id", "source", "size")
        .agg(F.min("whole").alias("whole"), F.min("extra").alias("extra"))
        .where("size > 0 and (whole > 0 or extra > 0)")
        .select(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), "size", "whole", "extra")
    )
    taken = materialize(taken, "mix-taken")
    full = F.col("extra") == F.col("size")
    times = F.col("whole") + F.when(full, 1).otherwise(0)
    # 0 stands for the whole text, another number for that many words of it.
    none = F.array().cast("array<bigint>")
    copies = F.concat(
        F.when(times > 0, F.array_repeat(F.lit(0).cast("long"), times.cast("int"))).otherwise(none),
        F.when(~full & (F.col("extra") > 0), F.array("extra")).otherwise(none),
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.col("source").alias("own_source"), word_count(F.col("text")).alias("words"))
    same = F.col("doc_id").eqNullSafe(F.col("mix_id")) & F.col("own_source").eqNullSafe(F.col("mix_source")) & (F.col("words") == F.col("size"))
    out = rows.join(small_side(taken, 64), same).select("row", F.explode(copies).alias("copy"))
    # Cut after each word: pieces are a word with the white space before it.
    words = F.split("row.text", AFTER_WORD)
    part = F.array_join(F.slice(words, 1, F.greatest(F.col("copy"), F.lit(1)).cast("int")), "")
    row = F.col("row").withField("text", part)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(part).cast(docs.schema["n_chars"].dataType))
    return out.select(F.when(F.col("copy") == 0, F.col("row")).otherwise(row).alias("row")).select("row.*")


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS seeded
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM d GROUP BY source
), w AS (
  SELECT *, 3 * source_size AS ceiling,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s
), f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER before, 0))::DOUBLE / sum(weight) OVER rest AS level
  FROM w
  WINDOW before AS (ORDER BY ceiling::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY ceiling::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), t AS (
  SELECT w.*, least(weight * (SELECT coalesce(arg_min(level, ceiling::DOUBLE / weight) FILTER (weight * level <= ceiling), 0) FROM f), ceiling::DOUBLE) AS target
  FROM w
), r AS (
  SELECT d.doc_id, d.size, t.source, t.source_size, t.target, d.seeded,
         ('0x' || substr(seeded, 1, 8))::BIGINT % ceil(n_docs / 256)::BIGINT AS bucket,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, floor((epochs - floor(epochs)) * sum(size) OVER (PARTITION BY source, bucket) + 0.5)
            - (sum(size) OVER (PARTITION BY source, bucket ORDER BY seeded, doc_id, size ROWS UNBOUNDED PRECEDING) - size) AS room
  FROM r
)
SELECT doc_id, size, source_size, target,
       (floor(epochs) * size + greatest(0, least(size, room)))::BIGINT AS taken
FROM q
"""
