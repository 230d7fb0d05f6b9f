"""Quality classifier with hierarchical empirical Bayes.

A logistic regression on symbol bigrams and base figures gives every document a
probability of good quality.  The evidence is summed by site and by section of a site
(host and path level); each site's rate is shrunk toward the global rate and each
section's rate toward its site's, by as much as the spread between sites (sections)
says (method of moments).  A document's posterior replaces the classifier's base rate by
the rate of its section, its own evidence left out; a sparse site hardly moves it.

The hierarchy is a list of columns, coarse to fine; ``url_levels`` derives host and
first path part from a URL.  ``documents`` has no URL, so the query takes
``source`` as host and ``lang`` as the section below it.

Training reads a bounded sample of labelled rows (``TRAIN_ROWS``); the
scoring pass reads every text once and writes small rows; the rest are grouped
aggregations with partial sums, so a hot site costs one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import RollingHash, materialize, read_table, text_blocks
from basketry.llm.quality_lm import text_stats
from basketry.llm.symbols import BITS, Symbols

#: The bound of the labelled sample, and the regularisation of the classifier.
TRAIN_ROWS, RIDGE, STEPS = 4000, 1.0, 12
BIGRAMS = 1 << (2 * BITS)
BASE = ("n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = BIGRAMS + len(BASE) + 3
BLOCK = 1 << 20


class Features:
    """Texts as rows of numbers."""

    def __init__(self) -> None:
        self.symbols, self.hasher = Symbols(), RollingHash(5)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        code, text = self.symbols.codes(data, bounds)
        counts = np.bincount(text * BIGRAMS + (code & np.uint32(BIGRAMS - 1)), minlength=n * BIGRAMS).reshape(n, BIGRAMS)
        size = np.maximum(counts.sum(axis=1), 1)
        stats = text_stats(data, bounds, self.hasher)
        words = np.maximum(stats["n_words"], 1)
        rest = [np.sqrt(stats[c] / words) for c in BASE] + [np.log1p(stats["n_words"]) / 8, stats["word_chars"] / words / 8, np.ones(n)]
        return np.concatenate([np.sqrt(counts / size[:, None]), np.stack(rest, axis=1)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_classifier(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps.

    Without labels, or with one class only, the weights give the add-one rate of the labels."""
    weights = np.zeros(FEATURES)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    weights[-1] = np.log(rate / (1 - rate))
    if len(np.unique(labels)) < 2:
        return weights
    penalty = np.full(FEATURES, RIDGE)
    penalty[-1] = 1e-6
    for _ in range(STEPS):
        p = sigmoid(x @ weights)
        gradient = x.T @ (labels - p) - penalty * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def training_rows(docs: DataFrame, labels: DataFrame, label: str, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Figures and labels of about ``train_rows`` labelled texts (twice as many at most), chosen by a hash of the id.

    The ids are few by construction and broadcast; whole texts become figures on the executors."""
    known = labels.where(f"{label} is not null and doc_id is not null").groupBy("doc_id").agg(F.max(label).alias("label"))
    n = known.count()
    span = 1 << 30
    share = min(span, span * train_rows // max(n, 1))
    chosen = known.where(F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(span)) < share).limit(2 * train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(2), BLOCK):
                rows = [r.tobytes() for r in features(data, bounds).astype(np.float32)]
                kept = [batch.column(i).slice(first, last - first) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("double").alias("label"), "text")
    found = sorted(rows.mapInArrow(run, "doc_id long, label double, x binary").limit(2 * train_rows).collect())
    x = np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in found], dtype=np.float64).reshape(len(found), FEATURES)
    return x, np.array([float(r["label"] > 0) for r in found])


def url_levels(url: Column) -> tuple[Column, Column]:
    """Host and first path part of a URL."""
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.lower(F.try_parse_url(url, F.lit("HOST"))), F.try_element_at(F.split(F.ltrim(path, F.lit("/")), "/"), F.lit(1))


def document_evidence(docs: DataFrame, weights: np.ndarray, levels: list[str]) -> DataFrame:
    """``doc_id, level_0, level_1, ..., doc_prob`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = [f"level_{i}" for i in range(len(levels))]
    schema = "doc_id long, " + ", ".join(f"{n} string" for n in names) + ", doc_prob double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for first, last, data, bounds in text_blocks(batch.column(batch.num_columns - 1), BLOCK):
                p = sigmoid(features(data, bounds) @ shared.value)
                kept = [batch.column(i).slice(first, last - first) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=["doc_id", *names, "doc_prob"])

    columns = [F.col(c).cast("string").alias(n) for c, n in zip(levels, names, strict=True)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns, "text").mapInArrow(run, schema)


def prior_strength(groups: DataFrame, mean: Column) -> float:
    """Pseudo-counts of a Beta prior, from the spread of group rates around ``mean`` beyond what their sizes explain.

    ``groups`` has ``n, total, squares``.  No spread gives a strong prior (``1e6``), few groups too."""
    row = groups.agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum("total").alias("t"),
        F.sum(F.col("n") * F.pow(F.col("total") / F.col("n") - mean, 2)).alias("between"),
        F.sum(F.col("squares") - F.col("total") * F.col("total") / F.col("n")).alias("within"),
    ).first()
    if not row["n"] or row["g"] < 2 or row["n"] <= row["g"]:
        return 1e6
    n, g, rate = float(row["n"]), row["g"], row["t"] / row["n"]
    noise = max(0.0, row["within"]) / (n - g)
    spread = (row["between"] - (g - 1) * noise) / max(1e-9, n - float(row["nn"]) / n)
    if spread <= 0:
        return 1e6
    return float(min(1e6, max(1.0, rate * (1 - rate) / spread - 1)))


def site_posteriors(evidence: DataFrame, levels: int) -> DataFrame:
    """Adds ``posterior_0`` (coarsest) to ``posterior_{levels-1}`` and ``posterior``; own evidence left out.

    Null levels are a site (section) of their own."""
    evidence = evidence.withColumn("logit", F.log(F.col("doc_prob") / (1 - F.col("doc_prob"))))
    sums = (F.count(F.lit(1)).alias("n"), F.sum("doc_prob").alias("total"), F.sum(F.pow("doc_prob", 2)).alias("squares"))
    world = evidence.agg(*sums).first()
    rate = (world["total"] or 0) + 0.5
    rate = min(1 - 1e-6, max(1e-6, rate / ((world["n"] or 0) + 1)))
    mean: Column = F.lit(rate)
    for i in range(levels):
        keys = [f"level_{j}" for j in range(i + 1)]
        groups = materialize(evidence.groupBy(*keys).agg(*sums), f"site-level-{i}")
        if i == 0:
            strength = prior_strength(groups, F.lit(rate))
        else:
            above = groups.groupBy(*keys[:-1]).agg(F.sum("n").alias("un"), F.sum("total").alias("ut"))
            above = above.select(*[F.col(k).alias(f"u_{k}") for k in keys[:-1]], "un", "ut")
            same = [F.col(k).eqNullSafe(F.col(f"u_{k}")) for k in keys[:-1]]
            strength = prior_strength(groups.join(above, on=same), F.col("ut") / F.col("un"))
        groups = groups.select(*[F.col(k).alias(f"g_{k}") for k in keys], F.col("n").alias(f"n_{i}"), F.col("total").alias(f"total_{i}"))
        evidence = evidence.join(groups, on=[F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in keys])
        rest = F.greatest(F.lit(0.0), F.col(f"total_{i}") - F.col("doc_prob"))
        evidence = evidence.withColumn(f"posterior_{i}", (rest + F.lit(strength) * mean) / (F.col(f"n_{i}") - 1 + F.lit(strength))).drop(
            *[f"g_{k}" for k in keys]
        )
        mean = F.col(f"posterior_{i}")
    odds = F.col("logit") + F.log(mean / (1 - mean)) - F.lit(float(np.log(rate / (1 - rate))))
    return evidence.withColumn("posterior", 1 / (1 + F.exp(-odds)))


def classify_quality(docs: DataFrame, labels: DataFrame, levels: list[str], label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """``doc_id, doc_prob, host_posterior, path_posterior, posterior, kept`` for every row of ``docs``.

    ``levels`` are the columns of the hierarchy, coarse to fine (two are reported).
    Null or empty texts are classified from their (empty) figures; null sites are one
    site; repeated rows stay rows of their own; labels repeated with one id count once
    (the greatest); without labels everything has probability 0.5; an empty table gives an empty result."""
    weights = fit_classifier(*training_rows(docs, labels, label))
    evidence = materialize(document_evidence(docs, weights, levels), "site-evidence")
    out = site_posteriors(evidence, len(levels))
    return out.select(
        "doc_id", "doc_prob", F.col("posterior_0").alias("host_posterior"), F.col(f"posterior_{len(levels) - 1}").alias("path_posterior"),
        "posterior", (F.col("posterior") >= threshold).alias("kept"),
    )


def op8_site_quality(spark, sf_dir: str) -> DataFrame:
    """Trained on labels of documents whose crc32(doc_id) mod 5 is not 0; the others are held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return classify_quality(docs, labels.where(~held_out), ["source", "lang"]).withColumn("held_out", held_out)
