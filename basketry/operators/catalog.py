"""Product catalog: normalisation, enrichment, product->category maps and
the category roll-up of product-grain metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.rates import safe_rate
from basketry.operators.vocab import PURCHASE, UNKNOWN_CATEGORY, VIEW

# A dimension is broadcast only if the optimizer's size of its plan is within
# this many bytes; larger ones are joined with a salted shuffle join (below).
MAX_BROADCAST_BYTES = 64 << 20
# Salt buckets for a shuffled lookup: a hot product (say a third of all
# events) is spread over this many join tasks; the dimension is replicated
# this many times, which is cheap next to the fact side.
SALT_BUCKETS = 16


def planned_bytes(dim: DataFrame) -> int:
    """The optimizer's size of ``dim`` in bytes, from file sizes and row
    widths. Nothing is run; an unknown size counts as very large."""
    return int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: For file sources the optimizer's size is that of the compressed files; in memory it may be several times that.
FILE_EXPANSION = 8


def fits_broadcast(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``dim`` may be sent to every executor: ``max_bytes`` in memory, allowing for compressed files."""
    return planned_bytes(dim) * FILE_EXPANSION <= max_bytes


def salted_left_join(facts: DataFrame, dim: DataFrame, key: str, buckets: int = SALT_BUCKETS) -> DataFrame:
    """``facts LEFT JOIN dim USING (key)`` for a ``dim`` too large to
    broadcast, robust to hot keys without AQE (also in streaming).

    Each fact row gets a salt in ``[0, buckets)`` from a hash of the whole
    row; the dimension is replicated once per salt value. Rows of one hot
    key therefore land in ``buckets`` different join partitions."""
    cols = facts.columns
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int")
    salted = facts.withColumn("_salt", salt)
    replicated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted.join(replicated, [key, "_salt"], "left").drop("_salt")


def normalize_catalog(catalog: DataFrame, order_col: str = "line_order") -> DataFrame:
    """One row per product: id trimmed and upper-cased, category trimmed.

    A product listed again keeps the category of its last line by
    ``order_col`` (see :func:`basketry.sources.files.read_catalog_csv`)."""
    cleaned = catalog.select(
        F.upper(F.trim(F.col("product_id").cast("string"))).alias("product_id"),
        F.trim(F.col("category").cast("string")).alias("category"),
        F.col(order_col).alias("_order"),
    ).filter(F.col("product_id").isNotNull())
    return cleaned.groupBy("product_id").agg(F.max_by("category", "_order").alias("category"))


def enrich_with_catalog(
    events: DataFrame,
    catalog: DataFrame,
    default: str = UNKNOWN_CATEGORY,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Sets ``category`` from the catalog by ``product_id``; products not in
    the catalog get ``default``. ``catalog`` must have one row per product
    (see :func:`normalize_catalog`), so no event is duplicated. A catalog
    whose plan is over ``max_broadcast_bytes`` is joined with
    :func:`salted_left_join`; the rows are the same either way.

    Works for batch and streaming ``events`` (stream-static join)."""
    facts = events.drop("category") if "category" in events.columns else events
    dim = catalog.select("product_id", F.col("category").alias("_catalog_category"))
    if fits_broadcast(dim, max_broadcast_bytes):
        joined = facts.join(F.broadcast(dim), "product_id", "left")
    else:
        joined = salted_left_join(facts, dim, "product_id")
    out = joined.withColumn("category", F.coalesce(F.col("_catalog_category"), F.lit(default))).drop("_catalog_category")
    ordered = [c for c in events.columns if c != "category"]
    at = events.columns.index("category") if "category" in events.columns else len(ordered)
    return out.select(*ordered[:at], "category", *ordered[at:])


def product_category_map(raw: DataFrame) -> DataFrame:
    """``product_id -> category`` seen in events: the greatest non-null category of each product.

    Events shrink to distinct pairs in a hash aggregate (fixed state, partial
    on the map side) before the few pairs of each product are compared."""
    pairs = raw.dropna(subset=["product_id", "category"]).groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("seen"))
    # The condition always holds; without it the optimizer takes the pairs for
    # redundant under a maximum and sorts all events instead.
    pairs = pairs.filter(F.col("seen") > 0)
    return pairs.groupBy("product_id").agg(F.max("category").alias("category"))


def _by_category(per_product: DataFrame, scale: int | None) -> DataFrame:
    """Products' ``views`` and ``purchases`` (one row each, with ``category``) as the category report."""
    totals = [F.sum(c).cast("long").alias(c) for c in ("views", "purchases")]
    report = per_product.groupBy("category").agg(*totals).withColumn("conversion_rate", safe_rate("purchases", "views", scale))
    return report.orderBy(F.desc("conversion_rate"), "category")


def category_conversion(product_metrics: DataFrame, raw: DataFrame, scale: int | None = None) -> DataFrame:
    """Roll stored product metrics up to categories through the map derived
    from ``raw``; products that ``raw`` gives no category form a null one.

    Windows are summed away first, so the join and the last shuffle carry one
    row per product. Any ``category`` of the metrics is ignored."""
    per_product = product_metrics.groupBy("product_id").agg(*[F.sum(c).alias(c) for c in ("views", "purchases")])
    return _by_category(per_product.join(product_category_map(raw), "product_id", "left"), scale)


def category_conversion_of_events(events: DataFrame, scale: int | None = None) -> DataFrame:
    """The same report straight from events, in one pass: counts by (product,
    category) are all that is shuffled; a product's counts go to its greatest
    category, and those without product or category to the null one. Events
    without a time belong to no window and aren't counted, but still name
    their product's category."""
    timed = F.col("timestamp").isNotNull()
    counts = events.groupBy("product_id", "category").agg(
        F.count_if(timed & (F.col("event_type") == VIEW)).alias("views"),
        F.count_if(timed & (F.col("event_type") == PURCHASE)).alias("purchases"),
    )
    greatest = F.when(F.col("product_id").isNotNull(), F.max("category")).alias("category")
    per_product = counts.groupBy("product_id").agg(greatest, *[F.sum(c).alias(c) for c in ("views", "purchases")])
    return _by_category(per_product, scale)
