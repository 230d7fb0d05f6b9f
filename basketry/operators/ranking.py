"""Most viewed products and their text report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.vocab import (
    CATEGORY_LINE_FORMAT,
    PRODUCT_LINE_FORMAT,
    RULE,
    TITLE_FORMAT,
    VIEW,
    VIEWS_LINE_FORMAT,
)


def _rank_order() -> list:
    return [F.desc("views"), F.col("product_id"), F.col("category")]


def product_views(events: DataFrame) -> DataFrame:
    """View count per (product, category); rows with a null key dropped."""
    return (
        events.filter(
            (F.col("event_type") == VIEW) & F.col("product_id").isNotNull() & F.col("category").isNotNull()
        )
        .groupBy("product_id", "category")
        .agg(F.count(F.lit(1)).alias("views"))
    )


def top_products(events: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most viewed products with a 1-based ``rank``; ties are
    broken by product id then category.

    The limit runs first (each task keeps k rows), so the numbering window
    without a partition sees at most k rows."""
    top = product_views(events).orderBy(*_rank_order()).limit(k)
    rank = F.row_number().over(Window.orderBy(*_rank_order()))
    return top.select(rank.alias("rank"), "product_id", "category", "views")


def top_products_lines(top: DataFrame, as_of: dt.date | str, k: int = 5) -> DataFrame:
    """The text report as ``(line_no, line)``: a titled header, then per
    product three lines and a blank line."""
    day = as_of.strftime("%Y-%m-%d") if isinstance(as_of, (dt.date, dt.datetime)) else str(as_of)
    spark = top.sparkSession
    header = spark.createDataFrame(
        [(1, RULE), (2, TITLE_FORMAT % (k, day)), (3, RULE), (4, "")],
        "line_no int, line string",
    )
    base = F.lit(4) + (F.col("rank") - 1) * 4
    body = top.select(
        F.explode(
            F.array(
                F.struct((base + 1).alias("line_no"), F.format_string(PRODUCT_LINE_FORMAT, "rank", "product_id").alias("line")),
                F.struct((base + 2).alias("line_no"), F.format_string(CATEGORY_LINE_FORMAT, "category").alias("line")),
                F.struct((base + 3).alias("line_no"), F.format_string(VIEWS_LINE_FORMAT, "views").alias("line")),
                F.struct((base + 4).alias("line_no"), F.lit("").alias("line")),
            )
        ).alias("l")
    ).select(F.col("l.line_no").cast("int").alias("line_no"), F.col("l.line").alias("line"))
    return header.unionByName(body)
