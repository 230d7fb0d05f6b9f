"""Hot products from bounded state: a sketch a window, then exact counts.

:func:`basketry.operators.windows.product_alerts` keeps a counter for every
(window, product, category). Here a window keeps one mergeable heavy-hitter
sketch (Spark's ``approx_top_k_accumulate``, a frequent-items sketch of fixed
size) and its number of events, however many products there are. A second
pass counts the sketch's candidates exactly in the raw dataset.

Nothing is lost: a sketch knows by how much its counts may fall short, and
lists every item with more than twice that many events. A window whose
threshold isn't above that bound, or for which raw holds other rows than the sketch
has seen (late ones), is counted whole instead. So the result is that of
``product_alerts`` over raw, whatever the size of the sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import written

#: Items that a sketch tracks by default; its state is at most some hundred bytes an item.
TRACKED = 1024
#: Estimated bytes of candidates that are broadcast at a time, and of one candidate.
CANDIDATE_BYTES, CANDIDATE_WIDTH = 32 << 20, 160


def product_key(product: str = "product_id", category: str = "category") -> Column:
    """One text for a (product, category), nulls included."""
    return F.to_json(F.struct(F.col(product).alias("p"), F.col(category).alias("c")))


def _key_columns(key: str) -> list[Column]:
    fields = F.from_json(F.col(key), "p string, c string")
    return [fields["p"].alias("product_id"), fields["c"].alias("category")]


def product_sketches(events: DataFrame, window: str = "5 minutes", tracked: int = TRACKED, time_col: str = "timestamp") -> DataFrame:
    """``window_start, window_end, total_events, sketch`` (streamable: one sketch a window is the whole state)."""
    agg = events.groupBy(F.window(F.col(time_col), window).alias("window")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.call_function("approx_top_k_accumulate", product_key(), F.lit(tracked)).alias("sketch"),
    )
    return agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total_events", "sketch")


def merge_sketches(sketches: DataFrame, *keys: Column, tracked: int = TRACKED) -> DataFrame:
    """Sketches and totals of windows merged by ``keys`` (such as a day): a roll-up without the events."""
    return sketches.groupBy(*keys).agg(
        F.sum("total_events").alias("total_events"),
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked)).alias("sketch"),
    )


def shortfall(sketch: str = "sketch") -> Column:
    """By how much a sketch's counts may fall short of the true ones.

    The eight bytes from the 25th on of the public frequent-items format, the
    least significant first; a sketch of no items is shorter and exact."""
    data = F.col(f"{sketch}.sketch")
    pairs = [F.substring(F.hex(data), 49 + 2 * i, 2) for i in reversed(range(8))]
    return F.when(F.octet_length(data) >= 32, F.conv(F.concat(*pairs), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))


def candidates(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``key, estimate`` of every item that a sketch lists, with the sketch's other columns."""
    listed = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(tracked))
    rows = sketches.select(*[c for c in sketches.columns if c != "sketch"], F.explode(listed).alias("found"))
    return rows.select("*", F.col("found.item").alias("key"), F.col("found.count").alias("estimate")).drop("found")


def hot_products(sketches: DataFrame, raw: DataFrame, window: str, threshold: int, tracked: int = TRACKED,
                 time_col: str = "timestamp", date_col: str | None = None) -> DataFrame:
    """``window_start, window_end, product_id, category, event_count`` of all groups with more than ``threshold`` events in raw.

    ``sketches`` are written windows (:func:`product_sketches`); only their windows are reported. ``raw`` is read
    for window totals (its time column alone) and for the candidates, and again, whole, only for windows that need it.
    With ``date_col``, raw's day partition, only days that have such windows are opened."""
    own_window = F.window(F.col(time_col), window)
    held = raw.filter(F.col(time_col).isNotNull()).withColumn("window_start", own_window["start"])
    totals = held.groupBy("window_start").agg(F.count(F.lit(1)).alias("raw_events"))
    judged = sketches.join(totals, "window_start").withColumn(
        "sure", (F.col("raw_events") == F.col("total_events")) & (F.lit(threshold) >= 2 * shortfall())
    )
    judged = written(judged, "hot-windows")
    sure = judged.filter("sure").select("window_start", "window_end", "sketch")
    unsure = judged.filter(~F.col("sure")).select("window_start", "window_end")

    def counted(wanted: DataFrame, on: list[str]) -> DataFrame:
        rows = held.withColumn("key", product_key())
        if date_col:
            days = wanted.select(F.explode(F.sequence(F.to_date("window_start"), F.to_date("window_end"))).alias(date_col)).distinct()
            rows = rows.join(F.broadcast(days), date_col, "left_semi")
        found = rows.join(wanted, on).groupBy("window_start", "window_end", "key").agg(F.count(F.lit(1)).alias("event_count"))
        return found.filter(F.col("event_count") > threshold)

    # The estimate never falls short by more than the shortfall: what can't pass needs no second look.
    listed = candidates(sure.withColumn("short", shortfall()), tracked).filter(F.col("estimate") + F.col("short") > threshold)
    listed = written(listed.select("window_start", "window_end", "key"), "hot-candidates")
    parts = [counted(_small(listed, CANDIDATE_WIDTH), ["window_start", "key"]), counted(_small(unsure, 32), ["window_start"])]
    return parts[0].unionByName(parts[1]).select("window_start", "window_end", *_key_columns("key"), "event_count")


def _small(df: DataFrame, width: int) -> DataFrame:
    """``df`` for broadcast if its counted rows are few enough; else the join shuffles, and AQE splits hot keys."""
    return F.broadcast(df) if df.count() * width <= CANDIDATE_BYTES else df
