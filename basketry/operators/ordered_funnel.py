"""The funnel in its order: view, then cart, then purchase of one product by one user.

The conversion report counts the three types side by side. Here a view is
followed up: did this user put this product into the cart afterwards, and then buy it, all within
a horizon of the view?

Native window functions, without a list of a user's events. The order is made within (user, product, slice
of time) with slices as long as the horizon: what follows a view lies in its slice or the next, so carts and
purchases are also given to the slice before their own. A user with a third of all events (a bot, a shared
terminal) is spread over the slices, and every view is counted once, in its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.rates import safe_rate
from basketry.operators.vocab import ADD_TO_CART, FUNNEL_TYPES, PURCHASE, VIEW
from basketry.operators.windows import window_micros


def follow_views(events: DataFrame, horizon: str = "1 day", time_col: str = "timestamp") -> DataFrame:
    """``user_id, product_id, category, viewed_at, carted_at, purchased_at`` for every view.

    ``carted_at`` is the user's first cart event of the product after the view and ``purchased_at`` the first
    purchase after that, both null if not within ``horizon`` of the view (its end included). Steps need strictly
    later times, so equal times don't follow each other. Rows without user, product or time are left out;
    repeated views are counted each."""
    length = window_micros(horizon)
    rows = events.filter(
        F.col("event_type").isin(*FUNNEL_TYPES) & F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & F.col(time_col).isNotNull()
    ).select("user_id", "product_id", "category", "event_type", F.unix_micros(time_col).alias("at"))
    own = F.floor(F.col("at") / length).cast("long")
    slices = F.when(F.col("event_type") == VIEW, F.array(own)).otherwise(F.array(own - 1, own))
    rows = rows.withColumn("slice", F.explode(slices))
    later = Window.partitionBy("user_id", "product_id", "slice").orderBy("at").rangeBetween(1, length)
    bought = F.min(F.when(F.col("event_type") == PURCHASE, F.col("at"))).over(later)
    # A cart event with the first purchase after it; of carts of one instant any, they have the same one.
    rows = rows.withColumn("cart", F.when(F.col("event_type") == ADD_TO_CART, F.struct("at", bought.alias("bought"))))
    rows = rows.withColumn("next", F.min("cart").over(later)).filter(F.col("event_type") == VIEW)
    within = F.when(F.col("next.bought") <= F.col("at") + length, F.col("next.bought"))
    return rows.select(
        "user_id",
        "product_id",
        "category",
        F.timestamp_micros("at").alias("viewed_at"),
        F.timestamp_micros("next.at").alias("carted_at"),
        F.timestamp_micros(within).alias("purchased_at"),
    )


def ordered_funnel(events: DataFrame, horizon: str = "1 day", keys: tuple[str, ...] = ("category",), time_col: str = "timestamp") -> DataFrame:
    """Views by ``keys`` and how many of them led on: ``views, carted, purchased, cart_rate, purchase_rate``."""
    followed = follow_views(events, horizon, time_col)
    counts = followed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("views"), F.count("carted_at").alias("carted"), F.count("purchased_at").alias("purchased")
    )
    return counts.withColumn("cart_rate", safe_rate("carted", "views", 4)).withColumn("purchase_rate", safe_rate("purchased", "views", 4))
