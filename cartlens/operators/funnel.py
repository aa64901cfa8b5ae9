"""From cart to purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators.events import is_type, labelled, of_type
from cartlens.schema import CART, PURCHASE


def event_counts_by_user(events: DataFrame, event_type: str, name: str) -> DataFrame:
    return of_type(events, event_type).groupBy("user_id").agg(F.count("event_type").alias(name))


def cart_purchase_diff_by_user(events: DataFrame) -> DataFrame:
    """Carts minus purchases of each user with a cart event, in one scan and one shuffle.

    The difference may be negative. Carts without a user are one group from which no purchase is
    subtracted, as in a join, where null equals nothing.
    """
    matched = is_type(PURCHASE) & F.col("user_id").isNotNull()
    return (
        of_type(events, CART, PURCHASE)
        .groupBy("user_id")
        .agg(F.count_if(is_type(CART)).alias("carts"), F.count_if(matched).alias("purchases"))
        .where(F.col("carts") > 0)
        .select("user_id", (F.col("carts") - F.col("purchases")).alias("cart_purchase_count_diff"))
    )


def join_cart_and_purchase_counts(carts: DataFrame, purchases: DataFrame) -> DataFrame:
    """The same from two stored tables of counts: every cart user, purchases where there are any.

    Both sides hold one row per user, so no key of this join can be hot.
    """
    bought = F.coalesce(F.col("purchase_event_count"), F.lit(0))
    return carts.join(purchases, "user_id", "left").select(
        "user_id", (F.col("cart_event_count") - bought).alias("cart_purchase_count_diff")
    )


def avg_cart_purchase_diff(events: DataFrame, *, period: str | None = None) -> DataFrame:
    average = cart_purchase_diff_by_user(events).agg(
        F.avg("cart_purchase_count_diff").alias("avg_cart_purchase_count_diff")
    )
    return labelled(average, period)


def cart_conversion_rate(events: DataFrame) -> DataFrame:
    """Purchases per hundred carts: one row, null when there is no cart."""
    return (
        of_type(events, CART, PURCHASE)
        .agg(
            F.count_if(is_type(CART)).alias("add_to_cart_num"),
            F.count_if(is_type(PURCHASE)).alias("purchase_num"),
        )
        .withColumn("cart_conversion_rate", F.try_divide("purchase_num", "add_to_cart_num") * 100)
    )
