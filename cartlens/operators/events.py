"""Selections of events that the metrics start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions import event_date, event_hour
from cartlens.schema import CART, ELECTRONICS, PURCHASE, VIEW


def of_type(events: DataFrame, *types: str) -> DataFrame:
    """Events of the given types: one comparison or one IN, both of which reach the Parquet reader."""
    kind = F.col("event_type")
    return events.where(kind == types[0] if len(types) == 1 else kind.isin(*types))


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def purchase_events(events: DataFrame) -> DataFrame:
    return of_type(events, PURCHASE)


def cart_events(events: DataFrame) -> DataFrame:
    return of_type(events, CART).select("event_time", "event_type", "product_id", "brand", "user_id")


def view_events(events: DataFrame) -> DataFrame:
    return of_type(events, VIEW).select(
        event_date(events).alias("event_date"),
        event_hour(events).alias("event_hour"),
        "event_type",
        "product_id",
        "user_id",
    )


def category_purchase_events(events: DataFrame, category_prefix: str) -> DataFrame:
    """Purchases with a brand whose category code starts with the prefix, in any case."""
    return purchase_events(events).where(
        F.col("brand").isNotNull()
        & F.col("category_code").isNotNull()
        & F.startswith(F.lower("category_code"), F.lit(category_prefix.lower()))
    )


def electronics_purchase_events(events: DataFrame) -> DataFrame:
    return category_purchase_events(events, ELECTRONICS)


def labelled(result: DataFrame, period: str | None, column: str = "batch_processing") -> DataFrame:
    """Add the period a result was computed for, when one is given."""
    return result if period is None else result.withColumn(column, F.lit(period))
