"""What was sold: revenue and units by category, brand and day.

Every grouping key here has far fewer values than the data has rows, so each map task sends at most one
partial row per key through the shuffle, also for a key that holds a third of all events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions import event_date, normalise_brand, normalise_category
from cartlens.operators.events import category_purchase_events, labelled, purchase_events
from cartlens.schema import ELECTRONICS


def _measure(name: str) -> Column:
    # Units count product ids: a purchase without one is no unit.
    return (F.sum("price") if name == "total_revenue" else F.count("product_id")).alias(name)


def _ranked(rows: DataFrame, key: Column, name: str, measure: str, period: str | None) -> DataFrame:
    """Measure per key, largest first, equal ones by name."""
    result = rows.groupBy(key.alias(name)).agg(_measure(measure))
    return labelled(result, period).orderBy(F.desc(measure), F.asc(name))


def category_revenue_rank(events: DataFrame, *, level: str = "full", period: str | None = None) -> DataFrame:
    category = normalise_category(F.col("category_code"), level)
    return _ranked(purchase_events(events), category, "rank_category_name", "total_revenue", period)


def brand_units_sold_rank(events: DataFrame, *, period: str | None = None) -> DataFrame:
    return _ranked(purchase_events(events), normalise_brand(F.col("brand")), "rank_brand_name", "units_sold", period)


def brand_revenue_rank(events: DataFrame, *, period: str | None = None) -> DataFrame:
    return _ranked(purchase_events(events), normalise_brand(F.col("brand")), "rank_brand_name", "total_revenue", period)


def category_brand_units_rank(
    events: DataFrame, *, category_prefix: str = ELECTRONICS, period: str | None = None
) -> DataFrame:
    """Units by brand within one category; brandless purchases do not take part, blank brands do."""
    rows = category_purchase_events(events, category_prefix)
    return _ranked(rows, normalise_brand(F.col("brand")), "rank_brand_name", "units_sold", period)


def daily_sales_metrics(events: DataFrame, *, period: str | None = None, with_total: bool = False) -> DataFrame:
    """Mean price and units per day. The mean keeps its published name, ``average_daily_revenue``.

    Purchases without a readable time belong to no day and are left out.
    """
    measures = [F.avg("price").alias("average_daily_revenue"), _measure("units_sold")]
    if with_total:
        measures.append(_measure("total_revenue"))
    daily = (
        purchase_events(events)
        .withColumn("event_date", event_date(events))
        .where(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(*measures)
    )
    return labelled(daily, period).orderBy("event_date")


def daily_average_price(events: DataFrame) -> DataFrame:
    dated = purchase_events(events).withColumn("event_date", event_date(events))
    return dated.groupBy("event_date").agg(F.avg("price").alias("average_daily_revenue"))


def daily_units_sold(events: DataFrame) -> DataFrame:
    dated = purchase_events(events).withColumn("event_date", event_date(events))
    return dated.groupBy("event_date").agg(_measure("units_sold"))


def join_daily_metrics(average_price: DataFrame, units_sold: DataFrame, *, period: str | None = None) -> DataFrame:
    """Both daily results side by side, for callers that hold them as two stored tables."""
    return labelled(average_price.join(units_sold, "event_date"), period).orderBy("event_date")
