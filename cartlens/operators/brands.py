"""Event counts by brand and the two weighted brand scores. Brands are taken as written unless asked."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions import (
    INDEX_WEIGHTS,
    POINT_WEIGHTS,
    normalise_brand,
    weighted_counts,
    weighted_type,
)
from cartlens.functions.cleaning import UNKNOWN_BRAND
from cartlens.operators.events import is_type, labelled, of_type
from cartlens.schema import VIEW

INDEX = "long_term_brand_popularity_index"
TOTAL_INDEX = "total_long_term_brand_popularity_index"


def _brand(normalise: bool) -> Column:
    return normalise_brand(F.col("brand")).alias("brand") if normalise else F.col("brand")


def _count_name(event_type: str) -> str:
    return f"{event_type}_events_count"


def brand_event_count(
    events: DataFrame, *, period_column: str | None = None, normalise: bool = False
) -> DataFrame:
    """Events per brand and type (and period), for events that name a brand."""
    keys = [_brand(normalise), "event_type", *([period_column] if period_column else [])]
    return events.where(F.col("brand").isNotNull()).groupBy(*keys).agg(F.count("*").alias("event_count"))


def merge_brand_event_counts(*counts: DataFrame) -> DataFrame:
    """Running counts: all given counts added up by brand and type."""
    every = reduce(DataFrame.unionByName, (c.select("brand", "event_type", "event_count") for c in counts))
    return every.groupBy("brand", "event_type").agg(F.sum(F.col("event_count").cast("long")).alias("event_count"))


def brand_points(counts: DataFrame, weights: Mapping[str, int] = POINT_WEIGHTS) -> DataFrame:
    """Points per brand from counts by brand and type."""
    points = F.col("event_count") * weighted_type(F.col("event_type"), weights)
    return counts.groupBy("brand").agg(F.sum(points).alias("total_points"))


def views_by_brand(events: DataFrame, *, normalise: bool = False) -> DataFrame:
    """Views per brand, most viewed first; views without a brand are one group."""
    counts = of_type(events, VIEW).groupBy(_brand(normalise)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("brand"))


def event_counts_by_brand(events: DataFrame, event_type: str) -> DataFrame:
    return of_type(events, event_type).groupBy("brand").agg(F.count("event_type").alias(_count_name(event_type)))


def _scored(counts: DataFrame, keys: list[str], weights: Mapping[str, int]) -> DataFrame:
    by_type = {kind: F.col(_count_name(kind)) for kind in weights}
    return counts.select(*keys, *by_type.values(), weighted_counts(by_type, weights).cast("long").alias(INDEX))


def _published(scored: DataFrame, period: str | None) -> DataFrame:
    both = labelled(labelled(scored, period), period, "data_period")
    return both.orderBy(F.desc(INDEX), F.asc("brand"))


def brand_popularity(
    events: DataFrame,
    *,
    period: str | None = None,
    period_column: str | None = None,
    weights: Mapping[str, int] = INDEX_WEIGHTS,
    normalise: bool = False,
) -> DataFrame:
    """Popularity index per brand: weighted views, carts and purchases, counted in one pass.

    With ``period_column`` all periods are scored together, one row per period and brand. Brands with
    events of other types only do not appear.
    """
    keys = ["brand"] if period_column is None else [period_column, "brand"]
    brand = F.coalesce(_brand(normalise), F.lit(UNKNOWN_BRAND)).alias("brand")
    counts = (
        of_type(events, *weights)
        .groupBy(*(brand if key == "brand" else key for key in keys))
        .agg(*(F.count_if(is_type(kind)).alias(_count_name(kind)) for kind in weights))
    )
    return _published(_scored(counts, keys, weights), period)


def join_brand_counts(
    views: DataFrame,
    carts: DataFrame,
    purchases: DataFrame,
    *,
    period: str | None = None,
    weights: Mapping[str, int] = INDEX_WEIGHTS,
) -> DataFrame:
    """The index from three stored tables of counts by brand.

    Events without a brand meet in no join, so each table adds an ``unknown_brand`` row of its own.
    """
    joined = views.join(carts, "brand", "full").join(purchases, "brand", "full")
    counts = joined.select(
        F.coalesce("brand", F.lit(UNKNOWN_BRAND)).alias("brand"),
        *(F.coalesce(_count_name(kind), F.lit(0)).alias(_count_name(kind)) for kind in weights),
    )
    return _published(_scored(counts, ["brand"], weights), period)


def total_popularity(*scores: DataFrame) -> DataFrame:
    """Index per brand over all given periods, largest first."""
    every = reduce(DataFrame.unionByName, (s.select("brand", INDEX) for s in scores))
    total = every.groupBy("brand").agg(F.sum(F.col(INDEX).cast("long")).alias(TOTAL_INDEX))
    return total.orderBy(F.desc(TOTAL_INDEX), F.asc("brand"))


def combined_popularity(total: DataFrame, live_points: DataFrame, *, fold_case: bool = False) -> DataFrame:
    """Batch total plus live points per brand, both given as (brand, total index).

    Live brands are upper case and batch brands as written; with ``fold_case`` they meet in upper case.
    """
    rows = total.unionByName(live_points)
    if fold_case:
        rows = rows.withColumn("brand", F.upper("brand"))
    return total_popularity(rows.withColumnRenamed(TOTAL_INDEX, INDEX))
