"""All published tables of a period from one scan of its events.

Each event is expanded to the groups it counts in, tagged by what the groups are, and one aggregation adds up all of
them. Partial sums are made in the tasks that scan, so a tag with few groups (days, hours, brands, categories) sends a
row per group and task only, and a hot user, session or missing brand no more than that. The sums are stored, filed by
tag; each table is then finished from the tag it needs, without the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions import INDEX_WEIGHTS, event_date, event_hour, normalise_brand, normalise_category, weighted_type
from cartlens.functions.cleaning import UNKNOWN_BRAND
from cartlens.operators.brands import INDEX
from cartlens.operators.events import is_type, labelled
from cartlens.schema import CART, ELECTRONICS, PURCHASE, VIEW
from cartlens.session import shared_folder
from cartlens.sinks.files import write_files

# What the groups of each tag are, and the fields that name a group.
CATEGORY, DAY, BRAND, SECTION, SESSION, HOUR, SCORED = "category", "day", "brand", "section", "session", "hour", "scored"
_FIELDS = {
    "tag": "string",
    "name": "string",
    "event_date": "date",
    "event_hour": "int",
    "event_type": "string",
    "user_id": "bigint",
    "user_session": "string",
}


def _group(tag: str, when: Column | None = None, **fields: Column) -> Column:
    """The group of one tag, or null for events that are in none of it."""
    given = {"tag": F.lit(tag), **fields}
    group = F.struct(*(given.get(k, F.lit(None)).cast(kind).alias(k) for k, kind in _FIELDS.items()))
    return group if when is None else F.when(when, group)


def sums_by_group(events: DataFrame, *, category_prefix: str = ELECTRONICS) -> DataFrame:
    """``n`` events, ``units`` sold or viewed, ``priced`` events and ``revenue`` of each group of each tag."""
    bought = is_type(PURCHASE)
    brand, category = F.col("brand"), F.col("category_code")
    in_section = brand.isNotNull() & F.startswith(F.lower(category), F.lit(category_prefix.lower()))
    day, hour = event_date(events), event_hour(events)
    groups = F.array(
        _group(CATEGORY, bought, name=normalise_category(category, "full")),
        _group(DAY, bought & day.isNotNull(), event_date=day),
        _group(BRAND, bought, name=normalise_brand(brand)),
        _group(SECTION, bought & in_section, name=normalise_brand(brand)),
        _group(HOUR, is_type(VIEW), event_date=day, event_hour=hour),
        _group(
            SCORED,
            F.col("event_type").isin(*INDEX_WEIGHTS),
            name=F.coalesce(brand, F.lit(UNKNOWN_BRAND)),
            event_type=F.col("event_type"),
        ),
        _group(
            SESSION, event_type=F.col("event_type"), user_id=F.col("user_id"), user_session=F.col("user_session")
        ),
    )
    of_groups = events.select("product_id", "price", F.explode(groups).alias("group")).where("group IS NOT NULL")
    return (
        of_groups.select("group.*", "product_id", "price")
        .groupBy(*_FIELDS)
        .agg(
            F.count("*").alias("n"),
            F.count("product_id").alias("units"),
            F.count("price").alias("priced"),
            F.sum("price").alias("revenue"),
        )
    )


def store_sums(events: DataFrame, *, category_prefix: str = ELECTRONICS) -> DataFrame:
    """The sums, stored in the shared folder by tag and read from there."""
    path = shared_folder(events.sparkSession)
    sums = sums_by_group(events, category_prefix=category_prefix)
    write_files(sums, path, partition_by=["tag"])
    return events.sparkSession.read.schema(sums.schema).parquet(path)


def _measured(rows: DataFrame, name: str, measure: str, value: str) -> DataFrame:
    return rows.select(F.col("name").alias(name), F.col(value).alias(measure))


def _daily(rows: DataFrame) -> DataFrame:
    mean = F.try_divide("revenue", "priced").alias("average_daily_revenue")
    return rows.select("event_date", mean, F.col("units").alias("units_sold"))


def _visits(rows: DataFrame) -> DataFrame:
    known = rows.where("user_id IS NOT NULL AND user_session IS NOT NULL")
    by_user = known.select("user_id", "user_session").distinct().groupBy("user_id").agg(F.count("*").alias("visits"))
    return by_user.agg(F.avg("visits").alias("avg_site_visits_per_user"))


def _events_per_session(rows: DataFrame) -> DataFrame:
    # A group of untyped events counts none.
    counted = F.sum(F.when(F.col("event_type").isNotNull(), F.col("n")).otherwise(0))
    by_session = rows.groupBy("event_type", "user_session").agg(counted.alias("n"))
    return by_session.groupBy("event_type").agg(F.avg("n").alias("avg_events_per_session"))


def _cart_purchase_diff(rows: DataFrame) -> DataFrame:
    carts = F.sum(F.when(is_type(CART), F.col("n")).otherwise(0))
    bought = F.sum(F.when(is_type(PURCHASE) & F.col("user_id").isNotNull(), F.col("n")).otherwise(0))
    by_user = rows.where(F.col("event_type").isin(CART, PURCHASE)).groupBy("user_id")
    diff = by_user.agg(carts.alias("carts"), bought.alias("purchases")).where("carts > 0")
    return diff.agg(F.avg(F.col("carts") - F.col("purchases")).alias("avg_cart_purchase_count_diff"))


def _hourly_views(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_hour").agg(F.avg("units").alias("avg_hourly_product_views"))


def _popularity(rows: DataFrame) -> DataFrame:
    counts = (F.coalesce(F.sum(F.when(is_type(k), F.col("n"))), F.lit(0)).alias(f"{k}_events_count") for k in INDEX_WEIGHTS)
    score = F.sum(F.col("n") * weighted_type(F.col("event_type"), INDEX_WEIGHTS)).cast("long")
    return rows.groupBy(F.col("name").alias("brand")).agg(*counts, score.alias(INDEX))


def tables_of(sums: DataFrame, period: str | None = None) -> dict[str, DataFrame]:
    """Each published table by its name, from the stored sums of one period."""

    def tag(name: str) -> DataFrame:
        return sums.where(F.col("tag") == name).drop("tag")

    def ranked(rows: DataFrame) -> DataFrame:
        """By the measure, the last column, largest first; equal ones by name."""
        first, last = rows.columns[0], rows.columns[-1]
        return labelled(rows, period).orderBy(F.desc(last), F.asc(first))

    units = ("rank_brand_name", "units_sold", "units")
    return {
        "category_revenue_rank": ranked(_measured(tag(CATEGORY), "rank_category_name", "total_revenue", "revenue")),
        "daily_revenue_and_units_sold_02": labelled(_daily(tag(DAY)), period).orderBy("event_date"),
        "brand_units_sold_rank": ranked(_measured(tag(BRAND), *units)),
        "brand_revenue_rank": ranked(_measured(tag(BRAND), "rank_brand_name", "total_revenue", "revenue")),
        "avg_site_visits_per_user": labelled(_visits(tag(SESSION)), period),
        "avg_events_per_session_by_event_type": ranked(_events_per_session(tag(SESSION))),
        "avg_cart_purchase_count_diff": labelled(_cart_purchase_diff(tag(SESSION)), period),
        "avg_hourly_product_views_08": labelled(_hourly_views(tag(HOUR)), period).orderBy("event_hour"),
        "electronics_brand_units_sold_rank_09": ranked(_measured(tag(SECTION), *units)),
        "long_term_brand_popularity_index_10": labelled(ranked(_popularity(tag(SCORED))), period, "data_period"),
    }
