"""Shop events, comments and a label catalogue derived from order-management tables.

Two sources of shop events: ``click_events`` (an event log whose ``props`` name a part) and ``sale_events``
(one purchase per order line).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.schema import CART

# Each column of a click event, by the table it needs: the event log alone, or the part that it names too.
_CLICK_EVENT = {
    "event_id": ("events", "event_id"),
    "event_time": ("events", "ts"),
    "event_type": ("events", "CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END"),
    "product_id": ("part", "CASE WHEN event_id % 97 <> 0 THEN p_partkey END"),
    "category_id": ("part", "CAST(p_size AS BIGINT)"),
    "category_code": (
        "part",
        """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '  '
           ELSE concat(CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'electronics' ELSE lower(p_type) END,
                       '.', replace(p_name, ' ', '.')) END""",
    ),
    "brand": (
        "part",
        """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '  '
           WHEN event_id % 5 = 0 THEN concat(' ', lower(p_brand), ' ') ELSE p_brand END""",
    ),
    "price": ("events", "value"),
    "user_id": ("events", "CASE WHEN event_id % 101 <> 0 THEN user_id END"),
    "user_session": ("events", "CASE WHEN event_id % 103 <> 0 THEN concat('s', user_id, '-', to_date(ts)) END"),
}
_COMMENT = (
    "concat('p', event_id % 50) AS post_id",
    "concat('c', event_id) AS comment_id",
    "CASE WHEN event_id % 19 <> 0 THEN concat('u', user_id) END AS author",
    """CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 6 = 0 THEN ''
       WHEN event_id % 4 = 0 THEN concat('Nothing about ', event_type)
       WHEN event_id % 5 = 0 THEN concat('any ', split_part(p_name, ' ', 2), ' will do ')
       ELSE concat('  My ', p_name, ' is a ', event_type) END AS text""",
    "1704067200 + event_id AS created_utc",
)
# Each column of a sale, by the table it needs beside the order lines.
_SALE = {
    "lineitem": {
        "event_type": "'purchase'",
        "product_id": "l_partkey",
        "price": "l_extendedprice",
        "user_session": "CAST(l_orderkey AS STRING)",
    },
    "part": {"category_code": "concat(lower(p_type), '.', replace(p_name, ' ', '.'))", "brand": "p_brand"},
    "orders": {"event_time": "o_orderdate", "user_id": "o_custkey"},
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _logged(spark: SparkSession, folder: str, *types: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.where(F.col("event_type").isin(*types)) if types else events


def _with_parts(events: DataFrame, folder: str) -> DataFrame:
    """Each logged event beside the part it names.

    The join carries no hint: Spark broadcasts parts while they are small by its own estimate, else it
    shuffles, and AQE splits a part that a large share of the events name.
    """
    events = events.selectExpr("*", "try_cast(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS part_key")
    return events.join(table(events.sparkSession, folder, "part"), F.expr("part_key = p_partkey"), "left")


def click_events(
    spark: SparkSession, folder: str, *types: str, columns: Sequence[str] = tuple(_CLICK_EVENT)
) -> DataFrame:
    """Shop events with null, blank, padded and lower-case fields spread over them by ``event_id``.

    Clicks stand in for carts. Named types are selected under their logged names, so that the Parquet
    reader can skip the others; a filter on the derived type would not reach it. Parts are joined only when
    a named column comes from them; their keys are unique and the join is outer, so rows stay the same.
    """
    logged = [name for kind in types for name in ((kind, "click") if kind == CART else (kind,))]
    events = _logged(spark, folder, *logged)
    if any(_CLICK_EVENT[name][0] == "part" for name in columns):
        events = _with_parts(events, folder)
    return events.selectExpr(*(f"{_CLICK_EVENT[name][1]} AS {name}" for name in columns))


def sale_events(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Every order line as a purchase, with the named columns of a shop event.

    Parts and orders are each joined only when a named column comes from them. Their keys are unique and
    the joins are outer, so lines are neither lost nor repeated and leaving a join out changes nothing else.
    """
    sales = table(spark, folder, "lineitem")
    if not _SALE["part"].keys().isdisjoint(columns):
        sales = sales.join(table(spark, folder, "part"), F.expr("l_partkey = p_partkey"), "left")
    if not _SALE["orders"].keys().isdisjoint(columns):
        sales = sales.join(table(spark, folder, "orders"), F.expr("l_orderkey = o_orderkey"), "left")
    texts = {name: text for group in _SALE.values() for name, text in group.items()}
    return sales.selectExpr(*(f"{texts[name]} AS {name}" for name in columns))


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Comments that name the part of their event, or only its last word, or nothing."""
    return _with_parts(_logged(spark, folder), folder).selectExpr(*_COMMENT)


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Part names as labels, their last words as shorter labels, one that cleans to nothing, one null."""
    named = table(spark, folder, "part").selectExpr(
        "explode(array(p_name, split_part(p_name, ' ', 2))) AS item_label", "p_brand AS brand"
    )
    odd = spark.sql("SELECT * FROM VALUES ('--', 'Brand#0'), (NULL, 'Brand#0') AS odd (item_label, brand)")
    return named.groupBy("item_label").agg(F.min("brand").alias("brand")).unionByName(odd)


def messages(comments: DataFrame) -> DataFrame:
    """Comments as the JSON messages a producer sends."""
    return comments.select(F.to_json(F.struct(*comments.columns)).alias("value"))


def listing_pages(comments: DataFrame) -> DataFrame:
    """One JSON page per comment: its post, then the comment, a stub for more, and a reply to it."""

    def child(kind: str, item: Column, body: Column, later: int = 0) -> Column:
        made = (F.col("created_utc") + later).cast("double")
        data = F.struct(item.alias("id"), F.col("author"), body.alias("body"), made.alias("created_utc"))
        return F.struct(F.lit(kind).alias("kind"), data.alias("data"))

    def listing(*children: Column) -> Column:
        return F.struct(F.lit("Listing").alias("kind"), F.struct(F.array(*children).alias("children")).alias("data"))

    nothing = F.lit(None).cast("string")
    reply = F.concat(F.lit("r"), F.col("comment_id"))
    page = F.array(
        listing(child("t3", F.col("post_id"), nothing)),
        listing(
            child("t1", F.col("comment_id"), F.col("text")),
            child("more", F.lit("_"), nothing),
            child("t1", reply, F.lit("I agree"), later=1),
        ),
    )
    return comments.select("post_id", F.to_json(page).alias("page"))
