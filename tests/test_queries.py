"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
)
LLM = contract.llm_queries()  # tested in tests/llm
QUERIES = {name: query for name, query in contract.queries().items() if name not in LLM}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name not in LLM}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def by_name(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_each_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    assert by_name(frame.columns, frame.collect()) == by_name(expected.columns, expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


WRITING = {
    "csv_roundtrip", "csv_dropmalformed", "parquet_roundtrip", "convert_format", "recursive_scan", "staged_events",
    "catalog_table_scan", "managed_text_table", "partitioned_by_category", "append_roundtrip", "overwrite_roundtrip",
    "replace_period_roundtrip", "brand_event_count_merge", "brand_popularity_total", "catalogue_csv_scan",
    "stream_archive", "incremental_since",
    "stream_brand_points", "stream_brand_points_by_position", "staged_rerun", "replace_period_empty", "brand_points_published",
    "published_once", "csv_rejects", "points_ledger", "live_total_folded", "stream_match_stateless", "archive_compacted",
    "incremental_by_maximum", "daily_metrics_join", "cart_purchase_diff_join", "brand_popularity_full_join",
}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - WRITING))
def test_plan_has_no_python_cross_join_or_single_task(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for unwanted in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD", "Window"):
        assert unwanted not in plan
    # A single partition only ever receives the one-row partial results of a global aggregate.
    singles = plan.count("Exchange SinglePartition")
    assert singles == (1 if name in GLOBAL else 0)


GLOBAL = {"avg_site_visits_per_user", "avg_cart_purchase_diff", "cart_conversion_rate", "sale_visits_per_user"}

ONE_SCAN = [
    "category_revenue_rank", "daily_sales_metrics", "brand_units_sold_rank", "brand_revenue_rank",
    "avg_site_visits_per_user", "avg_events_per_session", "avg_cart_purchase_diff", "avg_hourly_product_views",
    "electronics_brand_units_rank", "brand_popularity_monthly", "brand_event_count", "brand_points", "views_by_brand",
    "cart_conversion_rate",
]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_metric_reads_events_once_and_sorts_at_most_once(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert plan.count("events.parquet") == 1
    assert plan.count("rangepartitioning") <= 1


@pytest.mark.parametrize(
    "name",
    [
        "category_revenue_rank",
        "brand_units_sold_rank",
        "views_by_brand",
        "cart_purchase_diff_by_user",
        "hourly_product_views",
    ],
)
def test_event_types_are_selected_by_the_reader(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    scan = plan[plan.index("events.parquet"):]
    assert "event_type" in scan[scan.index("PushedFilters"):scan.index("ReadSchema")]


@pytest.mark.parametrize(
    "name",
    [
        "cart_conversion_rate", "event_count_by_session", "avg_events_per_session", "event_counts_by_user",
        "cart_purchase_diff_by_user", "avg_cart_purchase_diff", "avg_site_visits_per_user",
    ],
)
def test_parts_are_joined_only_when_asked_for(spark, name):
    assert "part.parquet" not in plan_of(QUERIES[name](spark, FOLDER))


def test_top_of_a_rank_is_not_sorted_whole(spark):
    plan = plan_of(QUERIES["views_by_brand_top20"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_metric_reads_only_its_columns(spark):
    plan = plan_of(QUERIES["sale_brand_revenue_rank"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in plan
    assert "orders.parquet" not in plan
    assert "part.parquet" not in plan_of(QUERIES["sale_visits_per_user"](spark, FOLDER))


def test_large_catalogue_plan_broadcasts_only_what_is_bounded(spark):
    small = plan_of(QUERIES["comment_brand_match_by_position"](spark, FOLDER))
    large = plan_of(QUERIES["comment_brand_match_salted"](spark, FOLDER))
    assert "salt" not in small and "salt" in large
    assert plan_of(QUERIES["comment_brand_match"](spark, FOLDER)).count("Exchange hashpartitioning") == 0
