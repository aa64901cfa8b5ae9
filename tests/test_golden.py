"""Every metric on fifteen events that hold each edge case once. Ranked results are compared in order."""

from __future__ import annotations

from datetime import date

import pytest
from samples import rows

from cartlens.functions import event_month
from cartlens.operators import brands, events, funnel, sales, visits
from cartlens.schema import BRAND_EVENT_COUNT_DDL, CART, PURCHASE, VIEW
from cartlens.sources.files import read_event_csv

BLANK, PADDED = "  ", "  Apple "


def test_revenue_by_full_category(golden):
    assert rows(sales.category_revenue_rank(golden)) == [
        ("electronics.smartphone", 160.0),
        ("without category", 70.0),
        ("appliances.kitchen", 20.0),
        ("Electronics.tablet", 10.0),
    ]


def test_revenue_by_top_category(golden):
    assert rows(sales.category_revenue_rank(golden, level="top")) == [
        ("electronics", 160.0),
        ("without category", 70.0),
        ("appliances", 20.0),
        ("Electronics", 10.0),
    ]


def test_unknown_category_level(golden):
    with pytest.raises(ValueError):
        sales.category_revenue_rank(golden, level="middle")


DAILY = [(date(2020, 4, 1), 100.0, 1), (date(2020, 4, 2), 30.0, 2), (date(2020, 4, 3), 10.0, 1)]


def test_daily_metrics_leave_out_unreadable_times(golden):
    assert rows(sales.daily_sales_metrics(golden)) == DAILY


def test_times_may_still_be_text(spark, raw_folder):
    text = read_event_csv(spark, f"{raw_folder}/2020-Apr.csv", parse_time=False)
    assert rows(sales.daily_sales_metrics(text)) == DAILY
    assert rows(visits.avg_hourly_product_views(text)) == [(0, 1.0), (1, 1.0), (5, 1.0)]
    assert sorted(rows(text.select(event_month(text)).distinct()), key=repr) == [("2020-04",), (None,)]
    with pytest.raises(TypeError):
        event_month(text, "price")


def test_daily_metrics_joined_from_two_results(golden):
    joined = sales.join_daily_metrics(sales.daily_average_price(golden), sales.daily_units_sold(golden))
    assert rows(joined) == DAILY


def test_daily_total_is_opt_in(golden):
    total = sales.daily_sales_metrics(golden, with_total=True)
    assert rows(total, "total_revenue") == [(100.0,), (90.0,), (10.0,)]


def test_units_and_revenue_by_brand(golden):
    assert rows(sales.brand_units_sold_rank(golden)) == [("SAMSUNG", 3), ("APPLE", 1), ("WITHOUT BRAND", 1)]
    assert rows(sales.brand_revenue_rank(golden)) == [("SAMSUNG", 170.0), ("WITHOUT BRAND", 60.0), ("APPLE", 30.0)]


def test_electronics_units(golden):
    assert rows(sales.category_brand_units_rank(golden)) == [("SAMSUNG", 3)]
    assert rows(sales.category_brand_units_rank(golden, category_prefix="APPLIANCES")) == []


def test_visits_per_user(golden):
    pairs = [(1, "s1"), (1, "s2"), (2, "s3"), (3, "s4"), (4, "s5")]
    assert sorted(rows(visits.distinct_user_sessions(golden))) == pairs
    assert rows(visits.avg_site_visits_per_user(golden, period="2020-Apr")) == [(1.25, "2020-Apr")]


def test_events_per_session(golden):
    assert rows(visits.avg_events_per_session(golden)) == [
        ("purchase", 1.2),
        ("cart", 1.0),
        ("remove_from_cart", 1.0),
        ("view", 1.0),
    ]


def test_untyped_events_average_zero(spark):
    log = [(None, "s1"), (None, "s1"), ("view", None)]
    untyped = spark.createDataFrame(log, "event_type STRING, user_session STRING")
    assert dict(rows(visits.avg_events_per_session(untyped))) == {None: 0.0, "view": 1.0}


def test_cart_purchase_difference(golden):
    expected = [(None, 1), (1, 1), (2, 0)]
    by_user = sorted(rows(funnel.cart_purchase_diff_by_user(golden)), key=repr)
    joined = funnel.join_cart_and_purchase_counts(
        funnel.event_counts_by_user(golden, CART, "cart_event_count"),
        funnel.event_counts_by_user(golden, PURCHASE, "purchase_event_count"),
    )
    assert sorted(by_user, key=repr) == sorted(rows(joined), key=repr) == sorted(expected, key=repr)
    assert rows(funnel.avg_cart_purchase_diff(golden)) == [(2 / 3,)]


def test_difference_may_be_negative(spark):
    log = spark.createDataFrame([(1, "cart"), (1, "purchase"), (1, "purchase")], "user_id BIGINT, event_type STRING")
    assert rows(funnel.cart_purchase_diff_by_user(log)) == [(1, -1)]


def test_global_average_of_nothing_is_one_null_row(golden):
    nothing = golden.where("event_type = 'none'")
    assert rows(funnel.avg_cart_purchase_diff(nothing)) == [(None,)]
    assert rows(visits.avg_site_visits_per_user(nothing)) == [(None,)]


def test_hourly_views(golden):
    assert rows(visits.avg_hourly_product_views(golden)) == [(0, 1.0), (1, 1.0), (5, 1.0)]


def test_popularity_in_one_pass(golden):
    assert rows(brands.brand_popularity(golden)) == [
        ("samsung", 2, 2, 3, 36),
        ("unknown_brand", 1, 1, 1, 13),
        (BLANK, 0, 0, 1, 10),
        (PADDED, 0, 0, 1, 10),
        ("apple", 1, 1, 0, 3),
    ]


def test_popularity_joined_from_three_counts(golden):
    counts = [brands.event_counts_by_brand(golden, kind) for kind in (VIEW, CART, PURCHASE)]
    joined = rows(brands.join_brand_counts(*counts))
    assert sorted(joined) == sorted(
        [
            ("samsung", 2, 2, 3, 36),
            (BLANK, 0, 0, 1, 10),
            (PADDED, 0, 0, 1, 10),
            ("unknown_brand", 0, 0, 1, 10),
            ("apple", 1, 1, 0, 3),
            ("unknown_brand", 0, 1, 0, 2),
            ("unknown_brand", 1, 0, 0, 1),
        ]
    )


def test_both_popularity_forms_have_equal_totals(golden):
    counts = [brands.event_counts_by_brand(golden, kind) for kind in (VIEW, CART, PURCHASE)]
    one_pass = brands.total_popularity(brands.brand_popularity(golden))
    assert rows(one_pass) == rows(brands.total_popularity(brands.join_brand_counts(*counts)))


def test_published_popularity_names_its_period_twice(golden):
    result = brands.brand_popularity(golden, period="2020-Apr")
    assert result.columns[-2:] == ["batch_processing", "data_period"]


def test_normalised_brands_are_opt_in(golden):
    assert ("APPLE", 1, 1, 1, 13) in rows(brands.brand_popularity(golden, normalise=True))
    assert ("APPLE", 1) in rows(brands.views_by_brand(golden, normalise=True))


COUNTS = [
    (BLANK, "purchase", 1),
    (PADDED, "purchase", 1),
    ("apple", "cart", 1),
    ("apple", "view", 1),
    ("samsung", "cart", 2),
    ("samsung", "purchase", 3),
    ("samsung", "remove_from_cart", 1),
    ("samsung", "view", 2),
]


def test_counts_and_points(golden):
    counts = brands.brand_event_count(golden)
    assert sorted(rows(counts)) == COUNTS
    assert sorted(rows(brands.brand_points(counts))) == [(BLANK, 10), (PADDED, 10), ("apple", 4), ("samsung", 38)]


def test_points_of_an_unweighted_type_are_zero(spark):
    counts = spark.createDataFrame([("x", "wish", 5), ("x", None, 5)], BRAND_EVENT_COUNT_DDL)
    assert rows(brands.brand_points(counts)) == [("x", 0)]


def test_merged_counts_add_up(golden):
    counts = brands.brand_event_count(golden)
    merged = brands.merge_brand_event_counts(counts, counts)
    assert sorted(rows(merged)) == [(b, t, 2 * n) for b, t, n in COUNTS]


def test_views_by_brand(golden):
    assert rows(brands.views_by_brand(golden)) == [("samsung", 2), (None, 1), ("apple", 1)]


def test_conversion_rate(golden):
    assert rows(funnel.cart_conversion_rate(golden)) == [(4, 6, 150.0)]
    assert rows(funnel.cart_conversion_rate(golden.where("event_type <> 'cart'"))) == [(0, 6, None)]


def test_selected_events(golden):
    assert events.purchase_events(golden).count() == 6
    assert events.cart_events(golden).count() == 4
    assert events.view_events(golden).count() == 4
    assert events.electronics_purchase_events(golden).count() == 3


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_days_and_hours_do_not_depend_on_the_session_zone(spark, golden, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows(sales.daily_sales_metrics(golden)) == DAILY
        assert rows(visits.avg_hourly_product_views(golden)) == [(0, 1.0), (1, 1.0), (5, 1.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
