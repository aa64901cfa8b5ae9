"""One key holds a third of all rows or more: results stay whole, and its rows are not left to one task."""

from __future__ import annotations

import pytest
from samples import rows
from pyspark.sql import functions as F

from cartlens.operators import brands, funnel, visits
from cartlens.operators.labels import match_labels, normalise_catalogue, prepare_matcher
from cartlens.plans import views
from cartlens.sources import tables

N = 30_000


@pytest.fixture(scope="module")
def hot_events(spark):
    """A third of the events: one user, one session, no brand."""
    hot = F.col("id") % 3 == 0
    return spark.range(N, numPartitions=8).select(
        F.expr("CASE WHEN id % 2 = 0 THEN 'view' WHEN id % 5 = 0 THEN 'purchase' ELSE 'cart' END").alias("event_type"),
        F.when(~hot, F.concat(F.lit("b"), F.col("id") % 100)).alias("brand"),
        F.when(hot, F.lit(-1)).otherwise(F.col("id")).alias("user_id"),
        F.when(hot, "s").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("user_session"),
    )


@pytest.fixture
def settings(spark):
    """Thresholds at which test data counts as skewed."""
    wanted = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_counted_whole(hot_events):
    by_user = dict(rows(visits.site_visits_by_user(hot_events)))
    assert by_user[-1] == 1 and len(by_user) == N - N // 3 + 1
    hot_session = visits.event_count_by_session(hot_events).where("user_session = 's'")
    assert dict(rows(hot_session, "event_type", "events_count")) == {"view": 5000, "purchase": 1000, "cart": 4000}
    assert dict(rows(funnel.cart_purchase_diff_by_user(hot_events)))[-1] == 3000
    unknown = brands.brand_popularity(hot_events).where("brand = 'unknown_brand'")
    assert rows(unknown) == [("unknown_brand", 5000, 4000, 1000, 5000 + 8000 + 10000)]


@pytest.mark.parametrize("metric", [
    visits.event_count_by_session, funnel.cart_purchase_diff_by_user, brands.brand_popularity, brands.brand_event_count,
])
def test_rows_are_combined_before_the_shuffle(hot_events, metric):
    plan = final_plan(metric(hot_events))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_count" in below


def test_a_much_repeated_text_is_split(spark, settings):
    repeated = F.when(F.col("id") % 3 == 0, "my small ring, said many times").otherwise(F.concat(F.lit("ring "), "id"))
    comments = spark.range(N, numPartitions=16).select("id", repeated.alias("text"))
    pairs = [("ring", "a"), ("small ring", "b")]
    clean = normalise_catalogue(spark.createDataFrame(pairs, "item_label STRING, brand STRING"))
    for bound in (1 << 20, 0):
        matched = match_labels(comments, prepare_matcher(clean, strategy="by_position", broadcast_bytes=bound))
        result = matched.groupBy("matched_brand").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
        assert sorted(rows(result)) == [("A", 20_000, 20_000), ("B", 10_000, 10_000)]
        once = matched.select("id", "matched_brand")
        once.write.format("noop").mode("overwrite").save()
        once.collect()
        assert "skew=true" in final_plan(once)


def test_a_part_that_a_third_of_all_events_name_is_split(spark, settings, tmp_path):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    part.write.parquet(str(tmp_path / "part.parquet"))
    key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100)
    spark.range(N, numPartitions=16).select(
        F.col("id").alias("event_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("ts"),
        F.col("id").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.concat(F.lit('{"k": '), key, F.lit("}")).alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    clicks = views.click_events(spark, str(tmp_path)).select("event_id", "product_id", "user_session")
    collected = clicks.collect()
    assert len(collected) == N and len({row["event_id"] for row in collected}) == N
    assert "skew=true" in final_plan(clicks)


def test_a_hot_category_is_written_by_several_tasks(spark, settings, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    tables.create_database(spark, "skew_db", str(tmp_path / "db"))
    try:
        tables.create_category_partitioned_table(spark, "skew_db.events")
        code = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20))
        absent = ("event_time", "product_id", "category_id", "brand", "price")
        empty = [F.lit(None).cast("string").alias(column) for column in absent]
        events = spark.range(N, numPartitions=16).select(
            code.alias("category_code"), F.lit("view").alias("event_type"), F.col("id").cast("string").alias("user_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("user_session"), *empty,
        )
        tables.insert_events(events, "skew_db.events")
        stored = spark.table("skew_db.events")
        assert stored.count() == N and stored.select("user_id").distinct().count() == N
        files = {p.name: len(list(p.glob("*.csv"))) for p in (tmp_path / "db/events").iterdir() if p.is_dir()}
        assert files["category_code=hot"] > 1
        assert len(files) == 21 and sum(files.values()) < 5 * 21
    finally:
        spark.sql("DROP DATABASE skew_db CASCADE")
