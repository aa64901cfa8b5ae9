"""How the shop is visited: sessions per user, events per session, views per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators.events import labelled, view_events


def distinct_user_sessions(events: DataFrame) -> DataFrame:
    known = F.col("user_id").isNotNull() & F.col("user_session").isNotNull()
    return events.where(known).select("user_id", "user_session").distinct()


def site_visits_by_user(events: DataFrame) -> DataFrame:
    """Sessions per user.

    Two shuffles on purpose: pairs are made distinct by user *and* session, which spreads a user who holds a
    third of all events over all tasks, and then only partial counts travel to the user's own task.
    """
    return distinct_user_sessions(events).groupBy("user_id").agg(F.count("user_session").alias("site_visit_count"))


def avg_site_visits_per_user(events: DataFrame, *, period: str | None = None) -> DataFrame:
    average = site_visits_by_user(events).agg(F.avg("site_visit_count").alias("avg_site_visits_per_user"))
    return labelled(average, period)


def event_count_by_session(events: DataFrame) -> DataFrame:
    """Events per type and session. Events without a session form one group per type; counting the type
    leaves a group of untyped events at 0."""
    return events.groupBy("event_type", "user_session").agg(F.count("event_type").alias("events_count"))


def avg_events_per_session(events: DataFrame, *, period: str | None = None) -> DataFrame:
    average = (
        event_count_by_session(events).groupBy("event_type").agg(F.avg("events_count").alias("avg_events_per_session"))
    )
    return labelled(average, period).orderBy(F.desc("avg_events_per_session"), F.asc("event_type"))


def hourly_product_views(events: DataFrame) -> DataFrame:
    counts = F.count("product_id").alias("hourly_product_views_count")
    return view_events(events).groupBy("event_date", "event_hour").agg(counts)


def avg_hourly_product_views(events: DataFrame, *, period: str | None = None) -> DataFrame:
    """Views per hour of the day, averaged over the dates on which that hour saw any view."""
    average = (
        hourly_product_views(events)
        .groupBy("event_hour")
        .agg(F.avg("hourly_product_views_count").alias("avg_hourly_product_views"))
    )
    return labelled(average, period).orderBy("event_hour")
