"""Counts by brand and event type, kept by period and summed when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.operators.brands import merge_brand_event_counts
from cartlens.schema import BRAND_EVENT_COUNT_DDL
from cartlens.sinks.files import write_files
from cartlens.sources.files import read_or_empty


def keep_brand_event_counts(counts: DataFrame, base: str, period: str) -> None:
    """Keep a period's counts beside those of the others. Kept again, they replace what was kept of it."""
    labelled = counts.withColumn("period", F.lit(period))
    write_files(labelled, base, mode="replace_period", period_column="period", periods=[period])


def running_brand_event_counts(spark: SparkSession, base: str) -> DataFrame:
    """The counts of all kept periods together; no rows before the first."""
    kept = read_or_empty(spark, base, BRAND_EVENT_COUNT_DDL)
    return merge_brand_event_counts(kept.select("brand", "event_type", "event_count"))
