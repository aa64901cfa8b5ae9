"""The published tables: which metric fills each, and how a new period is added to it.

    spark-submit --py-files cartlens.zip cartlens/plans/published.py \\
        --data-period 2020-Apr --raw <folder> --staged <folder> --out <folder>
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.operators import brands, funnel, sales, visits
from cartlens.plans import once
from cartlens.session import builder
from cartlens.sinks.counts import keep_brand_event_counts, running_brand_event_counts
from cartlens.sinks.files import stage_events, write_files
from cartlens.sinks.jdbc import JdbcTarget, write_jdbc
from cartlens.sources.files import read_period, read_recursive, read_staged_events


@dataclass(frozen=True)
class Published:
    metric: Callable[..., DataFrame]
    mode: str


# Names of the published tables, and whether a run adds to its table or replaces it.
TABLES = {
    "category_revenue_rank": Published(sales.category_revenue_rank, "append"),
    "daily_revenue_and_units_sold_02": Published(sales.daily_sales_metrics, "overwrite"),
    "brand_units_sold_rank": Published(sales.brand_units_sold_rank, "overwrite"),
    "brand_revenue_rank": Published(sales.brand_revenue_rank, "overwrite"),
    "avg_site_visits_per_user": Published(visits.avg_site_visits_per_user, "append"),
    "avg_events_per_session_by_event_type": Published(visits.avg_events_per_session, "overwrite"),
    "avg_cart_purchase_count_diff": Published(funnel.avg_cart_purchase_diff, "overwrite"),
    "avg_hourly_product_views_08": Published(visits.avg_hourly_product_views, "overwrite"),
    "electronics_brand_units_sold_rank_09": Published(sales.category_brand_units_rank, "append"),
    "long_term_brand_popularity_index_10": Published(brands.brand_popularity, "overwrite"),
}
TOTAL_TABLE = "long_term_brand_popularity_index_total"
LIVE_TABLE = "live_long_term_brand_popularity_index_total"
INDEX_TABLE = "long_term_brand_popularity_index_10"
MONTHLY_INDEX = "monthly_long_term_brand_popularity_index"
VIEWS_TABLE = "views_by_brand"
CONVERSION_TABLE = "cart_conversion_rate"


def write_table(
    result: DataFrame,
    name: str,
    period: str,
    *,
    files: str | None = None,
    database: JdbcTarget | None = None,
    mode: str | None = None,
) -> None:
    """Write one table's rows of one period as files, to a database or both, in its own mode or the named one.
    ``replace_period`` makes reruns safe and is for files; a database then gets the table's own mode."""
    own = TABLES[name].mode
    if files is not None:
        write_files(result, f"{files.rstrip('/')}/{name}", mode=mode or own, periods=[period])
    if database is not None:
        write_jdbc(result, name, database, mode=own if mode in (None, "replace_period") else mode)


def publish(
    events: DataFrame,
    period: str,
    *,
    files: str | None = None,
    database: JdbcTarget | None = None,
    tables: Iterable[str] = tuple(TABLES),
    mode: str | None = None,
) -> None:
    """Compute the named tables for one period's events and write them to files, a database or both."""
    for name in tables:
        result = TABLES[name].metric(events, period=period)
        write_table(result, name, period, files=files, database=database, mode=mode)


def publish_once(
    events: DataFrame,
    period: str,
    *,
    files: str | None = None,
    database: JdbcTarget | None = None,
    mode: str | None = None,
) -> dict[str, DataFrame]:
    """Write every table of one period from a single scan of its events. Returns the tables."""
    results = once.tables_of(once.store_sums(events), period)
    for name in TABLES:
        write_table(results[name], name, period, files=files, database=database, mode=mode)
    return results


def keep_monthly_index(events: DataFrame, period: str, folder: str) -> None:
    """Keep one period's popularity index beside those of the other periods."""
    write_files(brands.brand_popularity(events, period=period), folder, mode="replace_period", periods=[period])


def monthly_index(spark: SparkSession, folder: str, period: str) -> DataFrame:
    """The kept index of one period."""
    return spark.read.parquet(folder).where(F.col("batch_processing") == period)


def total_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index summed over every period kept in the folder."""
    return brands.total_popularity(read_recursive(spark, folder))


def publish_total(
    spark: SparkSession, folder: str, *, files: str | None = None, database: JdbcTarget | None = None
) -> None:
    """Replace the total table by the sum over every period kept in the folder: CSV files, a database or both."""
    total = total_index(spark, folder)
    if files is not None:
        write_files(total, f"{files.rstrip('/')}/{TOTAL_TABLE}", fmt="csv")
    if database is not None:
        write_jdbc(total, TOTAL_TABLE, database, mode="overwrite")


def run_period(
    spark: SparkSession,
    raw: str,
    staged: str,
    out: str,
    period: str,
    mode: str | None = None,
    database: JdbcTarget | None = None,
) -> None:
    """One period from its raw file to all published tables. The text is parsed once, the staged events are
    scanned once, and all tables come from the sums of that scan."""
    stage_events(read_period(spark, raw, period), staged, period)
    results = publish_once(
        read_staged_events(spark, staged, period), period, files=out, database=database, mode=mode
    )
    monthly = f"{out.rstrip('/')}/{MONTHLY_INDEX}"
    write_files(results[INDEX_TABLE], monthly, mode="replace_period", periods=[period])
    publish_total(spark, monthly, files=out, database=database)


def publish_brand_points(events: DataFrame, period: str, counts: str, points: str) -> DataFrame:
    """A period's events to counts by brand and type, added to those of the other periods, to points as CSV
    files. Returns the points."""
    spark = events.sparkSession
    keep_brand_event_counts(brands.brand_event_count(events), counts, period)
    result = brands.brand_points(running_brand_event_counts(spark, counts))
    write_files(result, points, fmt="csv")
    return result


def publish_first_look(events: DataFrame, out: str, *, top: int = 20) -> None:
    """The brands viewed most and the share of carts that end in a purchase."""
    base = out.rstrip("/")
    write_files(brands.views_by_brand(events).limit(top), f"{base}/{VIEWS_TABLE}")
    write_files(funnel.cart_conversion_rate(events), f"{base}/{CONVERSION_TABLE}")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--data-period", "--data_period", required=True)
    parser.add_argument("--raw", required=True, help="folder of <period>.csv files")
    parser.add_argument("--staged", required=True, help="folder that keeps the events as Parquet")
    parser.add_argument("--out", required=True, help="folder of the published tables")
    parser.add_argument("--mode", choices=("append", "overwrite", "replace_period"))
    parser.add_argument("--url", help="JDBC address of a database that gets the tables too")
    parser.add_argument("--driver", help="class of its driver")
    args = parser.parse_args()
    spark = builder("published tables").getOrCreate()
    database = JdbcTarget(url=args.url, driver=args.driver) if args.url else None
    run_period(spark, args.raw, args.staged, args.out, args.data_period, args.mode, database)


if __name__ == "__main__":
    main()
