"""

Round-trip queries write the whole derived table to the shared folder and return what is read back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions import (
    event_date,
    event_hour,
    event_month,
    normalise_brand,
    normalise_category,
    parse_event_time,
)
from cartlens.operators import brands, events, funnel, labels, listings, sales, visits
from cartlens.plans import once, views
from cartlens.plans.published import publish_brand_points, total_index
from cartlens.schema import CART, EVENT_COLUMNS, PURCHASE, VIEW
from cartlens.session import shared_folder
from cartlens.sinks import files as sinks
from cartlens.sinks.counts import keep_brand_event_counts, running_brand_event_counts
from cartlens.sinks.ledger import FileTables, Ledger
from cartlens.sinks.marks import load_mark, not_taken, save_mark, save_taken
from cartlens.sources import files as sources
from cartlens.sources import tables
from cartlens.sources.comments import message_stream, read_archive
from cartlens.streaming import (
    archive_comments,
    compact_archive,
    fold_live_total,
    ledger_points,
    live_total,
    parquet_points,
    read_compacted,
    stream_brand_points,
)

try:
    import corpus_pipeline
    from cartlens.llm import queries as llm
except ModuleNotFoundError as missing:  # the subpackage may be left out, but nothing of it may be broken
    if missing.name not in ("corpus_pipeline", "cartlens.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return queries()["brand_revenue_rank"](spark, "/root/testdata/sf0.001")


def _on_clicks(metric: Callable[[DataFrame], DataFrame], *types: str, columns: Sequence[str] = ()) -> Query:
    """The metric over click events; the types it needs are selected where the table is read. Parts are joined
    only if the named columns (all, if none are named) ask for them."""
    named = {"columns": columns} if columns else {}
    return lambda spark, folder: metric(views.click_events(spark, folder, *types, **named))


_OF_USERS = ("event_type", "user_id")
_OF_SESSIONS = ("event_type", "user_id", "user_session")


def _on_sales(metric: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, folder: metric(views.sale_events(spark, folder, *columns))


def _rounded(frame: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Sums of doubles differ in their last digits between engines and between runs."""
    return frame.withColumn(column, F.round(column, digits))


def _rounded_mean(frame: DataFrame, column: str) -> DataFrame:
    """Means of cents often lie exactly between two rounded values, where the last digit would decide; a
    shift far below the rounding step, the same in the SQL, takes them off that point."""
    return frame.withColumn(column, F.round(F.col(column) + 1.3e-7, 4))


# --- sources and sinks ------------------------------------------------------------------------------------


def _raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Click events as they stand in raw files: the time is text with its zone, in whole seconds."""
    clicks = views.click_events(spark, folder)
    time = F.concat(F.substring(F.col("event_time").cast("string"), 1, 19), F.lit(" UTC"))
    return clicks.withColumn("event_time", time)


def _raw_csv(spark: SparkSession, folder: str) -> str:
    path = shared_folder(spark)
    sinks.write_files(_raw_events(spark, folder).select(*EVENT_COLUMNS), path, fmt="csv")
    return path


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    loaded = sources.read_event_csv(spark, _raw_csv(spark, folder))
    return loaded.withColumn("event_time", F.unix_seconds("event_time")).withColumnRenamed("event_time", "epoch")


def csv_dropmalformed(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth line is one field short and must be gone, also when few columns are asked for."""
    raw = _raw_events(spark, folder)
    base = shared_folder(spark)
    short = F.col("event_id") % 10 == 0
    sinks.write_files(raw.where(~short).select(*EVENT_COLUMNS), f"{base}/good", fmt="csv")
    sinks.write_files(raw.where(short).select(*EVENT_COLUMNS[:-1]), f"{base}/short", fmt="csv")
    loaded = sources.read_text_event_csv(spark, [f"{base}/good", f"{base}/short"])
    return loaded


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth line is one field short and every tenth has a price in words; the rest is good. Returns the bad
    lines with the reason, and a row with the number of good ones that each of two counts finds."""
    raw = _raw_events(spark, folder).withColumn("price", F.col("price").cast("string"))
    base = shared_folder(spark)
    last = F.col("event_id") % 10
    worded = raw.withColumn("price", F.when(last == 3, "cheap").otherwise(F.col("price")))
    sinks.write_files(worded.where(last != 0).select(*EVENT_COLUMNS), f"{base}/whole", fmt="csv")
    sinks.write_files(worded.where(last == 0).select(*EVENT_COLUMNS[:-1]), f"{base}/short", fmt="csv")
    good, rejects = sources.route_event_csv(spark, [f"{base}/whole", f"{base}/short"], f"{base}/routed")
    every = good.select(F.count("*").alias("n"), F.count_if(F.hash(*EVENT_COLUMNS).isNotNull()).alias("m"))
    counts = every.select(
        F.concat_ws(" ", F.col("n").cast("string"), F.col("m").cast("string")).alias("line"), F.lit("good").alias("reason")
    )
    return rejects.unionByName(counts)


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_files(views.click_events(spark, folder), path)
    return spark.read.parquet(path)


def convert_format(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.convert_format(spark, f"{folder}/events.parquet", "parquet", path, "orc")
    return spark.read.orc(path)


def recursive_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    clicks = views.click_events(spark, folder)
    sinks.write_files(clicks, path, partition_by=["event_type"])
    # The type stands in the folders' names only, which a recursive read leaves out.
    return sources.read_recursive(spark, path)


def staged_events(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.stage_events(sources.read_event_csv(spark, _raw_csv(spark, folder)), path, "2024-Jan")
    loaded = sources.read_staged_events(spark, path, "2024-Jan")
    return _with_epoch(loaded)


def _with_epoch(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", F.unix_seconds("event_time")).withColumnRenamed("event_time", "epoch")


def staged_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """A period staged with all events and again without purchases; another period stays as it is."""
    path = shared_folder(spark)
    events = sources.read_event_csv(spark, _raw_csv(spark, folder))
    for period in ("2024-Jan", "2024-Feb"):
        sinks.stage_events(events, path, period)
    sinks.stage_events(events.where(F.col("event_type") != PURCHASE), path, "2024-Feb")
    return _with_epoch(sources.read_staged_events(spark, path))


def replace_period_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A published period replaced by a run that finds nothing; the other period stays."""
    path = shared_folder(spark)
    rank = sales.brand_units_sold_rank(views.click_events(spark, folder, PURCHASE))
    for result, period in ((rank, "2024-Jan"), (rank, "2024-Feb"), (rank.limit(0), "2024-Feb")):
        sinks.write_files(events.labelled(result, period), path, mode="replace_period", periods=[period])
    return spark.read.parquet(path).select("rank_brand_name", "units_sold", "batch_processing")


def _fresh_table(spark: SparkSession, name: str) -> str:
    """The name of a table that isn't there, in the one database of the catalogue queries."""
    tables.create_database(spark, "cartlens_queries")
    spark.sql(f"DROP TABLE IF EXISTS cartlens_queries.{name}")
    return f"cartlens_queries.{name}"


def catalog_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    name = _fresh_table(spark, "ecommerce_events")
    tables.create_external_csv_table(spark, name, _raw_csv(spark, folder))
    return _with_epoch(tables.read_table(spark, name)).withColumn("price", F.col("price").cast("double"))


def managed_text_table(spark: SparkSession, folder: str) -> DataFrame:
    name = _fresh_table(spark, "webshop_customer_events")
    tables.create_managed_text_table(spark, name)
    tables.insert_events(_raw_events(spark, folder), name)
    return tables.read_table(spark, name).withColumn("price", F.col("price").cast("double"))


def partitioned_by_category(spark: SparkSession, folder: str) -> DataFrame:
    name = _fresh_table(spark, "events_by_category")
    tables.create_category_partitioned_table(spark, name)
    tables.insert_events(_raw_events(spark, folder), name)
    return tables.read_table(spark, name).withColumn("price", F.col("price").cast("double"))


def _published_twice(mode: str) -> Query:
    """The same period published again after another one."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        once, path = shared_folder(spark), shared_folder(spark)
        sinks.write_files(sales.brand_units_sold_rank(views.click_events(spark, folder, PURCHASE)), once)
        for period in ("2024-Jan", "2024-Feb", "2024-Feb"):
            sinks.write_files(events.labelled(spark.read.parquet(once), period), path, mode=mode)
        return spark.read.parquet(path).select("rank_brand_name", "units_sold", "batch_processing")

    return run


# --- cleaning and filters ---------------------------------------------------------------------------------


def _parse_event_time(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw_events(spark, folder)
    # Every fifteenth time cannot be read.
    text = F.when(F.col("event_id") % 15 == 0, "not-a-time").otherwise(F.col("event_time"))
    timed = raw.withColumn("event_time", parse_event_time(text))
    return timed.select(
        "event_id",
        F.unix_seconds("event_time").alias("epoch"),
        event_date(timed).alias("event_date"),
        event_hour(timed).alias("event_hour"),
    )


def _brand_names(clicks: DataFrame) -> DataFrame:
    return clicks.select("event_id", normalise_brand(F.col("brand")).alias("rank_brand_name"))


def _category_names(clicks: DataFrame) -> DataFrame:
    code = F.col("category_code")
    return clicks.select(
        "event_id",
        normalise_category(code).alias("rank_category_name"),
        normalise_category(code, "top").alias("top_category_name"),
    )


# --- metrics ----------------------------------------------------------------------------------------------


def _ten_days(clicks: DataFrame) -> DataFrame:
    """All given events lie in one month, so its thirds serve as periods."""
    third = F.floor(F.least(F.dayofmonth("event_time") - 1, F.lit(29)) / 10).cast("string")
    return clicks.withColumn("period", F.concat(F.lit("2024-Jan-"), third))


def _merged_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of each third of the month, made in one pass, kept one after the other, the second one twice."""
    parts, base = shared_folder(spark), shared_folder(spark)
    clicks = _ten_days(views.click_events(spark, folder))
    sinks.write_files(brands.brand_event_count(clicks, period_column="period"), parts, partition_by=["period"])
    for third in (0, 1, 2, 1):
        period = f"2024-Jan-{third}"
        keep_brand_event_counts(spark.read.parquet(f"{parts}/period={period}"), base, period)
    return running_brand_event_counts(spark, base)


def brand_points_published(spark: SparkSession, folder: str) -> DataFrame:
    """The brand points chain from events to CSV files, read back."""
    counts, points = shared_folder(spark), shared_folder(spark)
    publish_brand_points(views.click_events(spark, folder), "2024-Jan", counts, points)
    written = spark.read.csv(points, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return written.withColumns({c: F.col(c).cast("long") for c in written.columns if c != "brand"})


def published_once(spark: SparkSession, folder: str) -> DataFrame:
    """All ten tables from one scan, as rows of one shape: the table, the key and up to four measures."""
    shapes = {
        "category_revenue_rank": ("rank_category_name", "total_revenue"),
        "daily_revenue_and_units_sold_02": ("event_date", "average_daily_revenue", "units_sold"),
        "brand_units_sold_rank": ("rank_brand_name", "units_sold"),
        "brand_revenue_rank": ("rank_brand_name", "total_revenue"),
        "avg_site_visits_per_user": (None, "avg_site_visits_per_user"),
        "avg_events_per_session_by_event_type": ("event_type", "avg_events_per_session"),
        "avg_cart_purchase_count_diff": (None, "avg_cart_purchase_count_diff"),
        "avg_hourly_product_views_08": ("event_hour", "avg_hourly_product_views"),
        "electronics_brand_units_sold_rank_09": ("rank_brand_name", "units_sold"),
        "long_term_brand_popularity_index_10": (
            "brand", brands.INDEX, "view_events_count", "cart_events_count", "purchase_events_count",
        ),
    }
    tables_now = once.tables_of(once.store_sums(views.click_events(spark, folder)))
    parts = []
    for name, (key, *measures) in shapes.items():
        values = [F.round(F.col(m) + 1.3e-7, 4) for m in measures] + [F.lit(None).cast("double")] * (4 - len(measures))
        named = [v.alias(n) for v, n in zip(values, ("first", "second", "third", "fourth"), strict=True)]
        text = (F.col(key) if key else F.lit(None)).cast("string").alias("key")
        parts.append(tables_now[name].select(F.lit(name).alias("table_name"), text, *named))
    return reduce(DataFrame.unionByName, parts)


def _stored_by_type(
    metric: Callable[[DataFrame], DataFrame],
    spark: SparkSession,
    folder: str,
    *types: str,
    columns: Sequence[str] = ("event_type", "brand"),
) -> str:
    """Counts by event type, made in one pass and filed by type."""
    path = shared_folder(spark)
    clicks = views.click_events(spark, folder, *types, columns=columns)
    sinks.write_files(metric(clicks), path, partition_by=["event_type"])
    return path


def _counts_of(spark: SparkSession, stored: str, kind: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{stored}/event_type={kind}").withColumnRenamed("n", name)


def _popularity_full_join(spark: SparkSession, folder: str) -> DataFrame:
    counted = _stored_by_type(lambda c: _count_by(c, "brand"), spark, folder, VIEW, CART, PURCHASE)
    names = {VIEW: "view_events_count", CART: "cart_events_count", PURCHASE: "purchase_events_count"}
    counts = [_counts_of(spark, counted, kind, name) for kind, name in names.items()]
    return brands.join_brand_counts(*counts, period="2024-Jan")


def _count_by(clicks: DataFrame, key: str) -> DataFrame:
    return clicks.groupBy(key, "event_type").agg(F.count("*").alias("n"))


def _popularity_total(spark: SparkSession, folder: str) -> DataFrame:
    """Each period's index, made in one pass, lies in a folder of its own, and all folders are summed."""
    base = shared_folder(spark)
    clicks = _ten_days(views.click_events(spark, folder, VIEW, CART, PURCHASE))
    sinks.write_files(brands.brand_popularity(clicks, period_column="period"), base, partition_by=["period"])
    return total_index(spark, base)


def _sale_periods(sold: DataFrame) -> DataFrame:
    """Index per calendar month of the order, for all months in one pass."""
    return brands.brand_popularity(sold.withColumn("period", event_month(sold)), period_column="period")


def _cart_purchase_join(spark: SparkSession, folder: str) -> DataFrame:
    counted = _stored_by_type(
        lambda c: _count_by(c, "user_id"), spark, folder, CART, PURCHASE, columns=("event_type", "user_id")
    )
    carts = _counts_of(spark, counted, CART, "cart_event_count")
    bought = _counts_of(spark, counted, PURCHASE, "purchase_event_count")
    return funnel.join_cart_and_purchase_counts(carts, bought)


def _daily_join(spark: SparkSession, folder: str) -> DataFrame:
    """Both daily results made in one pass, stored, and joined as two tables."""
    path = shared_folder(spark)
    clicks = views.click_events(spark, folder, PURCHASE)
    sinks.write_files(sales.daily_sales_metrics(clicks), path)
    stored = spark.read.parquet(path)
    joined = sales.join_daily_metrics(
        stored.select("event_date", "average_daily_revenue"), stored.select("event_date", "units_sold")
    )
    return _rounded_mean(joined, "average_daily_revenue")


# --- comments ---------------------------------------------------------------------------------------------


def _matched(spark: SparkSession, folder: str, **options) -> DataFrame:
    clean = labels.normalise_catalogue(views.catalogue(spark, folder))
    matcher = labels.prepare_matcher(clean, **options)
    return labels.match_labels(views.comments(spark, folder), matcher)


def _label_match(**options) -> Query:
    return lambda spark, folder: _matched(spark, folder, **options).select(
        "comment_id", "matched_item_label", "matched_brand"
    )


def document_label_match(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as texts; labels are the benchmark's passages and each source's last text, some of
    thousands of characters."""
    ascii_only = lambda column: F.regexp_replace(column, "[^ -~]+", " ")
    documents = views.table(spark, folder, "documents").select("doc_id", "source", ascii_only("text").alias("text"))
    passages = views.table(spark, folder, "benchmark").select(
        ascii_only("text").alias("item_label"), F.concat(F.lit("item "), "item_id").alias("brand")
    )
    last = documents.groupBy(F.col("source").alias("brand")).agg(F.max("text").alias("item_label"))
    clean = labels.normalise_catalogue(passages.unionByName(last))
    matcher = labels.prepare_matcher(clean, strategy="by_position", like_labels=True)
    found = labels.match_labels(documents, matcher)
    return found.select("doc_id", F.md5("matched_item_label").alias("label_md5"), "matched_brand")


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return listings.parse_comments(views.messages(views.comments(spark, folder)))


def _ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Arrival as a stream gives it, a point in time; it is returned as seconds, which no session zone touches."""
    filed = listings.with_ingest_columns(views.comments(spark, folder), at=F.timestamp_seconds("created_utc"))
    epoch = F.unix_seconds("ingest_ts").alias("ingest_epoch")
    return filed.select("comment_id", epoch, "ingest_date", "ingest_time")


def _combined(spark: SparkSession, folder: str) -> DataFrame:
    total = brands.total_popularity(brands.brand_popularity(views.click_events(spark, folder)))
    return brands.combined_popularity(total, labels.comment_points(_matched(spark, folder)))


def _flattened(spark: SparkSession, folder: str) -> DataFrame:
    return listings.flatten_listing(views.listing_pages(views.comments(spark, folder)))


def _new_comments(spark: SparkSession, folder: str) -> DataFrame:
    """What a run takes after one that started at the kept time."""
    base = shared_folder(spark)
    save_mark(spark, base, 1704070000.0)
    return listings.since(_flattened(spark, folder), load_mark(spark, base))


def _message_files(spark: SparkSession, folder: str) -> str:
    path = shared_folder(spark)
    sinks.write_files(views.messages(views.comments(spark, folder)), path, fmt="text")
    return path


def stream_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All messages as a stream of files, archived as CSV and read back."""
    arriving = message_stream(spark, "text", {}, _message_files(spark, folder))
    archive, mark = shared_folder(spark), shared_folder(spark)
    archive_comments(arriving, archive, mark, trigger={"availableNow": True}).awaitTermination()
    kept = read_archive(spark, archive).withColumnsRenamed({"ingest_date": "date", "ingest_time": "second"})
    # The moment of arrival differs from run to run; what must hold is that a message is filed under it, in UTC.
    filed = listings.with_ingest_columns(kept, at=F.col("ingest_ts"))
    agree = (F.col("date") == F.col("ingest_date")) & (F.col("second") == F.col("ingest_time"))
    return filed.withColumn("filed_in_utc", agree).drop("ingest_ts", "ingest_date", "ingest_time", "date", "second")


def _stream_points(spark: SparkSession, folder: str, **options) -> DataFrame:
    """All messages as a stream of files, matched as they arrive; the stored points, added up by brand."""
    matcher = labels.prepare_matcher(labels.normalise_catalogue(views.catalogue(spark, folder)), **options)
    arriving = message_stream(spark, "text", {}, _message_files(spark, folder))
    stored, mark = shared_folder(spark), shared_folder(spark)
    stream = stream_brand_points(arriving, matcher, parquet_points(stored), mark, trigger={"availableNow": True})
    stream.awaitTermination()
    points = sources.read_or_empty(spark, stored, f"brand STRING, {brands.TOTAL_INDEX} BIGINT")
    return brands.total_popularity(points.withColumnRenamed(brands.TOTAL_INDEX, brands.INDEX))


def _some_messages(spark: SparkSession, folder: str, path: str, part: int, parts: int) -> None:
    """Add one part of the messages to the files that a stream reads."""
    some = F.pmod(F.hash("comment_id"), F.lit(parts)) == part
    messages = views.messages(views.comments(spark, folder).where(some))
    sinks.write_files(messages.repartition(2), path, fmt="text", mode="append")


_ONE_FILE, _ONCE = {"maxFilesPerTrigger": "1"}, {"availableNow": True}


def points_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Points appended by batch to a table that takes no updates: one batch fails between its rows and its commit, and
    each batch runs again after all. The committed points, added up by brand."""
    matcher = labels.prepare_matcher(labels.normalise_catalogue(views.catalogue(spark, folder)))
    inbox, stored, mark = shared_folder(spark), shared_folder(spark), shared_folder(spark)
    for part in (0, 1):
        _some_messages(spark, folder, inbox, part, 2)
    ledger = Ledger(FileTables(stored), "points", f"brand STRING, {brands.TOTAL_INDEX} BIGINT")
    once = ledger_points(ledger)

    def half(points: DataFrame, batch: int) -> None:
        # As a writer that stops before the commit: rows of an attempt that nothing names.
        if not ledger.is_committed(spark, batch):
            lost = {"stream": F.lit(""), "batch": F.lit(batch).cast("long"), "attempt": F.lit("lost")}
            ledger.tables.append(points.withColumns(lost), "points_staged")
        once(points, batch)
        once(points, batch)

    arriving = message_stream(spark, "text", _ONE_FILE, inbox)
    stream_brand_points(arriving, matcher, half, mark, trigger=_ONCE).awaitTermination()
    points = ledger.rows(spark).withColumnRenamed(brands.TOTAL_INDEX, brands.INDEX)
    return brands.total_popularity(points)


def live_total_folded(spark: SparkSession, folder: str) -> DataFrame:
    """Points of many batches, folded between two runs of the stream and after; the newest batch runs again."""
    matcher = labels.prepare_matcher(labels.normalise_catalogue(views.catalogue(spark, folder)))
    inbox, stored, mark, snapshots = (shared_folder(spark) for _ in range(4))
    for part in (0, 1):
        _some_messages(spark, folder, inbox, part, 2)
        arriving = message_stream(spark, "text", _ONE_FILE, inbox)
        stream_brand_points(arriving, matcher, parquet_points(stored), mark, trigger=_ONCE).awaitTermination()
        fold_live_total(spark, stored, snapshots)
    return live_total(spark, stored, snapshots)


def stream_match_stateless(spark: SparkSession, folder: str) -> DataFrame:
    """The stream itself matched, without state; the catalogue's source is rewritten before the stream starts."""
    source, found, mark = (shared_folder(spark) for _ in range(3))
    sinks.write_files(labels.normalise_catalogue(views.catalogue(spark, folder)), source)
    matcher = labels.prepare_matcher(spark.read.parquet(source), strategy="in_row")
    sinks.write_files(spark.createDataFrame([("OF", "NOBODY")], "item_label_upper STRING, brand_upper STRING"), source)
    arriving = message_stream(spark, "text", {}, _message_files(spark, folder))
    matched = labels.match_stream(listings.parse_comments(arriving), matcher)
    matched = matched.select("comment_id", "matched_item_label", "matched_brand")
    writer = matched.writeStream.format("parquet").option("path", found).option("checkpointLocation", mark)
    writer.trigger(**_ONCE).start().awaitTermination()
    return spark.read.schema(matched.schema).parquet(found)


def archive_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Messages archived in three runs, the closed folders rewritten after the second and the third."""
    inbox, archive, mark, compacted = (shared_folder(spark) for _ in range(4))
    for part in (0, 1, 2):
        _some_messages(spark, folder, inbox, part, 3)
        arriving = message_stream(spark, "text", _ONE_FILE, inbox)
        archive_comments(arriving, archive, mark, trigger=_ONCE).awaitTermination()
        if part:
            compact_archive(spark, archive, compacted)
    return read_compacted(spark, archive, compacted).drop("ingest_ts", "ingest_date", "ingest_time")


def incremental_by_maximum(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs, of which the first comes in the middle of a second: which run took each comment."""
    kept = shared_folder(spark)
    every = _flattened(spark, folder)
    made, there = F.col("created_utc"), F.col("comment_id").startswith("c")
    seen = every.where((made < 1704070000) | ((made == 1704070000) & there))
    parts = []
    for run, comments in enumerate((seen, every), 1):
        path = shared_folder(spark)
        sinks.write_files(not_taken(comments, kept), path)
        taken = spark.read.schema(every.schema).parquet(path)
        save_taken(taken, kept)
        parts.append(taken.withColumn("run", F.lit(run)))
    return parts[0].unionByName(parts[1])


def catalogue_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    sinks.write_files(views.catalogue(spark, folder), path, fmt="csv")
    return labels.normalise_catalogue(sources.read_catalogue_csv(spark, path))


def llm_queries() -> dict[str, Query]:
    """The queries of the llm subpackage, and the pipeline."""
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}


def queries() -> dict[str, Query]:
    """One entry per query; each takes (spark, folder of the Parquet tables)."""
    on = _on_clicks
    return {
        "csv_roundtrip": csv_roundtrip,
        "csv_dropmalformed": csv_dropmalformed,
        "csv_rejects": csv_rejects,
        "parquet_roundtrip": parquet_roundtrip,
        "convert_format": convert_format,
        "recursive_scan": recursive_scan,
        "staged_events": staged_events,
        "staged_rerun": staged_rerun,
        "replace_period_empty": replace_period_empty,
        "catalog_table_scan": catalog_table_scan,
        "managed_text_table": managed_text_table,
        "partitioned_by_category": partitioned_by_category,
        "append_roundtrip": _published_twice("append"),
        "overwrite_roundtrip": _published_twice("overwrite"),
        "replace_period_roundtrip": _published_twice("replace_period"),
        "parse_event_time": _parse_event_time,
        "normalise_brand": on(_brand_names),
        "normalise_category": on(_category_names),
        "purchase_events": on(events.purchase_events, PURCHASE),
        "cart_events": on(events.cart_events, CART),
        "view_events": on(events.view_events, VIEW),
        "electronics_purchase_events": on(events.electronics_purchase_events, PURCHASE),
        "category_revenue_rank": on(
            lambda c: _rounded(sales.category_revenue_rank(c), "total_revenue"), PURCHASE
        ),
        "category_revenue_rank_top_level": on(
            lambda c: _rounded(sales.category_revenue_rank(c, level="top"), "total_revenue"), PURCHASE
        ),
        "daily_sales_metrics": on(
            lambda c: _rounded_mean(sales.daily_sales_metrics(c, period="2024-Jan"), "average_daily_revenue"),
            PURCHASE,
        ),
        "daily_metrics_join": _daily_join,
        "brand_units_sold_rank": on(sales.brand_units_sold_rank, PURCHASE),
        "brand_revenue_rank": on(
            lambda c: _rounded(sales.brand_revenue_rank(c, period="2024-Jan"), "total_revenue"), PURCHASE
        ),
        "electronics_brand_units_rank": on(sales.category_brand_units_rank, PURCHASE),
        "distinct_user_sessions": on(visits.distinct_user_sessions, columns=_OF_SESSIONS),
        "site_visits_by_user": on(visits.site_visits_by_user, columns=_OF_SESSIONS),
        "avg_site_visits_per_user": on(
            lambda c: _rounded(visits.avg_site_visits_per_user(c, period="2024-Jan"), "avg_site_visits_per_user"),
            columns=_OF_SESSIONS,
        ),
        "event_count_by_session": on(visits.event_count_by_session, columns=_OF_SESSIONS),
        "avg_events_per_session": on(
            lambda c: _rounded(visits.avg_events_per_session(c), "avg_events_per_session"), columns=_OF_SESSIONS
        ),
        "event_counts_by_user": on(
            lambda c: funnel.event_counts_by_user(c, CART, "cart_event_count"), CART, columns=_OF_USERS
        ),
        "cart_purchase_diff_by_user": on(funnel.cart_purchase_diff_by_user, CART, PURCHASE, columns=_OF_USERS),
        "cart_purchase_diff_join": _cart_purchase_join,
        "avg_cart_purchase_diff": on(
            lambda c: _rounded(funnel.avg_cart_purchase_diff(c), "avg_cart_purchase_count_diff"),
            *(CART, PURCHASE),
            columns=_OF_USERS,
        ),
        "cart_conversion_rate": on(
            lambda c: _rounded(funnel.cart_conversion_rate(c), "cart_conversion_rate"),
            *(CART, PURCHASE),
            columns=("event_type",),
        ),
        "hourly_product_views": on(visits.hourly_product_views, VIEW),
        "avg_hourly_product_views": on(
            lambda c: _rounded(visits.avg_hourly_product_views(c), "avg_hourly_product_views"), VIEW
        ),
        "brand_event_count": on(brands.brand_event_count),
        "brand_event_count_merge": _merged_counts,
        "brand_points_published": brand_points_published,
        "published_once": published_once,
        "brand_points": on(lambda c: brands.brand_points(brands.brand_event_count(c))),
        "views_by_brand": on(brands.views_by_brand, VIEW),
        "views_by_brand_top20": on(lambda c: brands.views_by_brand(c).limit(20), VIEW),
        "event_counts_by_brand": on(lambda c: brands.event_counts_by_brand(c, VIEW), VIEW),
        "brand_popularity_monthly": on(
            lambda c: brands.brand_popularity(c, period="2024-Jan"), VIEW, CART, PURCHASE
        ),
        "brand_popularity_by_period": on(
            lambda c: brands.brand_popularity(_ten_days(c), period_column="period"), VIEW, CART, PURCHASE
        ),
        "brand_popularity_full_join": _popularity_full_join,
        "brand_popularity_total": _popularity_total,
        "sale_brand_revenue_rank": _on_sales(
            lambda s: _rounded(sales.brand_revenue_rank(s), "total_revenue", 2), "event_type", "brand", "price"
        ),
        "sale_category_revenue_rank": _on_sales(
            lambda s: _rounded(sales.category_revenue_rank(s), "total_revenue", 2),
            *("event_type", "category_code", "price"),
        ),
        "sale_daily_metrics": _on_sales(
            lambda s: _rounded_mean(sales.daily_sales_metrics(s), "average_daily_revenue"),
            *("event_type", "event_time", "product_id", "price"),
        ),
        "sale_visits_per_user": _on_sales(
            lambda s: _rounded(visits.avg_site_visits_per_user(s), "avg_site_visits_per_user"),
            *("user_id", "user_session"),
        ),
        "sale_popularity_by_period": _on_sales(_sale_periods, "event_type", "event_time", "brand"),
        "parse_comments": _parsed,
        "ingest_partitions": _ingest,
        "catalogue_csv_scan": catalogue_csv_scan,
        "stream_archive": stream_archive,
        "archive_compacted": archive_compacted,
        "points_ledger": points_ledger,
        "live_total_folded": live_total_folded,
        "stream_match_stateless": stream_match_stateless,
        "stream_brand_points": _stream_points,
        "stream_brand_points_by_position": lambda spark, folder: _stream_points(spark, folder, strategy="by_position"),
        "catalog_normalise": lambda spark, folder: labels.normalise_catalogue(views.catalogue(spark, folder)),
        "comment_brand_match": _label_match(),
        "comment_brand_match_by_position": _label_match(strategy="by_position"),
        "comment_brand_match_salted": _label_match(strategy="by_position", broadcast_bytes=0),
        "comment_brand_match_whole_words": _label_match(whole_words=True),
        "comment_brand_match_by_words": _label_match(strategy="by_words", whole_words=True, broadcast_bytes=0),
        "document_label_match": document_label_match,
        "comment_brand_points": lambda spark, folder: labels.comment_points(_matched(spark, folder)),
        "comment_brand_points_total": lambda spark, folder: labels.comment_points_total(_matched(spark, folder)),
        "combined_brand_popularity": _combined,
        "flatten_listing": _flattened,
        "incremental_since": _new_comments,
        "incremental_by_maximum": incremental_by_maximum,
        **llm_queries(),
    }


# --- the same in plain SQL --------------------------------------------------------------------------------

_CLICKS = """
clicks AS (
  SELECT e.event_id, e.ts AS event_time,
    CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
    CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE p.p_partkey END AS product_id,
    CAST(p.p_size AS BIGINT) AS category_id,
    CASE WHEN e.event_id % 11 = 0 THEN NULL WHEN e.event_id % 13 = 0 THEN '  '
      ELSE CASE WHEN p.p_type IN ('ECONOMY', 'PROMO') THEN 'electronics' ELSE lower(p.p_type) END
        || '.' || replace(p.p_name, ' ', '.') END AS category_code,
    CASE WHEN e.event_id % 7 = 0 THEN NULL WHEN e.event_id % 17 = 0 THEN '  '
      WHEN e.event_id % 5 = 0 THEN ' ' || lower(p.p_brand) || ' ' ELSE p.p_brand END AS brand,
    e.value AS price,
    CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE e.user_id END AS user_id,
    CASE WHEN e.event_id % 103 = 0 THEN NULL
      ELSE 's' || CAST(e.user_id AS VARCHAR) || '-' || CAST(CAST(e.ts AS DATE) AS VARCHAR) END AS user_session
  FROM events e LEFT JOIN part p ON p.p_partkey = CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT)
),
bought AS (
  SELECT *, CASE WHEN brand IS NULL OR trim(brand) = '' THEN 'WITHOUT BRAND' ELSE upper(trim(brand)) END AS brand_name,
    CASE WHEN category_code IS NULL OR trim(category_code) = '' THEN 'without category' ELSE category_code END
      AS category_name
  FROM clicks WHERE event_type = 'purchase'
)
"""

_COMMENTS = """
comments AS (
  SELECT 'p' || CAST(e.event_id % 50 AS VARCHAR) AS post_id, 'c' || CAST(e.event_id AS VARCHAR) AS comment_id,
    CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE 'u' || CAST(e.user_id AS VARCHAR) END AS author,
    CASE WHEN e.event_id % 23 = 0 THEN NULL WHEN e.event_id % 6 = 0 THEN ''
      WHEN e.event_id % 4 = 0 THEN 'Nothing about ' || e.event_type
      WHEN e.event_id % 5 = 0 THEN 'any ' || split_part(p.p_name, ' ', 2) || ' will do '
      ELSE '  My ' || p.p_name || ' is a ' || e.event_type END AS text,
    CAST(1704067200 + e.event_id AS BIGINT) AS created_utc
  FROM events e LEFT JOIN part p ON p.p_partkey = CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT)
),
listed AS (
  SELECT p_name AS item_label, min(p_brand) AS brand FROM part GROUP BY p_name
  UNION ALL SELECT split_part(p_name, ' ', 2), min(p_brand) FROM part GROUP BY split_part(p_name, ' ', 2)
  UNION ALL SELECT '--', 'Brand#0' UNION ALL SELECT NULL, 'Brand#0'
),
catalogue AS (
  SELECT DISTINCT * FROM (
    SELECT trim(regexp_replace(upper(item_label), '[^A-Z0-9]+', ' ', 'g')) AS item_label_upper,
      upper(brand) AS brand_upper
    FROM listed WHERE item_label IS NOT NULL AND brand IS NOT NULL
  ) WHERE item_label_upper <> '' AND brand_upper <> ''
),
ranked AS (
  SELECT comment_id, item_label_upper, brand_upper, row_number() OVER (
      PARTITION BY comment_id ORDER BY length(item_label_upper) DESC, item_label_upper, brand_upper) AS place
  FROM comments JOIN catalogue ON contains(upper(trim(text)), item_label_upper)
),
matched AS (
  SELECT comment_id, item_label_upper AS matched_item_label, brand_upper AS matched_brand FROM ranked WHERE place = 1
)
"""

_SALES = """
sold AS (
  SELECT l_partkey AS product_id, lower(p_type) || '.' || replace(p_name, ' ', '.') AS category_code,
    p_brand AS brand, l_extendedprice AS price, o_orderdate AS event_time, o_custkey AS user_id, l_orderkey
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey
)
"""

_POPULARITY = """
popularity AS (
  SELECT coalesce(brand, 'unknown_brand') AS brand,
    CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS view_events_count,
    CAST(count(*) FILTER (event_type = 'cart') AS BIGINT) AS cart_events_count,
    CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchase_events_count,
    CAST(sum(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 ELSE 10 END) AS BIGINT)
      AS long_term_brand_popularity_index
  FROM clicks WHERE event_type IN ('view', 'cart', 'purchase') GROUP BY 1
)
"""


_DOCUMENT_MATCH = """
WITH texts AS (SELECT doc_id, source, regexp_replace(text, '[^ -~]+', ' ', 'g') AS text FROM documents),
searched AS (SELECT doc_id, trim(regexp_replace(upper(text), '[^A-Z0-9]+', ' ', 'g')) AS text FROM texts),
named AS (
  SELECT regexp_replace(text, '[^ -~]+', ' ', 'g') AS label, 'item ' || CAST(item_id AS VARCHAR) AS brand FROM benchmark
  UNION ALL SELECT max(text), source FROM texts GROUP BY source),
clean AS (
  SELECT trim(regexp_replace(upper(label), '[^A-Z0-9]+', ' ', 'g')) AS label, upper(brand) AS brand FROM named),
catalogue AS (
  SELECT label, min(brand) AS brand FROM clean WHERE label <> '' AND brand <> '' GROUP BY label),
ranked AS (
  SELECT doc_id, label, brand, row_number() OVER (PARTITION BY doc_id ORDER BY length(label) DESC, label) AS place
  FROM searched JOIN catalogue ON contains(text, label))
SELECT doc_id, md5(label) AS label_md5, brand AS matched_brand FROM ranked WHERE place = 1
"""


def _with(*parts: str) -> Callable[[str], str]:
    return lambda body: f"WITH {','.join(parts)} {body}"


def oracle_sql() -> dict[str, str]:
    """The SQL each query must agree with, on the same tables."""
    clicks = _with(_CLICKS)
    said = _with(_COMMENTS)
    sold = _with(_SALES)
    popular = _with(_CLICKS, _POPULARITY)
    third = "'2024-Jan-' || CAST(least(day(event_time) - 1, 29) // 10 AS VARCHAR)"
    epoch = "CAST(epoch(date_trunc('second', event_time)) AS BIGINT)"
    staged = (
        f"{epoch} AS epoch, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
    )
    seconds = "strftime(event_time, '%Y-%m-%d %H:%M:%S') || ' UTC'"
    session_counts = (
        "SELECT event_type, user_session, count(event_type) AS events_count FROM clicks GROUP BY 1, 2"
    )
    visits_by_user = (
        "SELECT user_id, count(*) AS site_visit_count FROM (SELECT DISTINCT user_id, user_session FROM clicks "
        "WHERE user_id IS NOT NULL AND user_session IS NOT NULL) GROUP BY user_id"
    )
    diffs = (
        "SELECT c.user_id, c.n - coalesce(p.n, 0) AS cart_purchase_count_diff FROM "
        "(SELECT user_id, count(*) AS n FROM clicks WHERE event_type = 'cart' GROUP BY 1) c LEFT JOIN "
        "(SELECT user_id, count(*) AS n FROM clicks WHERE event_type = 'purchase' GROUP BY 1) p "
        "ON c.user_id = p.user_id"
    )
    hourly = (
        "SELECT CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INT) AS event_hour, "
        "count(product_id) AS hourly_product_views_count FROM clicks WHERE event_type = 'view' GROUP BY 1, 2"
    )
    daily = (
        "SELECT CAST(event_time AS DATE) AS event_date, round(avg(price) + 0.00000013, 4) AS average_daily_revenue, "
        "count(product_id) AS units_sold"
    )
    brand_counts = (
        "SELECT brand, event_type, count(*) AS event_count FROM clicks WHERE brand IS NOT NULL GROUP BY 1, 2"
    )
    no_more = "CAST(NULL AS DOUBLE) AS {}"
    measure = "round({} + 0.00000013, 4) AS {}"

    def shaped(name: str, key: str, measures: Sequence[str], source: str) -> str:
        """Rows of one published table in the shape of ``published_once``."""
        names = ("first", "second", "third", "fourth")
        values = [measure.format(m, n) for m, n in zip(measures, names, strict=False)]
        values += [no_more.format(n) for n in names[len(measures) :]]
        return f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key, {', '.join(values)} FROM {source}"

    by_type = "SELECT brand, count(*) AS n FROM clicks WHERE event_type = '{}' GROUP BY 1"
    units_once = "SELECT brand_name AS rank_brand_name, count(product_id) AS units_sold FROM bought GROUP BY 1"
    electronics = (
        "FROM bought WHERE brand IS NOT NULL AND category_code IS NOT NULL "
        "AND starts_with(lower(category_code), 'electronics')"
    )
    points = clicks(
        "SELECT brand, CAST(sum(event_count * CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 3 "
        f"WHEN 'purchase' THEN 10 ELSE 0 END) AS BIGINT) AS total_points FROM ({brand_counts}) GROUP BY 1"
    )
    streamed = said(
        "SELECT matched_brand AS brand, 10 * count(*) AS total_long_term_brand_popularity_index FROM matched GROUP BY 1"
    )
    match = said("SELECT comment_id, matched_item_label, matched_brand FROM matched")
    whole_words = said(
        "SELECT comment_id, item_label_upper AS matched_item_label, brand_upper AS matched_brand FROM ("
        "SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY length(item_label_upper) DESC, "
        "item_label_upper, brand_upper) AS place FROM comments JOIN catalogue ON contains("
        "' ' || trim(regexp_replace(upper(text), '[^A-Z0-9]+', ' ', 'g')) || ' ', ' ' || item_label_upper || ' ')"
        ") WHERE place = 1"
    )
    pages = (
        "flat AS (SELECT post_id, comment_id, author, text, CAST(created_utc AS DOUBLE) AS created_utc FROM comments "
        "UNION ALL SELECT post_id, 'r' || comment_id, author, 'I agree', CAST(created_utc + 1 AS DOUBLE) FROM comments)"
    )
    flat = _with(_COMMENTS, pages)
    return {
        "csv_roundtrip": clicks(
            f"SELECT {epoch} AS epoch, event_type, product_id, category_id, category_code, brand, price, user_id, "
            "user_session FROM clicks"
        ),
        "csv_dropmalformed": clicks(
            f"SELECT {seconds} AS event_time, event_type, CAST(product_id AS VARCHAR) AS product_id, "
            "CAST(category_id AS VARCHAR) AS category_id, category_code, brand, CAST(price AS VARCHAR) AS price, "
            "CAST(user_id AS VARCHAR) AS user_id, user_session FROM clicks WHERE event_id % 10 <> 0"
        ),
        "csv_rejects": clicks(
            "SELECT " + " || ',' || ".join(
                f"coalesce(CAST({c} AS VARCHAR), '')"
                for c in (seconds, "event_type", "product_id", "category_id", "category_code", "brand")
            )
            + " || ',' || CASE WHEN event_id % 10 = 3 THEN 'cheap' ELSE coalesce(CAST(price AS VARCHAR), '') END || ',' "
            "|| coalesce(CAST(user_id AS VARCHAR), '') || CASE WHEN event_id % 10 = 0 THEN '' "
            "ELSE ',' || coalesce(user_session, '') END AS line, "
            "CASE WHEN event_id % 10 = 0 THEN 'number of fields' ELSE 'unreadable value' END AS reason "
            "FROM clicks WHERE event_id % 10 IN (0, 3) "
            "UNION ALL SELECT CAST(count(*) AS VARCHAR) || ' ' || CAST(count(*) AS VARCHAR), 'good' FROM clicks "
            "WHERE event_id % 10 NOT IN (0, 3)"
        ),
        "parquet_roundtrip": clicks("SELECT * FROM clicks"),
        "convert_format": "SELECT * FROM events",
        "recursive_scan": clicks("SELECT * EXCLUDE (event_type) FROM clicks"),
        "staged_events": clicks(f"SELECT {staged}, '2024-Jan' AS period FROM clicks"),
        "staged_rerun": clicks(
            f"SELECT {staged}, '2024-Jan' AS period FROM clicks UNION ALL "
            f"SELECT {staged}, '2024-Feb' AS period FROM clicks WHERE event_type <> 'purchase'"
        ),
        "replace_period_empty": clicks(f"SELECT *, '2024-Jan' AS batch_processing FROM ({units_once})"),
        "catalog_table_scan": clicks(
            f"SELECT {epoch} AS epoch, event_type, CAST(product_id AS INT) AS product_id, category_id, category_code, brand, "
            "CAST(CAST(price AS DECIMAL(10, 2)) AS DOUBLE) AS price, user_id, user_session FROM clicks"
        ),
        "managed_text_table": clicks(
            f"SELECT {seconds} AS event_time, event_type, CAST(product_id AS VARCHAR) AS product_id, "
            "CAST(category_id AS VARCHAR) AS category_id, category_code, brand, "
            "CAST(CAST(price AS FLOAT) AS DOUBLE) AS price, CAST(user_id AS VARCHAR) AS user_id, user_session "
            "FROM clicks"
        ),
        "partitioned_by_category": clicks(
            f"SELECT {seconds} AS event_time, event_type, CAST(product_id AS VARCHAR) AS product_id, "
            "CAST(category_id AS VARCHAR) AS category_id, category_code, brand, "
            "CAST(CAST(price AS FLOAT) AS DOUBLE) AS price, CAST(user_id AS VARCHAR) AS user_id, user_session "
            "FROM clicks"
        ),
        "append_roundtrip": clicks(
            f"SELECT u.*, b.batch_processing FROM ({units_once}) u CROSS JOIN "
            "(VALUES ('2024-Jan'), ('2024-Feb'), ('2024-Feb')) b (batch_processing)"
        ),
        "overwrite_roundtrip": clicks(f"SELECT *, '2024-Feb' AS batch_processing FROM ({units_once})"),
        "replace_period_roundtrip": clicks(
            f"SELECT u.*, b.batch_processing FROM ({units_once}) u CROSS JOIN "
            "(VALUES ('2024-Jan'), ('2024-Feb')) b (batch_processing)"
        ),
        "parse_event_time": clicks(
            "SELECT event_id, CASE WHEN event_id % 15 <> 0 THEN " + epoch + " END AS epoch, "
            "CASE WHEN event_id % 15 <> 0 THEN CAST(event_time AS DATE) END AS event_date, "
            "CASE WHEN event_id % 15 <> 0 THEN CAST(hour(event_time) AS INT) END AS event_hour FROM clicks"
        ),
        "normalise_brand": clicks(
            "SELECT event_id, CASE WHEN brand IS NULL OR trim(brand) = '' THEN 'WITHOUT BRAND' "
            "ELSE upper(trim(brand)) END AS rank_brand_name FROM clicks"
        ),
        "normalise_category": clicks(
            "SELECT event_id, CASE WHEN category_code IS NULL OR trim(category_code) = '' THEN 'without category' "
            "ELSE category_code END AS rank_category_name, CASE WHEN category_code IS NULL OR trim(category_code) = '' "
            "THEN 'without category' ELSE split_part(category_code, '.', 1) END AS top_category_name FROM clicks"
        ),
        "purchase_events": clicks("SELECT * FROM clicks WHERE event_type = 'purchase'"),
        "cart_events": clicks(
            "SELECT event_time, event_type, product_id, brand, user_id FROM clicks WHERE event_type = 'cart'"
        ),
        "view_events": clicks(
            "SELECT CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INT) AS event_hour, event_type, "
            "product_id, user_id FROM clicks WHERE event_type = 'view'"
        ),
        "electronics_purchase_events": clicks("SELECT * EXCLUDE (brand_name, category_name) " + electronics),
        "category_revenue_rank": clicks(
            "SELECT category_name AS rank_category_name, round(sum(price), 4) AS total_revenue FROM bought GROUP BY 1"
        ),
        "category_revenue_rank_top_level": clicks(
            "SELECT split_part(category_name, '.', 1) AS rank_category_name, round(sum(price), 4) AS total_revenue "
            "FROM bought GROUP BY 1"
        ),
        "daily_sales_metrics": clicks(f"{daily}, '2024-Jan' AS batch_processing FROM bought GROUP BY 1"),
        "daily_metrics_join": clicks(f"{daily} FROM bought GROUP BY 1"),
        "brand_units_sold_rank": clicks(units_once),
        "brand_revenue_rank": clicks(
            "SELECT brand_name AS rank_brand_name, round(sum(price), 4) AS total_revenue, "
            "'2024-Jan' AS batch_processing FROM bought GROUP BY 1"
        ),
        "electronics_brand_units_rank": clicks(
            f"SELECT brand_name AS rank_brand_name, count(product_id) AS units_sold {electronics} GROUP BY 1"
        ),
        "distinct_user_sessions": clicks(
            "SELECT DISTINCT user_id, user_session FROM clicks WHERE user_id IS NOT NULL AND user_session IS NOT NULL"
        ),
        "site_visits_by_user": clicks(visits_by_user),
        "avg_site_visits_per_user": clicks(
            "SELECT round(avg(site_visit_count), 4) AS avg_site_visits_per_user, '2024-Jan' AS batch_processing "
            f"FROM ({visits_by_user})"
        ),
        "event_count_by_session": clicks(session_counts),
        "avg_events_per_session": clicks(
            "SELECT event_type, round(avg(events_count), 4) AS avg_events_per_session "
            f"FROM ({session_counts}) GROUP BY 1"
        ),
        "event_counts_by_user": clicks(
            "SELECT user_id, count(*) AS cart_event_count FROM clicks WHERE event_type = 'cart' GROUP BY 1"
        ),
        "cart_purchase_diff_by_user": clicks(diffs),
        "cart_purchase_diff_join": clicks(
            # The join drops no cart user; one without an id finds no partner.
            diffs
        ),
        "avg_cart_purchase_diff": clicks(
            f"SELECT round(avg(cart_purchase_count_diff), 4) AS avg_cart_purchase_count_diff FROM ({diffs})"
        ),
        "cart_conversion_rate": clicks(
            "SELECT c AS add_to_cart_num, p AS purchase_num, round(p / c * 100, 4) AS cart_conversion_rate FROM "
            "(SELECT count(*) FILTER (event_type = 'cart') AS c, count(*) FILTER (event_type = 'purchase') AS p "
            "FROM clicks)"
        ),
        "hourly_product_views": clicks(hourly),
        "avg_hourly_product_views": clicks(
            "SELECT event_hour, round(avg(hourly_product_views_count), 4) AS avg_hourly_product_views "
            f"FROM ({hourly}) GROUP BY 1"
        ),
        "brand_event_count": clicks(brand_counts),
        "brand_event_count_merge": clicks(brand_counts),
        "brand_points": points,
        "brand_points_published": points,
        "views_by_brand": clicks(
            'SELECT brand, count(*) AS "count" FROM clicks WHERE event_type = \'view\' GROUP BY 1'
        ),
        "views_by_brand_top20": clicks(
            'SELECT brand, count(*) AS "count" FROM clicks WHERE event_type = \'view\' GROUP BY 1 '
            'ORDER BY "count" DESC, brand ASC NULLS FIRST LIMIT 20'
        ),
        "event_counts_by_brand": clicks(
            "SELECT brand, count(*) AS view_events_count FROM clicks WHERE event_type = 'view' GROUP BY 1"
        ),
        "published_once": popular(
            " UNION ALL ".join(
                (
                    shaped("category_revenue_rank", "category_name", ["sum(price)"], "bought GROUP BY category_name"),
                    shaped(
                        "daily_revenue_and_units_sold_02",
                        "CAST(event_time AS DATE)",
                        ["avg(price)", "count(product_id)"],
                        "bought WHERE event_time IS NOT NULL GROUP BY CAST(event_time AS DATE)",
                    ),
                    shaped("brand_units_sold_rank", "brand_name", ["count(product_id)"], "bought GROUP BY brand_name"),
                    shaped("brand_revenue_rank", "brand_name", ["sum(price)"], "bought GROUP BY brand_name"),
                    shaped("avg_site_visits_per_user", "NULL", ["avg(site_visit_count)"], f"({visits_by_user})"),
                    shaped(
                        "avg_events_per_session_by_event_type",
                        "event_type",
                        ["avg(events_count)"],
                        f"({session_counts}) GROUP BY event_type",
                    ),
                    shaped("avg_cart_purchase_count_diff", "NULL", ["avg(cart_purchase_count_diff)"], f"({diffs})"),
                    shaped(
                        "avg_hourly_product_views_08",
                        "event_hour",
                        ["avg(hourly_product_views_count)"],
                        f"({hourly}) GROUP BY event_hour",
                    ),
                    shaped(
                        "electronics_brand_units_sold_rank_09",
                        "brand_name",
                        ["count(product_id)"],
                        f"(SELECT * {electronics}) GROUP BY brand_name",
                    ),
                    shaped(
                        "long_term_brand_popularity_index_10",
                        "brand",
                        [
                            "long_term_brand_popularity_index",
                            "view_events_count",
                            "cart_events_count",
                            "purchase_events_count",
                        ],
                        "popularity",
                    ),
                )
            )
        ),
        "brand_popularity_monthly": popular(
            "SELECT *, '2024-Jan' AS batch_processing, '2024-Jan' AS data_period FROM popularity"
        ),
        "brand_popularity_by_period": clicks(
            f"SELECT {third} AS period, coalesce(brand, 'unknown_brand') AS brand, "
            "count(*) FILTER (event_type = 'view') AS view_events_count, "
            "count(*) FILTER (event_type = 'cart') AS cart_events_count, "
            "count(*) FILTER (event_type = 'purchase') AS purchase_events_count, "
            "CAST(sum(CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 ELSE 10 END) AS BIGINT) "
            "AS long_term_brand_popularity_index "
            "FROM clicks WHERE event_type IN ('view', 'cart', 'purchase') GROUP BY 1, 2"
        ),
        "brand_popularity_full_join": clicks(
            "SELECT coalesce(brand, 'unknown_brand') AS brand, coalesce(v.n, 0) AS view_events_count, "
            "coalesce(c.n, 0) AS cart_events_count, coalesce(p.n, 0) AS purchase_events_count, "
            "coalesce(v.n, 0) + 2 * coalesce(c.n, 0) + 10 * coalesce(p.n, 0) AS long_term_brand_popularity_index, "
            "'2024-Jan' AS batch_processing, '2024-Jan' AS data_period "
            f"FROM ({by_type.format('view')}) v FULL JOIN ({by_type.format('cart')}) c USING (brand) "
            f"FULL JOIN ({by_type.format('purchase')}) p USING (brand)"
        ),
        "brand_popularity_total": popular(
            "SELECT brand, long_term_brand_popularity_index AS total_long_term_brand_popularity_index FROM popularity"
        ),
        "sale_brand_revenue_rank": sold(
            "SELECT upper(trim(brand)) AS rank_brand_name, round(sum(price), 2) AS total_revenue FROM sold GROUP BY 1"
        ),
        "sale_category_revenue_rank": sold(
            "SELECT category_code AS rank_category_name, round(sum(price), 2) AS total_revenue FROM sold GROUP BY 1"
        ),
        "sale_daily_metrics": sold(f"{daily} FROM sold GROUP BY 1"),
        "sale_visits_per_user": sold(
            "SELECT round(count(*) / count(DISTINCT user_id), 4) AS avg_site_visits_per_user "
            "FROM (SELECT DISTINCT user_id, l_orderkey FROM sold)"
        ),
        "sale_popularity_by_period": sold(
            "SELECT strftime(event_time, '%Y-%m') AS period, brand, CAST(0 AS BIGINT) AS view_events_count, "
            "CAST(0 AS BIGINT) AS cart_events_count, count(*) AS purchase_events_count, "
            "10 * count(*) AS long_term_brand_popularity_index FROM sold GROUP BY 1, 2"
        ),
        "parse_comments": said("SELECT * FROM comments"),
        "ingest_partitions": said(
            "SELECT comment_id, created_utc AS ingest_epoch, strftime(t, '%Y-%m-%d') AS ingest_date, "
            "strftime(t, '%H-%M-%S') AS ingest_time FROM "
            "(SELECT comment_id, created_utc, make_timestamp(created_utc * 1000000) AS t FROM comments)"
        ),
        "catalog_normalise": said("SELECT * FROM catalogue"),
        "catalogue_csv_scan": said("SELECT * FROM catalogue"),
        # CSV has no empty text beside null.
        "stream_archive": said(
            "SELECT post_id, comment_id, author, nullif(text, '') AS text, created_utc, TRUE AS filed_in_utc FROM comments"
        ),
        "archive_compacted": said("SELECT post_id, comment_id, author, nullif(text, '') AS text, created_utc FROM comments"),
        "points_ledger": streamed,
        "live_total_folded": streamed,
        "stream_match_stateless": match,
        "stream_brand_points": streamed,
        "stream_brand_points_by_position": streamed,
        "document_label_match": _DOCUMENT_MATCH,
        "comment_brand_match": match,
        "comment_brand_match_by_position": match,
        "comment_brand_match_salted": match,
        "comment_brand_match_whole_words": whole_words,
        "comment_brand_match_by_words": whole_words,
        "comment_brand_points": said(
            "SELECT matched_brand AS brand, CAST(10 AS BIGINT) AS total_long_term_brand_popularity_index FROM matched"
        ),
        "comment_brand_points_total": said(
            "SELECT matched_brand AS brand, 10 * count(*) AS total_long_term_brand_popularity_index "
            "FROM matched GROUP BY 1"
        ),
        "combined_brand_popularity": _with(_CLICKS, _POPULARITY, _COMMENTS)(
            "SELECT brand, CAST(sum(n) AS BIGINT) AS total_long_term_brand_popularity_index FROM ("
            "SELECT brand, long_term_brand_popularity_index AS n FROM popularity "
            "UNION ALL SELECT matched_brand, 10 FROM matched) GROUP BY 1"
        ),
        "flatten_listing": flat("SELECT * FROM flat"),
        "incremental_since": flat("SELECT * FROM flat WHERE created_utc > 1704070000"),
        "incremental_by_maximum": flat(
            "SELECT *, CASE WHEN created_utc < 1704070000 OR (created_utc = 1704070000 AND starts_with(comment_id, 'c')) "
            "THEN 1 ELSE 2 END AS run FROM flat"
        ),
        **(llm.SQL if llm else {}),
    }
