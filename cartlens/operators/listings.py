"""Comment messages, listing pages and the incremental filter between collection runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from cartlens.schema import COMMENT_DDL, COMMENT_KIND, LISTING_DDL


def parse_comments(messages: DataFrame, *, value: str = "value", lenient_time: bool = True) -> DataFrame:
    """JSON messages (text or bytes) as comment columns; a message that is no JSON gives a row of nulls.

    Producers may write ``created_utc`` as a whole or a decimal number. Read as BIGINT a decimal would be
    lost, so it is read as DOUBLE and cut to seconds; ``lenient_time=False`` reads whole numbers only.
    """
    ddl = COMMENT_DDL.replace("created_utc BIGINT", "created_utc DOUBLE") if lenient_time else COMMENT_DDL
    parsed = messages.select(F.from_json(F.col(value).cast("string"), ddl).alias("data")).select("data.*")
    return parsed.withColumn("created_utc", F.col("created_utc").try_cast("long")) if lenient_time else parsed


def with_ingest_columns(comments: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the time of arrival and the date and second it is filed under, in UTC whatever the session's zone."""
    timed = comments.withColumn("ingest_ts", F.current_timestamp() if at is None else at)
    if isinstance(timed.schema["ingest_ts"].dataType, TimestampNTZType):
        wall = F.col("ingest_ts")
    else:
        wall = F.expr("timestampadd(MICROSECOND, unix_micros(ingest_ts), TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    text = wall.cast("string")  # as in 2020-04-01 22:13:05, perhaps with a fraction
    second = F.translate(F.substring(text, 12, 8), ":", "-")
    return timed.withColumns({"ingest_date": F.substring(text, 1, 10), "ingest_time": second})


def flatten_listing(pages: DataFrame, *, post_id: str = "post_id", page: str = "page") -> DataFrame:
    """Comments of JSON listing pages: the comments among the children in the second element of each page."""
    second = F.get(F.from_json(F.col(page), LISTING_DDL), F.lit(1))
    children = pages.select(F.col(post_id).alias("post_id"), F.explode(second["data"]["children"]).alias("child"))
    return children.where(F.col("child.kind") == COMMENT_KIND).select(
        "post_id",
        F.col("child.data.id").alias("comment_id"),
        F.col("child.data.author").alias("author"),
        F.col("child.data.body").alias("text"),
        F.col("child.data.created_utc").alias("created_utc"),
    )


def since(comments: DataFrame, mark: float | None) -> DataFrame:
    """Comments made after the mark; all of them when there is no mark yet."""
    return comments.where(F.col("created_utc") > F.lit(0.0 if mark is None else float(mark)))
