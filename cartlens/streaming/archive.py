"""Keep every comment message as it arrives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cartlens.operators.listings import parse_comments, with_ingest_columns
from cartlens.sinks.files import CSV_OPTIONS


def archive_comments(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = ("ingest_date", "ingest_time"),
    trigger: dict | None = None,
    value: str = "value",
) -> StreamingQuery:
    """Append parsed messages to CSV files, filed by date and second of arrival.

    The time of arrival is that of the micro-batch, so filing by second makes one folder per batch; pass
    ``("ingest_date",)`` for fewer. A restart goes on where the checkpoint stopped.
    """
    rows = with_ingest_columns(parse_comments(messages, value=value))
    return (
        rows.writeStream.format("csv")
        .options(**CSV_OPTIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .partitionBy(*partition_by)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
