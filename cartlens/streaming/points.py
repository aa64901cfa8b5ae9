"""Award points to brands whose labels appear in comments, as the comments arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlens.operators.brands import TOTAL_INDEX
from cartlens.operators.labels import Matcher, comment_points, match_labels
from cartlens.operators.listings import parse_comments
from cartlens.sinks.files import write_files
from cartlens.sinks.jdbc import JdbcTarget, write_jdbc
from cartlens.sinks.ledger import Ledger
from cartlens.sources.files import read_or_empty

BatchWriter = Callable[[DataFrame, int], None]
_POINTS_DDL = f"brand STRING, {TOTAL_INDEX} BIGINT"


def parquet_points(path: str) -> BatchWriter:
    """Write each batch under its number: a batch that is run again replaces itself.

    Numbers belong to a checkpoint, so a stream with a new checkpoint needs a new path.
    """

    def write(points: DataFrame, batch: int) -> None:
        # Points are few and small: gather them, or every batch would leave a file per task.
        numbered = points.withColumn("batch", F.lit(batch).cast("long")).hint("rebalance")
        write_files(numbered, path, mode="replace_period", period_column="batch", periods=[batch])

    def clear(points: DataFrame, batch: int) -> None:
        """A batch that finds nothing when it is run again takes back what it had found."""
        folder = f"{path.rstrip('/')}/batch={batch}"
        if not read_or_empty(points.sparkSession, folder, _POINTS_DDL).isEmpty():
            write(points, batch)

    write.on_empty = clear
    return write


def ledger_points(ledger: Ledger) -> BatchWriter:
    """Append to a table, each batch once, however often it runs or where it fails."""

    def write(points: DataFrame, batch: int) -> None:
        ledger.append_once(points, batch)

    return write


def jdbc_points(table: str, target: JdbcTarget) -> BatchWriter:
    """Append to a table. A batch that fails half-way may be written again; ``ledger_points`` counts it once."""

    def write(points: DataFrame, batch: int) -> None:
        write_jdbc(points, table, target, mode="append")

    return write


def stream_brand_points(
    messages: DataFrame,
    matcher: Matcher,
    write: BatchWriter,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    value: str = "value",
) -> StreamingQuery:
    """Match each micro-batch against the catalogue and hand its points to the writer.

    Batches without a match are not written; a writer that replaces batches clears one written before. The checkpoint is required: without one a restart would
    award all earlier points again. The batch is fetched and parsed once, and counting matches it once, in as
    many tasks as it has partitions; the write, which may use fewer, then finds the points in storage.
    """

    on_empty = getattr(write, "on_empty", None)

    def run(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        points = comment_points(match_labels(batch, matcher)).persist()
        try:
            if points.count() > 0:
                write(points, number)
            elif on_empty is not None:
                on_empty(points, number)
        finally:
            points.unpersist()
            batch.unpersist()

    return (
        parse_comments(messages, value=value)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
