"""Comment messages as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cartlens.schema import COMMENT_DDL


def kafka_options(servers: str, topic: str, *, starting: str = "latest", max_offsets: int | None = None) -> dict:
    """Options of the Kafka source. ``max_offsets`` bounds the first batch after a long stop."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def message_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Messages with a ``value`` column: ``kafka``, or ``text`` for files of one JSON message a line."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.load(path) if path else reader.load()).select("value")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived comments. Texts may hold line breaks, so a file is read as a whole; files are one task's
    share of one micro-batch."""
    ddl = f"{COMMENT_DDL}, ingest_ts TIMESTAMP, ingest_date STRING, ingest_time STRING"
    return spark.read.schema(ddl).csv(path, header=True, multiLine=True)
