"""Archived comments in few files, while the archive goes on.

The archive has a folder per second of arrival, each with small files. Compaction rewrites the closed folders (all
before the newest, which a batch may still add to) as one Parquet version, filed by day, and then appends a row to a
manifest: the version, and the second up to which it goes. Readers take the versions of the manifest and, of the
archive itself, only the folders behind the last one; so they see each comment once, before, during and after a
compaction. A version without its manifest row counts for nothing and is replaced by the next attempt. The folders
that are in a version may be removed by the archive's owner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cartlens.sinks.files import write_files
from cartlens.sources.comments import read_archive
from cartlens.sources.files import read_or_empty

_MANIFEST = "version BIGINT, through_date STRING, through_time STRING"


def _manifest(spark: SparkSession, compacted: str) -> list[Row]:
    """A row for each version, oldest first."""
    return read_or_empty(spark, f"{compacted}/manifest", _MANIFEST).orderBy("version").collect()


def _second(date: str, time: str, operator: str) -> Column:
    """Folders behind (``>``) or before (``<``) a second, in a form that prunes folders."""
    day, second = F.col("ingest_date"), F.col("ingest_time")
    if operator == ">":
        return (day > F.lit(date)) | ((day == F.lit(date)) & (second > F.lit(time)))
    return (day < F.lit(date)) | ((day == F.lit(date)) & (second < F.lit(time)))


def _not_compacted(spark: SparkSession, archive: str, versions: list[Row]) -> DataFrame:
    rows = read_archive(spark, archive)
    return rows.where(_second(versions[-1].through_date, versions[-1].through_time, ">")) if versions else rows


def compact_archive(spark: SparkSession, archive: str, compacted: str) -> int:
    """Rewrite what is closed and not yet rewritten. Returns the number of versions."""
    base = compacted.rstrip("/")
    versions = _manifest(spark, base)
    rows = _not_compacted(spark, archive, versions)
    filed = F.struct("ingest_date", "ingest_time")
    newest = rows.agg(F.max(filed).alias("at")).first().at
    if newest is None:
        return len(versions)
    closed = rows.where(_second(newest.ingest_date, newest.ingest_time, "<"))
    last = closed.agg(F.max(filed).alias("at")).first().at
    if last is None:
        return len(versions)
    version = len(versions)
    # Gathered by day and split where a day is large: a file per day and task at most.
    write_files(closed.hint("rebalance", "ingest_date"), f"{base}/version-{version}", partition_by=["ingest_date"])
    entry = {"version": F.lit(version).cast("long"), "through_date": F.lit(last.ingest_date)}
    entry["through_time"] = F.lit(last.ingest_time)
    row = spark.range(1).select(*(value.alias(name) for name, value in entry.items()))
    write_files(row, f"{base}/manifest", mode="append")
    return version + 1


def read_compacted(spark: SparkSession, archive: str, compacted: str) -> DataFrame:
    """All archived comments: the versions, and what the archive has behind them."""
    base = compacted.rstrip("/")
    versions = _manifest(spark, base)
    rest = _not_compacted(spark, archive, versions)
    parts = [spark.read.schema(rest.schema).parquet(f"{base}/version-{v.version}") for v in versions]
    return reduce(DataFrame.unionByName, parts, rest)
