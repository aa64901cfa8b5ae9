"""Parquet, CSV and other file datasets, whole or one period at a time."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartlens.schema import STAGED_EVENT_DDL

# A blank or padded name must come back as it was; the CSV writer trims unless told not to.
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
MODES = ("append", "overwrite", "replace_period")


def _folder_name(value: object) -> str:
    """The value as it stands in a partition's folder, if Spark spells it there as it is."""
    if not re.fullmatch(r"[\w .,+-]+", str(value)):
        raise ValueError(f"a period may hold letters, digits and _ . , + - only, not {value!r}")
    return str(value)


def write_files(
    frame: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    period_column: str = "batch_processing",
    periods: Sequence[object] | None = None,
) -> None:
    """Write a result.

    ``append`` adds rows, also when the same period is published again. ``overwrite`` leaves this result
    only. ``replace_period`` files rows under their period. With ``periods``, each of these is replaced as a
    whole, also by nothing, so a rerun leaves what the last run made; without, those present in the result
    are replaced, and only in the folders it has rows for. Other periods stay.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "replace_period" and periods is not None:
        for period in periods:
            folder = f"{path.rstrip('/')}/{period_column}={_folder_name(period)}"
            rows = frame.where(F.col(period_column) == F.lit(period)).drop(period_column)
            write_files(rows, folder, fmt=fmt, partition_by=[c for c in partition_by if c != period_column])
        return
    writer = frame.write.format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    folders = list(partition_by)
    if mode == "replace_period":
        folders = [period_column, *(c for c in folders if c != period_column)]
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.mode("append" if mode == "append" else "overwrite").save(path)


def convert_format(spark: SparkSession, source: str, source_fmt: str, target: str, target_fmt: str) -> None:
    """Copy a dataset into another format. ``avro`` works where its Spark module is on the classpath."""
    write_files(spark.read.format(source_fmt).load(source), target, fmt=target_fmt)


def stage_events(events: DataFrame, path: str, period: str) -> None:
    """Keep one period's events as Parquet, filed by period and event type; what was kept of the period goes.

    Metrics then read only the types and columns they use instead of parsing the text again. Rows stay in
    the task that read them: no shuffle, and no task that must take a whole period or type. Columns are cast
    to the staged types (null where that fails), so what is kept can always be read.
    """
    labelled = events.withColumn("period", F.lit(period))
    staged = StructType.fromDDL(STAGED_EVENT_DDL)
    typed = labelled.select(*(labelled[f.name].try_cast(f.dataType).alias(f.name) for f in staged))
    write_files(
        typed, path, mode="replace_period", partition_by=["event_type"], period_column="period", periods=[period]
    )
