"""The running total of live points: a snapshot, and the batches since.

Points lie in one folder per micro-batch, for ever more of them. Folding adds the closed batches (all but the newest,
which may run again) to the last snapshot and stores the sum as the next one. A mark names the snapshot that counts,
and is written last: a fold that fails leaves the one before in force, and is repeated as a whole. Readers add the
batches behind the mark to the snapshot, so a total reads as many folders as came since the last fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.operators.brands import TOTAL_INDEX
from cartlens.sinks.files import write_files
from cartlens.sources.files import read_or_empty

_POINTS = f"brand STRING, {TOTAL_INDEX} BIGINT"
_MARK = "through BIGINT"


def _through(spark: SparkSession, snapshots: str) -> int:
    """The last batch that the snapshot in force holds; -1 before the first."""
    last = read_or_empty(spark, f"{snapshots}/marks", _MARK).agg(F.max("through")).first()[0]
    return -1 if last is None else last


def _since(spark: SparkSession, points: str, snapshots: str) -> tuple[DataFrame, DataFrame]:
    """The snapshot in force, and the points of later batches (with ``batch``)."""
    through = _through(spark, snapshots)
    snapshot = read_or_empty(spark, f"{snapshots}/totals/through={through}", _POINTS).select("brand", TOTAL_INDEX)
    later = read_or_empty(spark, points, f"{_POINTS}, batch BIGINT").where(F.col("batch") > through)
    return snapshot, later.select("brand", F.col(TOTAL_INDEX).cast("long").alias(TOTAL_INDEX), "batch")


def _summed(*parts: DataFrame) -> DataFrame:
    first, second = parts
    every = first.unionByName(second.select("brand", TOTAL_INDEX))
    return every.groupBy("brand").agg(F.sum(TOTAL_INDEX).alias(TOTAL_INDEX))


def live_total(spark: SparkSession, points: str, snapshots: str) -> DataFrame:
    """Points per brand over all batches, largest first."""
    return _summed(*_since(spark, points, snapshots.rstrip("/"))).orderBy(F.desc(TOTAL_INDEX), F.asc("brand"))


def fold_live_total(spark: SparkSession, points: str, snapshots: str) -> int:
    """Fold the closed batches into a new snapshot. Returns the last batch that it holds, -1 for none."""
    base = snapshots.rstrip("/")
    snapshot, later = _since(spark, points, base)
    newest = later.agg(F.max("batch")).first()[0]
    closed = later if newest is None else later.where(F.col("batch") < newest)
    last = closed.agg(F.max("batch")).first()[0]
    if last is None:
        return _through(spark, base)
    total = _summed(snapshot, closed).withColumn("through", F.lit(last))
    write_files(total, f"{base}/totals", mode="replace_period", period_column="through", periods=[last])
    write_files(spark.range(1).select(F.lit(last).cast("long").alias("through")), f"{base}/marks", mode="append")
    return last
