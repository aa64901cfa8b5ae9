"""How far a collection job has taken comments, kept between its runs: the time a run started, or the latest time
of a comment taken together with the comments taken at that very time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.sinks.files import write_files
from cartlens.sources.files import read_or_empty

_DDL = "mark DOUBLE"


def load_mark(spark: SparkSession, base: str) -> float:
    """The latest kept time, in seconds since 1970; 0 before the first run has finished."""
    return read_or_empty(spark, base, _DDL).agg(F.max("mark")).first()[0] or 0.0


def save_mark(spark: SparkSession, base: str, run_start: float) -> None:
    """Keep the time at which a run started, once its comments are written. Comments made while it ran are
    then taken by the next run. Each run adds its mark, so the one before counts until this one is written."""
    mark = spark.range(1).selectExpr(f"CAST({run_start!r} AS DOUBLE) AS mark")
    write_files(mark.coalesce(1), base, mode="append")


_TAKEN_DDL = "created_utc DOUBLE, comment_id STRING"


def _latest_taken(spark: SparkSession, base: str) -> tuple[float | None, DataFrame]:
    """The latest time of a comment taken, and the ids of all that were taken at it."""
    taken = read_or_empty(spark, base, _TAKEN_DDL)
    latest = taken.agg(F.max("created_utc")).first()[0]
    return latest, taken.where(F.col("created_utc") == F.lit(latest)).select("comment_id").distinct()


def not_taken(comments: DataFrame, base: str) -> DataFrame:
    """Comments made after the latest one taken, and those of the same time that were not there yet.

    Times have whole seconds, so a second may still get comments when a run has taken some of it. Ids are
    compared for that second only. Comments without a time are never taken.
    """
    latest, ids = _latest_taken(comments.sparkSession, base)
    timed = comments.where(F.col("created_utc").isNotNull())
    if latest is None:
        return timed
    same = timed.where(F.col("created_utc") == F.lit(latest)).join(ids, "comment_id", "left_anti")
    return timed.where(F.col("created_utc") > F.lit(latest)).unionByName(same.select(*comments.columns))


def save_taken(comments: DataFrame, base: str) -> None:
    """Keep what was taken, once it is written: the latest time, and the ids at it. A run that took nothing
    changes nothing; one that is saved again adds what is there already."""
    latest = comments.agg(F.max("created_utc")).first()[0]
    if latest is not None:
        at = comments.where(F.col("created_utc") == F.lit(latest))
        rows = at.select(F.col("created_utc").cast("double").alias("created_utc"), "comment_id")
        write_files(rows.hint("rebalance"), base, mode="append")
