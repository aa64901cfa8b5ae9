"""CSV and Parquet datasets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions import parse_event_time
from cartlens.schema import RAW_EVENT_DDL, STAGED_EVENT_DDL, TEXT_EVENT_DDL
from cartlens.sinks.files import write_files

_LINE = "_line"
GOOD, WRONG_FIELDS, WRONG_VALUE = "good", "number of fields", "unreadable value"


def read_event_csv(spark: SparkSession, path: str, *, parse_time: bool = True) -> DataFrame:
    """Events from CSV with a header. Unreadable fields become null, and so do empty ones."""
    events = spark.read.schema(RAW_EVENT_DDL).csv(path, header=True, mode="PERMISSIVE")
    return events.withColumn("event_time", parse_event_time(F.col("event_time"))) if parse_time else events


def route_event_csv(spark: SparkSession, path: str | list[str], stored: str) -> tuple[DataFrame, DataFrame]:
    """Parse once, and keep good rows and rejected lines apart under ``stored``. Returns both as they are kept.

    Rejected are lines with a wrong number of fields and lines of which a field cannot be read as its type; a reject
    is the whole line and the reason. Column pruning is off for the parse, and both results are read back from what
    it stored, so neither rows nor counts depend on the columns asked for later. Times stay text here and are parsed
    in the good rows, null where unreadable, as ``read_event_csv`` does.
    """
    parsed = (
        spark.read.schema(f"{RAW_EVENT_DDL}, {_LINE} STRING")
        .option("columnNameOfCorruptRecord", _LINE)
        .option("columnPruning", False)
        .csv(path, header=True, mode="PERMISSIVE")
    )
    # As text, every field can be read: what is still wrong then is their number.
    as_text = F.from_csv(_LINE, f"{TEXT_EVENT_DDL}, _wrong STRING", {"columnNameOfCorruptRecord": "_wrong"})
    reason = F.when(F.col(_LINE).isNull(), GOOD).when(as_text["_wrong"].isNotNull(), WRONG_FIELDS).otherwise(WRONG_VALUE)
    write_files(parsed.withColumn("outcome", reason), stored, partition_by=["outcome"])
    kept = spark.read.schema(f"{RAW_EVENT_DDL}, {_LINE} STRING, outcome STRING").parquet(stored)
    good = kept.where(F.col("outcome") == GOOD).drop("outcome", _LINE)
    rejects = kept.where(F.col("outcome") != GOOD).select(F.col(_LINE).alias("line"), F.col("outcome").alias("reason"))
    return good.withColumn("event_time", parse_event_time(F.col("event_time"))), rejects


def read_period(spark: SparkSession, raw_folder: str, period: str) -> DataFrame:
    """The raw file of one period, ``<folder>/<period>.csv``."""
    return read_event_csv(spark, f"{raw_folder.rstrip('/')}/{period}.csv")


def read_staged_events(spark: SparkSession, path: str, *periods: str) -> DataFrame:
    """Events kept by ``stage_events``: all periods, or those named. The schema is given, so that no period
    or type is taken for a number because of its spelling."""
    events = spark.read.schema(STAGED_EVENT_DDL).parquet(path)
    return events.where(F.col("period").isin(*periods)) if periods else events


def read_text_event_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Events as nine strings; lines with a wrong number of fields are dropped.

    Column pruning is off for this read: with it a line's fate depends on the columns a query asks for,
    and counts would include lines that a full read drops.
    """
    return (
        spark.read.schema(TEXT_EVENT_DDL)
        .option("columnPruning", False)
        .csv(path, header=True, mode="DROPMALFORMED")
    )


def read_catalogue_csv(spark: SparkSession, path: str) -> DataFrame:
    """A label catalogue: text columns named by the header, of which two are used."""
    return spark.read.csv(path, header=True).select("item_label", "brand")


def read_recursive(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """Every file below a folder, whatever the folders between are called."""
    return spark.read.format(fmt).option("recursiveFileLookup", True).load(folder)


def read_or_empty(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A Parquet dataset, or no rows when the path does not exist yet. Other failures are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)
