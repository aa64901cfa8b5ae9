"""Catalog databases and tables over event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartlens.schema import EVENT_COLUMNS, TABLE_EVENT_DDL, TEXT_EVENT_DDL


# Names must come back with their blanks; the CSV writer behind a table trims unless told not to.
_CSV = "OPTIONS (header 'true', ignoreLeadingWhiteSpace 'false', ignoreTrailingWhiteSpace 'false')"


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def create_external_csv_table(spark: SparkSession, name: str, location: str, ddl: str = TABLE_EVENT_DDL) -> None:
    """A table over CSV files with a header line that already lie in ``location``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING csv {_CSV} LOCATION {_quoted(location)}")


def create_managed_text_table(spark: SparkSession, name: str) -> None:
    """An empty delimited-text table; its price is FLOAT and all else is text."""
    ddl = TEXT_EVENT_DDL.replace("price STRING", "price FLOAT")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING csv {_CSV}")


def create_category_partitioned_table(spark: SparkSession, name: str) -> None:
    """As the text table, one folder per category code; load it with ``insert_events``."""
    ddl = TEXT_EVENT_DDL.replace("price STRING", "price FLOAT")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING csv {_CSV} PARTITIONED BY (category_code)")


def insert_events(events: DataFrame, name: str) -> None:
    """Append events, cast to the table's types (null where that fails), each row to its partition if any.

    Rows of a partition are gathered first, else every task would write a file into every partition. AQE
    splits the gathering of a partition that holds a large share of the rows.
    """
    spark = events.sparkSession
    target = spark.table(name)
    rows = events.select(*(events[field.name].try_cast(field.dataType).alias(field.name) for field in target.schema))
    folders = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    (rows.hint("rebalance", *folders) if folders else rows).write.insertInto(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*EVENT_COLUMNS)
