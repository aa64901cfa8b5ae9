"""Rows of numbered batches that count once, in tables that can only be appended to.

A batch's rows go to a staging table under its number and a new attempt; when all are there, one row in a commit table
names the attempt. What readers see are the rows of each batch's committed attempt. So a batch that fails between the
two leaves rows that nobody sees, one that is run again after its commit adds nothing, and of two attempts that both
commit only one counts. This needs neither transactions nor updates, and holds for a database written by many tasks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.sinks.files import write_files
from cartlens.sinks.jdbc import JdbcTarget, read_jdbc, write_jdbc
from cartlens.sources.files import read_or_empty

_COMMIT = "stream STRING, batch BIGINT, attempt STRING"


class Tables(Protocol):
    """Where the tables are: something to append to and to read from. A table that isn't there has no rows."""

    def append(self, frame: DataFrame, table: str) -> None: ...

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame: ...


@dataclass(frozen=True)
class FileTables:
    """Parquet datasets in one folder."""

    folder: str

    def append(self, frame: DataFrame, table: str) -> None:
        write_files(frame, f"{self.folder.rstrip('/')}/{table}", mode="append")

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        return read_or_empty(spark, f"{self.folder.rstrip('/')}/{table}", ddl)


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a database."""

    target: JdbcTarget

    def append(self, frame: DataFrame, table: str) -> None:
        write_jdbc(frame, table, self.target, mode="append")

    def read(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        # Appending no rows makes the table where it is missing.
        self.append(spark.createDataFrame([], ddl), table)
        return read_jdbc(spark, table, self.target)


@dataclass(frozen=True)
class Ledger:
    """A table of rows by batch. ``stream`` tells apart streams whose batch numbers begin anew."""

    tables: Tables
    name: str
    ddl: str
    """The columns of its rows."""
    stream: str = ""

    @property
    def _staged(self) -> str:
        return f"{self.name}_staged"

    @property
    def _commits(self) -> str:
        return f"{self.name}_commits"

    def is_committed(self, spark: SparkSession, batch: int) -> bool:
        commits = self.tables.read(spark, self._commits, _COMMIT)
        mine = (F.col("batch") == F.lit(batch)) & (F.col("stream") == F.lit(self.stream))
        return not commits.where(mine).isEmpty()

    def append_once(self, rows: DataFrame, batch: int) -> bool:
        """Add a batch's rows, unless they were added before. Tells whether they were added now."""
        spark = rows.sparkSession
        if self.is_committed(spark, batch):
            return False
        key = {"stream": F.lit(self.stream), "batch": F.lit(batch).cast("long"), "attempt": F.lit(uuid.uuid4().hex)}
        self.tables.append(rows.withColumns(key), self._staged)
        self.tables.append(spark.range(1).select(*(value.alias(name) for name, value in key.items())), self._commits)
        return True

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of all committed batches, with ``stream`` and ``batch``."""
        commits = self.tables.read(spark, self._commits, _COMMIT)
        counted = commits.groupBy("stream", "batch").agg(F.min("attempt").alias("attempt"))
        staged = self.tables.read(spark, self._staged, f"{self.ddl}, {_COMMIT}")
        return staged.join(counted, ["stream", "batch", "attempt"]).drop("attempt")
