"""Result tables in a database, written by the executors through JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """A database. User and password come from the caller or the environment, never from code."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    table_options: str | None = None
    """What the database wants after the column list of a new table, if anything."""
    connections: int = 16
    """Upper bound on tasks that write at the same time."""

    @classmethod
    def from_environment(cls, url: str, driver: str, **rest) -> JdbcTarget:
        return cls(url, driver, os.environ.get("JDBC_USER"), os.environ.get("JDBC_PASSWORD"), **rest)

    def options(self, table: str) -> dict[str, str]:
        given = {
            "url": self.url,
            "dbtable": table,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "createTableOptions": self.table_options,
            "numPartitions": str(self.connections),
        }
        return {name: value for name, value in given.items() if value is not None}


def write_jdbc(
    frame: DataFrame, table: str, target: JdbcTarget, *, mode: str = "append", truncate: bool = False
) -> None:
    """``append`` adds rows; ``overwrite`` replaces the table, or with ``truncate`` its rows only."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"a JDBC table takes append or overwrite, not {mode!r}")
    writer = frame.write.format("jdbc").options(**target.options(table))
    if truncate:
        writer = writer.option("truncate", "true")
    writer.mode(mode).save()


def read_jdbc(spark: SparkSession, table: str, target: JdbcTarget) -> DataFrame:
    """A table of the database."""
    return spark.read.format("jdbc").options(**target.options(table)).load()
