"""Date, hour and month of an event in UTC, whatever the session time zone is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlens.functions.cleaning import parse_event_time


def _epoch_or_wall(events: DataFrame, column: str) -> tuple[Column | None, Column | None]:
    kind = events.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return None, F.col(column)
    if isinstance(kind, T.StringType):
        return F.unix_seconds(parse_event_time(F.col(column))), None
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(F.col(column)), None
    raise TypeError(f"{column} must be a timestamp or its text, not {kind.simpleString()}")


def event_date(events: DataFrame, column: str = "event_time") -> Column:
    epoch, wall = _epoch_or_wall(events, column)
    if wall is not None:
        return F.to_date(wall)
    return F.date_from_unix_date(F.floor(epoch / 86400).cast("int"))


def event_hour(events: DataFrame, column: str = "event_time") -> Column:
    epoch, wall = _epoch_or_wall(events, column)
    if wall is not None:
        return F.hour(wall)
    return F.floor(F.pmod(epoch, F.lit(86400)) / 3600).cast("int")


def event_month(events: DataFrame, column: str = "event_time") -> Column:
    """The calendar month as ``2020-04``, the usual period of a metric."""
    return F.substring(event_date(events, column).cast("string"), 1, 7)
