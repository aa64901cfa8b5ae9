"""Small helpers of the operators: files in the shared folder, maps over Arrow batches, split of the rows by id."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: ``spark.checkpoint.dir``, or the warehouse
    where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/cartlens-llm/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: what follows doesn't compute them anew, and a
    lost executor costs only its own tasks."""
    path = shared_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


# Workers give large arrays back to the system when these are freed, rather than keep what their largest task needed.
_WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(8 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(32 << 20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def find_package(spark: SparkSession) -> None:
    """Let the workers of a session on this machine import the package where it isn't installed; on a cluster
    it is sent along (``--py-files``). Python workers get the settings of their memory."""
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    for name, value in _WORKER_MEMORY.items():
        environment.setdefault(name, value)


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int = 4 << 20) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of at most so many bytes, or one row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def map_batches(
    frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """Apply a function to each Arrow batch."""
    find_package(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return frame.mapInArrow(run, schema)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo the divisor; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def hash_share(rows: int, bound: int, *columns: str) -> Column:
    """Select about ``bound`` of so many rows by a hash of the columns; all of them if there are no more."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(1 << 30)) < F.lit(int((1 << 30) * bound / rows))
