"""Vectors with a cosine of 0.95 or more, by random hyperplanes, and their connected components.

Each of several tables cuts the space with random hyperplanes through the origin; the sides on which a vector
lies are its code, and vectors with the same code in a table meet there and are compared exactly, in double
precision. Two vectors at the threshold share a code in one table with probability ``p ** bits`` (p = 1 - angle /
pi); there are so many tables that they meet in none with a chance of ``MISSED`` at most. The number of bits
follows the number of vectors, so a code has some ``PER_CODE`` of them.

Equal vectors are one class, which is moved and compared once and counts for all its copies. A pair that
meets in several tables counts in the first. A code that very many vectors share is dealt out in tiles, each
pair of which meets in one. Of the links found in a tile only their numbers, and as many links as join what is
connected, leave the task.

Defined results: null vectors, those with null or non-finite components and those without length link with
nothing, and are kept; vectors of different lengths don't link. A row without an id links with nothing, has no
component and is not kept. Rows that share an id are answered each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, map_batches, stored
from cartlens.llm.graph import components

THRESHOLD = 0.95
MISSED = 1e-4
PER_CODE = 200
TILE = 1024
SEED = 7


def plan_tables(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits of a code and number of tables for so many vectors."""
    bits = min(24, max(6, round(math.log2(max(1, vectors) / PER_CODE))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log1p(-same))


def _planes(dimension: int, bits: int, tables: int) -> np.ndarray:
    """Normals of the planes, table by table; fewer tables have the first of the same planes."""
    planes = np.random.default_rng((SEED, dimension)).standard_normal((tables, dimension, bits))
    return planes.transpose(1, 0, 2).reshape(dimension, tables * bits)


def _codes(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The code of each vector in each table."""
    sides = vectors @ _planes(vectors.shape[1], bits, tables) >= 0
    return sides.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits))


def _unit(data: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square is too large or small
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _checked(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Each row's id and its vector as bytes, null where it can't link."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for value in batch.column("vector"):
            part = value.values if value.is_valid else None
            usable = part is not None and len(part) and not part.null_count
            x = part.cast(pa.float64()).to_numpy(zero_copy_only=False) if usable else np.zeros(0)
            # Zeros of either sign are equal.
            out.append((x + 0.0).tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "vector"])

    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    return map_batches(rows, run, "vec_id long, vector binary")


def _coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """A row for each class and table, with its code there (the dimension is part of it)."""
    names = ["place", "code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            size = np.array([len(x) for x in data])
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                codes = _codes(_unit([data[i] for i in at]), bits, tables)
                code = codes.astype(np.int64) * (1 << 24) + min(int(length) // 8, (1 << 24) - 1)
                for table in range(tables):
                    part = batch.take(pa.array(at))
                    part = part.append_column("place", pa.array(np.full(len(at), table, np.int32)))
                    yield part.append_column("code", pa.array(code[:, table]))

    find_package(classes.sparkSession)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{ddl}, {names[0]} int, {names[1]} long")


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest row connected to each row of a symmetric matrix of links."""
    n = len(linked)
    root = np.arange(n)
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], n).min(axis=1, initial=n))
        low = np.minimum(low, low[low])
        if np.array_equal(low, root):
            return root
        root = low


class _Tile:
    """Vectors that meet under one code of one table: links that no earlier table has."""

    def __init__(self, bits: int, threshold: float) -> None:
        self.bits, self.threshold = bits, threshold

    def links(self, table: int, across: bool, own: np.ndarray, data: list[bytes]) -> np.ndarray:
        x = _unit(data)
        linked = x @ x.T >= self.threshold
        np.fill_diagonal(linked, False)
        if across:  # links within either side belong to that side's own tile
            linked &= own[:, None] != own[None, :]
        at = np.flatnonzero(linked.any(axis=1))
        if table and len(at):
            codes = _codes(x[at], self.bits, table)
            for earlier in range(table):
                linked[np.ix_(at, at)] &= codes[:, earlier][:, None] != codes[:, earlier][None, :]
        return linked


def _found_links(rows: DataFrame, bits: int, threshold: float) -> DataFrame:
    """Rows ``a, b, n``: vectors linked with ``a`` (b is null), or a link that joins what is connected (n is null)."""
    keys = ("place", "code", "i", "j")
    tile_of = _Tile(bits, threshold)

    def found(tile: pa.Table) -> pa.RecordBatch:
        ids, weight = tile["id"].to_numpy(), tile["copies"].to_numpy()
        across = tile["i"][0].as_py() != tile["j"][0].as_py()
        linked = tile_of.links(tile["place"][0].as_py(), across, tile["own"].to_numpy(), tile["vector"].to_pylist())
        number = linked @ weight
        some = np.flatnonzero(number)
        roots = _roots(linked)
        joins = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[some], ids[joins]])),
                pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[roots[joins]])]),
                pa.concat_arrays([pa.array(number[some]), pa.nulls(len(joins), pa.int64())]),
            ],
            names=["a", "b", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the rows of the tile that may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            new = np.zeros(len(table), bool)
            new[0] = True
            for key in keys:
                value = table[key].to_numpy()
                new[1:] |= value[1:] != value[:-1]
            begin = np.flatnonzero(new)
            for low, high in zip(begin[:-1], begin[1:], strict=True):
                if high - low > 1:
                    yield found(table.slice(low, high - low))
            rest = table.slice(begin[-1])
        if rest is not None and len(rest) > 1:
            yield found(rest)

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "id")
    return dealt.mapInArrow(run, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector."""
    rows = _checked(vectors, id_column, vector_column).withColumn("digest", F.sha2("vector", 256))
    rows = stored(rows, "vectors")
    usable = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    classes = usable.groupBy("digest").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    classes = stored(classes, "classes")
    bits, tables = plan_tables(classes.count(), threshold)

    codes = _coded(classes.select("id", "vector"), bits, tables).groupBy("place", "code").count()
    hot = stored(codes.where(F.col("count") > TILE), "hot-codes")
    hot = hot.select("place", "code", F.ceil(F.col("count") / TILE).cast("int").alias("chunks"))
    coded = _coded(classes.select("id", "copies", "vector"), bits, tables).join(hot, ["place", "code"], "left")
    coded = coded.withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    coded = coded.withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    coded = coded.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    i, j = F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j")
    tiles = coded.select("place", "code", i, j, "own", "id", "copies", "vector")

    found = stored(_found_links(tiles, bits, threshold), "links")
    number = found.where("n IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    joined = components(found.where("b IS NOT NULL").select("a", "b"), "a", "b").withColumnRenamed("node", "id")
    of_class = classes.drop("vector").join(number, "id", "left").join(joined, "id", "left")
    of_class = of_class.select(
        "digest",
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        F.coalesce("component", "id").alias("component"),
    )
    alone = F.col("vec_id").isNull() | F.col("links").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component"))
    return rows.drop("vector").join(of_class, "digest", "left").select(
        "vec_id",
        F.when(alone, 0).otherwise(F.col("links")).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
