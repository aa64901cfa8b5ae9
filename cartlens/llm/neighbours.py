"""Nearest vectors by cosine: a neighbour graph built by NN-descent, and greedy searches in it.

Equal vectors are one node. First lists come from several orders of the nodes, each by the signs of random
projections: nodes that stand in one run of an order are compared. Then rounds of NN-descent: the neighbours of a
node, in either direction, are compared with each other, since neighbours of neighbours are likely neighbours. Each
round is a Spark job: links are joined with the vectors of their ends, dealt out by the node between them, compared
there, and the ``DEGREE`` nearest of each node kept. Only pairs with a link that is new since the last round are
compared, and only those go on that beat the worst link of one of their ends. Rounds end when few links are new. A
node that very many have as neighbour is dealt out in chunks of ``CHUNK`` of these, each with all its own neighbours.

A query begins at its own node's links and at some fixed nodes, and keeps the ``BEAM`` nearest nodes seen; each round
joins those not yet expanded with their links, leaves out what was seen, fetches the vectors, and updates the beams,
until no beam changes. What the beams hold at last is compared in double precision on the original vectors.

The graph and the searches work on unit vectors in half precision; a result's score does not. Results are
approximate: a nearest vector may be missed. Tests measure the recall against brute force.

Defined results: vectors that are null, without length, or have null or non-finite components take no part; vectors
of different lengths are not near each other. Rows that share a vec_id are candidates, and queries, of their own; a
row without one is no query and takes no part. Equal scores are ordered by vec_id. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlens.llm.frames import find_package, map_batches, stored

TOP = 5
DEGREE = 32  # links of a node
ORDERS = 12  # orders for the first lists
RUN = 192  # nodes of an order compared with each other
FIRST = 8  # links of a node from each order
CHUNK = 48  # nodes that have a node as neighbour, compared together
ROUNDS = 6
FEW = 0.05  # share of new links at which rounds end
BEAM = 128
ENTRIES = 64  # fixed nodes that every search looks at
BITS = 48
SEED = 11
_LINKS = "node long, other long, sim float, fresh boolean"


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job inside go when it ends; what jobs hand on is stored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """row, vec_id and the vector in doubles of each row that takes part."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for value in batch.column("vector"):
            part = value.values if value.is_valid else None
            if part is None or not len(part) or part.null_count:
                out.append(None)
                continue
            x = part.cast(pa.float64()).to_numpy(zero_copy_only=False) + 0.0  # zeros of either sign are equal
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        columns = [batch.column("row"), batch.column("vec_id"), pa.array(out, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "vector"])

    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).alias("vector"),
    )
    checked = map_batches(rows, run, "row long, vec_id long, vector binary")
    return checked.where("vec_id IS NOT NULL AND vector IS NOT NULL")


def _scaled(x: np.ndarray) -> np.ndarray:
    """By a power of two, so that no square is too large or too small; no digit changes."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -exponent)


def _codes(vectors: DataFrame) -> DataFrame:
    """node and its unit vector in half precision."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for data in batch.column("vector").to_pylist():
            x = _scaled(np.frombuffer(data, np.float64)[None, :])[0]
            out.append((x / np.sqrt(x @ x)).astype(np.float16).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "code"])

    return map_batches(vectors.select("node", "vector"), run, "node long, code binary")


def _matrix(column: pa.Array, low: int, high: int, kind: type = np.float16) -> np.ndarray:
    """Rows of a binary column, all of one length."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[low] : offsets[high]]
    return data.view(kind).reshape(high - low, -1)


def _groups(
    batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], most: int | None = None
) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    """Ranges of sorted rows with equal keys, cut to ``most`` rows; ranges go on from one batch to the next."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for key in keys:
            value = batch.column(key).to_numpy(zero_copy_only=False)
            new[1:] |= value[1:] != value[:-1]
        begin = np.flatnonzero(new)
        if most:
            end = np.append(begin[1:], batch.num_rows)
            begin = np.concatenate([np.arange(a, b, most) for a, b in zip(begin, end, strict=True)])
        for low, high in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            yield batch, low, high
        rest = batch.slice(int(begin[-1]))
    if rest is not None and rest.num_rows:
        rest = pa.Table.from_batches([rest]).combine_chunks().to_batches()[0]
        yield rest, 0, rest.num_rows


class _Found:
    """Links found so far in a task, passed on in batches."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.number = 0

    def add(self, node: np.ndarray, other: np.ndarray, sim: np.ndarray) -> None:
        self.parts.append((node, other, sim))
        self.number += len(node)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.number >= least:
            columns = [pa.array(np.concatenate(x)) for x in zip(*self.parts, strict=True)]
            columns.append(pa.array(np.ones(self.number, bool)))
            yield pa.RecordBatch.from_arrays(columns, names=["node", "other", "sim", "fresh"])
            self.parts, self.number = [], 0


def _first_lists(nodes: DataFrame, number: int, orders: int, run_length: int, first: int) -> DataFrame:
    """The nearest nodes in the runs of each order."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("code").to_pylist()
            size = np.array([len(x) for x in data])
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                x = np.frombuffer(b"".join(data[i] for i in at), np.float16).reshape(len(at), -1).astype(np.float32)
                for order in range(orders):
                    planes = np.random.default_rng((SEED, order, x.shape[1])).standard_normal((x.shape[1], BITS), np.float32)
                    place = (x @ planes >= 0) @ (1 << np.arange(BITS)[::-1])
                    columns = [
                        pa.array(np.full(len(at), order, np.int32)),
                        pa.array(np.full(len(at), length, np.int32)),
                        pa.array(place),
                        *(batch.column(k).take(pa.array(at)) for k in ("node", "code")),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["order", "size", "place", "node", "code"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found()
        for batch, low, high in _groups(batches, ("order", "size"), run_length):
            if high - low < 2:
                continue
            x = _matrix(batch.column("code"), low, high).astype(np.float32)
            node = batch.column("node").to_numpy()[low:high]
            sims = x @ x.T
            np.fill_diagonal(sims, -3)
            some = min(first, len(node) - 1)
            near = np.argpartition(-sims, some - 1, axis=1)[:, :some]
            found.add(np.repeat(node, some), node[near].ravel(), np.take_along_axis(sims, near, 1).ravel())
            yield from found.batches(1 << 16)
        yield from found.batches(1)

    spark = nodes.sparkSession
    find_package(spark)
    rows = nodes.select("node", "code").mapInArrow(placed, "order int, size int, place long, node long, code binary")
    parts = max(1, orders * number // (64 * run_length))
    dealt = rows.repartitionByRange(parts, "order", "size", "place").sortWithinPartitions("order", "size", "place", "node")
    return dealt.mapInArrow(compared, _LINKS)


def _nearest_of(rows: tuple[np.ndarray, ...], degree: int) -> tuple[np.ndarray, ...]:
    """Of links (node, other, sim, fresh), the nearest of each node; one that was known is not new."""
    order = np.lexsort((rows[3], rows[1], rows[0]))
    rows = tuple(x[order] for x in rows)
    new = np.ones(len(order), bool)
    new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
    rows = tuple(x[new] for x in rows)
    order = np.lexsort((rows[1], -rows[2], rows[0]))
    node = rows[0][order]
    keep = order[np.arange(len(node)) - np.searchsorted(node, node) < degree]
    return tuple(x[keep] for x in rows)


def _merged(links: DataFrame, degree: int) -> DataFrame:
    """The nearest links of each node."""
    names = ["node", "other", "sim", "fresh"]

    def batch_of(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the nearest so far of the last node, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in names)
            if rest is not None:
                rows = tuple(np.concatenate(x) for x in zip(rest, rows, strict=True))
            rows = _nearest_of(rows, degree)
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last:
                yield batch_of(tuple(x[:last] for x in rows))
            rest = tuple(x[last:] for x in rows)
        if rest is not None:
            yield batch_of(rest)

    return links.repartition("node").sortWithinPartitions("node").mapInArrow(run, _LINKS)


def _compared_through(links: DataFrame, nodes: DataFrame, degree: int) -> DataFrame:
    """Links that a round finds: between nodes that have a neighbour in common."""
    chunks = links.groupBy(F.col("other").alias("via")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    forth = links.select(F.col("node").alias("via"), F.col("other").alias("node"), "fresh", F.lit(False).alias("back"))
    back = links.select(F.col("other").alias("via"), "node", "fresh", F.lit(True).alias("back"))
    members = forth.unionByName(back).join(chunks, "via", "left")
    number = F.coalesce("chunks", F.lit(1))
    dealt = F.when(F.col("back"), F.array(F.pmod(F.xxhash64("node"), number).cast("int"))).otherwise(
        F.sequence(F.lit(0), number - 1)
    )
    members = members.select("via", "node", "fresh", F.explode(dealt).alias("chunk"))
    worst = links.groupBy("node").agg(F.when(F.count("*") >= degree, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    points = nodes.select("node", "code").join(worst, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found()
        for batch, low, high in _groups(batches, ("via", "chunk")):
            fresh = batch.column("fresh").to_numpy(zero_copy_only=False)[low:high]
            if high - low < 2 or not fresh.any():
                continue
            node = batch.column("node").to_numpy()[low:high]
            order = np.lexsort((~fresh, node))  # of a link in both directions, a new one
            order = order[np.concatenate([[True], node[order][1:] != node[order][:-1]])]
            node, fresh = node[order], fresh[order]
            x = _matrix(batch.column("code"), low, high)[order].astype(np.float32)
            worst = batch.column("worst").to_numpy()[low:high][order]
            new, known = np.flatnonzero(fresh), np.flatnonzero(~fresh)
            sims = x[new] @ x.T
            sims[np.arange(len(new)), new] = -3
            i, j = np.nonzero(sims > worst[new][:, None])
            found.add(node[new[i]], node[j], sims[i, j])
            i, j = np.nonzero(sims[:, known] > worst[known][None, :])
            found.add(node[known[j]], node[new[i]], sims[i, known[j]])
            yield from found.batches(1 << 16)
        yield from found.batches(1)

    find_package(links.sparkSession)
    rows = members.join(points, "node").select("via", "chunk", "node", "fresh", "code", "worst")
    return rows.repartition("via", "chunk").sortWithinPartitions("via", "chunk").mapInArrow(run, _LINKS)


def neighbour_graph(nodes: DataFrame, *, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """node, other, sim and fresh: the nearest nodes found of each node of ``nodes`` (node, code)."""
    number = nodes.count()
    links = stored(_merged(_first_lists(nodes, number, ORDERS, RUN, FIRST), degree), "first-links")
    for turn in range(rounds):
        if links.where("fresh").count() <= (FEW * number * degree if turn else 0):
            break
        found = _compared_through(links, nodes, degree)
        links = stored(_merged(links.withColumn("fresh", F.lit(False)).unionByName(found), degree), f"links-{turn}")
    return links


class _Beam:
    """A query's nearest nodes so far; ``opened`` are those that the round put there."""

    def __init__(self, most: int) -> None:
        self.most = most

    def __call__(self, state: pa.Table, found: pa.Table) -> pa.Table:
        if not len(state):
            return state.append_column("opened", pa.nulls(0, pa.list_(pa.int64())))
        row = {k: state[k][0].as_py() for k in state.column_names}
        node, sim = np.frombuffer(row["beam"], np.int64), np.frombuffer(row["sims"], np.float32)
        opened = np.zeros(len(node), bool)
        own = np.frombuffer(row["code"], np.float16)
        if len(found):
            found = found.combine_chunks()
            codes = found["code"].chunk(0)
            same = np.diff(np.frombuffer(codes.buffers()[1], np.int32)[codes.offset : codes.offset + len(codes) + 1]) == own.nbytes
            at = pa.array(np.flatnonzero(same))
            codes, new = codes.take(at), found["node"].chunk(0).take(at).to_numpy()
            if len(new):
                x = _matrix(codes, 0, len(codes)).astype(np.float32)
                node = np.concatenate([node, new])
                sim = np.concatenate([sim, x @ own.astype(np.float32)])
                opened = np.concatenate([opened, np.ones(len(new), bool)])
        order = np.lexsort((node, -sim))[: self.most]
        row |= {"beam": node[order].tobytes(), "sims": sim[order].tobytes()}
        out = pa.table({k: pa.array([v], state.schema.field(k).type) for k, v in row.items()})
        return out.append_column("opened", pa.array([node[order][opened[order]].tolist()], pa.list_(pa.int64())))


def _searched(queries: DataFrame, nodes: DataFrame, links: DataFrame, degree: int, most: int) -> DataFrame:
    """query and node: what the beams of the queries (query, start, code) hold at last."""
    near = links.select(F.col("node").alias("via"), F.col("other").alias("node"))
    place = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("sim"), "node"))
    back = links.withColumn("place", place).where(F.col("place") <= degree).select(F.col("other").alias("via"), "node")
    around = stored(near.unionByName(back).distinct(), "search-links")
    entries = [r.node for r in nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()]

    codes = nodes.select("node", "code")
    state = queries.select("query", "start", "code", F.lit(b"").alias("beam"), F.lit(b"").alias("sims"))
    asked = queries.select("query", F.col("start").alias("via")).join(around, "via").select("query", "node")
    fixed = queries.select("query", F.explode(F.array(*map(F.lit, entries)).cast("array<long>")).alias("node"))
    asked = asked.unionByName(fixed).distinct().join(queries.select("query", F.col("start").alias("node")), ["query", "node"], "left_anti")
    asked = stored(asked, "asked-0")
    seen = asked
    beam = _Beam(most)
    schema = "query long, start long, code binary, beam binary, sims binary, opened array<long>"
    find_package(queries.sparkSession)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return beam(left, right)

    turn = 0
    while not asked.isEmpty():
        found = asked.join(codes, "node").select("query", "node", "code")
        state = stored(state.groupBy("query").cogroup(found.groupBy("query")).applyInArrow(run, schema), f"beams-{turn}")
        turn += 1
        asked = state.select("query", F.explode("opened").alias("via")).join(around, "via").select("query", "node").distinct()
        # The query's own node is never asked for.
        asked = asked.join(state.select("query", F.col("start").alias("node")), ["query", "node"], "left_anti")
        asked = stored(asked.join(seen, ["query", "node"], "left_anti"), f"asked-{turn}")
        seen = seen.unionByName(asked)
        state = state.drop("opened")
    return state.select("query", "start", "beam")


def _scored(beams: DataFrame, nodes: DataFrame) -> DataFrame:
    """query, node and score (the cosine on the original vectors) of what the beams hold, and the queries' own nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, node = [], []
            for q, start, beam in zip(*(batch.column(k).to_pylist() for k in ("query", "start", "beam")), strict=True):
                held = [start, *np.frombuffer(beam, np.int64).tolist()]
                query += [q] * len(held)
                node += held
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(node, pa.int64())], names=["query", "node"])

    def cosines(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({k: pa.array([], t) for k, t in (("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64()))})
        own = _scaled(np.frombuffer(left["own"][0].as_py(), np.float64)[None, :])
        x = _scaled(np.frombuffer(b"".join(right["vector"].to_pylist()), np.float64).reshape(len(right), -1))
        score = (x * own).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((own * own).sum()))
        return pa.table({"query": right["query"], "node": right["node"], "score": score})

    held = beams.mapInArrow(run, "query long, node long").join(nodes.select("node", "vector"), "node")
    starts = nodes.select(F.col("node").alias("start"), F.col("vector").alias("own"))
    own = beams.select(F.col("query").alias("of"), "start").join(starts, "start").select("of", "own")
    return own.groupBy("of").cogroup(held.groupBy("query")).applyInArrow(cosines, "query long, node long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    top: int = TOP,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    degree: int = DEGREE,
    rounds: int = ROUNDS,
    beam: int = BEAM,
) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest other rows found of each row whose ``vec_id`` is a query's."""
    spark = vectors.sparkSession
    with _shuffles_cleaned(spark):
        rows = stored(_usable(vectors, id_column, vector_column).withColumn("digest", F.sha2("vector", 256)), "vectors")
        classes = rows.groupBy("digest").agg(F.min("row").alias("node"), F.first("vector").alias("vector"))
        classes = stored(classes, "nodes")
        nodes = stored(_codes(classes), "codes")
        links = neighbour_graph(nodes, degree=degree, rounds=rounds)
        rows = stored(rows.drop("vector").join(classes.select("digest", "node"), "digest").drop("digest"), "rows")
        # Equal queries are one search.
        asked = rows.where(is_query).select(F.col("node").alias("start")).distinct()
        asked = asked.join(nodes.withColumnRenamed("node", "start"), "start").withColumn("query", F.col("start"))
        beams = stored(_searched(stored(asked, "queries"), nodes, links, degree, beam), "beams")
        scores = stored(_scored(beams, classes), "scores")
    place = F.row_number().over(Window.partitionBy("node").orderBy("vec_id", "row"))
    members = rows.withColumn("place", place).where(F.col("place") <= top + 1).select("node", "vec_id", "row")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), F.col("node").alias("query"))
    found = queries.join(scores, "query").join(members, "node").where("row <> own")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
