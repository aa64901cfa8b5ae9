"""Documents whose sets of word shingles have a Jaccard similarity of 0.8 or more, and their groups.

A document's shingles are hashed into groups, at least one for four shingles; the vector of their counts is the
document's point. The sum of the coordinates' minima of two points is at least the size of the sets'
intersection, and with the largest coordinates of an R-tree's node it bounds all points below, so a node whose
bound is under the intersection that 0.8 asks for is left out. The pairs that remain are verified on the sets
themselves. Points of different lengths are compared on the shorter's groups, which join the longer's.

No task can hold a tree over all points. The points are dealt out by their leading coordinates first: with all
shingles in one order, two similar sets share one among the first ``n - ceil(0.8 n) + 1`` of each. Points that
share one meet in a tree of their own; up to ``LEAF`` points are a leaf, whose pairs are bounded one by one. The
order puts the most frequent shingles, as counted in all documents, last; it only decides how many points
meet, not which pairs are found.

1. One pass over the texts gives each document its size, point, a digest of its set, and a few minima of its
   shingles. Documents with the same set are one class from here on.
2. Classes that share a minimum are compared with a few of them, which joins most of a group of any size by few
   comparisons; what is linked is a component.
3. A second pass gives the leading shingles. Those of one class only are dropped where they meet; of the rest,
   points of different components are paired in leaves and trees. A shingle of very many points is dealt out
   in tiles, so no tree holds more than about two thousand.
4. Pairs are verified on the sets, which are made anew from the texts of the classes concerned.

Texts are never shuffled. Defined results: null, empty and blank texts have no shingles and link with nothing;
texts of fewer than five words are one shingle. A document without an id links with nothing and has no
component. Rows that share an id are answered each. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, map_batches, stored
from cartlens.llm.graph import components
from cartlens.llm.words import mix, shingles, slices, words

SHINGLE = 5
GROUPS = 64  # of the smallest points, and of all points in a tree
MOST_GROUPS = 1 << 14
MINIMA = 6
STARS = 4  # classes that others with the same minimum are compared with
LEAF = 16  # points of a leaf, and children of a node
TILE = 1024  # points of one side of a tile
FREQUENT = 1 << 18  # shingles that the order puts last
WINDOW = 1 << 21  # shingles counted together
SEEN = 4  # occurrences in a window from which a shingle's count is passed on
SLOT_BITS = 25  # of the filter that finds the documents to make sets of; its size is fixed
_AT_ONCE = 1 << 15  # pairs bounded together

_FULL = 255  # a coordinate of so many or more; beside another such it bounds nothing
_ANY = 1 << 20

_SEEDS = mix(np.arange(1, MINIMA + 1, dtype=np.uint64))


def required(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest intersection of sets of these sizes with 100 * intersection >= 80 * union."""
    return (4 * (a + b) + 8) // 9


def _digests(hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's set, whatever its order."""
    sums = []
    for seed in (0x1234567, 0x89ABCDEF):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashed ^ np.uint64(seed)))])
        sums.append(mix(total[first[1:]] - total[first[:-1]]).view(np.int64))
    return sums[0], sums[1]


def _minima(hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, the smallest of its shingles in a few orders; only for texts with shingles."""
    return np.stack([np.minimum.reduceat(mix(hashed ^ seed), first) + seed for seed in _SEEDS], axis=1)


def _points(hashed: np.ndarray, first: np.ndarray) -> pa.BinaryArray:
    """The number of shingles in each group, a byte each."""
    n = np.diff(first)
    bits = np.clip(np.ceil(np.log2(np.maximum(n, 1) / 4)), np.log2(GROUPS), np.log2(MOST_GROUPS)).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(1 << bits)])
    group = (hashed >> np.repeat(64 - bits, n).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(np.repeat(begin[:-1], n) + group, minlength=begin[-1])
    data = np.minimum(counts, _FULL).astype(np.uint8)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(n), [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(data)]
    )


def _folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The point over fewer groups; coordinates that are full stay above any bound."""
    whole = np.where(point == _FULL, _ANY, point.astype(np.int32))
    return whole.reshape(groups, -1).sum(axis=1)


def may_be_similar(a: bytes, b: bytes, n_a: int, n_b: int) -> bool:
    """Whether the points of sets of these sizes leave room for a similarity of 0.8."""
    if 5 * min(n_a, n_b) < 4 * max(n_a, n_b):
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    groups = min(len(x), len(y))
    return int(np.minimum(_folded(x, groups), _folded(y, groups)).sum()) >= (4 * (n_a + n_b) + 8) // 9


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


SKETCH_DDL = "doc_id long, n long, c1 long, c2 long, minima array<long>, point binary, shingle long, seen long"


def sketch(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each document, and rows of frequent shingles with the number of documents that have them."""

    def frequent(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, seen = np.unique(np.concatenate(parts), return_counts=True)
        values, seen = values[seen >= SEEN], seen[seen >= SEEN]
        empty = [pa.nulls(len(values), t) for t in (pa.int64(),) * 4 + (pa.list_(pa.int64()), pa.binary())]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(values.view(np.int64)), pa.array(seen)], names=names)

    names = [part.split()[0] for part in SKETCH_DDL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            for low, high in slices(batch.column("text")):
                hashed, first = shingles(words(batch.column("text").slice(low, high - low)), SHINGLE)
                n = np.diff(first)
                c1, c2 = _digests(hashed, first)
                some = n > 0
                minima = _minima(hashed, first[:-1][some]) if some.any() else np.zeros((0, MINIMA), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(n),
                        pa.array(c1),
                        pa.array(c2),
                        _lists(minima.ravel(), some * MINIMA),
                        _points(hashed, first),
                        pa.nulls(high - low, pa.int64()),
                        pa.nulls(high - low, pa.int64()),
                    ],
                    names=names,
                )
                parts.append(hashed)
                waiting += len(hashed)
                if waiting >= WINDOW:
                    yield from frequent(parts)
                    parts, waiting = [], 0
        if parts:
            yield from frequent(parts)

    find_package(documents.sparkSession)
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(run, SKETCH_DDL)


# --- sets of chosen documents, and verification -----------------------------------------------------------


def _slot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << SLOT_BITS)).cast("int")


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """A bit for each slot that one of the ids falls into, in words of 32: 4 MB, whatever the number of ids."""
    masks = ids.select(_slot("id").alias("slot")).groupBy(F.expr("shiftright(slot, 5)").alias("word"))
    found = masks.agg(F.expr("bit_or(shiftleft(1L, slot & 31))").alias("bits")).toArrow()
    out = np.zeros(1 << (SLOT_BITS - 5), np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def _sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of the documents with these ids (and of a few others, which no pair names)."""
    wanted = _filter_bits(ids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        slot = batch.column("slot").to_numpy()
        batch = batch.filter(pa.array((wanted[slot >> 5] >> (slot & 31).astype(np.uint32) & 1).astype(bool)))
        made = []
        for low, high in slices(batch.column("text")):
            hashed, first = shingles(words(batch.column("text").slice(low, high - low)), SHINGLE)
            made += [hashed[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("id"), _binary(made)], names=["id", "members"])

    slotted = texts.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text", _slot("doc_id").alias("slot"))
    return map_batches(slotted, run, "id long, members binary")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose sets are similar."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = stored(_sets(texts, ids), "sets")
    one = sets.select(F.col("id").alias("a"), F.col("members").alias("of_a"))
    other = sets.select(F.col("id").alias("b"), F.col("members").alias("of_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for a, b in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common = int((y[at] == x).sum()) if len(y) else 0
            keep.append(100 * common >= 80 * (len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "of_a", "of_b")
    return stored(map_batches(joined, run, "a long, b long"), "verified")


# --- leading coordinates -----------------------------------------------------------------------------------


def _frequent(sketched: DataFrame) -> np.ndarray:
    """At most ``FREQUENT`` shingles, the rarest first."""
    counts = sketched.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("seen").alias("seen"))
    found = counts.orderBy(F.desc("seen"), "shingle").limit(FREQUENT).toArrow()
    return found["shingle"].to_numpy()[::-1].view(np.uint64)


def leading(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Each set's leading shingles with half its digest, and a number that spreads the frequent ones (others: 0)."""
    order = np.argsort(frequent)
    known = frequent[order]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        taken, owner, salt = [], [], []
        for low, high in slices(batch.column("text")):
            hashed, first = shingles(words(batch.column("text").slice(low, high - low)), SHINGLE)
            rank = np.zeros(len(hashed), np.int64)
            if len(known):
                at = np.searchsorted(known, hashed)
                at[at == len(known)] = 0
                rank = np.where(known[at] == hashed, order[at] + 1, 0)
            n = np.diff(first)
            digest = np.repeat(_digests(hashed, first)[0], n)
            if rank.any():  # stable: equal ranks stay in the order of their hashes
                sort = np.lexsort((rank, np.repeat(np.arange(len(n)), n)))
                hashed, rank = hashed[sort], rank[sort]
            lead = np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)
            use = np.arange(len(hashed)) - np.repeat(first[:-1], n) < np.repeat(lead, n)
            taken.append(hashed[use].view(np.int64))
            owner.append(digest[use])
            salt.append(np.where(rank[use] > 0, (digest[use] & 0xFFFF) + 1, 0).astype(np.int32))
        columns = [pa.array(np.concatenate(x)) for x in (taken, owner, salt)]
        return pa.RecordBatch.from_arrays(columns, names=["shingle", "c1", "salt"])

    return map_batches(texts.select("text"), run, "shingle long, c1 long, salt int")


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, with the number of rows at the end."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.concatenate([np.flatnonzero(new), [len(new)]])


def _shared(rows: DataFrame) -> DataFrame:
    """Leading shingles that two sets or more have, once for each set.

    A shingle that is not among the frequent ones belongs to a small share of the documents, so its rows are
    looked at together; rows of the others are spread, and kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        shingle, c1, salt = (np.concatenate([p.column(k).to_numpy() for p in parts]) for k in ("shingle", "c1", "salt"))
        order = np.lexsort((c1, shingle))
        order = order[_runs(shingle[order], c1[order])[:-1]]
        begin = _runs(shingle[order])
        several = np.repeat(np.diff(begin) > 1, np.diff(begin))
        order = order[several | (salt[order] > 0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shingle[order]), pa.array(c1[order]), pa.array(salt[order] > 0)], names=["shingle", "c1", "often"]
        )

    return rows.repartition("shingle", "salt").mapInArrow(run, "shingle long, c1 long, often boolean")


def _leaf_pairs(rows: DataFrame) -> DataFrame:
    """Of shingles that are not frequent: pairs ``a, b`` of different components within a leaf; the points of
    larger groups come back with their shingle (``b`` is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        keys = ("shingle", "component", "id", "n")
        shingle, component, ids, n = (np.concatenate([p.column(k).to_numpy() for p in parts]) for k in keys)
        order = np.lexsort((ids, component, shingle))
        shingle, component, ids, n = shingle[order], component[order], ids[order], n[order]
        begin = _runs(shingle)
        length = np.diff(begin)
        several = component[begin[:-1]] != component[begin[1:] - 1]
        small = np.repeat(several & (length <= LEAF), length)
        end = np.repeat(begin[1:], length)
        found = []
        for step in range(1, LEAF):  # each row with the rows after it in its leaf
            at = np.flatnonzero(small & (np.arange(len(ids)) + step < end))
            to = at + step
            fit = (component[at] != component[to]) & (5 * np.minimum(n[at], n[to]) >= 4 * np.maximum(n[at], n[to]))
            a, b = ids[at[fit]], ids[to[fit]]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        large = np.repeat(several & (length > LEAF), length)
        rest = int(large.sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([pairs[:, 0], ids[large]])),
                pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(rest, pa.int64())]),
                pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(shingle[large])]),
            ],
            names=["a", "b", "shingle"],
        )

    return rows.repartition("shingle").mapInArrow(run, "a long, b long, shingle long")


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs whose points leave room for the similarity."""
    of = lambda name: classes.select(*(F.col(c).alias(f"{c}_{name}") for c in ("id", "n", "point")))
    joined = pairs.join(of("a"), F.col("a") == F.col("id_a")).join(of("b"), F.col("b") == F.col("id_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        points = zip(*(batch.column(k).to_pylist() for k in ("point_a", "point_b", "n_a", "n_b")), strict=True)
        return batch.select(["a", "b"]).filter(pa.array([may_be_similar(*x) for x in points], pa.bool_()))

    return map_batches(joined.select("a", "b", "point_a", "point_b", "n_a", "n_b"), run, "a long, b long")


# --- trees --------------------------------------------------------------------------------------------------


class CountTree:
    """An R-tree over points, packed by size and then by the coordinate that varies most."""

    def __init__(self, points: np.ndarray, size: np.ndarray, component: np.ndarray) -> None:
        widest = int(np.argmax(points.var(axis=0)))
        slab = np.argsort(np.argsort(size, kind="stable"), kind="stable") // (LEAF * LEAF)
        order = np.lexsort((points[:, widest], slab))
        self.points, self.size, self.component, self.order = points[order], size[order], component[order], order
        # For each level, from the leaves up: largest coordinates, smallest and largest size, first and last component.
        self.levels = []
        top, low, high = self.points, self.size, self.size
        first, last = self.component, self.component
        while len(top) > LEAF or not self.levels:
            at = np.arange(0, len(top), LEAF)
            top = np.maximum.reduceat(top, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            self.levels.append((top, low, high, first, last))

    def _bounded(self, query: np.ndarray, node: np.ndarray, level: int) -> np.ndarray:
        """Which of these queries may have a partner below these nodes (level -1: at these points)."""
        if level < 0:
            top, low, high, first, last = self.points, self.size, self.size, self.component, self.component
        else:
            top, low, high, first, last = self.levels[level]
        n, own = self.size[query], self.component[query]
        keep = (5 * high[node] >= 4 * n) & (4 * low[node] <= 5 * n)
        keep &= (first[node] != own) | (last[node] != own)
        at = np.flatnonzero(keep)
        for a in range(0, len(at), _AT_ONCE):
            part = at[a : a + _AT_ONCE]
            bound = np.minimum(self.points[query[part]], top[node[part]]).sum(axis=1)
            smallest = np.maximum(low[node[part]], -(-4 * n[part] // 5))
            keep[part] = bound >= required(n[part], smallest)
        return keep

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the points whose bound allows a similarity of 0.8, each pair once."""
        n = len(self.points)
        per = max(1, (_AT_ONCE * 8) // max(1, n))
        for start in range(0, n, per):
            ask = np.arange(start, min(n, start + per))
            level = len(self.levels) - 1
            nodes = len(self.levels[level][0])
            query, node = np.repeat(ask, nodes), np.tile(np.arange(nodes), len(ask))
            while level >= 0:
                keep = self._bounded(query, node, level)
                query, node = query[keep], node[keep]
                below = n if level == 0 else len(self.levels[level - 1][0])
                query = np.repeat(query, LEAF)
                node = (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                query, node = query[node < below], node[node < below]
                level -= 1
            once = query < node
            query, node = query[once], node[once]
            keep = self._bounded(query, node, -1)
            yield self.order[query[keep]], self.order[node[keep]]


def _earlier(lists: pa.ListArray, shingle: int) -> np.ndarray:
    """For each row, which of the shingles below this one it has (of those that several rows have)."""
    values = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    row, values = row[values < shingle], values[values < shingle]
    kinds, number, seen = np.unique(values, return_inverse=True, return_counts=True)
    out = np.zeros((len(lists), len(kinds)), bool)
    out[row, number] = True
    return out[:, seen > 1]


def _tree_pairs(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of different components that share a leading shingle and whose points leave room for the similarity.
    ``rows``: shingle, id and component, of shingles that many points share."""
    counts = rows.groupBy("shingle").agg(
        F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    rows = rows.join(counts.where("low < high").select("shingle", "rows"), "shingle")
    # A point is fetched once for all of its shingles; a document has few. A pair that shares several of them
    # belongs to the smallest.
    points = rows.groupBy("id", "component").agg(F.collect_set(F.struct("shingle", "rows")).alias("all"))
    points = points.join(classes.select("id", "n", "point"), "id").withColumn("others", F.col("all.shingle"))
    rows = points.withColumn("one", F.explode("all")).drop("all").select("*", "one.*").drop("one")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("rows") / TILE)).cast("int")
    rows = rows.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    with_other = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    i, j = F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j")
    columns = ["shingle", i, j, "own", "id", "component", "n", "point", "others"]
    tiles = with_other.select(*columns).repartition("shingle", "i", "j")
    tiles = tiles.sortWithinPartitions("shingle", "i", "j", "id")

    def pairs_of(tile: pa.Table) -> pa.RecordBatch:
        ids, size = tile["id"].to_numpy(), tile["n"].to_numpy()
        fine = tile["point"].to_pylist()
        points = np.stack([_folded(np.frombuffer(p, np.uint8), GROUPS) for p in fine])
        own, across = tile["own"].to_numpy(), tile["i"][0].as_py() != tile["j"][0].as_py()
        earlier = _earlier(tile["others"].combine_chunks(), tile["shingle"][0].as_py())
        found = []
        for x, y in CountTree(points, size, tile["component"].to_numpy()).pairs():
            here = (earlier[x] & earlier[y]).sum(axis=1) == 0
            if across:  # pairs within either side belong to that side's own tile
                here &= own[x] != own[y]
            pairs = zip(x[here], y[here], strict=True)
            found += [(p, q) for p, q in pairs if may_be_similar(fine[p], fine[q], size[p], size[q])]
        places = np.array(found, np.int64).reshape(-1, 2)
        a, b = ids[places[:, 0]], ids[places[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the rows of the tile that may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            begin = _runs(*(table[k].to_numpy() for k in ("shingle", "i", "j")))[:-1]
            for low, high in zip(begin[:-1], begin[1:], strict=True):
                if high - low > 1:
                    yield pairs_of(table.slice(low, high - low))
            rest = table.slice(begin[-1])
        if rest is not None and len(rest) > 1:
            yield pairs_of(rest)

    return tiles.mapInArrow(run, "a long, b long").where("a <> b")


# --- the join -----------------------------------------------------------------------------------------------


def similar_groups(documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each document: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sketched = stored(sketch(texts), "sketches")
    one = sketched.where("shingle IS NULL")
    classes = one.where("n > 0 AND doc_id IS NOT NULL").groupBy("c1", "c2", "n").agg(
        F.min(F.struct("doc_id", "minima", "point")).alias("first")
    )
    classes = stored(
        classes.select("c1", "c2", "n", "first.*").withColumnRenamed("doc_id", "id"), "classes"
    )  # a class goes by the smallest id of its documents

    # Links to a few of each set of classes that share a minimum: those whose minima are shared most, which in a
    # group of altered copies are the text they were made from, or near it.
    by_minimum = classes.select("id", F.explode("minima").alias("minimum"))
    sharing = by_minimum.groupBy("minimum").agg(F.count("*").alias("classes")).where("classes > 1")
    by_minimum = stored(by_minimum.join(sharing, "minimum"), "minima")
    weight = F.sum("classes").over(Window.partitionBy("id"))  # a class has few minima
    weighed = by_minimum.withColumn("weight", weight)
    part = F.pmod(F.xxhash64("id", "minimum"), F.lit(STARS)).alias("part")
    middle = weighed.groupBy("minimum", part).agg(F.max(F.struct("weight", F.col("id").alias("a"))).alias("most"))
    stars = by_minimum.join(middle.select("minimum", "most.a"), "minimum").where("id <> a")
    stars = stars.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
    star_links = verified(_bounded(stars, classes), texts)
    joined = components(star_links, "a", "b")
    named = classes.join(joined, F.col("id") == F.col("node"), "left").select(
        "c1", "id", "n", "point", F.coalesce("component", "id").alias("component")
    )
    named = stored(named, "named-classes")

    # Links between those components, by leaves and trees.
    shared = stored(_shared(leading(texts, _frequent(sketched))), "shared")
    met = shared.join(named.select("c1", "id", "n", "component"), "c1")
    leaves = stored(_leaf_pairs(met.where("NOT often").drop("c1", "often")), "leaves")
    large = leaves.where("b IS NULL").select("shingle", F.col("a").alias("id")).join(named.select("id", "component"), "id")
    often = met.where("often").select("shingle", "id", "component").distinct()
    in_trees = _tree_pairs(often.unionByName(large), named)
    in_leaves = _bounded(leaves.where("b IS NOT NULL").select("a", "b").distinct(), named)
    links = verified(in_leaves.unionByName(in_trees).distinct(), texts)
    of_a = named.select(F.col("id").alias("a"), F.col("component").alias("left"))
    of_b = named.select(F.col("id").alias("b"), F.col("component").alias("right"))
    between = links.join(of_a, "a").join(of_b, "b").select("left", "right")
    merged = components(between, "left", "right").withColumnRenamed("component", "merged")
    final = named.join(merged, F.col("component") == F.col("node"), "left").select(
        F.col("id").alias("class"), F.coalesce("merged", "component").alias("component_id")
    )
    of_class = classes.join(final, F.col("id") == F.col("class")).select("c1", "c2", "n", "component_id")
    return one.join(of_class, ["c1", "c2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def first_of_groups(documents: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns; of rows that share an id,
    one stays."""
    groups = similar_groups(documents)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    names = documents.columns
    rows = documents.select(F.col("doc_id"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    rows = rows.join(kept, "doc_id")
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("row.text")))
    without_id = documents.where("doc_id IS NULL")
    return rows.withColumn("one", one).where("one = 1").select("row.*").unionByName(without_id)



