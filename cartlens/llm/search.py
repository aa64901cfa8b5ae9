"""The best documents for each item by an integer BM25, by pipelined term partitioning.

One pass over the documents writes an index of shards (some megabytes of text each): for each term of the items,
the places of its documents in the shard and its occurrences there. Terms belong to owners by their weight, rarest
first. The items are cut into blocks; a bundle for each block and shard carries the sparse scores of the shard's
documents from owner to owner. At each, a cogroup lays the bundle beside the posting lists that this owner has for
the shard, adds their contributions, and drops the documents that can't come among the best any more: those whose
score, with the most that all later owners could add, stays below the item's ``top``-th best score so far. After
the last owner, each bundle names its best documents, and the best of these are the result.

A bundle holds one block of items (some ``BLOCK_TERMS`` terms, or one item) and one shard, so no task's memory grows
with the corpus or the benchmark. A fixed filter of 1 MB keeps words that no item has out of the index; what it lets
through by chance meets no item. Equal 64-bit hashes are taken for equal terms.

Defined results: a null text, or one without a term, is no document. Rows that share a doc_id are documents of
their own; those without one rank behind others of the same score. Items that share an item_id, or have none, are
answered each; an item without a term has no row, as has everything if there are no documents or no items. A text
of any length is read whole, in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlens.llm.frames import find_package, stored
from cartlens.llm.words import NOT_ALPHANUMERIC, buffers, slices, words

TOP = 20
OWNERS = (5000, 3000, 1500)  # the least weight of a term of each owner; lighter terms are the last one's
SHARD_BYTES = 4 << 20
SHARD_DOCUMENTS = 1 << 13
BLOCK_TERMS = 1 << 14
FILTER_BITS = 1 << 23

_POSTINGS = (
    "shard long, term long, size int, docs binary, tf binary, max_tf long, least_n long, "
    "n binary, ids array<long>, words long"
)
_BUNDLE = "shard long, block int, ids array<long>, m binary, items binary, counts binary, docs binary, scores binary"
_RESULT = "item_id long, rank int, doc_id long, score long"


def _cut(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Parts of the texts with the place of the first: some texts, or a piece of a long one, cut between terms."""
    for low, high in slices(texts, SHARD_BYTES):
        for first in range(low, high, SHARD_DOCUMENTS):
            part = texts.slice(first, min(SHARD_DOCUMENTS, high - first))
            _, data = buffers(part)
            if len(part) > 1 or len(data) <= SHARD_BYTES:
                yield first, part
                continue
            begin = 0
            while begin < len(data):
                end = min(begin + SHARD_BYTES, len(data))
                while end < len(data) and not NOT_ALPHANUMERIC[data[end]]:
                    end += 1
                yield first, pa.array([data[begin:end].tobytes()], pa.binary())
                begin = end


def _item_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """item, item_id, term and its repeats, for each term of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, part in _cut(texts):
                found = words(part, NOT_ALPHANUMERIC)
                text, term, repeats = _summed(found.of_text() + first, found.hash, np.ones(len(found.hash), np.int64))
                at = pa.array(text)
                columns = [batch.column("item").take(at), batch.column("item_id").take(at)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(term.view(np.int64)), pa.array(repeats)],
                    names=["item", "item_id", "term", "repeats"],
                )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(item_column).cast("long").alias("item_id"),
        F.col(text_column).alias("text"),
    )
    find_package(items.sparkSession)
    parts = rows.mapInArrow(run, "item long, item_id long, term long, repeats long")
    return parts.groupBy("item", "item_id", "term").agg(F.sum("repeats").alias("repeats"))


def _differs(*keys: np.ndarray) -> np.ndarray:
    """Whether each row but the first differs from the one before."""
    out = np.zeros(max(0, len(keys[0]) - 1), bool)
    for key in keys:
        out |= key[1:] != key[:-1]
    return out


def _filter(terms: DataFrame) -> bytes:
    """A bit for each remainder that some term leaves; 1 MB at most, whatever the items."""
    place = F.pmod("term", F.lit(FILTER_BITS)) + 1
    rows = terms.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    parts = {r.bucket: bytes(r.bits) for r in rows.collect()}
    size = 4096  # bytes of a bucket
    return b"".join(parts.get(i + 1, bytes(size)) for i in range(FILTER_BITS // 8 // size))


class _Indexer:
    """Turns texts into shards: a row for each term of the filter, and a row (without a term) for the documents."""

    def __init__(self, bits: bytes) -> None:
        self.bits = bits

    def counted(self, texts: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text: its place, the term, occurrences; and the number of terms of each text."""
        n = np.zeros(len(texts), np.int64)
        parts = []
        for first, part in _cut(texts):
            found = words(part, NOT_ALPHANUMERIC)
            n[first : first + len(part)] += found.counts()
            keep = np.flatnonzero(wanted[found.hash % np.uint64(FILTER_BITS)])
            parts.append(_summed(found.of_text()[keep] + first, found.hash[keep], np.ones(len(keep), np.int64)))
        return (*_summed(*(np.concatenate(x) for x in zip(*parts, strict=True))), n)

    def shard(self, number: int, ids: pa.Array, texts: pa.Array, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc, term, tf, n = self.counted(texts, wanted)
        some = np.flatnonzero(n)
        if not len(some):
            return
        place = np.cumsum(n > 0) - 1
        doc, n = place[doc], n[some]
        size, none = pa.array([len(some)], pa.int32()), [pa.nulls(1, pa.binary())]
        columns = [pa.array([number]), pa.nulls(1, pa.int64()), size, *none, *none, *[pa.nulls(1, pa.int64())] * 2]
        listed = pa.ListArray.from_arrays([0, len(some)], ids.take(pa.array(some)))
        yield self._rows([*columns, pa.array([n.tobytes()]), listed, pa.array([int(n.sum())])])
        if not len(term):
            return
        begin = np.flatnonzero(np.concatenate([[True], _differs(term)]))
        end = np.append(begin[1:], len(term))
        width = np.uint8 if tf.max() < 256 else np.uint32
        empty = pa.nulls(len(begin), pa.int64())
        yield self._rows(
            [
                pa.array(np.full(len(begin), number, np.int64)),
                pa.array(term[begin].view(np.int64)),
                pa.array((end - begin).astype(np.int32)),
                _pieces(doc.astype(np.uint16), begin),
                _pieces(tf.astype(width), begin),
                pa.array(np.maximum.reduceat(tf, begin)),
                pa.array(np.minimum.reduceat(n[doc], begin)),
                pa.nulls(len(begin), pa.binary()),
                pa.nulls(len(begin), pa.list_(pa.int64())),
                empty,
            ]
        )

    def _rows(self, columns: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _POSTINGS.split(", ")])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        wanted = np.unpackbits(np.frombuffer(self.bits, np.uint8), bitorder="little").view(bool)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text")
            for low, high in slices(texts, SHARD_BYTES):
                for first in range(low, high, SHARD_DOCUMENTS):
                    some = min(SHARD_DOCUMENTS, high - first)
                    yield from self.shard(number, batch.column("doc_id").slice(first, some), texts.slice(first, some), wanted)
                    number += 1


def _summed(doc: np.ndarray, term: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of equal (term, doc), in that order."""
    order = np.lexsort((doc, term))
    doc, term, number = doc[order], term[order], number[order]
    if not len(doc):
        return doc, term, number
    begin = np.flatnonzero(np.concatenate([[True], _differs(doc, term)]))
    return doc[begin], term[begin], np.add.reduceat(number, begin)


def _pieces(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """The values as binaries that begin at these places."""
    offsets = (np.append(begin, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class _Owner:
    """What one owner does with a bundle: adds what its posting lists contribute."""

    def __init__(self, top: int, last: bool) -> None:
        self.top, self.last = top, last

    def __call__(self, key: tuple[pa.Scalar, ...], bundles: pa.Table, lists: pa.Table) -> pa.Table:
        if not len(bundles):  # no shard without a bundle
            return self._empty()
        bundle = {name: bundles[name][0] for name in bundles.column_names}
        m = np.frombuffer(bundle["m"].as_py(), np.int64)
        need = dict(zip(bundle["need_items"].as_py() or (), bundle["needs"].as_py() or (), strict=True))
        items = np.array(sorted(need), np.int64)
        least = np.array([max(1, need[i]) for i in items.tolist()], np.int64)
        scores = np.zeros((len(items), len(m)), np.int64)
        self._unpack(bundle, items, scores)
        for row in range(len(lists)):
            doc = np.frombuffer(lists["docs"][row].as_py(), np.uint16)
            raw = lists["tf"][row].as_py()
            tf = np.frombuffer(raw, np.uint8 if len(raw) == len(doc) else np.uint32).astype(np.int64)
            at = np.searchsorted(items, lists["of_items"][row].values.to_numpy())
            weight = lists["weights"][row].values.to_numpy()
            scores[at[:, None], doc[None, :]] += weight[:, None] * _impacts(tf, m[doc])[None, :]
        kept = scores >= least[:, None]
        ids = bundle["ids"].values
        if self.last:
            return self._best(items, scores, kept, ids)
        at, doc = np.nonzero(kept)
        count = kept.sum(axis=1)
        some = count > 0
        best, best_of = self._highest(scores, kept)
        values = {
            "shard": key[0].as_py(),
            "block": key[1].as_py(),
            "ids": bundle["ids"],
            "m": bundle["m"].as_py(),
            "items": items[some].tobytes(),
            "counts": count[some].tobytes(),
            "docs": doc.astype(np.uint16).tobytes(),
            "scores": scores[at, doc].tobytes(),
            "best_items": items[best_of].tolist(),
            "best": best.tolist(),
        }
        types = {"ids": pa.list_(pa.int64()), "best_items": pa.list_(pa.int64()), "best": pa.list_(pa.int64())}
        columns = {k: pa.array([v if k != "ids" else v.as_py()], types.get(k)) for k, v in values.items()}
        columns["block"] = columns["block"].cast(pa.int32())
        return pa.table(columns)

    def _unpack(self, bundle: dict[str, pa.Scalar], items: np.ndarray, scores: np.ndarray) -> None:
        if not bundle["items"].is_valid:
            return
        own, count = (np.frombuffer(bundle[k].as_py(), np.int64) for k in ("items", "counts"))
        doc = np.frombuffer(bundle["docs"].as_py(), np.uint16)
        at = np.repeat(np.searchsorted(items, own), count)
        scores[at, doc] = np.frombuffer(bundle["scores"].as_py(), np.int64)

    def _highest(self, scores: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` best scores of each item in this shard, and whose they are."""
        masked = np.where(kept, scores, 0)
        if masked.shape[1] > self.top:
            masked = -np.partition(-masked, self.top - 1, axis=1)[:, : self.top]
        of, place = np.nonzero(masked)
        return masked[of, place], of

    def _empty(self) -> pa.Table:
        ddl = "item long, doc_id long, score long" if self.last else f"{_BUNDLE}, best_items array<long>, best array<long>"
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
        fields = [x.split() for x in ddl.split(", ")]
        return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})

    def _best(self, items: np.ndarray, scores: np.ndarray, kept: np.ndarray, ids: pa.Array) -> pa.Table:
        at, doc = np.nonzero(kept)
        found = ids.take(pa.array(doc))
        missing = found.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((found.fill_null(0).to_numpy(), missing, -scores[at, doc], at))
        of = at[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        order = order[rank < self.top]
        return pa.table({"item": items[at[order]], "doc_id": found.take(pa.array(order)), "score": scores[at[order], doc[order]]})


def _floors(bundles: DataFrame, top: int) -> DataFrame:
    """The ``top``-th best score so far of each item that has so many."""
    pairs = bundles.select(F.explode(F.arrays_zip("best_items", "best")).alias("x"))
    pairs = pairs.select(F.col("x.best_items").alias("item"), F.col("x.best").alias("score"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    return pairs.withColumn("place", place).where(F.col("place") <= top).groupBy("item").agg(
        F.when(F.count("*") == top, F.min("score")).alias("floor")
    )


def rank_documents(
    documents: DataFrame,
    items: DataFrame,
    *,
    top: int = TOP,
    owners: Sequence[int] = OWNERS,
    doc_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` best documents with a score above 0."""
    spark = documents.sparkSession
    asked = stored(_item_terms(items, item_column, item_text_column), "item-terms")
    blocks = -(-asked.count() // BLOCK_TERMS)
    index = _index(documents.select(F.col(doc_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")), asked)
    shards, postings = index.where("term IS NULL"), index.where("term IS NOT NULL")
    total, length = shards.agg(F.sum("size"), F.sum("words")).head()
    if not blocks or not total:
        return spark.createDataFrame([], _RESULT)

    weighed = _weighed(asked, postings, total, length, owners, blocks)
    rest = weighed.groupBy("block", "item").agg(
        *(F.sum(F.when(F.col("owner") > k, F.col("bound")).otherwise(0)).alias(f"rest{k}") for k in range(len(owners) + 1))
    )
    rest = stored(rest, "item-bounds")
    bundles = _first_bundles(shards, blocks, total, length)
    for k in range(len(owners)):
        bundles = stored(_pass_on(bundles, postings, weighed, rest, k, top, last=False), f"bundles-{k}")
    found = _pass_on(bundles, postings, weighed, rest, len(owners), top, last=True)

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _index(documents: DataFrame, asked: DataFrame) -> DataFrame:
    find_package(documents.sparkSession)
    indexer = _Indexer(_filter(asked))
    return stored(documents.mapInArrow(lambda batches: indexer(batches), _POSTINGS), "postings")


def _weighed(
    asked: DataFrame, postings: DataFrame, total: int, length: int, owners: Sequence[int], blocks: int
) -> DataFrame:
    """The items' terms that some document has: weight with repeats, owner, and the most it can contribute."""
    terms = postings.groupBy("term").agg(
        F.sum("size").alias("df"), F.max("max_tf").alias("tf"), F.min("least_n").alias("n")
    )
    owner = F.lit(len(owners))
    for k, least in reversed(list(enumerate(owners))):
        owner = F.when(F.col("w") >= least, k).otherwise(owner)
    most = F.expr(f"(1000000000 * tf) div (1000 * tf + 12 * (75 + (25 * n * {total}L) div {length}L))")
    weighed = (
        asked.join(terms, "term")
        .withColumn("w", F.floor(1000 * F.log((2.0 * total + 2) / (2.0 * F.col("df") + 1))))
        .where("w > 0")
        .select(
            F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"),
            "item",
            "term",
            owner.alias("owner"),
            (F.col("w") * F.col("repeats")).alias("weight"),
            (F.col("w") * F.col("repeats") * most).alias("bound"),
        )
    )
    return stored(weighed, "weighed-terms")


def _first_bundles(shards: DataFrame, blocks: int, total: int, length: int) -> DataFrame:
    """An empty bundle for each block of items and each shard, with the documents' ids and lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [(75 + (25 * np.frombuffer(x, np.int64) * total) // length).tobytes() for x in batch.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("block"), batch.column("ids"), pa.array(m, pa.binary())],
                names=["shard", "block", "ids", "m"],
            )

    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    rows = shards.select("shard", every, "ids", "n").mapInArrow(run, "shard long, block int, ids array<long>, m binary")
    for name in ("items", "counts", "docs", "scores"):
        rows = rows.withColumn(name, F.lit(None).cast("binary"))
    return rows.withColumn("best_items", F.lit(None).cast("array<long>")).withColumn("best", F.col("best_items"))


def _pass_on(
    bundles: DataFrame, postings: DataFrame, weighed: DataFrame, rest: DataFrame, k: int, top: int, *, last: bool
) -> DataFrame:
    """The bundles after the k-th owner."""
    needs = rest.select("block", "item", F.col(f"rest{k}").alias("rest"))
    needs = needs.join(_floors(bundles, top), "item", "left") if k else needs.withColumn("floor", F.lit(0))
    need = F.struct("item", (F.coalesce("floor", F.lit(0)) - F.col("rest")).alias("need"))
    needs = needs.groupBy("block").agg(F.collect_list(need).alias("x"))
    needs = needs.select("block", F.col("x.item").alias("need_items"), F.col("x.need").alias("needs"))
    owned = weighed.where(F.col("owner") == k).groupBy("term", "block").agg(
        F.collect_list(F.struct("item", "weight")).alias("x")
    )
    owned = owned.select("term", "block", F.col("x.item").alias("of_items"), F.col("x.weight").alias("weights"))
    lists = postings.select("shard", "term", "docs", "tf").join(owned, "term").drop("term")
    sent = bundles.drop("best_items", "best").join(needs, "block", "left").select(*bundles.columns[:-2], "need_items", "needs")
    keys = ("shard", "block")
    schema = "item long, doc_id long, score long" if last else f"{_BUNDLE}, best_items array<long>, best array<long>"
    owner = _Owner(top, last)

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        return owner(key, left, right)

    return sent.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(run, schema)
