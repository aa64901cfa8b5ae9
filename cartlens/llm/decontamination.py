"""Passages of a benchmark in documents, found by spaced seeds and verified around each hit.

Words are runs of letters and digits, with A-Z in lower case. A seed takes the words at the ones of a mask and
ignores those at its zeros, so a substituted word at an ignored place leaves it whole. The masks together find
any passage of 15 words with up to 3 substitutions, and of 13 words with up to 2. Each hit gives a diagonal
(place in the document minus place in the item), on which the best stretch is taken: one point for an equal
word, two off for another. A stretch counts when it has ``min_words`` equal words, or all of a shorter item. Where
the best one doesn't count, the stretch with the most equal words among all with at most ``OTHERS`` other words is
taken, so that early or clustered substitutions don't cut a passage that the masks find.

The seeds of texts and items are joined. A benchmark measured to have no more than about ``BLOCK_WORDS`` words is
sent to the tasks, which look every word of every text up: one lazy scan without a shuffle. A larger one never
reaches the driver: its seeds are a table; a filter of fixed size, made of them by an aggregation, leaves few of the
texts' seeds, which are shuffled and joined with the table, each distinct text once. Hits become diagonals; the texts
that have one are read again, the words each diagonal covers are cut out and joined with the item's own. So the
documents are read twice, however large the benchmark is. Contaminated texts are left out by a join on their digest.
Both ways find the same overlaps.

Defined results: null and empty texts and items without words match nothing; items of fewer than ``SHORTEST``
words match nothing; items shorter than the longest mask are looked for as a whole, word for word. Equal items
are each reported. Rows with the same ids give one row per pair: the longest overlap, the first on ties.
Columns other than the id and the text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, map_batches, stored
from cartlens.llm.words import NOT_ALPHANUMERIC, mix, slices, words

MASKS = ("1110011001", "1001001111", "11001010101", "10111011", "111100011")
MIN_WORDS = 10
SHORTEST = 5
OTHERS = 3  # substitutions that the masks find
BLOCK_WORDS = 200_000  # words of a benchmark that is sent to the tasks
SLOT_BITS = 26  # of the filter of seeds, and of that of texts: 8 MB each, whatever they hold
DIAGONALS = 4096  # of one text that are handled as a row
_LONGEST = max(map(len, MASKS))
_AT_ONCE = 1 << 20  # hits looked at together
_FILTER_BITS = 22

_ALL_MASKS = (*MASKS, *("1" * n for n in range(SHORTEST, _LONGEST)))

_ODD = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

OVERLAP_DDL = "doc_id long, item_id long, matched_words int, overlap_words int, doc_word long, item_word int"


def _seeds(hashed: np.ndarray, mask: str) -> np.ndarray:
    """A seed for each place from which the mask fits."""
    n = max(0, len(hashed) - len(mask) + 1)
    out = np.full(n, int(mask, 2) * 2654435761, np.uint64)
    for k, i in enumerate(i for i, bit in enumerate(mask) if bit == "1"):
        out += hashed[i : i + n] * _ODD[k]
    return mix(out)


class SeedIndex:
    """The seeds of a block of items."""

    def __init__(self, ids: list, texts: list) -> None:
        found = words(pa.array(texts, pa.string()), NOT_ALPHANUMERIC)
        self.ids = ids
        self.items = [found.hash[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        long = [i for i, item in enumerate(self.items) if len(item) >= _LONGEST]
        self.tables = [(mask, *self._table(mask, long)) for mask in MASKS]
        lengths = sorted({len(x) for x in self.items if SHORTEST <= len(x) < _LONGEST})
        self.tables += [
            ("1" * n, *self._table("1" * n, [i for i, x in enumerate(self.items) if len(x) == n])) for n in lengths
        ]

    def _table(self, mask: str, items: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted seeds, the item and place of each, and a bit for each seed's first bits."""
        each = [_seeds(self.items[i], mask) for i in items]
        seed = np.concatenate([*each, np.zeros(0, np.uint64)])
        item = np.repeat(np.array(items, np.int64), [len(x) for x in each])
        place = np.concatenate([*(np.arange(len(x)) for x in each), np.zeros(0, np.int64)])
        order = np.argsort(seed, kind="stable")
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[seed >> np.uint64(64 - _FILTER_BITS)] = True
        return seed[order], item[order], place[order], bits

    def overlaps(self, hashed: np.ndarray, first: np.ndarray, min_words: int) -> list[tuple[int, ...]]:
        """(text, item, equal words, words, start in the text, start in the item) of each diagonal with a hit."""
        diagonals: set[tuple[int, int, int]] = set()
        for mask, seeds, items, places, bits in self.tables:
            if not len(seeds):
                continue
            found = _seeds(hashed, mask)
            at = np.flatnonzero(bits[found >> np.uint64(64 - _FILTER_BITS)])
            text = np.searchsorted(first, at, "right") - 1
            keep = at + len(mask) <= first[text + 1]  # a seed doesn't reach into the next text
            at, text = at[keep], text[keep]
            low, high = (np.searchsorted(seeds, found[at], side) for side in ("left", "right"))
            ends = np.concatenate([[0], np.cumsum(high - low)])
            done = 0
            while done < len(at):
                to = max(done + 1, int(np.searchsorted(ends, ends[done] + _AT_ONCE, "right")) - 1)
                number = (high - low)[done:to]
                row = np.arange(ends[to] - ends[done]) + np.repeat(low[done:to] + ends[done] - ends[done:to], number)
                hits = np.stack(
                    [
                        np.repeat(text[done:to], number),
                        items[row],
                        np.repeat(at[done:to] - first[text[done:to]], number) - places[row],
                    ],
                    axis=1,
                )
                diagonals.update(map(tuple, np.unique(hits, axis=0).tolist()))
                done = to
        return [
            (text, item, *best)
            for text, item, shift in sorted(diagonals)
            if (best := self._best(hashed[first[text] : first[text + 1]], self.items[item], shift, min_words))
        ]

    @staticmethod
    def _best(text: np.ndarray, item: np.ndarray, shift: int, min_words: int) -> tuple[int, ...] | None:
        low, high = max(0, -shift), min(len(item), len(text) - shift)
        best = _stretch(text[low + shift : high + shift] == item[low:high], min(min_words, len(item)))
        return best and (best[0], best[1], low + best[2] + shift, low + best[2])


def _stretch(equal: np.ndarray, need: int) -> tuple[int, int, int] | None:
    """Equal words, words and beginning of a diagonal's best stretch, if it has as many equal words as needed."""
    if equal.sum() < need:
        return None
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
    lowest = np.minimum.accumulate(score)
    end = int(np.argmax(score - lowest))
    start = int(np.flatnonzero(score[: end + 1] == lowest[end])[-1])
    if equal[start:end].sum() < need:
        start, end = _most_equal(equal)
    matched = int(equal[start:end].sum())
    return (matched, end - start, start) if matched >= need else None


def _most_equal(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with the most equal words among those with at most ``OTHERS`` others; the shortest, then the
    first on ties."""
    edge = np.concatenate([[-1], np.flatnonzero(~equal), [len(equal)]])
    last = np.minimum(np.arange(len(edge) - 1) + OTHERS + 1, len(edge) - 1)
    low, high = edge[:-1] + 1, edge[last]  # from behind one other word up to another
    at = np.flatnonzero(equal)
    first, behind = np.searchsorted(at, low), np.searchsorted(at, high)
    some = behind > first
    first, behind = first[some], behind[some]
    best = np.lexsort((first, at[behind - 1] - at[first], first - behind))[0]
    return int(at[first[best]]), int(at[behind[best] - 1]) + 1


def _items(benchmark: DataFrame, item_column: str, text_column: str) -> tuple[DataFrame, bool]:
    """The benchmark's items that have a text, and whether they are few enough to be sent to the tasks."""
    items = benchmark.select(F.col(item_column).cast("long").alias("item"), F.col(text_column).alias("text"))
    items = items.where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).head()[0] or 0
    return items, size < BLOCK_WORDS * 6


def _index(items: DataFrame) -> SeedIndex:
    rows = sorted(items.collect(), key=lambda r: (r.item is not None, r.item or 0, r.text))
    return SeedIndex([r.item for r in rows], [r.text for r in rows])


# --- a benchmark of any size -------------------------------------------------------------------------------


def _filter(values: DataFrame) -> np.ndarray:
    """Two bits for each value of the column ``value``, in words of 32."""
    slots = F.array(
        F.shiftrightunsigned("value", 64 - SLOT_BITS), F.col("value").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    )
    masks = values.select(F.explode(slots).alias("slot")).groupBy(F.expr("shiftright(slot, 5)").alias("word"))
    found = masks.agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 31 AS int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (SLOT_BITS - 5), np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def _passing(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places of the values that the filter lets through."""
    size = np.uint64(len(bits) * 32)
    top = np.uint64(65 - int(size).bit_length())  # its first bits, then its last ones
    at = np.arange(len(value))
    for slot_of in (lambda v: v >> top, lambda v: v & (size - np.uint64(1))):
        slot = slot_of(value[at])
        at = at[(bits[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)]
    return at


def _item_words(items: DataFrame) -> DataFrame:
    """Each distinct item with its words' hashes. Items whose keys clash are told apart by their words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = words(batch.column("text"), NOT_ALPHANUMERIC)
        packed = [found.hash[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("item"), pa.array(np.diff(found.first)), pa.array(packed, pa.binary())],
            names=["item_key", "item_id", "n", "words"],
        )

    keyed = items.distinct().select(F.xxhash64("item", "text").alias("key"), "item", "text")
    return map_batches(keyed, run, "item_key long, item_id long, n long, words binary")


def _item_seeds(items: DataFrame) -> DataFrame:
    """The seeds of each item: by all masks, or of a short item as a whole."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, lengths = batch.column("item_key").to_numpy(), batch.column("n").to_numpy()
        parts = [(np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4)))]
        for key, n, packed in zip(keys, lengths, batch.column("words"), strict=True):
            hashed = np.frombuffer(packed.as_buffer(), np.uint64)
            for number, mask in enumerate(_ALL_MASKS):
                if (n >= _LONGEST and mask in MASKS) or (n < _LONGEST and mask == "1" * n):
                    seed = _seeds(hashed, mask)
                    parts.append((seed, *(np.full(len(seed), v) for v in (key, n, number)), np.arange(len(seed))))
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        columns[0] = columns[0].view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["seed", "item_key", "n", "mask", "item_place"]
        )

    return map_batches(
        items.select("item_key", "n", "words"), run, "seed long, item_key long, n long, mask long, item_place long"
    )


def _text_seeds(texts: DataFrame, masks: list[str], bits: np.ndarray) -> DataFrame:
    """The seeds of each text, by its key, that the filter lets through."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column("key").to_numpy()
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for low, high in slices(batch.column("text")):
            found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
            for mask in masks:
                seed = _seeds(found.hash, mask)
                at = _passing(bits, seed)
                text = np.searchsorted(found.first, at, "right") - 1
                keep = at + len(mask) <= found.first[text + 1]  # a seed doesn't reach into the next text
                at, text = at[keep], text[keep]
                parts.append((keys[low + text], seed[at], at - found.first[text]))
        key, seed, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(seed.view(np.int64)), pa.array(place)], names=["key", "seed", "place"]
        )

    return map_batches(texts.select("key", "text"), run, "key long, seed long, place long")


def _suspects(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """The texts whose keys the filter lets through."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.take(pa.array(_passing(bits, batch.column("key").to_numpy().view(np.uint64))))

    return map_batches(texts, run, texts.schema)


def _covered(texts: DataFrame, id_type: str) -> DataFrame:
    """For each diagonal of each text, the hashes of the words it covers and where these begin."""
    schema = pa.schema([(c, pa.int64()) for c in ("item_key", "n", "doc_word", "item_word")] + [("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("text")):
                found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
                lists = batch.column("diagonals").slice(low, high - low)
                row = np.repeat(np.arange(high - low), np.diff(lists.offsets.to_numpy()))
                flat = lists.flatten()
                item, n, shift = (flat.field(flat.type.get_field_index(c)).to_numpy() for c in ("item_key", "n", "shift"))
                first = found.first[row]
                begin = np.maximum(0, -shift)
                end = np.minimum(n, found.first[row + 1] - first - shift)
                parts = [
                    found.hash[a:b].tobytes() for a, b in zip(first + shift + begin, first + shift + end, strict=True)
                ]
                columns = [pa.array(c, pa.int64()) for c in (item, n, begin + shift, begin)]
                ids = batch.column("id").slice(low, high - low).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [ids, *columns, pa.array(parts, pa.binary())], names=["id", *schema.names]
                )

    find_package(texts.sparkSession)
    ddl = f"id {id_type}, item_key long, n long, doc_word long, item_word long, part binary"
    return texts.select("id", "text", "diagonals").mapInArrow(run, ddl)


def _joined_overlaps(texts: DataFrame, items: DataFrame, min_words: int) -> DataFrame:
    """Overlaps of texts (``id, text``) and items, a row for each diagonal that has one."""
    items = stored(_item_words(items), "items")
    seeds = stored(_item_seeds(items), "seeds")
    masks = [_ALL_MASKS[r.mask] for r in seeds.select("mask").distinct().orderBy("mask").collect()]
    texts = texts.where("text IS NOT NULL").withColumn("key", F.xxhash64("text"))
    # Copies of a text are one here. Texts whose keys clash share their diagonals, which their own words then decide.
    asked = _text_seeds(texts, masks, _filter(seeds.select(F.col("seed").alias("value")))).distinct()
    shift = (F.col("place") - F.col("item_place")).alias("shift")
    found = stored(asked.join(seeds, "seed").select("key", "item_key", "n", shift).distinct(), "diagonals")
    per_text = found.groupBy("key").agg(F.count("*").alias("rows"))
    parts = 1 + (per_text.agg(F.max("rows")).head()[0] or 0) // DIAGONALS
    part = F.pmod(F.xxhash64("item_key", "shift"), F.lit(parts)).alias("part")
    lists = found.groupBy("key", part).agg(F.collect_list(F.struct("item_key", "n", "shift")).alias("diagonals"))
    suspects = _suspects(texts, _filter(found.select(F.col("key").alias("value"))))
    id_type = texts.schema["id"].dataType.simpleString()
    pairs = _covered(suspects.join(lists, "key"), id_type).join(items, ["item_key", "n"])
    columns = ["id", "item_id", "matched_words", "overlap_words", "doc_word", "item_word"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, matched, size, start = [], [], [], []
        starts = batch.column("item_word").to_numpy()
        for row, (part, whole) in enumerate(zip(batch.column("part"), batch.column("words"), strict=True)):
            text, item = (np.frombuffer(v.as_buffer(), np.uint64) for v in (part, whole))
            best = _stretch(text == item[starts[row] : starts[row] + len(text)], min(min_words, len(item)))
            if best:
                for values, value in zip((rows, matched, size, start), (row, *best), strict=True):
                    values.append(value)
        at = np.array(rows, np.int64)
        begin = np.array(start, np.int64)
        places = [pa.array(batch.column(c).to_numpy()[at] + begin) for c in ("doc_word", "item_word")]
        places[1] = places[1].cast(pa.int32())
        counts = [pa.array(c, pa.int32()) for c in (matched, size)]
        ids = [batch.column(c).take(pa.array(at)) for c in ("id", "item_id")]
        return pa.RecordBatch.from_arrays([*ids, *counts, *places], names=columns)

    ddl = f"id {id_type}, item_id long, matched_words int, overlap_words int, doc_word long, item_word int"
    return map_batches(pairs.select("id", "item_id", "item_word", "doc_word", "part", "words"), run, ddl)


# --- the operator ------------------------------------------------------------------------------------------


def find_overlaps(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row for each document and item that overlap, with the longest overlap and where it starts."""
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("matched_words", pa.int32())]
        + [("overlap_words", pa.int32()), ("doc_word", pa.int64()), ("item_word", pa.int32())]
    )

    def scan(index: SeedIndex) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, rows = batch.column("doc_id"), []
            for low, high in slices(batch.column("text")):
                found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
                for text, item, *best in index.overlaps(found.hash, found.first, min_words):
                    rows.append((ids[low + text].as_py(), index.ids[item], *best))
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        return map_batches(texts, run, OVERLAP_DDL)

    items, few = _items(benchmark, item_column, text_column)
    if few:
        found = scan(_index(items))
    else:
        found = _joined_overlaps(texts.withColumnRenamed("doc_id", "id"), items, min_words)
        found = found.withColumnRenamed("id", "doc_id")
    best = F.struct(
        F.col("matched_words"), (-F.col("overlap_words")).alias("a"), (-F.col("doc_word")).alias("b"),
        (-F.col("item_word")).alias("c"),
    )
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id", "item_id", "best.matched_words", (-F.col("best.a")).alias("overlap_words"),
            (-F.col("best.b")).alias("doc_word"), (-F.col("best.c")).alias("item_word"),
        )
    )


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, *, text_column: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents without an overlap, with all their columns; a benchmark that is sent to the tasks needs no
    shuffle."""
    items, few = _items(benchmark, "item_id", "text")
    if not few:
        digest = F.sha2(F.col(text_column), 256)
        texts = documents.select(digest.alias("id"), F.col(text_column).alias("text"))
        found = stored(_joined_overlaps(texts, items, min_words).select("id").distinct(), "contaminated")
        return documents.join(found, F.sha2(documents[text_column], 256) == found["id"], "left_anti")
    index = _index(items)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_column)
        keep = np.ones(len(texts), bool)
        for low, high in slices(texts):
            found = words(texts.slice(low, high - low), NOT_ALPHANUMERIC)
            for text, *_ in index.overlaps(found.hash, found.first, min_words):
                keep[low + text] = False
        return batch.filter(pa.array(keep))

    return map_batches(documents, clean, documents.schema)
