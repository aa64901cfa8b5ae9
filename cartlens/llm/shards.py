"""Training-order shards: token sequences at slots given by a keyed permutation, in files of fixed stride.

Each text's token ids, with the vocabulary's end id behind them, are cut into sequences. Sequences are numbered
through all partitions, and a Feistel network with a secret key permutes the numbers; a number that leaves the
range is permuted again until it is inside, so every sequence gets a slot of its own below their number. A
shard holds ``shard_records`` slots in order; each record has the same length, so slot s is found at record
``s % shard_records`` of shard ``s // shard_records``, and reading can go on from any slot without the rest.
Sequences are shuffled by ranges of slots: a task gets the slots of ``shards_per_task`` shards, sorts them and
writes its shards one after another. As slots are a permutation, the ranges are known and equally full.

A record is the document's id, the sequence's number in its text, the number of its ids, the ids, padding, and a
line break (Spark writes each shard as text). Numbers are big-endian; ids take 16 bits where the vocabulary
allows it.

The texts are encoded twice, once to count and once to write, rather than stored encoded in between; both passes
read the same partitions, so the documents must come from files (store them first where they don't).

Defined results: null and empty texts are one sequence with the end id only; a null id is the smallest 64-bit
number in the record and null when read. Rows that share an id have their sequences each. A text of any length
is encoded in blocks and spread over its sequences' slots. An empty table has no shards and reads as no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, shared_path
from cartlens.llm.tokens import Vocabulary, encoded, encoder
from cartlens.llm.words import mix

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 256  # ids of a sequence
SHARD_RECORDS = 1 << 14
SHARDS_PER_TASK = 8  # some 70 MB of records
KEY = 20240601
ROUNDS = 6
_HEAD = np.dtype([("doc", ">i8"), ("part", ">i4"), ("n", ">i4")])
_NULL = np.iinfo(np.int64).min


def slots(numbers: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """A permutation of ``range(total)``, applied to these numbers."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix(np.array([key], np.uint64)))
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # walk the cycle until the number is in range again
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= np.uint64(total)]
    return out.astype(np.int64)


READ_DDL = "slot long, shard long, doc_id long, part int, n_tokens int, ids binary"


class Layout(NamedTuple):
    """Where the sequences lie."""

    path: str
    sequences: int
    length: int
    shard_records: int
    id_bytes: int

    @property
    def stride(self) -> int:
        return _HEAD.itemsize + self.length * self.id_bytes + 1


def _sequences(
    vocabulary: Vocabulary, texts: pa.Array, length: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice: its first text, its ids with ends, where each text's begin, and the texts' sequences."""
    for low, ids, first in encoded(vocabulary, texts):
        ids = np.insert(ids, first[1:], encoder(vocabulary).end)
        first = first + np.arange(len(first))
        yield low, ids, first, -(-np.diff(first) // length)


def _offsets(texts: DataFrame, vocabulary: Vocabulary, length: int) -> dict[int, tuple[int, int]]:
    """For each partition, the number of sequences in those before it, and its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            total += sum(int(n.sum()) for *_, n in _sequences(vocabulary, batch.column("text"), length))
        columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "n"])

    rows = texts.mapInArrow(count, "part int, n long").collect()  # a row for each partition
    out, done = {}, 0
    for row in sorted(rows, key=lambda r: r["part"]):
        out[row["part"]] = (done, row["n"])
        done += row["n"]
    return out


def write_shards(
    documents: DataFrame,
    path: str | None = None,
    *,
    vocabulary_path: str = VOCABULARY,
    length: int = LENGTH,
    shard_records: int = SHARD_RECORDS,
    shards_per_task: int = SHARDS_PER_TASK,
    key: int = KEY,
) -> Layout:
    """Write the documents' sequences (doc_id, text) in training order and return where they lie."""
    spark = documents.sparkSession
    path = path or shared_path(spark, "shards")
    find_package(spark)
    vocabulary = Vocabulary.read(vocabulary_path)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    offsets = _offsets(texts, vocabulary, length)
    total = sum(n for _, n in offsets.values())
    kind = vocabulary.kind
    layout = Layout(path, total, length, shard_records, kind.itemsize)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own = offsets[TaskContext.get().partitionId()]
        end = number + own
        for batch in batches:
            documents = batch.column("doc_id").fill_null(int(_NULL)).to_numpy()
            for low, ids, first, count in _sequences(vocabulary, batch.column("text"), length):
                text = np.repeat(np.arange(len(count)), count)
                part = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                begin = first[text] + part * length
                size = np.minimum(first[text + 1] - begin, length)
                head = np.empty(len(text), _HEAD)
                head["doc"], head["part"], head["n"] = documents[text + low], part, size
                slot = slots(np.arange(number, number + len(text)), total, key)
                number += len(text)
                # Heads and ids of varying number behind each other; the writer adds the padding.
                stop = np.cumsum(_HEAD.itemsize + size * kind.itemsize)
                whole = np.empty(stop[-1], np.uint8)
                from_head = stop - (_HEAD.itemsize + size * kind.itemsize)
                whole[from_head[:, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(len(head), -1)
                filled = np.ones(len(whole), bool)
                filled[from_head[:, None] + np.arange(_HEAD.itemsize)] = False
                whole[filled] = ids.astype(kind).view(np.uint8)
                ends = np.concatenate([[0], stop]).astype(np.int32)
                records = pa.BinaryArray.from_buffers(
                    pa.binary(), len(text), [None, pa.py_buffer(ends), pa.py_buffer(whole)]
                )
                columns = [pa.array(slot // shard_records), pa.array(slot), records]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "slot", "record"])
        encoder.cache_clear()  # the worker lives on, and what follows needs no encoder
        if number != end:
            raise RuntimeError("the documents' partitions have changed between the passes; store them first")

    rows = texts.mapInArrow(run, "shard long, slot long, record binary")
    of_task = shard_records * shards_per_task
    ranges = max(1, -(-total // of_task))
    padded = F.rpad("record", F.lit(layout.stride - 1), F.lit(b"\x00"))
    in_range = (F.col("slot") / F.lit(of_task)).cast("int")
    ordered = rows.repartitionById(ranges, in_range).sortWithinPartitions("shard", "slot")
    ordered.select("shard", padded.cast("string").alias("record")).write.partitionBy("shard").text(path)
    return layout


def _number(record: str, begin: int, size: int) -> str:
    return f"cast(conv(hex(substring({record}, {begin}, {size})), 16, -10) as long)"


def read_shards(spark: SparkSession, layout: Layout, *, from_slot: int = 0) -> DataFrame:
    """The sequences from a slot on: slot, shard, doc_id, part, n_tokens and ids (bytes). Earlier shards aren't
    read; within a shard, records are found by their place."""
    if not layout.sequences:
        return spark.createDataFrame([], READ_DDL)
    files = spark.read.format("binaryFile").load(layout.path)
    files = files.where(F.col("shard") >= from_slot // layout.shard_records).select("shard", "content")
    places = F.expr(f"sequence(0, cast(octet_length(content) / {layout.stride} as int) - 1)")
    records = files.select("shard", "content", F.explode(places).alias("place")).select(
        F.col("shard").cast("long").alias("shard"),
        (F.col("shard").cast("long") * layout.shard_records + F.col("place")).alias("slot"),
        F.expr(f"substring(content, place * {layout.stride} + 1, {layout.stride - 1})").alias("record"),
    )
    doc = F.expr(_number("record", 1, 8))
    n = F.expr(_number("record", 13, 4)).cast("int")
    return records.where(F.col("slot") >= from_slot).select(
        "slot",
        "shard",
        F.when(doc != int(_NULL), doc).alias("doc_id"),
        F.expr(_number("record", 9, 4)).cast("int").alias("part"),
        n.alias("n_tokens"),
        F.expr(f"substring(record, {_HEAD.itemsize + 1}, {layout.id_bytes} * {_number('record', 13, 4)})").alias("ids"),
    )


def materialise(documents: DataFrame, **options: object) -> DataFrame:
    """Write the shards, read them back, and return each slot's sequence: its shard, document, part, number of
    tokens and the MD5 of its ids."""
    layout = write_shards(documents, **options)
    read = read_shards(documents.sparkSession, layout)
    return read.withColumn("ids_md5", F.md5("ids")).drop("ids")
