"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's score is a logistic function of its words (runs of letters and digits, A-Z in lower case) and of
their beginnings and ends of 4 to 8 bytes, which inflected words share; a document's score is the noisy-or of
its sentences', ``1 - prod(1 - score)``. Only documents have labels, so the weights are fitted to these
through the noisy-or, and the sentence scores that come with them locate what is offending. Sentences end at
``. ! ?`` or a line's end.

Weights are fitted to about ``SAMPLE`` documents of either label, drawn by a hash of the id, over what at
least ``MIN_DOCUMENTS`` of them have and toxic ones clearly have more often (a likelihood ratio of ``MIN_RATIO``),
so chance words of few documents learn nothing. The tasks read the drawn texts, whole and however long; the driver
receives how many documents have each feature, then, of each document, its number of sentences and which of them
have a feature that counts, in the order of the ids. Scoring is one pass over whole texts without a shuffle.

Defined results: null texts and texts without words score 0; with labels of one kind only, or none, every text
with a word scores the share of toxic labels (0 without labels). Documents with several labels are toxic if
one says so; null labels and null ids say nothing. Of several texts with one id, the first in code point order is
learned from; each is scored. An empty table has an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, hash_share, map_batches, remainder, small_batches, stored
from cartlens.llm.words import LOWER, NOT_ALPHANUMERIC, Words, mix, slices, words

SAMPLE = 2500  # documents learned from, of either label
MIN_DOCUMENTS = 4
MIN_RATIO = 20.0  # twice the log likelihood ratio of a feature and the label
PARTS = range(4, 9)  # bytes of the beginnings and ends
BITS = 20  # weights are looked up by so many bits of a word's hash
ROUNDS = 250
RATE = 0.15
PENALTY = 2e-4

_ENDS = np.zeros(256, bool)
_ENDS[[0x0A, 0x0D, 0x21, 0x2E, 0x3F]] = True


class ToxicityModel(NamedTuple):
    weight: np.ndarray  # by the first bits of a word's hash
    bias: float
    base: float | None  # the score of every text with a word, where nothing could be learned


NONE = 1 << BITS  # the feature that a word lacks, whose weight is 0


def _number(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - BITS)).astype(np.int64)


def _features(found: Words) -> Iterator[np.ndarray]:
    """The number of each word, then of its beginnings and ends of each length."""
    yield _number(found.hash)
    data, length = LOWER[found.data], found.end - found.start
    for from_end in (False, True):
        part = np.full(len(length), 1 + from_end, np.uint64)
        for i in range(PARTS.stop - 1):
            at = found.end - 1 - i if from_end else found.start + i
            inside = i < length
            byte = data[np.where(inside, at, found.start)] if len(data) else np.zeros(0, np.uint8)
            part = (part ^ byte) * np.uint64(0x100000001B3)
            if i + 1 in PARTS:
                yield np.where(inside, _number(mix(part + np.uint64(i))), NONE)


def _sentences(found: Words) -> np.ndarray:
    """Where each sentence's words begin, with the number of words at the end."""
    ends = np.flatnonzero(_ENDS[found.data])
    part = np.searchsorted(ends, found.start)
    text = found.of_text()
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (text[1:] != text[:-1])
    return np.concatenate([np.flatnonzero(new), [len(part)]])


def _useful(seen: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Features that documents with label 1 have more often, beyond chance. ``seen``: documents of either label
    that have a feature, ``of``: all documents of either label."""
    both = seen.sum(axis=0)
    ratio = np.zeros(seen.shape[1])
    for mark in (0, 1):
        for have, total in ((seen[mark], both), (of[mark] - seen[mark], of.sum() - both)):
            expected = np.maximum(total * of[mark] / of.sum(), 1e-12)
            ratio += 2 * have * np.log(np.maximum(have, 1e-12) / expected)
    more = seen[1] * of[0] > seen[0] * of[1]
    return more & (both >= MIN_DOCUMENTS) & (ratio >= MIN_RATIO)


def _counted(drawn: DataFrame, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that enough documents have and toxic ones more often, and how many of either label have them."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = batch.column("mark").to_numpy()
        seen = np.zeros((2, NONE + 1), np.int64)
        for low, high in slices(batch.column("text")):
            found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
            text = found.of_text()
            for column in _features(found):
                pairs = np.unique(text * (NONE + 1) + column)
                for mark in (0, 1):
                    of_mark = pairs[marks[low:high][pairs // (NONE + 1)] == mark] % (NONE + 1)
                    seen[mark] += np.bincount(of_mark, minlength=NONE + 1)
        at = np.flatnonzero(seen[:, :NONE].any(axis=0))
        columns = [pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])]
        return pa.RecordBatch.from_arrays(columns, names=["feature", "clean", "toxic"])

    counts = map_batches(drawn.select("text", "mark"), count, "feature long, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.where(F.col("clean") + F.col("toxic") >= MIN_DOCUMENTS)
    counts = counts.where(F.col("toxic") * int(of[0]) > F.col("clean") * int(of[1]))
    rows = counts.toArrow().sort_by("feature")  # at most 2**BITS rows of three numbers
    return rows["feature"].to_numpy(), np.stack([rows["clean"].to_numpy(), rows["toxic"].to_numpy()])


class _Hits(NamedTuple):
    """The drawn documents, in the order of their ids, and their sentences that have a useful feature."""

    toxic: np.ndarray
    plain: np.ndarray  # sentences of each document without a useful feature
    document: np.ndarray  # of each sentence that has one
    sentence: np.ndarray  # of each hit
    column: np.ndarray  # the number of its feature


def _hits(drawn: DataFrame, useful: np.ndarray) -> _Hits:
    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = np.full(NONE + 1, -1, np.int32)
        number[useful] = np.arange(len(useful))
        out = []
        for low, high in slices(batch.column("text")):
            found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
            begin = _sentences(found)
            text = np.searchsorted(found.first, begin[:-1], "right") - 1
            totals = np.bincount(text, minlength=high - low)
            out.append((np.arange(low, high), np.full(high - low, -1), totals))
            sentence = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
            # A feature counts once in a sentence.
            each = [(sentence * len(useful) + number[c])[number[c] >= 0] for c in _features(found)]
            each = np.unique(np.concatenate(each))
            of = each // max(1, len(useful))
            out.append((text[of] + low, of, each % max(1, len(useful))))
        text, sentence, column = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
        rows = pa.array(text)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("mark").take(rows), pa.array(sentence), pa.array(column)],
            names=["doc_id", "mark", "sentence", "n"],
        )

    rows = map_batches(drawn, find, "doc_id long, mark int, sentence long, n long").toArrow()
    doc, mark, sentence, n = (rows[c].to_numpy() for c in ("doc_id", "mark", "sentence", "n"))
    order = np.lexsort((n, sentence, doc))
    doc, mark, sentence, n = doc[order], mark[order], sentence[order], n[order]
    total = sentence == -1  # a document's own row, which comes first
    ids = doc[total]
    of = np.searchsorted(ids, doc[~total])
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (sentence[~total][1:] != sentence[~total][:-1])
    document = of[new]
    plain = n[total] - np.bincount(document, minlength=len(ids))
    return _Hits(mark[total].astype(float), plain, document, np.cumsum(new) - 1, n[~total])


def fit(hits: _Hits, importance: np.ndarray, features: int) -> tuple[np.ndarray, float]:
    """The weights of the features and the bias that maximise the likelihood of the documents' labels, by Adam
    on all of these documents at once."""
    weight, bias = np.zeros(features), -4.0
    moments = [np.zeros(features + 1), np.zeros(features + 1)]
    importance = importance / importance.sum()
    for step in range(1, ROUNDS + 1):
        z = np.bincount(hits.sentence, weight[hits.column], len(hits.document)) + bias
        log_clean = np.bincount(hits.document, -np.logaddexp(0, z), len(hits.toxic))
        log_clean -= hits.plain * np.logaddexp(0, bias)
        clean = np.exp(np.minimum(log_clean, -1e-9))
        up = (hits.toxic * clean / (1 - clean) - (1 - hits.toxic)) * importance
        slope = up[hits.document] / (1 + np.exp(-z))
        of_bias = slope.sum() + (hits.plain * up).sum() / (1 + np.exp(-bias))
        gradient = np.append(np.bincount(hits.column, slope[hits.sentence], features) - PENALTY * weight, of_bias)
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weight += move[:-1]
        bias += move[-1]
    return weight, float(bias)


def learn(documents: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> ToxicityModel:
    """Fit the model to a bounded sample of the labelled documents."""
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max((F.col("toxic").cast("int") != 0).cast("int")).alias("mark"))
    number = {row["mark"]: row["count"] for row in marks.groupBy("mark").count().collect()}
    chosen = [marks.where(F.col("mark") == mark).where(hash_share(n, sample, "doc_id")) for mark, n in number.items()]
    flat = np.zeros(NONE + 1, np.float32)
    if not chosen:
        return ToxicityModel(flat, 0.0, 0.0)
    few = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    texts = documents.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most about 2 * sample ids are sent to the tasks, and as many texts stored.
    drawn = texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "mark").agg(F.min("text").alias("text"))
    drawn = stored(drawn, "toxicity")
    of = {row["mark"]: row["count"] for row in drawn.groupBy("mark").count().collect()}
    if not of.get(0) or not of.get(1):
        return ToxicityModel(flat, 0.0, float(bool(of.get(1))))
    of = np.array([of[0], of[1]])
    with small_batches(documents.sparkSession):
        features, seen = _counted(drawn, of)
        useful = features[_useful(seen, of)]
        if not len(useful):
            return ToxicityModel(flat, 0.0, number[1] / (number[0] + number[1]))
        hits = _hits(drawn, useful)
    importance = np.where(hits.toxic == 1, number[1] / of[1], number[0] / of[0])
    weight, bias = fit(hits, importance, len(useful))
    flat[useful] = weight
    return ToxicityModel(flat, bias, None)


def _scores(model: ToxicityModel, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where sentences begin, their scores, and the texts' scores."""
    begin = _sentences(found)
    n = len(found.first) - 1
    if model.base is not None:
        return begin, np.full(len(begin) - 1, model.base), np.where(found.counts() > 0, model.base, 0.0)
    if not len(found.hash):
        return begin, np.zeros(0), np.zeros(n)
    # A feature that a sentence repeats counts once; only those with a weight need looking at.
    hits = []
    for column in _features(found):
        at = np.flatnonzero(model.weight[column])
        hits.append((np.searchsorted(begin, at, "right") - 1) * (NONE + 1) + column[at])
    unique = np.unique(np.concatenate(hits))
    z = np.bincount(unique // (NONE + 1), model.weight[unique % (NONE + 1)], len(begin) - 1) + model.bias
    text = np.searchsorted(found.first, begin[:-1], "right") - 1
    log_clean = np.bincount(text, -np.logaddexp(0, z), n)
    return begin, 1 / (1 + np.exp(-z)), -np.expm1(log_clean)


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and predicted of each document, and its highest sentence score."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, highest = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for low, high in slices(batch.column("text")):
            found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
            begin, of_sentence, scores[low:high] = _scores(model, found)
            np.maximum.at(highest, np.searchsorted(found.first, begin[:-1], "right") - 1 + low, of_sentence)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(highest)],
            names=["doc_id", "score", "predicted", "top_sentence"],
        )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(texts, run, "doc_id long, score double, predicted int, top_sentence double")


def offending_sentences(documents: DataFrame, model: ToxicityModel, *, threshold: float = 0.5) -> DataFrame:
    """The sentences that score so high: doc_id, number of the first word, score, and the words' text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column("text")):
                found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
                begin, of_sentence, _ = _scores(model, found)
                at = np.flatnonzero(of_sentence >= threshold)
                text = np.searchsorted(found.first, begin[at], "right") - 1
                parts = [
                    bytes(found.data[found.start[a] : found.end[b - 1]]).decode("utf-8")
                    for a, b in zip(begin[at], begin[at + 1], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(text + low)),
                        pa.array(begin[at] - found.first[text]),
                        pa.array(of_sentence[at]),
                        pa.array(parts, pa.string()),
                    ],
                    names=["doc_id", "word", "score", "sentence"],
                )

    find_package(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, word long, score double, sentence string")


def detect(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (crc32 of the id, modulo 5, is 0), score and predicted, learned from the rest's labels."""
    model = learn(documents.where(remainder("doc_id", 5) != 0), labels.where(remainder("doc_id", 5) != 0))
    return score(documents, model).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "top_sentence"
    )
