"""Language of documents and of the spans of mixed-language text.

Each word is scored for each language by its letter trigrams (with its bounds), as learned from labelled
documents. The script of its first letter narrows the candidates to languages that use this script, and no other
can label it; a word in a script that none uses belongs to no language. Viterbi's algorithm over a text's words, with a penalty for
each switch, labels its words; runs of one label are spans. The document's language is the one with the
most letters; its score is its share of all letters times its probability on its own words.

Learning counts trigrams in the tasks, of about ``SAMPLE`` documents a language at most, drawn by a hash.
Labelling is one pass without a shuffle; a text is scored in blocks, and what is kept of it is one score for
each word and language.

Defined results: null texts and texts without a letter are ``und`` with score 0; if nothing can be learned, all
are. A text in an unknown script goes to the language learned from most documents, with score 0. Ties go to
the language with the higher score on the whole text (a word that it can't label costs ``OUTSIDE``), then to the
one learned from more documents. Very long texts are scored in blocks, whole. Repeated rows are labelled each, and
count each when learned from; an empty table has an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import map_batches, remainder
from cartlens.llm.words import slices

UNDETERMINED = "und"
SAMPLE = 2000  # documents learned from, for each language
SWITCH = 12.0  # what a switch between two words costs, in nats
OUTSIDE = 24.0  # nats that a word outside a language's scripts costs it, among languages with as many letters
USES_SCRIPT = 0.01  # share of a language's letters from which it uses a script
MIN_SHARE = 0.3  # of a text's letters, held by learned languages together
BITS = 16
_SMOOTHING = 0.5
_BLOCK = 1 << 19  # letters scored together
_TOGETHER = 3 << 20  # bytes of texts labelled together
_AS_MANY = 64  # languages up to which blocks have these sizes; with more they are smaller

# The scripts' ranges of code points.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "ethiopic": ((0x1200, 0x137F),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)),
}


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: its lower case, whether it is a letter, and its script (0: another)."""
    lower = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    script = np.zeros(0x110000, np.uint8)
    for code in range(0x32000):
        char = chr(code)
        if unicodedata.category(char)[0] == "L":
            letter[code] = True
            if len(char.lower()) == 1:
                lower[code] = ord(char.lower())
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            script[low : high + 1] = number
    return lower, letter, script


class Letters(NamedTuple):
    """The words of some texts: their places in the joined code points, their text, script and trigrams.

    A word's events are its letters and its end, each with the two letters before.
    """

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    script: np.ndarray
    event: np.ndarray
    first_event: np.ndarray
    offset: np.ndarray


def _letters(texts: list[str]) -> Letters:
    lower, letter, script = _tables()
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "replace"), np.uint32)
    offset = np.cumsum([0, *(len(t) + 1 for t in texts)])
    inside = letter[codes]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = np.where(inside, lower[codes], 0).astype(np.uint64)
    before, earlier = np.zeros_like(low), np.zeros_like(low)
    before[1:], earlier[2:] = low[:-1], low[:-2]
    earlier[before == 0] = 0
    event = inside.copy()
    event[end] = True
    mixed = (low[event] * np.uint64(0x9E3779B97F4A7C15)) ^ (before[event] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) + earlier[event] * np.uint64(0x165667B19E3779F9)
    number = (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)
    return Letters(
        start, end, np.searchsorted(offset, start, "right") - 1, script[codes[start]], number.astype(np.int64),
        np.cumsum(np.concatenate([[0], end - start + 1])), offset,
    )


class LanguageModel(NamedTuple):
    languages: list[str]
    weight: np.ndarray  # log probability of each trigram, by language
    allowed: np.ndarray  # script by language


def learn(documents: DataFrame, *, sample: int = SAMPLE) -> LanguageModel:
    """Count the trigrams of about ``sample`` labelled documents a language (columns doc_id, text and lang)."""
    labelled = documents.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    labelled = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [row["lang"] for row in counts]
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))
    share = F  # one flat list of cases, whatever the number of languages
    for row in counts:
        share = share.when(F.col("lang") == row["lang"], F.lit(min(1 << 30, int((1 << 30) * sample / row["count"]))))
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share).drop("doc_id")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = np.array(batch.column("lang").to_pylist(), object)
        out = []
        for low, high in slices(batch.column("text"), _BLOCK):
            found = _letters(batch.column("text").slice(low, high - low).to_pylist())
            of_word = names[low:high][found.text] if len(found.text) else np.zeros(0, object)
            for name in set(of_word):
                own = of_word == name
                events = found.event[np.repeat(own, np.diff(found.first_event))]
                letters = np.bincount(found.script[own], (found.end - found.start)[own], len(SCRIPTS) + 1)
                seen = np.concatenate([np.bincount(events, minlength=1 << BITS), letters]).astype(np.int64)
                at = np.flatnonzero(seen)
                out.append((np.repeat(name, len(at)), at, seen[at]))
        join = lambda i, kind: np.concatenate([np.zeros(0, kind), *(x[i] for x in out)])
        return pa.RecordBatch.from_arrays(
            [pa.array(join(0, object), pa.string()), pa.array(join(1, np.int64)), pa.array(join(2, np.int64))],
            names=["lang", "event", "n"],
        )

    counted = map_batches(drawn, count, "lang string, event long, n long")
    counted = counted.groupBy("lang", "event").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most one row for each language and trigram number
    seen = np.zeros(((1 << BITS) + len(SCRIPTS) + 1, len(languages)))
    column = {name: i for i, name in enumerate(languages)}
    names = table["lang"].to_pylist()
    seen[table["event"].to_numpy(), [column[x] for x in names]] = table["n"].to_numpy()
    grams, letters = seen[: 1 << BITS], seen[1 << BITS :]
    weight = np.log((grams + _SMOOTHING) / (grams.sum(axis=0) + _SMOOTHING * (1 << BITS)))
    allowed = letters >= np.maximum(1, USES_SCRIPT * letters.sum(axis=0))
    return LanguageModel(languages, weight.astype(np.float32), allowed)


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word of each text (words ``first[i]:first[i + 1]``); all texts go forward
    together, the longest first, so that those with a word left are a prefix."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than t words
    stay = np.ones(score.shape, bool)
    best_before = np.zeros(len(score), np.int16)
    value = np.zeros((len(length), score.shape[1]), np.float64)
    for t in range(longest):
        n = active[t]
        at = begin[:n] + t
        if t:
            v = value[:n]
            leader = v.argmax(axis=1)
            switch = v[np.arange(n), leader][:, None] - penalty
            keep = v >= switch
            stay[at], best_before[at] = keep, leader
            value[:n] = np.where(keep, v, switch)
        value[:n] += score[at]
    label = np.zeros(len(score), np.int16)
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        label[at] = state[:n]
        state[:n] = np.where(stay[at, state[:n]], state[:n], best_before[at])
    return label


def _at_once(size: int, model: LanguageModel) -> int:
    return size * _AS_MANY // max(_AS_MANY, len(model.languages))


class _Labelled(NamedTuple):
    """Labels of the words of some texts (-1: no language), with the texts' totals."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    label: np.ndarray
    predicted: np.ndarray
    score: np.ndarray
    held: np.ndarray  # share of the letters that any language holds


def _label(model: LanguageModel, texts: pa.Array, penalty: float) -> _Labelled:
    """Starts and ends are code points within the text."""
    k = len(model.languages)
    starts, ends, numbers, scores, known = [], [], [], [], []
    for low, high in slices(texts, _BLOCK):
        found = _letters([t or "" for t in texts.slice(low, high - low).to_pylist()])
        score = np.empty((len(found.start), k))
        done = 0
        while done < len(found.start):
            most = found.first_event[done] + _at_once(_BLOCK, model)
            to = max(done + 1, int(np.searchsorted(found.first_event, most, "right")) - 1)
            a, b = found.first_event[done], found.first_event[to]
            score[done:to] = np.add.reduceat(model.weight[found.event[a:b]], found.first_event[done:to] - a, axis=0)
            done = to
        candidates = model.allowed[found.script]
        some = candidates.any(axis=1)
        candidates[~some] = True
        score[~some] = 0
        score[~candidates] = -np.inf
        score -= score.max(axis=1, keepdims=True)
        starts.append(found.start - found.offset[found.text])
        ends.append(found.end - found.offset[found.text])
        numbers.append(found.text + low)
        scores.append(score)
        known.append(some)
    join = lambda parts, empty: np.concatenate([empty, *parts])
    start, end = join(starts, np.zeros(0, np.int64)), join(ends, np.zeros(0, np.int64))
    text, score = join(numbers, np.zeros(0, np.int64)), join(scores, np.zeros((0, k)))
    some = join(known, np.zeros(0, bool))
    n = len(texts)
    label = viterbi(score, np.searchsorted(text, np.arange(n + 1)), penalty)
    label[~some] = -1
    letters = np.bincount(text[some] * k + label[some], (end - start)[some], n * k).reshape(n, k)
    whole = np.stack([np.bincount(text, np.maximum(score[:, i], -OUTSIDE), n) for i in range(k)], axis=1)
    best = letters == letters.max(axis=1, keepdims=True)
    predicted = np.where(best, whole, -np.inf).argmax(axis=1)
    own = some & (label == predicted[text])
    own_score = np.stack([np.bincount(text[own], score[own, i], n) for i in range(k)], axis=1)
    probability = np.exp(own_score - own_score.max(axis=1, keepdims=True))
    probability /= probability.sum(axis=1, keepdims=True)
    total = np.bincount(text, end - start, n)
    rows = np.arange(n)
    share = letters[rows, predicted] / np.maximum(total, 1)
    predicted = np.where(total > 0, predicted, -1)
    score = np.where(total > 0, share * probability[rows, predicted], 0.0)
    return _Labelled(start, end, text, label, predicted, score, letters.sum(axis=1) / np.maximum(total, 1))


def _names(model: LanguageModel, label: np.ndarray) -> pa.Array:
    return pa.array(np.array([*model.languages, UNDETERMINED], object)[label], pa.string())


def predict(documents: DataFrame, model: LanguageModel, *, penalty: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred and score of each document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores, _ = _predictions(model, batch.column("text"), penalty)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), _names(model, labels), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
        )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(texts, run, "doc_id long, lang_pred string, score double")


def _predictions(model: LanguageModel, texts: pa.Array, penalty: float) -> tuple[np.ndarray, ...]:
    labels, scores, held = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts))
    if model.languages:
        for low, high in slices(texts, _at_once(_TOGETHER, model)):
            done = _label(model, texts.slice(low, high - low), penalty)
            labels[low:high], scores[low:high], held[low:high] = done.predicted, done.score, done.held
    return labels, scores, held


SPAN_DDL = "doc_id long, span int, start long, end long, lang string"


def language_spans(documents: DataFrame, model: LanguageModel, *, penalty: float = SWITCH) -> DataFrame:
    """A row for each run of words of one language: its number, where it starts and ends (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for low, high in slices(batch.column("text"), _at_once(_TOGETHER, model)) if model.languages else ():
                done = _label(model, batch.column("text").slice(low, high - low), penalty)
                if not len(done.text):
                    continue
                new = np.ones(len(done.text), bool)
                new[1:] = (done.text[1:] != done.text[:-1]) | (done.label[1:] != done.label[:-1])
                at = np.flatnonzero(new)
                last = np.concatenate([at[1:], [len(new)]]) - 1
                number = np.arange(len(at)) - np.searchsorted(done.text[at], done.text[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(done.text[at] + low)),
                        pa.array(number.astype(np.int32)),
                        pa.array(done.start[at]),
                        pa.array(done.end[last]),
                        _names(model, done.label[at]),
                    ],
                    names=["doc_id", "span", "start", "end", "lang"],
                )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, SPAN_DDL)


def held_out(documents: DataFrame) -> DataFrame:
    """Documents with whether they are held out: crc32 of the id, modulo 3, is 1."""
    return documents.select("doc_id", "text", "lang", (remainder("doc_id", 3) == 1).alias("held_out"))


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score, learned from the documents that are not held out."""
    model = learn(held_out(documents).where("NOT held_out"))
    return predict(documents, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def keep_identified(documents: DataFrame, *, min_share: float = MIN_SHARE) -> DataFrame:
    """The documents with a language: those with a letter, of whose letters the learned languages
    together hold ``MIN_SHARE`` or more; all columns stay. Nothing is shuffled. If no language could be learned, all stay."""
    model = learn(held_out(documents).where("NOT held_out"))
    if not model.languages:
        return documents

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, _, held = _predictions(model, batch.column("text"), SWITCH)
        return batch.filter(pa.array((labels >= 0) & (held >= min_share)))

    return map_batches(documents, run, documents.schema)
