"""Licence notices in documents, by a positional index of rare licence words.

The index holds each word of the licence templates with the templates and places where it stands. Its words
are weighed by their inverse document frequency over all documents. A file can only hold a template's notice if
it has all words of the template's mandatory key phrase. For such a template the file looks up, of the template's
words that it has, its own ``LOOKUPS`` of highest weight, and its two of highest weight in the key phrase. Their
postings meet by relative position (place in the file minus place in the template): where two different words
agree, the key phrase must stand, word for word, at that position. How much of the template stands there, word by
word, is the notice's score. Two words of a phrase that stands always agree on its position, so each notice is
found, however common it is, and phrases are compared only where postings meet.

Beside that, all places of the three base phrases are counted. Words are runs of letters and digits with A-Z
in lower case. Two passes over whole texts; only one row for each licence word and task is shuffled. Texts are
taken in blocks, so very long ones take memory for their words only.

Defined results: null and empty texts have no words and no labels (empty strings, null places, score 0). A base
phrase without a notice scores ``BASE_SCORE``. Repeated rows are answered each, whatever their ids, and words of
equal weight are looked up in the order of their hashes; an empty table has an empty result. Other columns are
never read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import map_batches
from cartlens.llm.words import NOT_ALPHANUMERIC, Words, slices, words

LOOKUPS = 4  # words of a template that a file looks up, beside two of the key phrase
BASE_SCORE = 0.5

# The base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, text of a notice, and the phrase of it that must stand.
TEMPLATES = (
    ("mit", "Released under the MIT License", "the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License",
        "the Apache License, Version 2.0",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "GNU General Public License"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "under the terms of the GNU General Public License",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License", "GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License", "GNU Affero General Public License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
        "Permission to use, copy, modify, and/or distribute this software",
    ),
    ("mpl", "subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License"),
    ("cc-by", "Licensed under CC BY 4.0", "under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "CC BY-SA 4.0"),
    ("cc0", "released under CC0 1.0 Universal", "CC0 1.0"),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
        "free and unencumbered software released into the public domain",
    ),
    ("proprietary", "All rights reserved", "All rights reserved"),
)


def _hashes(text: str) -> np.ndarray:
    return words(pa.array([text], pa.string()), NOT_ALPHANUMERIC).hash


class Template(NamedTuple):
    label: str
    words: np.ndarray
    key: np.ndarray
    key_place: int


def _template(label: str, text: str, key: str) -> Template:
    whole, phrase = _hashes(text), _hashes(key)
    place = next(i for i in range(len(whole)) if np.array_equal(whole[i : i + len(phrase)], phrase))
    return Template(label, whole, phrase, place)


class LicenceIndex:
    """Postings of the licence words, and each template's words by weight."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...] = TEMPLATES) -> None:
        self.templates = [_template(*t) for t in templates]
        self.vocabulary = np.unique(np.concatenate([t.words for t in self.templates]))
        posting = sorted(
            (int(np.searchsorted(self.vocabulary, h)), t, i)
            for t, template in enumerate(self.templates)
            for i, h in enumerate(template.words)
        )
        self.word, self.template, self.place = np.array(posting).T
        self.first = np.searchsorted(self.word, np.arange(len(self.vocabulary) + 1))
        self.weigh(np.zeros(len(self.vocabulary), np.int64), 0)

    def numbers(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where licence words stand, and their numbers."""
        at = np.searchsorted(self.vocabulary, hashed)
        at[at == len(self.vocabulary)] = 0
        where = np.flatnonzero(self.vocabulary[at] == hashed)
        return where, at[where]

    def weigh(self, documents: np.ndarray, total: int) -> None:
        """Order each template's words and its key phrase's by weight, from the number of documents that have
        each and of all documents."""
        idf = np.log((1 + total) / (1 + documents))

        def heaviest_first(hashed: np.ndarray) -> np.ndarray:
            own = np.unique(np.searchsorted(self.vocabulary, hashed))
            return own[np.argsort(-idf[own], kind="stable")]

        self.by_weight = [(heaviest_first(t.words), heaviest_first(t.key)) for t in self.templates]

    def lookups(self, has: np.ndarray) -> np.ndarray:
        """Which words each file looks up for each template (file, template, word), from those that it has."""
        out = np.zeros((len(has), len(self.templates), has.shape[1]), bool)
        for t, (whole, key) in enumerate(self.by_weight):
            possible = np.flatnonzero(has[:, key].all(axis=1))
            for own, most in ((whole, LOOKUPS), (key, 2)):
                present = has[np.ix_(possible, own)]
                out[np.ix_(possible, [t], own)] |= (present & (present.cumsum(axis=1) <= most))[:, None, :]
        return out


def _frequencies(texts: DataFrame, index: LicenceIndex) -> tuple[np.ndarray, int]:
    """The number of documents that have each licence word, and of all documents."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(len(index.vocabulary) + 1, np.int64)
        total[-1] = batch.num_rows
        for low, high in slices(batch.column("text")):
            found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
            where, number = index.numbers(found.hash)
            text = np.searchsorted(found.first, where, "right") - 1
            once = np.unique(text * len(index.vocabulary) + number) % len(index.vocabulary)
            total[:-1] += np.bincount(once, minlength=len(index.vocabulary))
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    counts = map_batches(texts.select("text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(len(index.vocabulary) + 1, np.int64)
    for row in counts.collect():  # a row for each licence word
        out[row["word"]] = row["n"]
    return out[:-1], int(out[-1])


def _phrase_places(found: Words, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and word numbers where the phrase's words stand in a row."""
    n = len(found.hash) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(found.hash[:n] == phrase[0])
    for i in range(1, len(phrase)):
        at = at[found.hash[at + i] == phrase[i]]
    text = np.searchsorted(found.first, at, "right") - 1
    whole = at + len(phrase) <= found.first[text + 1]
    return text[whole], at[whole] - found.first[text[whole]]


def _stands(own: np.ndarray, phrase: np.ndarray, at: int) -> bool:
    """Whether the phrase's words stand in a row at this place of a file's words."""
    return at >= 0 and np.array_equal(own[at : at + len(phrase)], phrase)


def notices(found: Words, index: LicenceIndex) -> list[tuple[int, int, int, float]]:
    """(text, template, first word, score) of each notice: words looked up agree, and the key phrase stands."""
    where, number = index.numbers(found.hash)
    text = np.searchsorted(found.first, where, "right") - 1
    some, file = np.unique(text, return_inverse=True)  # files that have a licence word
    has = np.zeros((len(some), len(index.vocabulary)), bool)
    has[file, number] = True
    looked_up = index.lookups(has)
    use = looked_up.any(axis=1)[file, number]
    where, number, text, file = where[use], number[use], text[use], file[use]
    postings = index.first[number + 1] - index.first[number]
    ends = np.cumsum(postings)
    row = np.arange(ends[-1] if len(ends) else 0) + np.repeat(index.first[number] - (ends - postings), postings)
    each = np.repeat(np.arange(len(number)), postings)
    own = looked_up[file[each], index.template[row], number[each]]
    row, each = row[own], each[own]
    shift = (where - found.first[text])[each] - index.place[row]
    meet = np.unique(np.stack([text[each], index.template[row], shift, number[each]], axis=1), axis=0)
    groups, agree = np.unique(meet[:, :3], axis=0, return_counts=True)
    out = []
    for t, k, start in groups[agree >= 2].tolist():
        template, own = index.templates[k], found.hash[found.first[t] : found.first[t + 1]]
        if _stands(own, template.key, start + template.key_place):
            a, b = max(0, -start), min(len(template.words), len(own) - start)
            equal = int((own[start + a : start + b] == template.words[a:b]).sum())
            out.append((t, k, max(0, start), equal / len(template.words)))
    return out


_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_notices long"
)


def scan(documents: DataFrame) -> DataFrame:
    """For each document its base phrases, labels and score, and the number of notices found by the index."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = LicenceIndex()
    index.weigh(*_frequencies(texts, index))
    base = [(_hashes(phrase), label) for phrase, label in BASE_PHRASES.items()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        n_words, n_base, n_notices = (np.zeros(n, np.int64) for _ in range(3))
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        score = np.zeros(n)
        base_labels, labels = ([set() for _ in range(n)] for _ in range(2))
        for low, high in slices(batch.column("text")):
            found = words(batch.column("text").slice(low, high - low), NOT_ALPHANUMERIC)
            n_words[low:high] = found.counts()
            for phrase, label in base:
                text, at = _phrase_places(found, phrase)
                text = text + low
                np.add.at(n_base, text, 1)
                np.minimum.at(first, text, at)
                np.maximum.at(last, text, at)
                for t in set(text.tolist()):
                    base_labels[t].add(label)
                    labels[t].add(label)
                    score[t] = max(score[t], BASE_SCORE)
            for t, k, _, covered in notices(found, index):
                labels[t + low].add(index.templates[k].label)
                score[t + low] = max(score[t + low], covered)
                n_notices[t + low] += 1
        none = n_base == 0
        joined = [pa.array([",".join(sorted(x)) for x in each], pa.string()) for each in (base_labels, labels)]
        columns = [
            batch.column("doc_id"), pa.array(n_words), pa.array(n_base), pa.array(first, mask=none),
            pa.array(last, mask=none), *joined, pa.array(score), pa.array(n_notices),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in _DDL.split(", ")])

    return map_batches(texts, run, _DDL)
