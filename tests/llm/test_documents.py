"""Operators on documents against brute force, with every kind of odd row."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartlens.llm import decontamination, jaccard, langid, licences, lm, mixing, queries, shards, tokens, toxicity
from cartlens.llm.graph import components
from cartlens.llm.words import NOT_ALPHANUMERIC, words

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def varied(documents, prose):
    """Copies, near copies, short, empty, null and very long texts, repeated rows, null and shared ids."""
    base = prose(1, 300)
    cut = base.split()
    rows = [(i, prose(100 + i, 40 + 7 * i), "en", f"s{i % 4}") for i in range(20)]
    rows += [(30 + i, base, "en", "hot") for i in range(25)]
    rows += [(60 + i, " ".join(cut[: 100 + i] + ["new"] + cut[101 + i :]).upper(), "en", "hot") for i in range(25)]
    rows += [(90 + i, " ".join(cut[: 290 - 3 * i]), "de", None) for i in range(20)]
    rows += [(120, None, None, None), (121, "", "en", "s1"), (122, " \n", "en", "s1"), (123, "one two", "en", "s1")]
    rows += [(124, "One  two", "en", "s1"), (125, "mit license. Apache License", None, "s2"), (None, base, "en", "s2")]
    rows += [(126, "one two", "en", "s1"), (126, "one two", "en", "s1"), (127, prose(5, 20000), "fr", "s3")]
    rows += [(128, prose(5, 20000) + " tail", "fr", "s3"), (-5, prose(9, 60), "en", "s3")]
    return documents(rows)


def brute_groups(rows):
    sets = []
    for row in rows:
        own = plain(row.text)
        sets.append({tuple(own[j : j + 5]) for j in range(max(1, len(own) - 4))} if own else set())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and rows[i].doc_id is not None and rows[j].doc_id is not None:
                if 100 * common >= 80 * len(sets[i] | sets[j]):
                    group[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row.doc_id is not None:
            least[find(i)] = min(least.get(find(i), row.doc_id), row.doc_id)
    return [(row.doc_id, len(sets[i]), least.get(find(i))) for i, row in enumerate(rows)]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize(("leaf", "tile", "frequent"), [(16, 1024, 1 << 18), (2, 4, 1 << 18), (2, 4, 0)])
def test_groups_are_those_of_all_pairs(varied, leaf, tile, frequent, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "MINIMA", 1)  # leave work to the trees
    assert in_order(jaccard.similar_groups(varied).collect()) == in_order(brute_groups(varied.collect()))


def test_one_of_each_group_stays(varied):
    kept = jaccard.first_of_groups(varied)
    assert kept.columns == varied.columns
    expected = {component for _, _, component in brute_groups(varied.collect())}
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(expected - {None})
    assert kept.where("doc_id IS NULL").count() == 1


def test_tree_finds_what_all_bounds_allow():
    draw = np.random.default_rng(3)
    size = draw.integers(20, 60, 300)
    fine = [np.bincount(draw.integers(0, 64, n), minlength=64).astype(np.uint8) for n in size]
    for i in range(0, 300, 3):
        fine[i] = fine[i - 1].copy()
        fine[i][i % 64] += 1
    size = np.array([f.sum() for f in fine]).astype(np.int64)
    component = np.arange(300) // 2
    points = np.stack(fine).astype(np.int32)
    found = {
        tuple(sorted((int(a), int(b))))
        for x, y in jaccard.CountTree(points, size, component).pairs()
        for a, b in zip(x, y, strict=True)
    }
    expected = {
        (a, b)
        for a in range(300)
        for b in range(a + 1, 300)
        if component[a] != component[b]
        and jaccard.may_be_similar(fine[a].tobytes(), fine[b].tobytes(), size[a], size[b])
    }
    assert expected and found == expected


def test_points_of_any_size_bound_the_intersection():
    draw = np.random.default_rng(4)
    for n in (3, 70, 300, 3000):
        a = np.unique(draw.integers(0, 2**64 - 1, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * 0.9)], draw.integers(0, 2**64 - 1, n // 20, dtype=np.uint64)]))
        p = jaccard._points(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])).to_pylist()
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            assert jaccard.may_be_similar(p[0], p[1], len(a), len(b))


def test_components_of_chains_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(300, 200), (5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == (
        {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)} | {200: 200, 300: 200}
    )


def test_mix_follows_the_water_level(varied):
    rows = varied.collect()
    mixed = mixing.mix_sources(varied).collect()
    size = Counter()
    for row in rows:
        size[row.source] += len(plain(row.text))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in order if s not in free)
        target = {s: weight[s] * left / sum(weight[t] for t in free) if s in free else 3 * size[s] for s in order}
        over = {s for s in free if target[s] > 3 * size[s]}
        if not over:
            break
        free -= over
    assert len(mixed) == len(rows)
    source = {row.doc_id: row.source for row in rows}
    taken = Counter()
    for row in mixed:
        assert row.source_size == size[source[row.doc_id]]
        assert math.isclose(row.target, target[source[row.doc_id]])
        assert row.taken == row.size * row.copies <= 3 * row.size
        taken[source[row.doc_id]] += row.taken
    largest = {s: max(len(plain(r.text)) for r in rows if r.source == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    assert in_order(mixing.mix_sources(varied.repartition(3)).collect()) == in_order(mixed)
    repeated = mixing.repeat_documents(varied)
    assert repeated.columns == varied.columns
    copies = Counter(r.doc_id for r in repeated.collect())
    assert copies == Counter({i: sum(r.copies for r in mixed if r.doc_id == i) for i in source if copies[i]})


@pytest.mark.parametrize("same", [False, True])
def test_rows_without_ids_are_drawn_one_by_one(documents, prose, same):
    rows = [(None if i % 2 else i, "five words in each text" if same else prose(i, 5), "en", "a") for i in range(500)]
    rows += [(None, "five words in each text", "en", "b") for i in range(500)] + [(7, prose(i, 5), "en", "c") for i in range(90)]
    frame = documents(rows).repartition(7)
    mixed = mixing.mix_sources(frame)
    sums = mixed.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    got = mixed.collect()
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    assert sum(r.taken for r in sums) > 0 and all(r.target > 0 for r in sums)
    of_one_target = [r for r in sums if r.source_size == 450]
    assert abs(of_one_target[0].taken - of_one_target[0].target) <= 2.5
    both = {r.target: r.taken for r in sums if r.source_size == 2500}
    assert len(both) == 2 and all(abs(taken - target) <= 2.5 for target, taken in both.items())
    assert in_order(mixing.mix_sources(frame.coalesce(2)).collect()) == in_order(got)
    stored = mixing.stored(frame, "mixed-test")
    copies = Counter((r.doc_id, r.source) for r in mixing.repeat_documents(stored).collect())
    taken = Counter()
    for r in mixing.repeat_documents(stored).collect():
        taken[r.source] += 5
    assert sum(taken.values()) == sum(r.taken for r in got) == 5 * sum(copies.values())
    assert sorted(taken.values()) == sorted(r.taken for r in sums)


def test_mix_equals_its_sql(spark, documents, prose):
    rows = [(None if i % 3 == 0 else i // 4, prose(i % 50, 3 + i % 9), "en", f"s{i % 5}" if i % 7 else None) for i in range(600)]
    rows += [(None, "one two three", "en", "s1") for _ in range(200)] + [(900, None), (None, ""), (None, None)]
    frame = documents(rows)
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    names = ["doc_id", "size", "source_size", "copies", "taken"]
    wanted = con.execute(f"SELECT {', '.join(names)} FROM ({queries.OP10_SQL})").fetchall()
    assert in_order(mixing.mix_sources(frame).select(names).collect()) == in_order(wanted)


def test_mix_is_native(varied):
    plan = mixing.repeat_documents(varied.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.fixture(scope="module")
def benchmark(spark, prose):
    items = [(i, prose(700 + i, 15 + 3 * i), "c") for i in range(12)]
    items += [(20, None, "c"), (21, "", "c"), (22, "two words", "c"), (23, "six words in all of it", "c"), (24, items[0][1], "c")]
    return spark.createDataFrame(items, "item_id long, text string, doc_id string")


def substituted(text, places):
    own = text.split()
    for place in places:
        own[place] = "substituted"
    return " ".join(own)


def test_overlaps_survive_substitutions_and_leave_others_alone(documents, benchmark, prose):
    items = {r.item_id: r.text for r in benchmark.collect()}
    around = lambda i, text: f"{prose(i, 50)}. {text}, {prose(i + 1000, 50)}"
    rows = [(i, around(i, items[i]), "en", "s") for i in range(12)]
    rows += [(100 + i, around(i, substituted(items[i], (4, 9))).upper(), "en", "s") for i in range(12)]
    rows += [(200 + i, prose(2000 + i, 200), "en", "s") for i in range(12)]
    rows += [(300, None), (301, ""), (302, "two words"), (303, "so SIX words, in all of it."), (304, "six words in all")]
    rows += [(1, rows[1][1], "en", "s"), (None, items[3], "en", "s")]
    found = decontamination.find_overlaps(documents(rows), benchmark).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert len(pairs) == len(found)
    expected = {(i, i) for i in range(12)} | {(100 + i, i) for i in range(12)} | {(0, 24), (100, 24), (303, 23), (None, 3)}
    assert pairs == expected
    whole = next(r for r in found if (r.doc_id, r.item_id) == (5, 5))
    assert (whole.matched_words, whole.overlap_words, whole.doc_word, whole.item_word) == (30, 30, 50, 0)
    kept = decontamination.drop_contaminated(documents(rows), benchmark)
    assert kept.columns == documents(rows).columns
    dirty = {doc for doc, _ in expected}
    assert sorted((r.doc_id for r in kept.collect())) == sorted({r[0] for r in rows} - dirty)


def test_masks_find_three_substitutions_among_fifteen_words():
    draw = np.random.default_rng(1)
    for _ in range(200):
        item = " ".join(f"w{k}" for k in range(15))
        index = decontamination.SeedIndex([1], [item])
        text = substituted(item, draw.choice(15, 3, replace=False))
        from cartlens.llm.words import NOT_ALPHANUMERIC, words
        import pyarrow as pa

        found = words(pa.array([text]), NOT_ALPHANUMERIC)
        for _, table, *_ in [(m, s) for m, s, *_ in index.tables]:
            assert len(table)
        hits = sum(
            int(np.isin(decontamination._seeds(found.hash, mask), seeds).sum()) for mask, seeds, *_ in index.tables
        )
        assert hits


@pytest.mark.parametrize(("length", "most"), [(15, 3), (13, 2)])
def test_every_placement_of_the_substitutions_is_verified(length, most):
    from itertools import combinations

    import pyarrow as pa

    from cartlens.llm.words import NOT_ALPHANUMERIC, words

    item = [f"w{k}" for k in range(length)]
    longer = [*(f"p{k}" for k in range(9)), *item, *(f"q{k}" for k in range(9))]
    index = decontamination.SeedIndex([1, 2], [" ".join(item), " ".join(longer)])
    chosen = [c for n in range(most + 1) for c in combinations(range(length), n)]
    texts = [" ".join(["a b c d", *("x" if k in c else w for k, w in enumerate(item)), "e f g"]) for c in chosen]
    found = words(pa.array(texts), NOT_ALPHANUMERIC)
    got = {(t, i): best for t, i, *best in index.overlaps(found.hash, found.first, decontamination.MIN_WORDS)}
    assert set(got) == {(t, i) for t in range(len(chosen)) for i in range(2)}
    for (t, i), (matched, size, doc_word, item_word) in got.items():
        assert matched >= decontamination.MIN_WORDS and doc_word - item_word == 4 - 9 * i
        assert matched == sum(
            k - 4 not in chosen[t] for k in range(doc_word, doc_word + size)
        )


@pytest.mark.parametrize(("diagonals", "slot_bits"), [(4096, 26), (2, 26), (4096, 8)])
def test_a_joined_benchmark_gives_what_a_sent_one_gives(documents, benchmark, prose, monkeypatch, diagonals, slot_bits):
    items = {r.item_id: r.text for r in benchmark.collect()}
    rows = [(i, f"{prose(i, 30)} {items[i]} {prose(i + 50, 30)}", "en", "s") for i in range(12)]
    rows += [(20 + i, prose(90 + i, 60), "en", "s") for i in range(3)] + [(30, None), (3, rows[3][1]), (None, items[4])]
    rows += [(31, ""), (32, " . "), (33, items[5][:-9]), (34, " ".join(items[i] for i in range(6))), (35, rows[1][1])]
    rows += [(36, " ".join([items[2]] * 3)), (37, substituted(items[7], [3, 9])), (38, prose(7, 20000) + items[8])]
    frame = documents(rows)
    whole = in_order(decontamination.find_overlaps(frame, benchmark).collect())
    clean = in_order(decontamination.drop_contaminated(frame, benchmark).collect())
    assert len(whole) > 20 and 3 < len(clean) < 12

    def never(*_):
        raise AssertionError("the benchmark reached the driver")

    monkeypatch.setattr(decontamination, "_index", never)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 50)
    monkeypatch.setattr(decontamination, "DIAGONALS", diagonals)
    monkeypatch.setattr(decontamination, "SLOT_BITS", slot_bits)
    assert in_order(decontamination.find_overlaps(frame, benchmark).collect()) == whole
    kept = decontamination.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns and in_order(kept.collect()) == clean


def test_a_joined_benchmark_without_seeds_finds_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 0)
    short = spark.createDataFrame([(1, "one two"), (2, None), (None, "")], "item_id long, text string")
    frame = documents([(1, "one two three"), (2, None), (3, "")])
    assert decontamination.find_overlaps(frame, short).count() == 0
    assert in_order(decontamination.drop_contaminated(frame, short).collect()) == in_order(frame.collect())
    assert decontamination.find_overlaps(documents([]), short).count() == 0


def test_stretches_without_enough_equal_words_are_none():
    text = np.array([1] * 9 + [0] * 5 + [1] * 9, np.uint64)
    item = np.ones(23, np.uint64)
    assert decontamination.SeedIndex._best(text, item, 0, 10) is None
    assert decontamination.SeedIndex._best(text, item, 0, 9) == (9, 9, 0, 0)


def test_licences_against_plain_search(documents, prose):
    notice = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
    rows = [(1, "MIT License mit-license mit  license"), (2, None), (3, ""), (4, "mit licenses"), (5, prose(4, 3000))]
    rows += [(6, f"{prose(5, 30)} {notice} {prose(6, 30)}"), (7, "GNU Lesser General Public License"), (8, "é mit license")]
    rows += [(9, "All rights reserved. Licensed under CC BY-NC 4.0."), (9, "All rights reserved."), (10, "reserved rights all")]
    rows += [(11, "Redistribution and use in source, and binary forms, with or without modification, are permitted")]
    got = licences.scan(documents(rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        texts = [t for i, t, *_ in rows if i == row.doc_id]
        if len(texts) > 1:
            continue
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[0] or "").translate(LOWER))
        places, base = [], set()
        for phrase, label in licences.BASE_PHRASES.items():
            phrase = phrase.split()
            at = [i for i in range(len(own)) if own[i : i + len(phrase)] == phrase]
            places += at
            base |= {label} if at else set()
        assert (row.n_words, row.n_base, row.base_labels) == (len(own), len(places), ",".join(sorted(base)))
        assert (row.first_word, row.last_word) == ((min(places), max(places)) if places else (None, None))
        assert base <= set(row.labels.split(",")) and 0 <= row.score <= 1
    labels = {row.doc_id: row.labels for row in got if row.doc_id != 9}
    assert labels[6] == "apache" and labels[7] == "gpl,lgpl" and labels[11] == "bsd" and labels[10] == labels[4] == ""
    assert sorted(row.labels for row in got if row.doc_id == 9) == ["cc-by-nc,proprietary", "proprietary"]


def test_a_notice_is_found_however_common_it_is(documents, prose):
    whole = licences.TEMPLATES[1][1]
    head = licences.TEMPLATES[1][2]
    rows = [(i, f"{prose(i, 20)} {whole if i % 2 else head} {prose(i + 500, 20)}") for i in range(60)]
    assert {(r.labels, r.n_notices) for r in licences.scan(documents(rows)).collect()} == {("mit", 1)}


def plain_notices(texts):
    """(row, template, first word, score) wherever a template's key phrase stands."""
    out = []
    for i, text in enumerate(texts):
        own = words_of(text)
        for k, (_, whole, key) in enumerate(licences.TEMPLATES):
            whole, key = words_of(whole), words_of(key)
            place = next(j for j in range(len(whole)) if whole[j : j + len(key)] == key)
            for at in (j - place for j in range(len(own)) if own[j : j + len(key)] == key):
                equal = sum(0 <= at + j < len(own) and own[at + j] == word for j, word in enumerate(whole))
                out.append((i, k, max(0, at), equal / len(whole)))
    return sorted(out)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("common", ["none", "all", "tails"])
def test_the_index_finds_what_a_plain_search_finds(common, monkeypatch):
    draw = random.Random(5)
    vocabulary = sorted({w for _, whole, _ in licences.TEMPLATES for w in words_of(whole)}) + ["other", "words"]
    texts = [None, "", "mit", " ".join(draw.choices(vocabulary, k=30000))]
    for i in range(300):
        parts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 20))) for _ in range(4)]
        for part in range(3):
            own = words_of(draw.choice(licences.TEMPLATES)[draw.choice((1, 1, 2))])
            if draw.random() < 0.5:  # damaged notices
                at = draw.randrange(len(own))
                own[at : at + draw.randint(0, 2)] = draw.choices(vocabulary, k=draw.randint(0, 2))
            parts[part] += " " + " ".join(own)
        texts.append(" ".join(parts))
    index = licences.LicenceIndex()
    heads = {w for _, _, key in licences.TEMPLATES for w in words_of(key)}
    have = {licences._hashes(w)[0]: {"none": 0, "all": 300, "tails": 250 * (w in heads)}[common] for w in vocabulary}
    index.weigh(np.array([have[h] for h in index.vocabulary]), 300)
    places = []
    whole = licences._stands
    monkeypatch.setattr(licences, "_stands", lambda *a: places.append(1) or whole(*a))
    found = words(pa.array(texts, pa.string()), NOT_ALPHANUMERIC)
    got = licences.notices(found, index)
    assert [x[:3] for x in got] == [x[:3] for x in plain_notices(texts)] and len(got) > 300
    assert np.allclose([x[3] for x in got], [x[3] for x in plain_notices(texts)])
    assert len(got) <= len(places) < sum(map(len, map(words_of, texts)))  # phrases are compared where postings meet
    assert index.lookups(np.ones((1, len(index.vocabulary)), bool)).sum(axis=2).max() <= licences.LOOKUPS + 2
    places.clear()
    licences.notices(words(pa.array(["granted any person the of to in"] * 50), NOT_ALPHANUMERIC), index)
    assert not places


SCRIPTED = {"en": "abcdefgh", "fr": "ijklmnop", "ru": "абвгдежз"}


def test_language_of_held_out_texts_and_spans(documents, prose):
    rows = [(i, prose(i, 30, SCRIPTED[lang]), lang, "s") for i, lang in enumerate(list(SCRIPTED) * 40)]
    rows += [(1000, None, "en"), (1001, "12 3 !", "en"), (1002, "", None), (1003, prose(1, 20000, SCRIPTED["fr"]), None)]
    rows += [(1004, "ΑΒΓ δεζ", None), (1005, prose(2, 30, SCRIPTED["en"]).upper(), None), (1005, prose(2, 30, "ijkl"), None)]
    frame = documents(rows)
    got = langid.identify(frame).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, _, lang, _ in rows[:120]:
        assert by_id[i].lang_pred == lang and by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "fr"]
    assert by_id[1004].score == 0 and by_id[1000].score == 0 and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id == 1005} == {"en", "fr"}

    model = langid.learn(frame)
    mixed = " ".join(prose(50 + k, 25, SCRIPTED[x]) for k, x in enumerate(["en", "fr", "ru", "en"]))
    spans = langid.language_spans(documents([(1, mixed), (2, None), (3, "77")]), model).orderBy("span").collect()
    assert [s.lang for s in spans] == ["en", "fr", "ru", "en"] and {s.doc_id for s in spans} == {1}
    words = [prose(50 + k, 25, SCRIPTED[x]) for k, x in enumerate(["en", "fr", "ru", "en"])]
    assert [mixed[s.start : s.end] for s in spans] == words
    kept = langid.keep_identified(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {1000, 1001, 1002, 1004}


def test_every_labelled_language_is_learned_and_even_mixtures_stay(documents, prose):
    rows = [(10 * i + k, prose(i + k, 3, "abcdefgh"), f"l{i:02}", "s") for i in range(64) for k in range(3)]
    rows += [(5000 + k, prose(k, 30, "абвгдежз"), "rare", "s") for k in range(2)]
    model = langid.learn(documents(rows))
    assert len(model.languages) == 65
    held = documents([(1, prose(9, 30, "абвгдежз"))])
    assert [r.lang_pred for r in langid.predict(held, model).collect()] == ["rare"]

    four = ["abcdefgh", "ijklmnop", "абвгдежз", "αβγδεζηθ"]
    rows = [(i, prose(i, 30, four[i % 4]), f"x{i % 4}", "s") for i in range(80)]
    rows += [(100, " ".join("".join(4 * [a[k] for k in range(8)]) for a in four), None), (101, "漢字" * 20, None)]
    kept = {r.doc_id for r in langid.keep_identified(documents(rows)).collect()}
    assert 100 in kept and 101 not in kept


def test_no_language_labels_words_outside_its_scripts(documents, prose):
    """A little learned language gives unseen trigrams more than one with much text."""
    rows = [(3 * i, prose(i, 400, "абвгдежз"), "large", "s") for i in range(60)] + [(1000, "abc cab bca", "small", "s")]
    model = langid.learn(documents(rows))
    assert sorted(model.languages) == ["large", "small"]
    texts = documents([(1, "юэщ ъыь чцх"), (2, "xyz zzy"), (3, "юэщъыь xyz"), (4, "юэщ xyz юэщ xyz"), (5, "xyz абв 漢字")])
    got = {r.doc_id: r for r in langid.predict(texts, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["large", "small", "large"]
    assert got[1].score == got[2].score == 1 and math.isclose(got[3].score, 6 / 9) and math.isclose(got[4].score, 0.5)
    spans = langid.language_spans(texts, model).where("doc_id = 4").orderBy("span").collect()
    assert [r.lang for r in spans] == ["large", "small"] * 2
    spans = langid.language_spans(texts, model).where("doc_id = 5").orderBy("span").collect()
    assert [r.lang for r in spans] == ["small", "large", "und"]


def slow_identify(model, text):
    """Label, score and each word's label, word by word over all paths' best ends."""
    lower = lambda c: c.lower() if len(c.lower()) == 1 else c
    runs = re.findall(r"[^\W\d_]+", text or "")
    script = {c: n for n, r in enumerate(langid.SCRIPTS.values(), 1) for low, high in r for c in range(low, high + 1)}
    k = len(model.languages)
    scores, known = [], []
    for run in runs:
        found = langid._letters([run])
        own = [float(sum(np.float64(model.weight[e, i]) for e in found.event)) for i in range(k)]
        assert len(found.event) == len(run) + 1 and [lower(c) for c in run]
        allowed = [bool(model.allowed[script.get(ord(run[0]), 0), i]) for i in range(k)]
        known.append(any(allowed))
        own = [x if a else -math.inf for x, a in zip(own, allowed, strict=True)] if any(allowed) else [0.0] * k
        scores.append([x - max(own) for x in own])
    best = [(0.0, [])] * 0
    for i, own in enumerate(scores):
        if i == 0:
            best = [(own[x], [x]) for x in range(k)]
        else:
            best = [
                max(((v - langid.SWITCH * (p[-1] != x) + own[x], [*p, x]) for v, p in best), key=lambda t: t[0])
                for x in range(k)
            ]
    if not runs:
        return "und", 0.0, []
    path = max(best, key=lambda t: t[0])[1]
    label = [x if a else -1 for x, a in zip(path, known, strict=True)]
    letters = [sum(len(r) for r, x in zip(runs, label, strict=True) if x == i) for i in range(k)]
    whole = [sum(max(s[i], -langid.OUTSIDE) for s in scores) for i in range(k)]
    top = max(range(k), key=lambda i: (letters[i], whole[i], -i))
    of_own = [sum(s[i] for s, x in zip(scores, label, strict=True) if x == top) for i in range(k)]
    probability = math.exp(of_own[top]) / sum(math.exp(x) for x in of_own)
    return model.languages[top], letters[top] / sum(map(len, runs)) * probability, label


def test_identify_equals_a_slow_version(documents, prose):
    alphabet = {"en": "abcdefgh", "fr": "efghijkl", "ru": "абвгдежз", "mk": "дежзиклм"}
    rows = [(i, prose(i, 12 + i % 9, alphabet[x]), x, "s") for i, x in enumerate(list(alphabet) * 30)]
    frame = documents(rows)
    model = langid.learn(frame)
    draw = random.Random(8)
    texts = [None, "", "12", "漢字 漢字", "漢字 abc", "Ünïcode ЖЗИ", "a", "abcабв", *(r[1] for r in rows[:20])]
    for i in range(80):
        parts = [prose(1000 + 9 * i + j, draw.randint(1, 6), alphabet[draw.choice(list(alphabet))]) for j in range(4)]
        texts.append(" ".join([*parts, "漢字"][: draw.randint(1, 5)]))
    got = langid.predict(documents(list(enumerate(texts))), model).orderBy("doc_id").collect()
    for row, text in zip(got, texts, strict=True):
        label, score, _ = slow_identify(model, text)
        assert math.isclose(row.score, score, rel_tol=1e-4, abs_tol=1e-9), text  # weights are summed in single precision
        assert row.lang_pred == label or (score == 0 and not re.search(r"[^\W\d_]", text or "")), text


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(2)
    score = draw.normal(size=(23, 3))
    first = np.array([0, 0, 6, 7, 15, 23])
    label = langid.viterbi(score, first, 0.7)
    from itertools import product

    for a, b in zip(first[:-1], first[1:], strict=True):
        worth = lambda p: sum(score[a + i, x] for i, x in enumerate(p)) - 0.7 * sum(  # noqa: E731, B023
            x != y for x, y in zip(p, p[1:], strict=False)
        )
        best = max(map(worth, product(range(3), repeat=int(b - a))))
        assert math.isclose(worth(label[a:b].tolist()), best, abs_tol=1e-12)


def test_toxic_sentences_are_found_from_document_labels(spark, documents, prose):
    insult = ["vileword", "foulword", "vileness"]
    rows, labels = [], []
    for i in range(300):
        parts = [prose(10 * i + k, 8) for k in range(6)]
        if i % 4 == 0:
            parts[i % 6] += f" {insult[i % 3]} " + prose(i, 2)
        rows.append((i, ". ".join(parts), "en", "s"))
        labels.append((i, 0, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (1002, " .!"), (1003, prose(3, 20000) + " foulword"), (1004, prose(3, 20000))]
    labels += [(5, 0, None), (8, 0, 0), (None, 0, 1), (5000, 0, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = documents(rows)
    got = {r.doc_id: r for r in toxicity.detect(frame, marks).collect()}
    assert len(got) == len(rows)
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held)
    assert all(got[i].predicted == int(i % 4 == 0) for i in held)
    assert [got[i].score for i in (1000, 1001, 1002)] == [0, 0, 0] and got[1003].score > got[1004].score
    model = toxicity.learn(frame, marks)
    found = toxicity.offending_sentences(frame.where("doc_id < 100"), model).collect()
    assert found and all(any(x in r.sentence for x in insult) for r in found)
    none = toxicity.detect(frame, marks.where("toxic = 0")).agg(F.max("score")).head()[0]
    assert none == 0


def test_long_texts_teach_and_rows_in_any_order_learn_the_same(spark, documents, prose):
    rows = [(i, prose(i, 20000) + (". some vileword here" if i % 2 else ""), "en", "s") for i in range(24)]
    assert min(len(r[1]) for r in rows) > 65536
    rows += [(100 + i, prose(500 + i, 30), "en", "s") for i in range(30)]
    rows += [(1, prose(77, 30), "en", "s"), (None, "vileword"), (200, None)]
    labels = [(i, 0, int(i < 24 and i % 2 == 1)) for i in range(130) if i != 1] + [(1, 0, 1), (1, 0, 0), (200, 0, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = documents(rows)
    model = toxicity.learn(frame, marks)
    again = toxicity.learn(frame.repartition(5), marks.repartition(3))
    assert np.array_equal(model.weight, again.weight) and model.bias == again.bias
    asked = documents([(1, "calm words. a vileword stands here."), (2, prose(4, 30)), (3, prose(8, 20000) + ". a vileword")])
    assert [r.predicted for r in toxicity.score(asked, model).orderBy("doc_id").collect()] == [1, 0, 1]


def test_weights_are_those_of_a_fit_sentence_by_sentence():
    """The same fit with every sentence written out, also those without a useful feature."""
    draw = np.random.default_rng(6)
    of = np.repeat(np.arange(30), draw.integers(1, 6, 30))
    has = draw.random((len(of), 4)) < 0.2
    toxic = np.zeros(30)
    toxic[np.unique(of[has[:, 0]])] = 1
    some = has.any(axis=1)
    sentence, column = np.nonzero(has[some])
    plain = np.bincount(of[~some], minlength=30)
    importance = draw.random(30) + 0.5
    weight, bias = toxicity.fit(toxicity._Hits(toxic, plain, of[some], sentence, column), importance, 4)
    w, b, m, v = np.zeros(4), -4.0, np.zeros(5), np.zeros(5)
    share = importance / importance.sum()
    for step in range(1, toxicity.ROUNDS + 1):
        p = 1 / (1 + np.exp(-(has @ w + b)))
        clean = np.array([np.prod(1 - p[of == d]) for d in range(30)])
        up = np.where(toxic == 1, clean / (1 - clean), -1.0) * share
        g = np.append(has.T.astype(float) @ (p * up[of]) - toxicity.PENALTY * w, (p * up[of]).sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        move = toxicity.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w + move[:-1], b + move[-1]
    assert np.allclose(weight, w, atol=1e-4) and math.isclose(bias, b, abs_tol=1e-4)


def test_base_scores_and_model_scores(documents, prose):
    rows = [(i, prose(i % 30, 30 + i % 7, "abc"), "en", "s") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "never seen"), (103, prose(8, 20000)), (None, "a b a"), (5, "a B")]
    frame = documents(rows)
    got = lm.evaluate(frame).collect()
    assert len(got) == len(rows)
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    count = Counter()
    for i, text, *_ in rows:
        if crc(i) != 2:
            count.update([*plain(text), "\0"])
    total, kinds = sum(count.values()), len(count)
    by_text = {}
    for i, text, *_ in rows:
        own = [*plain(text), "\0"]
        base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in own)
        by_text.setdefault(i, []).append((crc(i) == 2, len(own), sum(count[x] > 0 for x in own), total, round(base, 6)))
    for row in got:
        have = (row.held_out, row.n_tokens, row.n_known, row.train_tokens, round(row.base_score, 6))
        assert have in by_text[row.doc_id]
        assert row.score < 0
    assert len({r.score for r in got if r.doc_id in (100, 101)}) == 1


def test_the_attention_model_counts_all_texts_and_sees_pieces_of_long_ones(documents, prose):
    from cartlens.llm import attention

    vocabulary = tokens.Vocabulary.read(lm.VOCABULARY)
    made, size = tokens.encoder(vocabulary), vocabulary.size + 1
    rows = [(i, prose(i, 20, "abcdef") + f" only{i}", "en", "s") for i in range(40)]
    rows += [(50, prose(7, 20000, "ghij"), "en", "s"), (51, None), (52, "")]
    model = lm.fit(documents(rows), vocabulary)
    texts = [[*made.inner.encode_ordinary(r[1] or ""), made.end] for r in rows]
    seen = np.bincount(np.concatenate(texts).astype(int), minlength=size) + attention._SMOOTHING
    assert np.allclose(model.in_class, seen / np.bincount(model.of_class, seen)[model.of_class])
    follows = Counter()
    for ids in texts:
        follows.update(int(model.of_class[a]) * size + int(b) for a, b in zip([made.end, *ids[:-1]], ids, strict=True))
    assert dict(zip(model.after.tolist(), model.times.tolist(), strict=True)) == dict(follows)
    assert model.after_total.sum() == sum(map(len, texts))
    long = lm.fit(documents(rows[40:41]), vocabulary)
    assert np.abs(long.out).max() > 0  # the gradient steps saw it


def test_scores_equal_a_slow_version_and_attention_helps(spark, documents, prose):
    from cartlens.llm import attention

    vocabulary = tokens.Vocabulary.read(lm.VOCABULARY)
    draw = random.Random(9)
    words = prose(3, 60, "abcdefgh").split()
    # What comes next depends on a word some places before.
    text = lambda: " ".join(w for _ in range(25) for k in [draw.randrange(30)] for w in (words[k], "so", words[59 - k]))
    model = lm.fit(documents([(i, text()) for i in range(150)]), vocabulary)
    made = tokens.encoder(vocabulary)
    held = [np.array([*made.inner.encode_ordinary(t), made.end]) for t in [text() for _ in range(20)] + ["", "a b"]]
    first = np.concatenate([[0], np.cumsum([len(t) for t in held])])
    got = attention.text_scores(model, np.concatenate(held), first)

    def slow(ids):
        total, shown = 0.0, np.array([model.end, *ids[:-1]])
        begin = 0
        for at in range(len(ids)):
            if at - begin >= attention.WINDOW:
                begin += attention.WINDOW - attention.OVERLAP
            seen = shown[begin : at + 1]
            weight = model.query[shown[at]].astype(float) @ model.key[seen].T + model.distance[at - np.arange(begin, at + 1)]
            weight = np.exp(weight - weight.max())
            score = weight / weight.sum() @ model.value[seen] @ model.out + model.alone[shown[at]]
            share = np.exp(score - score.max())
            share /= share.sum()
            total += math.log10(share[model.of_class[ids[at]]]) + model.log_in_class(shown[at : at + 1], ids[at : at + 1])[0]
        return total

    assert np.allclose(got, [slow(t) for t in held], rtol=1e-4, atol=1e-4)
    without = attention.text_scores(model._replace(out=np.zeros_like(model.out)), np.concatenate(held), first)
    assert got[:20].sum() > without[:20].sum() + 0.02 * first[20]


def test_the_gradient_steps_see_every_window_of_all_training_texts(documents, prose, monkeypatch):
    from cartlens.llm import attention

    vocabulary = tokens.Vocabulary.read(lm.VOCABULARY)
    made = tokens.encoder(vocabulary)
    rows = [(i, prose(i, 10 + 37 * i, "abcdef"), "en", "s") for i in range(40)] + [(50, None), (51, "")]
    windows = sum(-(-(len(made.inner.encode_ordinary(r[1] or "")) + 1) // attention.WINDOW) for r in rows)
    seen, averaged = [], lm._averaged

    def noted(blocks, parameters):
        seen.append(blocks.where("block = 0").agg(F.sum("weight")).head()[0] or 0)
        return averaged(blocks, parameters)

    monkeypatch.setattr(lm, "_averaged", noted)
    monkeypatch.setattr(lm, "LANE", 16)
    for least, passes in ((1, 1), (2 * windows + 1, 3)):
        monkeypatch.setattr(lm, "LEAST_WINDOWS", least)
        seen.clear()
        lm.fit(documents(rows).repartition(3), vocabulary)
        assert sum(seen) == passes * windows


@pytest.mark.parametrize("passes", [1, 3, 4, 9])
def test_turns_share_out_the_windows_and_every_id_is_told(passes):
    draw = np.random.default_rng(3)
    texts = [np.append(draw.integers(0, 900, n), 900) for n in (0, 1, 62, 63, 64, 700, 5)]
    ids, first = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    mark = draw.integers(-(2**63), 2**63 - 1, len(texts))
    told, behind = Counter(), Counter()
    for turn in range(lm.TURNS):
        shown, told_ids, inside = lm._windows(ids, first, mark, 900, turn, passes)
        for x, y, n in zip(shown, told_ids, inside, strict=True):
            told.update(y[:n].tolist())
            behind.update(zip(x[:n].tolist(), y[:n].tolist(), strict=True))
    pairs = Counter((int(a), int(b)) for t in texts for a, b in zip([900, *t[:-1]], t, strict=True))
    assert told == Counter({k: passes * n for k, n in Counter(ids.tolist()).items()})
    assert behind == Counter({k: passes * n for k, n in pairs.items()})


def test_a_gradient_step_goes_against_the_numeric_gradient():
    from cartlens.llm import attention

    draw = np.random.default_rng(4)
    ids, first = np.append(draw.integers(0, 9, 199), 9), np.array([0, 200])
    made = attention.tables(attention.count(ids, first, 10, draw))
    start = attention.initial(10)
    start[4] = draw.normal(0, 0.5, start[4].shape).astype(np.float32)
    start[5] = draw.normal(0, 0.5, start[5].shape).astype(np.float32)
    x, target, inside = draw.integers(0, 10, (3, 64)), draw.integers(0, 10, (3, 64)), np.arange(64) < np.array([[64], [40], [1]])

    def loss(parameters):
        embedding, *joins, out, distance = (p.astype(float) for p in parameters)
        total = 0.0
        for shown, told, use in zip(x, target, inside, strict=True):
            q, k, v = (embedding[shown] @ j for j in joins)
            for at in np.flatnonzero(use):
                weight = k[: at + 1] @ q[at] / 4 + distance[at - np.arange(at + 1)]
                weight = np.exp(weight - weight.max())
                score = weight / weight.sum() @ v[: at + 1] @ out + made.alone[shown[at]]
                total += np.log(np.exp(score).sum()) - score[made.of_class[told[at]]]
        return total / inside.sum()

    learner = attention.Learner(start, made)
    learner.step(x, target, inside, 0.0)
    for i, place in [(0, (3, 2)), (0, (7, 11)), (1, (0, 5)), (2, (9, 1)), (3, (4, 4)), (4, (6, 3)), (5, (0,)), (5, (7,))]:
        apart = []
        for sign in (1, -1):
            moved = [p.astype(float) for p in start]
            moved[i][place] += sign * 1e-4
            apart.append(loss(moved))
        gradient = learner.moments[i][0][place] / 0.1
        assert math.isclose(gradient, (apart[0] - apart[1]) / 2e-4, rel_tol=1e-2, abs_tol=1e-5)


@pytest.mark.parametrize(("near", "large"), [(1, 0.5), (14, 30)])
def test_a_step_is_the_same_in_parts_of_any_size(monkeypatch, near, large):
    from cartlens.llm import attention

    draw = np.random.default_rng(6)
    ids, first = np.append(draw.integers(0, 9, 199), 9), np.array([0, 200])
    made = attention.tables(attention.count(ids, first, 10, draw))
    start = attention.initial(10)
    start[1:3] = (p * np.float32(near) for p in start[1:3])
    start[4] = draw.normal(0, large, start[4].shape).astype(np.float32)
    x, target = draw.integers(0, 10, (2, 21, 64))
    inside = np.arange(64) < draw.integers(1, 65, 21)[:, None]
    came = []
    for part in (1, 8, 21):
        monkeypatch.setattr(attention, "PART", part)
        learner = attention.Learner(start, made)
        learner.step(x, target, inside, 0.01)
        came.append([m for m, _ in learner.moments])
    assert all(np.isfinite(p).all() for p in came[0])
    for other in came[1:]:
        assert all(np.allclose(p, q, rtol=1e-3, atol=1e-4 * np.abs(p).max()) for p, q in zip(came[0], other, strict=True))


def test_a_models_bounds_are_found_once_for_all_texts(monkeypatch):
    from cartlens.llm import attention

    draw = np.random.default_rng(7)
    ids, first = np.append(draw.integers(0, 20, 99), 20), np.array([0, 100])
    model = attention.train(ids, first, 21, steps=5)
    want, bounds = attention.text_scores(model, ids, first), attention.bounds(model)
    monkeypatch.setattr(attention, "_below_most", None)
    assert attention.text_scores(model, ids, first, bounds) == want


def test_words_are_looked_up_each_where_it_stands():
    draw = np.random.default_rng(8)
    known = np.unique(draw.integers(0, 2**64, 50, dtype=np.uint64))
    asked = np.concatenate([draw.choice(known, 200), draw.integers(0, 2**64, 50, dtype=np.uint64)])
    at, hit = lm._looked_up(known, asked)
    assert hit.tolist() == np.isin(asked, known).tolist() and (known[at[hit]] == asked[hit]).all()
    assert not lm._looked_up(known[:0], asked)[1].any() and not len(lm._looked_up(known, asked[:0])[1])


def test_attention_scores_add_up_to_one_and_windows_score_each_id_once():
    from cartlens.llm import attention

    draw = np.random.default_rng(5)
    texts = [np.append(draw.integers(0, 20, n), 20) for n in (0, 3, 63, 64, 65, 200)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    model = attention.train(np.concatenate(texts), first, 21, steps=5)
    begin = np.array([20, 3, 7])
    total = sum(
        10 ** attention.text_scores(model, np.append(begin[1:], k), np.array([0, 3]))[0] for k in range(21)
    )
    before = 10 ** attention.text_scores(model, begin[1:], np.array([0, 2]))[0]
    assert math.isclose(total, before, rel_tol=1e-4)
    text, place, scored = attention._windows(first)
    seen = Counter()
    for t, p, s in zip(text, place, scored, strict=True):
        seen.update((t, k) for k in range(s, min(p + attention.WINDOW, first[t + 1] - first[t])))
    assert seen == Counter({(t, k): 1 for t in range(len(texts)) for k in range(len(texts[t]))})
    alone = [attention.text_scores(model, t, np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(alone, attention.text_scores(model, np.concatenate(texts), first))


def test_ids_behind_a_seam_have_sixteen_ids_of_context():
    from cartlens.llm import attention

    _, place, scored = attention._windows(np.array([0, 65, 400]))
    assert len(place) > 2 and all(s == 0 or s - p >= 16 for p, s in zip(place, scored, strict=True))


def test_shards_hold_every_sequence_once_in_slot_order(spark, varied, tmp_path):
    varied.repartition(3).write.parquet(str(tmp_path / "docs"))
    frame = spark.read.parquet(str(tmp_path / "docs"))
    layout = shards.write_shards(frame, str(tmp_path / "shards"), shard_records=50, length=32)
    read = shards.read_shards(spark, layout).collect()
    assert sorted(r.slot for r in read) == list(range(layout.sequences))
    assert all(r.shard == r.slot // 50 for r in read)
    made = tokens.encoder(tokens.Vocabulary.read(shards.VOCABULARY))
    expected = Counter()
    for row in frame.collect():
        ids = [*made.inner.encode_ordinary(row.text or ""), made.end]
        expected.update((row.doc_id, k // 32, tuple(ids[k : k + 32])) for k in range(0, len(ids), 32))
    assert Counter((r.doc_id, r.part, tuple(np.frombuffer(r.ids, ">u2").tolist())) for r in read) == expected
    assert all(r.n_tokens == len(r.ids) // 2 for r in read)
    later = shards.read_shards(spark, layout, from_slot=120).collect()
    assert in_order(later) == in_order(r for r in read if r.slot >= 120)
    for part in (tmp_path / "shards").glob("shard=*/part-*"):
        assert part.stat().st_size % layout.stride == 0
    files = [f for f in (tmp_path / "shards").glob("shard=*/part-*")]
    assert len(files) == -(-layout.sequences // 50)


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation_of_the_key(total):
    slot = shards.slots(np.arange(total), total)
    assert sorted(slot.tolist()) == list(range(total))
    if total > 60:
        assert slot.tolist() != shards.slots(np.arange(total), total, key=1).tolist()
        assert abs(np.corrcoef(np.arange(total), slot)[0, 1]) < 0.3


def test_empty_tables(spark, empty, benchmark, tmp_path):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert jaccard.similar_groups(empty).count() == 0
    assert decontamination.find_overlaps(empty, benchmark).count() == 0
    assert mixing.mix_sources(empty).count() == mixing.repeat_documents(empty).count() == 0
    assert licences.scan(empty).count() == langid.identify(empty).count() == 0
    assert toxicity.detect(empty, marks).count() == lm.evaluate(empty).count() == 0
    assert shards.materialise(empty).count() == 0
    assert langid.keep_identified(empty).count() == jaccard.first_of_groups(empty).count() == 0


def test_empty_benchmark_and_empty_labels(spark, varied, benchmark):
    none = benchmark.where("false")
    assert decontamination.find_overlaps(varied, none).count() == 0
    assert decontamination.drop_contaminated(varied, none).count() == varied.count()
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.detect(varied, marks).agg(F.max("score")).head()[0] == 0
    unlabelled = varied.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    assert langid.keep_identified(unlabelled).count() == varied.count()
