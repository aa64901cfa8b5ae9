"""The label matcher against a plain search, under every plan it may choose."""

from __future__ import annotations

import random
import re

import pytest
from samples import rows

from cartlens.operators import labels
from cartlens.operators.labels import (
    comment_points,
    comment_points_total,
    match_labels,
    normalise_catalogue,
    prepare_matcher,
)

PLANS = {
    "in_row": {"strategy": "in_row"},
    "broadcast": {"strategy": "by_position"},
    "short_heads": {"strategy": "by_position", "most_heads": 0},
    "salted": {"strategy": "by_position", "broadcast_bytes": 0},
}


def catalogue_of(spark, *pairs):
    return normalise_catalogue(spark.createDataFrame(list(pairs), "item_label STRING, brand STRING"))


def comments_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")


def plain_search(pairs, text):
    """Longest label in the text, then first by name, then first brand by name."""
    if text is None:
        return None
    found = [(-len(label), label, brand) for label, brand in pairs if label in text.strip(" ").upper()]
    return min(found)[1:] if found else None


def matched(spark, clean, comments, **plan):
    result = match_labels(comments, prepare_matcher(clean, **plan))
    return {row["id"]: (row["matched_item_label"], row["matched_brand"]) for row in result.collect()}


@pytest.mark.parametrize("plan", PLANS)
def test_longest_label_wins(spark, plan):
    clean = catalogue_of(spark, ("ring", "a"), ("Small-Ring", "b"), ("small ring pro", "c"))
    texts = comments_of(spark, "  my small ring pro rocks", "a STRING of text", "nothing", None, "", "x")
    assert matched(spark, clean, texts, **PLANS[plan]) == {0: ("SMALL RING PRO", "C"), 1: ("RING", "A")}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("seed", range(3))
def test_equal_to_plain_search(spark, plan, seed):
    rng = random.Random(seed)

    def word(most):
        return "".join(rng.choice("AB1 ") for _ in range(rng.randint(1, most))).strip() or "A"

    pairs = {(" ".join(word(5).split()), rng.choice("XYZ")) for _ in range(60)}
    texts = [word(40).lower() for _ in range(150)] + [None, "", "-", "é" * 5 + "ab1"]
    texts += texts[:50]
    clean = catalogue_of(spark, *pairs)
    expected = {i: plain_search(pairs, t) for i, t in enumerate(texts)}
    expected = {i: hit for i, hit in expected.items() if hit}
    assert matched(spark, clean, comments_of(spark, *texts), **PLANS[plan]) == expected


@pytest.mark.parametrize("plan", PLANS)
def test_whole_long_texts_are_searched(spark, plan):
    clean = catalogue_of(spark, ("deep label", "d"), ("xyz", "e"))
    texts = [
        "é " * place + "deep label" + " ö" * 700
        for place in (0, 250, 251, 252, 253, 254, 255, 256, 257, 511, 512, 1023, 3000)
    ]
    assert matched(spark, clean, comments_of(spark, *texts), **PLANS[plan]) == {
        i: ("DEEP LABEL", "D") for i in range(len(texts))
    }


@pytest.mark.parametrize("plan", PLANS)
def test_rows_that_repeat_each_keep_their_match(spark, plan):
    clean = catalogue_of(spark, ("ring", "a"))
    texts = comments_of(spark, *(["one ring"] * 500), "none")
    same = texts.unionByName(texts)
    result = match_labels(same, prepare_matcher(clean, **PLANS[plan]))
    assert result.count() == 1000
    assert result.columns == ["id", "text", "matched_item_label", "matched_brand"]
    assert rows(comment_points_total(result)) == [("A", 10_000)]


@pytest.mark.parametrize("plan", PLANS)
def test_ties_go_by_name(spark, plan):
    clean = catalogue_of(spark, ("bb", "two"), ("aa", "one"), ("aa", "another"))
    assert matched(spark, clean, comments_of(spark, "bb aa"), **PLANS[plan]) == {0: ("AA", "ANOTHER")}


@pytest.mark.parametrize("plan", PLANS)
def test_punctuation_and_word_options(spark, plan):
    clean = catalogue_of(spark, ("Galaxy S21", "samsung"), ("ring", "a"))
    texts = comments_of(spark, "my Galaxy-S21!", "a string", "(ring)")
    plan = PLANS[plan]
    assert matched(spark, clean, texts, **plan) == {1: ("RING", "A"), 2: ("RING", "A")}
    assert matched(spark, clean, texts, like_labels=True, **plan) == {
        0: ("GALAXY S21", "SAMSUNG"), 1: ("RING", "A"), 2: ("RING", "A"),
    }
    assert matched(spark, clean, texts, whole_words=True, **plan) == {0: ("GALAXY S21", "SAMSUNG"), 2: ("RING", "A")}


@pytest.mark.parametrize("plan", PLANS)
def test_empty_catalogue_matches_nothing(spark, plan):
    clean = catalogue_of(spark, ("--", "x"), (None, "x"), ("x", None), ("y", ""))
    assert rows(clean) == []
    assert matched(spark, clean, comments_of(spark, "x", "--"), **PLANS[plan]) == {}


def test_plan_follows_the_measured_size(spark):
    clean = catalogue_of(spark, *((f"label {i}", "x") for i in range(50)))
    assert prepare_matcher(clean).strategy == "in_row"
    by_count = prepare_matcher(clean, in_row_labels=49)
    by_bytes = prepare_matcher(clean, in_row_bytes=100)
    assert by_count.strategy == by_bytes.strategy == "by_position"
    assert by_count.broadcast_labels and not by_count.lengths
    beyond = prepare_matcher(clean, in_row_labels=49, broadcast_bytes=1000)
    assert not beyond.broadcast_labels and beyond.lengths == (7, 8)
    with pytest.raises(ValueError):
        prepare_matcher(clean, strategy="in_row", in_row_labels=49)
    with pytest.raises(ValueError):
        prepare_matcher(clean, strategy="guess")


def test_points_per_comment(spark):
    clean = catalogue_of(spark, ("ring", "a"))
    result = match_labels(comments_of(spark, "ring", "rings", "no"), prepare_matcher(clean))
    assert rows(comment_points(result)) == [("A", 10), ("A", 10)]


def test_heads_grow_while_they_are_few(spark):
    clean = catalogue_of(spark, *((f"model {i}x", "x") for i in range(1000)))
    plan = {"strategy": "by_position"}
    sizes = {most: prepare_matcher(clean, most_heads=most, **plan).head_size for most in (0, 1, 10, 100, 2000)}
    assert sizes == {0: 3, 1: 6, 10: 6, 100: 8, 2000: 12}
    assert sum(37**n for n in range(1, labels.HEAD_SIZES[0] + 1)) == 52_059


def test_prefix_tree_takes_the_longest_word():
    tree = re.compile(labels._prefix_tree(["A", "AB", "ABCD", "AXE", "B 1"]))
    assert [tree.match(t) and tree.match(t)[0] for t in ("ABCE", "ABCDE", "AXX", "B 12", "C", "B")] == [
        "AB", "ABCD", "A", "B 1", None, None,
    ]
    assert re.search(labels._prefix_tree([]), "anything") is None


@pytest.mark.parametrize("plan", PLANS)
def test_labels_longer_than_a_cut_are_compared_whole(spark, plan):
    start = "Q" * labels.CUT + " "
    long, other = start + "W" * 1500, start + "V" * 1500
    clean = catalogue_of(spark, (long, "a"), (other, "b"), (start.strip(), "c"), ("q", "d"))
    texts = comments_of(spark, f"x {long} y", f"x{other}", start, long[:-1], "q", "x")
    got = matched(spark, clean, texts, **PLANS[plan])
    assert {i: brand for i, (_, brand) in got.items()} == {0: "A", 1: "B", 2: "C", 3: "C", 4: "D"}


@pytest.mark.parametrize("plan", ["broadcast", "short_heads", "salted"])
def test_texts_are_cleaned_and_searched_once_for_long_labels(spark, plan, tmp_path):
    long = "W" * (labels.CUT + 9)
    clean = catalogue_of(spark, (long, "a"), ("ring", "b"))
    texts = [f"x {long}", f"x {long}", "a ring", None, "", long[:-1], "other"]
    comments_of(spark, *texts).write.parquet(str(tmp_path / "comments"))
    comments = spark.read.parquet(str(tmp_path / "comments"))
    found = match_labels(comments, prepare_matcher(clean, **PLANS[plan]))
    assert {row["id"]: row["matched_brand"] for row in found.collect()} == {0: "A", 1: "A", 2: "B"}
    assert found.columns == ["id", "text", "matched_item_label", "matched_brand"]
    assert not any(str(tmp_path) in file for file in found.inputFiles())  # the source isn't read, cleaned and searched again
