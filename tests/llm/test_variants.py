"""Spelling variants against a plain comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from cartlens.llm import variants

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary(rows, length, least):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= least}


def expected(rows, length=6, least=5):
    n = vocabulary(rows, length, least)
    around = {w: [x for x in n if x != w and near(w, x)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(around[w]), n.get(form[w])) for w in n), key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    words = ["".join(draw.choices("abé", k=draw.randint(5, 9))) for _ in range(150)]
    words += [w[:i] + draw.choice("abÿ") + w[i + draw.randint(0, 1) :] for w in words for i in [draw.randint(0, len(w))]]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaabaaa", "aaabbaaa", "×××÷÷÷", "×××÷÷÷÷"]
    often = [draw.choice((1, 2, 6, 40)) for _ in words]
    rows = [(i, " ".join(draw.choices(words, often, k=60)).replace(" ", draw.choice([" ", "1", "\n", "漢", "_"]))) for i in range(120)]
    rows += [(7, "Aaaaaa AAAAAA aaaaaab"), (7, "Aaaaaa AAAAAA aaaaaab"), (None, "aaaaaa bbbbbbb"), (8, None), (9, "")]
    return rows + [(10 + i, "q" * 300 + "w" + "q" * 200 + " " + "q" * 501) for i in range(6)]


@pytest.mark.parametrize("most", [1 << 14, 20, 1])
def test_variants_equal_all_pairs(documents, texts, most):
    got = variants.group_spellings(documents(texts).repartition(3), most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(texts)


def test_other_lengths_and_counts(documents, texts):
    got = variants.group_spellings(documents(texts[:120]), least_length=2, least_count=2)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(texts[:120], 2, 2)


def test_pieces_of_a_text_keep_its_words(monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 5)
    text = "ab ABCDEFÉGH,ijklmnop 漢漢漢漢 qrstuv"
    pieces = list(variants._pieces(text.encode()))
    assert "".join(pieces) == text.translate(FOLD) and len(pieces) > 2
    found = [w for p in pieces for w in re.findall("[a-zÀ-ÿ]{6,}", p)]
    assert found == re.findall("[a-zÀ-ÿ]{6,}", text.translate(FOLD))


def test_acceptor_is_minimal():
    acceptors = variants.Acceptors()
    root = acceptors.add(sorted(a + b + "x" for a in "abc" for b in "pqr"))
    assert len(acceptors.arcs) == 4 and acceptors.size[root] == 9  # one state for each symbol read


def test_no_words(documents, empty):
    assert variants.group_spellings(empty).collect() == []
    assert variants.group_spellings(documents([(1, None), (2, "a b"), (3, "abcdefgh")])).collect() == []
