"""Word hashes, shingles and token ids against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartlens.llm import tokens
from cartlens.llm import words as w

LOWER = {i: i + 32 for i in range(65, 91)}
PATTERNS = {
    r"[^\x20\x09-\x0D]+": w.SPACES,
    r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+": w.NOT_ALPHANUMERIC,
}
TEXTS = ["", None, " \n", "Hello  world\x0bfoo", "x", "A b", "b a hello-É" + "z" * 500 + " world", "é漢🙂 9a\x00b\x7fC"]
PARTS = [*"aAb Zé漢🙂 \x85\x1c\x00\t\n.!19'", "\u00a0", "\u3000", "the ", "'s"]
ANY_TEXT = st.lists(st.sampled_from(PARTS), max_size=50).map("".join)


def plain(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
@pytest.mark.parametrize("pattern", PATTERNS)
def test_words_are_those_of_the_pattern(pattern, block, monkeypatch):
    monkeypatch.setattr(w, "BLOCK_BYTES", block)
    found = w.words(pa.array(TEXTS), PATTERNS[pattern])
    for i, text in enumerate(TEXTS):
        part = slice(found.first[i], found.first[i + 1])
        expected = plain(text, pattern)
        got = [bytes(found.data[a:b]).decode().translate(LOWER) for a, b in zip(found.start[part], found.end[part], strict=True)]
        assert got == expected
        assert found.hash[part].tolist() == [
            int(w.words(pa.array([x]), np.zeros(256, bool)).hash[0]) for x in expected
        ]


@given(st.lists(ANY_TEXT | st.none(), max_size=8))
@settings(max_examples=60, deadline=None)
def test_shingles_are_distinct_runs_of_five(texts):
    hashed, first = w.shingles(w.words(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        own = plain(text, r"[^\x20\x09-\x0D]+")
        expected = {tuple(own[j : j + 5]) for j in range(max(1, len(own) - 4))} if own else set()
        assert first[i + 1] - first[i] == len(expected)


def test_slices_cover_texts_and_keep_long_ones_alone():
    texts = pa.array(["a" * 10, "b" * 100, None, "", "c" * 10])
    assert list(w.slices(texts, 25)) == [(0, 1), (1, 2), (2, 5)]
    assert list(w.slices(pa.array([], pa.string()))) == []


@given(st.lists(ANY_TEXT | st.none(), max_size=6))
@settings(max_examples=60, deadline=None)
def test_token_ids_are_the_vocabularys(texts):
    made = tokens.encoder(tokens.Vocabulary.read("/opt/tokenizers/byte_bpe_50k.tiktoken"))
    ids, first = made.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == made.inner.encode_ordinary(text or "")


def test_long_text_is_encoded_in_blocks(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 100)
    made = tokens.Encoder(tokens.Vocabulary.read("/opt/tokenizers/byte_bpe_50k.tiktoken"))
    text = "Ein Wort, noch eins's é  und\n" * 40 + "x" * 700 + " ende "
    ids, first = made.encode(pa.array([text]))
    assert ids.tolist() == made.inner.encode_ordinary(text) and first.tolist() == [0, len(ids)]
