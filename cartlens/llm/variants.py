"""Spelling variants: words at one edit from each other, by finite-state composition.

The vocabulary is counted in one pass, summed in the tasks and then by word. Pairs of near words are what the
composition of the vocabulary's minimised acceptor, a transducer of one edit, and the acceptor again accepts. It is
cut into partitions by initial states: two words of which the shorter has ``m`` code points, one edit apart, share
their first ``m // 2`` or their last ``m - m // 2``. So a partition holds the words of ``m`` and ``m + 1`` code points
with one such beginning (or, spelled backwards, ending), and starts the composition in the state that it leads to.
In a task, the words' rests become two minimised acceptors with common states; a walk over the composed states
(state, edited or not, state) gives the accepted pairs as ranks of words, and stops at equal states, behind which
every rest is common.

A partition of more than ``MOST`` words is cut where its words part, at the successors of the state there: one for
each next code point unedited, and one for each rest behind an edit just there. This is repeated while any is too
large, so no task builds an acceptor of more words, and no pair is left out.

Forms are followed to their roots by doubling: each round joins the words with the roots of their roots.

Defined results: a null text has no words; a null doc_id counts as the text '' in the hash; rows that share a doc_id
and repeated rows count each; empty tables give no rows. A text of any length is read whole, in pieces.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.frames import find_package, stored
from cartlens.llm.words import LOWER

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
ALTERED = 199  # a word of a document loses a code point where this divides their hash
MOST = 1 << 14  # words in one acceptor
PIECE = 4 << 20  # bytes of a text looked at together
HELD = 1 << 17  # words a task sums before it passes them on

_LOWER = LOWER.tobytes()
_LETTERS = "a-zA-ZÀ-ÿ"


def _pieces(data: bytes) -> Iterator[str]:
    """The text in lower case (A-Z only), cut where no word is."""
    begin = 0
    while begin < len(data):
        end = min(begin + PIECE, len(data))
        # A byte of a letter is an ASCII letter or above ASCII.
        while end < len(data) and (data[end] >= 0x80 or chr(data[end]).isalpha()):
            end += 1
        yield data[begin:end].translate(_LOWER).decode("utf-8", "replace")
        begin = end


def vocabulary(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """word and n of each word that is long and frequent enough."""
    find_word = re.compile(f"[{_LETTERS}]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = defaultdict(int)
        for batch in batches:
            for number, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if number is None else number}:".encode())
                for piece in _pieces(text.as_buffer().to_pybytes()):
                    for word, n in Counter(find_word.findall(piece)).items():
                        mark = zlib.crc32(word.encode(), start)
                        if mark % ALTERED:
                            total[word] += n
                        elif len(word) > least_length:
                            at = mark % len(word)
                            total[word[:at] + word[at + 1 :]] += n
                if len(total) >= HELD:
                    yield _counts(total)
                    total.clear()
        if total:
            yield _counts(total)

    rows = documents.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    find_package(documents.sparkSession)
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _counts(total: dict[str, int]) -> pa.RecordBatch:
    columns = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


class Acceptors:
    """Minimised acceptors of sorted words of one length each, with common states.

    State 0 accepts the end. ``arcs`` has, for each state, symbol -> (next state, words before those of this arc),
    ``size`` the number of words that it accepts; so a path's numbers add up to the rank of its word.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.size = [1]
        self.known: dict[tuple[tuple[str, int], ...], int] = {(): 0}

    def _state(self, arcs: dict[str, int]) -> int:
        key = tuple(arcs.items())
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.arcs)
            before, own = 0, {}
            for symbol, to in key:
                own[symbol] = (to, before)
                before += self.size[to]
            self.arcs.append(own)
            self.size.append(before)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state of the acceptor of these words."""
        length = len(words[0])
        open_arcs: list[dict[str, int]] = [{} for _ in range(length)]
        last = words[0]
        for word in words[1:]:
            same = 0
            while word[same] == last[same]:
                same += 1
            self._close(open_arcs, last, same)
            last = word
        if not length:
            return 0
        self._close(open_arcs, last, 0)
        return self._state(open_arcs[0])

    def _close(self, open_arcs: list[dict[str, int]], word: str, down_to: int) -> None:
        """States of the word's rests become final, and an arc of the state ``down_to`` leads to them."""
        state = 0
        for at in range(len(word) - 1, down_to, -1):
            open_arcs[at][word[at]] = state
            state = self._state(open_arcs[at])
            open_arcs[at] = {}
        open_arcs[down_to][word[down_to]] = state

    def replaced(self, root: int) -> Iterator[tuple[int, int]]:
        """Ranks of the words that differ by one replaced symbol."""
        edited: list[tuple[int, int, int, int]] = []
        unedited = [(root, 0)]
        while unedited:
            p, rank = unedited.pop()
            arcs = list(self.arcs[p].values())
            unedited += [(to, rank + n) for to, n in arcs if self.size[to] > 1]
            for i, (a, m) in enumerate(arcs):
                edited += [(a, b, rank + m, rank + n) for b, n in arcs[i + 1 :]]
            yield from self._common(edited)

    def inserted(self, root: int, longer: int) -> Iterator[tuple[int, int]]:
        """Ranks of words and of the longer ones that have one symbol more. Of equal symbols, the last is the new one."""
        edited: list[tuple[int, int, int, int]] = []
        unedited = [(root, longer, 0, 0)]
        while unedited:
            p, q, u, v = unedited.pop()
            here, there = self.arcs[p], self.arcs[q]
            for symbol, (to, n) in there.items():
                if symbol in here:
                    unedited.append((here[symbol][0], to, u + here[symbol][1], v + n))
                if not here:  # the end of the shorter word
                    edited.append((p, to, u, v + n))
                for other, (a, m) in here.items():
                    if other != symbol and (b := self.arcs[to].get(other)):
                        edited.append((a, b[0], u + m, v + n + b[1]))
            yield from self._common(edited)

    def _common(self, edited: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int]]:
        """Pairs behind the edit: the same rest on both sides."""
        while edited:
            p, q, u, v = edited.pop()
            if p == q:
                for i in range(self.size[p]):
                    yield u + i, v + i
                continue
            there = self.arcs[q]
            for symbol, (a, m) in self.arcs[p].items():
                if to := there.get(symbol):
                    edited.append((a, to[0], u + m, v + to[1]))


def near_in_partition(words: list[str], m: int, shared: int) -> Iterator[tuple[int, int]]:
    """Indices of near words in a sorted partition: words of m and m + 1 code points with the first ``shared`` the same."""
    short = [i for i, w in enumerate(words) if len(w) == m]
    if not short:
        return
    long = [i for i, w in enumerate(words) if len(w) > m]
    acceptors = Acceptors()
    root = acceptors.add([words[i][shared:] for i in short])
    if len(short) > 1:
        for a, b in acceptors.replaced(root):
            yield short[a], short[b]
    if long:
        for a, b in acceptors.inserted(root, acceptors.add([words[i][shared:] for i in long])):
            yield short[a], long[b]


def _behind_edit(words: list[str], m: int, shared: int) -> Iterator[tuple[int, int]]:
    """As above, where the edit is at code point ``shared`` and all rests behind it are the same."""
    short = [i for i, w in enumerate(words) if len(w) == m]
    long = [i for i, w in enumerate(words) if len(w) > m]
    if long:  # the partition of an inserted code point
        for a in short:
            for b in long:
                if words[a][shared : shared + 1] != words[b][shared]:
                    yield a, b
        return
    for x, a in enumerate(short):
        for b in short[x + 1 :]:
            yield a, b


def _entries(words: DataFrame, least_length: int) -> DataFrame:
    """Each word in the partitions it belongs to: side (1: spelled backwards), m, code points shared, and the text."""
    length = F.char_length("word")
    places = []
    for m in (length, length - 1):
        half = F.floor(m / 2).cast("int")
        for side, shared, text in ((0, half, F.col("word")), (1, m - half, F.reverse("word"))):
            place = F.struct(
                F.lit(side).alias("side"), m.alias("m"), shared.alias("shared"), F.lit(0).alias("kind"), text.alias("text")
            )
            places.append(F.when(m >= least_length, place))
    rows = words.select("n", F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())).alias("x"))
    return rows.select("x.*", "n").withColumn("key", F.expr("substr(text, 1, shared)"))


_GROUP = ("side", "m", "shared", "kind", "key")


def _with_branch(large: DataFrame) -> DataFrame:
    """The groups with ``branch``: how many code points all their texts (of which these have ``low`` and ``high``) share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True)
            branch = pa.array([len(commonprefix(x)) for x in ends], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in _GROUP), branch], names=[*_GROUP, "branch"])

    find_package(large.sparkSession)
    return large.mapInArrow(run, "side int, m int, shared int, kind int, key string, branch int")


def _successors(hot: DataFrame) -> DataFrame:
    """The partitions of the states behind the one where the texts part: one code point further, or (kinds 1, 2)
    behind a replaced or inserted one."""
    beginning = "substr(text, 1, branch)"
    after = F.expr(f"concat({beginning}, '\u0000', substr(text, branch + 2))")
    here = F.expr(f"concat({beginning}, '\u0000', substr(text, branch + 1))")
    short = F.char_length("text") == F.col("m")
    goes_on = F.col("branch") < F.char_length("text")
    state = lambda shared, kind, key: F.struct(shared.alias("shared"), F.lit(kind).alias("kind"), key.alias("key"))
    branch = F.col("branch")
    further = state(branch + 1, 0, F.expr("substr(text, 1, branch + 1)"))
    replaced, inserted = state(branch, 1, after), state(branch, 2, F.when(short, here).otherwise(after))
    # A word that ends here has no state behind it.
    next_ones = F.array(F.when(goes_on, further), F.when(short & goes_on, replaced), F.when(short | goes_on, inserted))
    rows = hot.select("side", "m", "text", "n", F.explode(F.filter(next_ones, lambda x: x.isNotNull())).alias("x"))
    return rows.select("side", "m", "x.shared", "x.kind", "text", "n", "x.key")


def _partitions(words: DataFrame, least_length: int, most: int) -> DataFrame:
    """Entries of partitions of at most so many words."""
    entries, parts = _entries(words, least_length), []
    keys = list(_GROUP)
    while True:
        hot = entries.where("kind = 0").groupBy(*keys).count().where(F.col("count") > most).drop("count")
        hot = stored(hot, "large-partitions")
        if hot.isEmpty():
            break
        parts.append(entries.join(hot, keys, "left_anti").select(*entries.columns))
        inside = entries.join(hot, keys, "left_semi")
        ends = inside.groupBy(*keys).agg(F.min("text").alias("low"), F.max("text").alias("high"))
        entries = stored(_successors(inside.join(_with_branch(ends), keys)), "successors")
    for part in parts:
        entries = entries.unionByName(part)
    return entries


def near_words(words: DataFrame, *, least_length: int = LEAST_LENGTH, most: int = MOST) -> DataFrame:
    """a, n_a, b, n_b: each pair of near words once, with their counts."""
    names = ["a", "n_a", "b", "n_b"]

    def found(key: tuple[int, int, int, int, str], words: list[str], n: list[int]) -> Iterator[tuple[str, int, str, int]]:
        side, m, shared, kind, _ = key
        half = m // 2
        for i, j in (_behind_edit if kind else near_in_partition)(words, m, shared):
            a, b = words[i], words[j]
            if side:
                a, b = a[::-1], b[::-1]
                # Equal letters around the middle: the pair is also found by its beginning.
                if len(a) != len(b) and a[:half] == b[:half]:
                    continue
            yield a, n[i], b, n[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, words, n, out = None, [], [], []
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in (*_GROUP, "text", "n")]
            for *key, text, number in zip(*columns, strict=True):
                if key != current:
                    if len(words) > 1:
                        out += found(current, words, n)
                    current, words, n = key, [], []
                    if len(out) >= 1 << 15:
                        yield table(out)
                        out = []
                words.append(text)
                n.append(number)
        if len(words) > 1:
            out += found(current, words, n)
        if out:
            yield table(out)

    def table(out: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
        columns = [pa.array(x) for x in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    entries = _partitions(words, least_length, most).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "text")
    find_package(words.sparkSession)
    return entries.mapInArrow(run, "a string, n_a long, b string, n_b long")


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of each word that has a form: rounds of doubling, until none leads on."""
    state = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = state.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        state = stored(state, "roots")
        if state.where("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def group_spellings(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    most: int = MOST,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of the vocabulary."""
    words = vocabulary(
        documents, id_column=id_column, text_column=text_column, least_length=least_length, least_count=least_count
    )
    words = stored(words, "vocabulary")
    pairs = stored(near_words(words, least_length=least_length, most=most), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("near")).alias("x"))
    both = both.unionByName(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("near")).alias("x"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("x").alias("x"))
    known = words.join(best, "word", "left")
    formed = (-F.col("x.less")) >= ratio * F.col("n")
    known = known.select(
        "word",
        F.when(formed, F.col("x.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, -F.col("x.less")).alias("form_n"),
    )
    known = stored(known, "known-words")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
