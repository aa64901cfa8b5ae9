"""Find the product label a comment names, and award points to its brand.

A comment names a label when the label is a substring of its text; the longest label wins, then the
first by name. Two plans give the same winner:

* ``in_row``: the catalogue travels inside the plan as one regular expression, shaped as a prefix tree, that
  each row applies at every place of its text. No shuffle. The work at a place does
  not grow with the catalogue but the expression does, so this is used up to ``IN_ROW_LABELS`` labels and
  ``IN_ROW_BYTES``, both measured before the plan is made.
* ``by_position``: any catalogue. A regular expression of the first few characters of the labels, of which
  there is a bounded number, cuts each distinct text at the places where some label could start, and the cuts
  meet the labels in an equi-join. A cut has at most ``CUT`` characters; a longer label meets it with its first
  ones and is then looked for in the whole text; where there are such labels, the rows with a text in which some label
  could start are stored in the shared folder first. Labels are broadcast only when measured to be within
  ``BROADCAST_BYTES``; beyond that both sides are shuffled, with salted cuts.

A third plan is for labels that match whole words only, and is chosen by name:

* ``by_words``: runs of words of each distinct text, as long as some label, meet the labels by a hash of the run in an
  equi-join. Only hashes and text ids travel, 24 bytes for each run, whatever the labels' lengths. A label of more than
  ``MOST_WORDS`` words meets a run by its first ones and is then looked for in the whole text. What wins is compared
  with the text, so equal hashes of different runs match nothing.

All plans read the version of the catalogue that ``prepare_matcher`` stores, whatever becomes of its source, and
both take the micro-batches of a stream (``foreachBatch``). ``match_stream`` takes the stream itself, with ``in_row``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions import clean_label, normalise_text
from cartlens.functions.scoring import COMMENT_POINTS
from cartlens.operators.brands import TOTAL_INDEX
from cartlens.session import shared_folder

IN_ROW_LABELS = 10_000
IN_ROW_BYTES = 1 << 20
BROADCAST_BYTES = 64 << 20
SALTS = 32
MOST_WORDS = 32
CUT = 64
# Label starts are as long as they can be while there are no more than MOST_HEADS. The shortest size needs no
# check: a clean label has 37 different characters, so there are at most 37 + 37**2 + 37**3 = 52,059 of it.
HEAD_SIZES = (3, 4, 6, 8, 12)
MOST_HEADS = 10_000


def normalise_catalogue(catalogue: DataFrame) -> DataFrame:
    """Clean, distinct (item_label_upper, brand_upper) pairs of a raw (item_label, brand) catalogue."""
    return (
        catalogue.where(F.col("item_label").isNotNull() & F.col("brand").isNotNull())
        .select(clean_label(F.col("item_label")).alias("item_label_upper"), F.upper("brand").alias("brand_upper"))
        .where((F.col("item_label_upper") != "") & (F.col("brand_upper") != ""))
        .distinct()
    )


@dataclass(frozen=True)
class Matcher:
    """A measured catalogue and the plan chosen for it."""

    labels: DataFrame
    """One row per label, as stored: ``label`` as searched, ``item_label_upper``, ``brand_upper``."""
    strategy: str
    pattern: str
    """A regular expression: the labels for ``in_row``, their heads for ``by_position``."""
    brands: str | None = None
    """The labels and their brands as JSON, for ``in_row``."""
    head_size: int = 0
    shortest: int = 0
    longest: int = 0
    broadcast_labels: bool = False
    lengths: tuple[int, ...] = ()
    """The lengths of labels' cuts (at most ``CUT``), for a catalogue whose lengths by head are too many to
    broadcast."""
    word_counts: tuple[int, ...] = ()
    """How many words labels have (at most ``MOST_WORDS``), for ``by_words``."""
    like_labels: bool = False
    whole_words: bool = False

    def searched_text(self, text: Column) -> Column:
        cleaned = normalise_text(text, like_labels=self.like_labels or self.whole_words)
        return F.concat(F.lit(" "), cleaned, F.lit(" ")) if self.whole_words else cleaned


def prepare_matcher(
    catalogue: DataFrame,
    *,
    strategy: str | None = None,
    like_labels: bool = False,
    whole_words: bool = False,
    in_row_labels: int = IN_ROW_LABELS,
    in_row_bytes: int = IN_ROW_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
    most_heads: int = MOST_HEADS,
) -> Matcher:
    """Store and measure a clean catalogue and choose the plan for it (or take ``strategy``).

    A label listed under several brands goes to the first by name. ``like_labels`` cleans texts as labels
    are cleaned; ``whole_words`` does so too and lets labels match at word boundaries only.
    """
    pad = F.lit(" ") if whole_words else F.lit("")
    labels = (
        catalogue.groupBy("item_label_upper")
        .agg(F.min("brand_upper").alias("brand_upper"))
        .withColumn("label", F.concat(pad, "item_label_upper", pad))
    )
    options = {"like_labels": like_labels, "whole_words": whole_words}
    if strategy not in (None, "in_row", "by_position", "by_words"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "by_words" and not whole_words:
        raise ValueError("by_words finds whole words only")
    version = shared_folder(labels.sparkSession)
    labels.write.parquet(version)
    labels = labels.sparkSession.read.schema(labels.schema).parquet(version)
    length = F.length("label")
    text_bytes = F.octet_length(F.concat("label", "item_label_upper", "brand_upper"))
    size = labels.agg(
        F.count("*").alias("labels"),
        F.coalesce(F.sum(text_bytes), F.lit(0)).alias("bytes"),
        F.coalesce(F.min(length), F.lit(1)).alias("shortest"),
        F.coalesce(F.max(length), F.lit(1)).alias("longest"),
    ).first()
    fits_broadcast = size["bytes"] + 64 * size["labels"] <= broadcast_bytes
    if strategy == "by_words":
        counts = labels.select(_word_count().alias("n")).distinct().collect()
        counts = tuple(sorted(row["n"] for row in counts))
        return Matcher(labels, strategy, "", broadcast_labels=fits_broadcast, word_counts=counts, **options)
    if strategy != "by_position":
        if size["labels"] <= in_row_labels and size["bytes"] <= in_row_bytes:
            rows = labels.collect()
            entries = json.dumps([row.asDict() for row in rows])
            return Matcher(labels, "in_row", _prefix_tree([row["label"] for row in rows]), brands=entries, **options)
        if strategy == "in_row":
            raise ValueError("the catalogue is too large to travel inside the plan")

    # Heads of each size, and the lengths that follow each of them, in one pass.
    sizes = F.explode(F.array(*map(F.lit, HEAD_SIZES)))
    by_size = labels.select("label", _cut_length().alias("length"), sizes.alias("n"))
    by_head = by_size.groupBy("n", F.substring("label", F.lit(1), F.col("n")).alias("head"))
    by_head = by_head.agg(F.count_distinct("length").alias("cuts"))
    by_n = by_head.groupBy("n").agg(F.count("*").alias("heads"), F.sum("cuts").alias("cuts"))
    heads_of = {row["n"]: row for row in by_n.collect()}
    fitting = [n for n in HEAD_SIZES[1:] if n in heads_of and heads_of[n]["heads"] <= most_heads]
    head_size = max([HEAD_SIZES[0], *fitting]) if heads_of else HEAD_SIZES[-1]
    cuts = heads_of[head_size]["cuts"] if heads_of else 0
    heads = labels.select(_head(head_size).alias("head")).distinct().collect()
    # A broadcast row costs its text and some 64 bytes of row and hash table.
    if 64 * cuts <= broadcast_bytes:
        lengths = ()
    else:
        lengths = tuple(sorted(row["n"] for row in labels.select(_cut_length().alias("n")).distinct().collect()))
    return Matcher(
        labels,
        "by_position",
        _prefix_tree([row["head"] for row in heads]),
        head_size=head_size,
        shortest=size["shortest"],
        longest=size["longest"],
        broadcast_labels=fits_broadcast,
        lengths=lengths,
        **options,
    )


def _prefix_tree(words: list[str]) -> str:
    """A regular expression for the longest of the words at a place. Words hold A-Z, 0-9 and spaces only."""
    branches = []
    for _, group in groupby(sorted(word for word in words if word), key=lambda word: word[0]):
        same_start = list(group)
        stem = commonprefix(same_start)
        ends = [word[len(stem) :] for word in same_start]
        branches.append(stem + (_prefix_tree(ends) if any(ends) else ""))
    tree = f"(?:{'|'.join(branches) or '(?!)'})"
    # Where a word may end, a longer one is tried first.
    return f"{tree}?" if "" in words else tree


def match_labels(comments: DataFrame, matcher: Matcher, *, text: str = "text") -> DataFrame:
    """Comments that name a label, with ``matched_item_label`` and ``matched_brand``."""
    if comments.isStreaming:
        raise ValueError("match the micro-batches of a stream, as stream_brand_points does")
    if matcher.strategy == "in_row":
        return _match_in_row(comments, matcher, text)
    if matcher.strategy == "by_words":
        return _match_by_words(comments, matcher, text)
    return _match_by_position(comments, matcher, text)


def match_stream(comments: DataFrame, matcher: Matcher, *, text: str = "text") -> DataFrame:
    """As ``match_labels``, for a stream as well: rows in, rows out, nothing kept between batches.

    The catalogue travels inside the plan, so every batch of a running query meets the version that
    ``prepare_matcher`` stored, whatever becomes of its source; a restart may bring another matcher. Only a catalogue
    measured to fit the plan can do this: a larger one needs the texts grouped, which a stream would have to keep, and
    is matched by micro-batch.
    """
    if matcher.strategy != "in_row":
        raise ValueError("a catalogue of this size is matched by micro-batch, as stream_brand_points does")
    return _match_in_row(comments, matcher, text)


def _match_in_row(comments: DataFrame, matcher: Matcher, text: str) -> DataFrame:
    # Looking ahead consumes nothing, so labels that overlap are all found: the longest at each place.
    found = F.regexp_extract_all(F.col("_searched"), F.lit(f"(?=({matcher.pattern}))"), F.lit(1))
    preference = F.transform(found, lambda label: F.struct((-F.length(label)).alias("shorter"), label.alias("label")))
    hits = (
        comments.withColumn("_searched", matcher.searched_text(F.col(text)))
        .where(F.col("_searched").rlike(matcher.pattern))
        .withColumn("_label", F.array_min(preference)["label"])
        .drop("_searched")
    )
    # Bounded by the measured size, so safe to broadcast.
    entry = "STRUCT<label: STRING, item_label_upper: STRING, brand_upper: STRING>"
    names = F.from_json(F.lit(matcher.brands), f"ARRAY<{entry}>")
    brands = comments.sparkSession.range(1).select(F.inline(names)).select(
        F.col("label").alias("_label"),
        F.col("item_label_upper").alias("matched_item_label"),
        F.col("brand_upper").alias("matched_brand"),
    )
    return hits.join(F.broadcast(brands), "_label").drop("_label")


def _head(size: int) -> Column:
    return F.substring("label", 1, size)


def _cut_length() -> Column:
    return F.least(F.length("label"), F.lit(CUT))


def _with_lengths(windows: DataFrame, matcher: Matcher) -> DataFrame:
    """Each window with each length a label at its start may have: those of labels with the same head, or
    those of all labels."""
    if matcher.lengths:
        return windows.withColumn("length", F.explode(F.array(*map(F.lit, matcher.lengths))))
    heads = matcher.labels.groupBy(_head(matcher.head_size).alias("head")).agg(
        F.collect_set(_cut_length()).alias("lengths")
    )
    sizes = F.sequence(F.lit(min(matcher.shortest, matcher.head_size)), F.lit(matcher.head_size))
    return (
        windows.withColumn("size", F.explode(sizes))
        .where(F.col("size") <= F.length("window"))
        .withColumn("head", F.substring("window", F.lit(1), F.col("size")))
        .join(F.broadcast(heads), "head")
        .withColumn("length", F.explode("lengths"))
    )


def _whole_labels(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Of labels that are longer than a cut, those that stand in the text as a whole; all shorter ones."""
    columns = ["_text_id", "label", "item_label_upper", "brand_upper"]
    short = found.where(F.length("label") <= CUT).select(*columns)
    long = found.where(F.length("label") > CUT).select(*columns).distinct()
    once = texts.distinct()
    return short.unionByName(long.join(once, "_text_id").where(F.contains("_searched", "label")).select(*columns))


def _match_by_position(comments: DataFrame, matcher: Matcher, text: str) -> DataFrame:
    searched = matcher.searched_text(F.col(text))
    identity = F.unhex(F.sha2(F.col("_searched"), 256))
    every = comments.withColumn("_searched", searched)
    # Texts in which no label can start are not worth a shuffle.
    candidates = every.where(F.col("_searched").rlike(matcher.pattern))
    if matcher.longest > CUT:
        # Long labels are looked for in whole texts, which are read three times then: clean and search them once.
        path = shared_folder(comments.sparkSession)
        candidates.write.parquet(path)
        every = candidates = comments.sparkSession.read.schema(candidates.schema).parquet(path)
    if matcher.broadcast_labels:
        texts = every.select("_searched")
    else:
        # The cuts will be shuffled: search equal texts once, or a much repeated one would be a hot key there.
        texts = candidates.select("_searched").distinct()

    # A window is what follows a place where some label may start, up to the longest cut or a character that
    # no label has. Rows carry windows, never the text.
    tail = f"[A-Z0-9 ]{{0,{min(matcher.longest, CUT)}}}"
    windows = F.regexp_extract_all(F.col("_searched"), F.lit(f"(?=({matcher.pattern}{tail}))"), F.lit(1))
    cuts = (
        _with_lengths(texts.select(identity.alias("_text_id"), F.explode(windows).alias("window")), matcher)
        .where(F.col("length") <= F.length("window"))
        .select("_text_id", F.substring("window", F.lit(1), F.col("length")).alias("start"))
    )

    labels = matcher.labels.withColumn("start", F.substring("label", 1, CUT))
    keys = ["start"]
    if matcher.broadcast_labels:
        labels = F.broadcast(labels)
    else:
        # A label that a third of all texts name is split over SALTS tasks; each cut still meets each label once.
        keys.append("salt")
        cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("_text_id"), F.lit(SALTS)).cast("int"))
        labels = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = cuts.join(labels, keys)
    if matcher.longest > CUT:
        found = _whole_labels(found, candidates.select(identity.alias("_text_id"), "_searched"))
    preference = F.struct((-F.length("label")).alias("shorter"), "label", "item_label_upper", "brand_upper")
    winners = (
        found.groupBy("_text_id")
        .agg(F.min(preference).alias("best"))
        .select(
            F.hex("_text_id").alias("_key"),
            F.col("best.item_label_upper").alias("matched_item_label"),
            F.col("best.brand_upper").alias("matched_brand"),
        )
    )
    # One winner per text, so rows never multiply. The key is another spelling of the grouped one on purpose:
    # it makes Spark shuffle the winners for this join, and AQE splits the comments of a much repeated text
    # only where both sides come straight from a shuffle.
    keyed = candidates.withColumn("_key", F.hex(identity)).drop("_searched")
    return keyed.join(winners, "_key").drop("_key")


def _words(text: Column) -> Column:
    return F.split(F.trim(text), " ")


def _word_count() -> Column:
    return F.least(F.size(_words(F.col("label"))), F.lit(MOST_WORDS))


def _run_hash(words: Column, start: Column | int, length: Column) -> Column:
    return F.xxhash64(F.array_join(F.slice(words, start, length), " "))


def _match_by_words(comments: DataFrame, matcher: Matcher, text: str) -> DataFrame:
    searched = matcher.searched_text(F.col(text))
    candidates = comments.withColumn("_searched", searched).where(F.trim("_searched") != "")
    identity = F.unhex(F.md5("_searched"))
    # Equal texts are searched once, or a much repeated one would be a hot key of the join.
    texts = candidates.select("_searched").distinct().select(identity.alias("_text_id"), _words(F.col("_searched")).alias("words"))
    runs = texts.withColumn("length", F.explode(F.array(*map(F.lit, matcher.word_counts)).cast("array<int>")))
    runs = runs.where(F.size("words") >= F.col("length"))
    places = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    hashes = F.transform(places, lambda at: _run_hash(F.col("words"), at, F.col("length")))
    found = runs.select("_text_id", F.explode(F.array_distinct(hashes)).alias("run"))
    labels = matcher.labels.withColumn("run", _run_hash(_words(F.col("label")), 1, _word_count()))
    keys = ["run"]
    if matcher.broadcast_labels:
        labels = F.broadcast(labels)
    else:
        # As by position: a label that many texts name is split over tasks.
        keys.append("salt")
        found = found.withColumn("salt", F.pmod(F.xxhash64("_text_id"), F.lit(SALTS)).cast("int"))
        labels = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = found.join(labels, keys).select("_text_id", "label", "item_label_upper", "brand_upper")
    if matcher.word_counts and matcher.word_counts[-1] == MOST_WORDS:
        once = candidates.select(identity.alias("_text_id"), "_searched").distinct()
        long = F.size(_words(F.col("label"))) > MOST_WORDS
        whole = found.where(long).distinct().join(once, "_text_id").where(F.contains("_searched", "label"))
        found = found.where(~long).unionByName(whole.drop("_searched"))
    preference = F.struct((-F.length("label")).alias("shorter"), "label", "item_label_upper", "brand_upper")
    winners = found.groupBy("_text_id").agg(F.min(preference).alias("best"))
    # Another spelling of the key, as by position, so that AQE can split a much repeated text.
    winners = winners.select(F.hex("_text_id").alias("_key"), "best")
    keyed = candidates.withColumn("_key", F.hex(identity))
    return (
        keyed.join(winners, "_key")
        .where(F.contains("_searched", "best.label"))
        .withColumn("matched_item_label", F.col("best.item_label_upper"))
        .withColumn("matched_brand", F.col("best.brand_upper"))
        .drop("_key", "_searched", "best")
    )


def comment_points(matched: DataFrame) -> DataFrame:
    """One row of points for each matched comment."""
    return matched.select(
        F.col("matched_brand").alias("brand"), F.lit(COMMENT_POINTS).cast("long").alias(TOTAL_INDEX)
    )


def comment_points_total(matched: DataFrame) -> DataFrame:
    return comment_points(matched).groupBy("brand").agg(F.sum(TOTAL_INDEX).alias(TOTAL_INDEX))
