"""Mix sources to target weights by capped water-filling, with DataFrame functions only.

Sources, in code point order with null last, weigh 1, 2, 3, repeating, and share all words of the documents.
A source's target stops at ``max_epochs`` times its own words; the excess goes to the others by weight, round
by round, until none is above. A source whose target is 1.4 times its words takes each document once and
0.4 of its words again: its documents stand in an order drawn from the seed, and those before a threshold
are taken once more. The threshold is the place nearest to the target, so a source misses its target by
half a document at most.

Only sizes are stored and moved: words are counted once, thresholds are found by source, and a document's
repetitions follow from its own id and its source's row. The threshold is searched in 1,024 ranges of the
drawn numbers, of which only the one it falls in is sorted, so a hot source isn't sorted in one task.

A document's number is drawn from its id; one without an id draws from its text. Rows with the same source, id and
text are summed and stand together. If the threshold falls among them, so many of them are taken once more as come
nearest to the target; which of them, is a matter of their place in the table, and as they are equal, reruns agree.
Their places are counted by partition first, so a third of all rows may be equal. ``repeat_documents`` reads the
table twice and expects the same places, so its documents should come from files.

Defined results: a null text has size 0, as has an empty one; very long texts are counted whole; null is a source of
its own; a source without words has target 0 and takes each document 0 times; no row is repeated more than
``max_epochs`` times, if that is whole; an empty table has an empty mix. Other columns don't matter and are kept by
``repeat_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.frames import stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
_RANGE_BITS = 10


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def drawn(doc_id: str, text: str, seed: str = SEED) -> Column:
    """A number below 2**32 drawn for an id, or for the text where that is null."""
    own = F.concat(F.lit("text:"), F.coalesce(F.col(text), F.lit("")))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), own))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def _digest(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def _range(u: Column) -> Column:
    return F.shiftright(u, 32 - _RANGE_BITS).cast("int")


_KEY = ("u", "doc_id", "digest")  # equal rows of a source have these in common, and their size


def sized_documents(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """Id, source, size, drawn number, digest of the text and place of each document, stored."""
    sized = documents.select(
        "doc_id", "source", word_count("text").alias("size"), drawn("doc_id", "text", seed).alias("u"),
        _digest("text").alias("digest"), F.monotonically_increasing_id().alias("place"),
    )
    return stored(sized, "sizes")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """Each source's words, weight and target."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    # Numbered without gathering all sources in one task: sorted ranges, then a count of each range.
    ranged = stored(sums.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))  # one row for each range
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    number = F.col("earlier") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int")).cast("long")
    numbered = stored(ranged.join(parts, "part").withColumn("weight", weight).drop("part", "earlier"), "weights")

    cap = F.col("source_size") * F.lit(max_epochs)
    free, clamped, share = F.lit(True), -1, F.lit(0.0)
    while True:  # clamp, and share the rest anew; each round clamps a source at least
        left = F.sum("source_size") - F.coalesce(F.sum(F.when(~free, cap)), F.lit(0))
        weights_left = F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0))
        now = numbered.agg(
            left.alias("left"), weights_left.alias("weights"), F.count(F.when(~free, 1)).alias("clamped")
        ).head()
        if now.clamped == clamped or not now.weights:
            break
        clamped = now.clamped
        share = F.col("weight") * F.lit(now.left) / F.lit(now.weights)
        free = share <= cap
    return numbered.withColumn("target", F.when(free, share).otherwise(cap).cast("double"))


def source_plan(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """For each source, how often all its documents are taken, and up to which drawn number once more."""
    targets = source_targets(sized, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    need = F.col("target") - F.col("whole") * F.col("source_size")
    targets = stored(targets.withColumn("need", need), "targets")

    ranges = sized.groupBy("source", _range(F.col("u")).alias("range")).agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("until", F.sum("words").over(in_order)).withColumn("from", F.col("until") - F.col("words"))
    named = targets.select(F.col("source").alias("named"), "need")
    crossing = (
        ranges.join(named, F.col("source").eqNullSafe(F.col("named")))
        .where((F.col("from") < F.col("need")) & (F.col("need") <= F.col("until")))
        .select("named", "range", "from", "need")
    )
    rows = sized.withColumn("in_range", _range(F.col("u"))).join(
        crossing, F.col("source").eqNullSafe(F.col("named")) & (F.col("in_range") == F.col("range"))
    )
    rows = rows.groupBy("named", "range", "from", "need", *_KEY).agg(
        F.sum("size").alias("words"), F.max("size").alias("size"), F.count("*").alias("rows")
    )
    by_draw = Window.partitionBy("named", "range").orderBy(*_KEY)
    rows = rows.withColumn("until", F.col("from") + F.sum("words").over(by_draw))
    under = F.col("need") - (F.col("until") - F.col("words"))
    crossed = rows.where((F.col("until") >= F.col("need")) & (under > 0))
    again = F.floor(under / F.col("size") + 0.5).cast("long").alias("again")
    ends = stored(crossed.select("named", "range", F.struct(*_KEY).alias("last"), again, "rows"), "ends")
    plan = targets.join(ends, F.col("source").eqNullSafe(F.col("named")), "left")
    plan = plan.join(_last_places(sized, ends), F.col("source").eqNullSafe(F.col("placed")), "left")
    last_place = F.when(F.col("again") >= F.col("rows"), F.lit(_ALL)).otherwise(F.coalesce("last_place", F.lit(-1)))
    return stored(
        plan.select("source", "source_size", "target", "whole", "range", "last", last_place.alias("last_place")), "plan"
    )


_ALL = (1 << 63) - 1
_IN_PARTITION = 33  # bits of a place that number the rows of one partition


def _last_places(sized: DataFrame, ends: DataFrame) -> DataFrame:
    """For each source whose threshold falls among equal rows, the place of the last that is taken once more."""
    among = ends.where((F.col("again") > 0) & (F.col("again") < F.col("rows"))).select("named", "last", "again")
    same = F.struct(*_KEY).eqNullSafe(F.col("last")) & F.col("source").eqNullSafe(F.col("named"))
    part = F.shiftright("place", _IN_PARTITION).alias("part")
    equal = sized.join(among, same).select("named", "again", "place", part)
    counts = equal.groupBy("named", "again", "part").agg(F.count("*").alias("n"))  # a row for each partition
    counts = counts.withColumn("until", F.sum("n").over(Window.partitionBy("named").orderBy("part")))
    left = (F.col("again") - F.col("until") + F.col("n")).alias("left")
    crossed = counts.where((F.col("until") >= F.col("again")) & (F.col("until") - F.col("n") < F.col("again")))
    crossed = crossed.select(F.col("named").alias("placed"), F.col("part").alias("in_part"), left)
    rows = equal.join(crossed, F.col("named").eqNullSafe(F.col("placed")) & (F.col("part") == F.col("in_part")))
    number = F.row_number().over(Window.partitionBy("placed").orderBy("place"))
    rows = rows.withColumn("number", number).where(F.col("number") == F.col("left"))
    return rows.select("placed", F.col("place").alias("last_place"))


def _copies(u: Column, doc_id: Column, digest: Column, place: Column) -> Column:
    """Repetitions of a document, beside its source's row of the plan."""
    key = F.struct(u.alias("u"), doc_id.alias("doc_id"), digest.alias("digest"))
    taken = (key < F.col("last")) | (key.eqNullSafe(F.col("last")) & (place <= F.col("last_place")))
    inside = (_range(u) == F.col("range")) & F.coalesce(taken, F.lit(False))
    again = F.coalesce((_range(u) < F.col("range")) | inside, F.lit(False))
    return F.col("whole") + again.cast("long")


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """For each document: doc_id, its size, its source's size and target, copies, and the words it gives the mix."""
    sized = sized_documents(documents, seed)
    plan = source_plan(sized, weights, max_epochs).withColumnRenamed("source", "named")
    copies = _copies(*map(F.col, (*_KEY, "place")))
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("named"))).withColumn("copies", copies)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return joined.select("doc_id", "size", "source_size", "target", "copies", taken)


def repeat_documents(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns."""
    plan = source_plan(sized_documents(documents, seed), weights, max_epochs)
    names = documents.columns
    row = documents.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    row = row.withColumns({
        "u": drawn("row.doc_id", "row.text", seed), "id": F.col("row.doc_id"), "digest": _digest("row.text"),
        "place": F.monotonically_increasing_id(),
    })
    joined = row.join(plan, F.col("row.source").eqNullSafe(F.col("source")))
    copies = _copies(*map(F.col, ("u", "id", "digest", "place"))).cast("int")
    repeated = joined.select("row", F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return repeated.select("row.*")
