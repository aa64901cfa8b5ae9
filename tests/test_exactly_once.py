"""Results that must come out the same after failures, repeats and rewrites."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from samples import rows

from cartlens.operators.labels import match_labels, match_stream, normalise_catalogue, prepare_matcher
from cartlens.operators.listings import parse_comments
from cartlens.plans import once
from cartlens.plans.published import TABLES, publish_once
from cartlens.sinks.jdbc import JdbcTarget
from cartlens.sinks.ledger import FileTables, JdbcTables, Ledger
from cartlens.sinks.marks import not_taken, save_taken
from cartlens.sources.comments import message_stream, read_archive
from cartlens.sources.files import read_event_csv, route_event_csv
from cartlens.streaming import (
    archive_comments,
    compact_archive,
    fold_live_total,
    ledger_points,
    live_total,
    parquet_points,
    read_compacted,
    stream_brand_points,
)

POINTS = "brand STRING, total_long_term_brand_popularity_index BIGINT"
ONCE = {"availableNow": True}


def message(number, text):
    return json.dumps({"post_id": "p", "comment_id": f"c{number}", "author": "u", "text": text, "created_utc": 100})


def arrive(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(messages) + "\n")


def tuples(frame):
    return sorted(rows(frame), key=repr)


# --- all tables from one scan -----------------------------------------------------------------------------


def test_tables_from_one_scan_equal_the_metrics(spark, golden):
    odd = golden.limit(1).withColumns({"event_type": F.lit(None).cast("string"), "price": F.lit(None).cast("double")})
    events = golden.unionByName(odd).unionByName(odd.withColumn("event_type", F.lit("purchase")))
    tables = once.tables_of(once.store_sums(events), "2020-Apr")
    assert tables.keys() == TABLES.keys()
    for name, published in TABLES.items():
        want = published.metric(events, period="2020-Apr")
        assert tables[name].columns == want.columns
        assert [f.dataType for f in tables[name].schema] == [f.dataType for f in want.schema]
        got = [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(tables[name])]
        assert got == [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(want)], name


def test_one_scan_and_one_shuffle_before_the_tables(golden):
    plan = once.sums_by_group(golden)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("partial_sum") > 0


def test_tables_of_no_events(golden):
    tables = once.tables_of(once.store_sums(golden.limit(0)))
    assert {name: table.count() for name, table in tables.items() if table.count()} == {
        "avg_site_visits_per_user": 1,
        "avg_cart_purchase_count_diff": 1,
    }


def test_publish_once_keeps_each_table_mode(golden, monkeypatch):
    written = []
    write = lambda frame, table, target, mode: written.append((table, mode))
    monkeypatch.setattr("cartlens.plans.published.write_jdbc", write)
    publish_once(golden, "2020-Apr", database=JdbcTarget("u", "d"))
    assert written == [(name, table.mode) for name, table in TABLES.items()]


# --- the ledger -------------------------------------------------------------------------------------------


class Failing(FileTables):
    """Fails at the next append to a table of this kind."""

    fail_at: list[str] = []

    def append(self, frame, table):
        if self.fail_at and table.endswith(self.fail_at[0]):
            self.fail_at.pop()
            raise OSError("the database is gone")
        super().append(frame, table)


@pytest.mark.parametrize("step", ["_staged", "_commits"])
def test_a_batch_that_fails_at_either_step_counts_once(spark, tmp_path, step):
    tables = Failing(str(tmp_path))
    ledger = Ledger(tables, "points", POINTS)
    points = spark.createDataFrame([("A", 10), ("A", 10), ("B", 10)], POINTS)
    assert rows(ledger.rows(spark)) == []
    assert ledger.append_once(points, 0)
    tables.fail_at.append(step)
    with pytest.raises(OSError):
        ledger.append_once(points, 1)
    assert ledger.rows(spark).count() == 3
    assert ledger.append_once(points, 1) and not ledger.append_once(points, 1) and not ledger.append_once(points, 0)
    assert sorted(rows(ledger.rows(spark), "batch", "brand")) == [(b, x) for b in (0, 1) for x in "AAB"]


def test_two_attempts_that_both_commit_count_once(spark, tmp_path, monkeypatch):
    ledger = Ledger(FileTables(str(tmp_path)), "points", POINTS)
    points = spark.createDataFrame([("A", 10)], POINTS)
    monkeypatch.setattr(Ledger, "is_committed", lambda *_: False)
    assert ledger.append_once(points, 5) and ledger.append_once(points, 5)
    assert ledger.rows(spark).count() == 1


def test_streams_of_one_table_keep_their_own_batches(spark, tmp_path):
    points = spark.createDataFrame([("A", 10)], POINTS)
    for stream in ("x", "y", "x"):
        Ledger(FileTables(str(tmp_path)), "points", POINTS, stream).append_once(points, 0)
    assert sorted(rows(Ledger(FileTables(str(tmp_path)), "points", POINTS).rows(spark), "stream")) == [("x",), ("y",)]


def test_a_database_is_appended_to_and_read(spark, monkeypatch):
    calls = []
    monkeypatch.setattr("cartlens.sinks.ledger.write_jdbc", lambda f, t, d, mode: calls.append((t, mode, f.columns)))
    empty = spark.createDataFrame([], "stream STRING, batch BIGINT, attempt STRING")
    monkeypatch.setattr("cartlens.sinks.ledger.read_jdbc", lambda spark, table, target: empty)
    ledger = Ledger(JdbcTables(JdbcTarget("u", "d")), "points", POINTS)
    assert ledger.append_once(spark.createDataFrame([("A", 10)], POINTS), 3)
    key = ["stream", "batch", "attempt"]
    points = POINTS.replace(" STRING", "").replace(" BIGINT", "").split(", ")
    assert calls == [
        ("points_commits", "append", key),  # makes the table where it is missing
        ("points_staged", "append", points + key),
        ("points_commits", "append", key),
    ]


def test_a_stream_that_fails_before_the_commit_goes_on(spark, tmp_path):
    pairs = spark.createDataFrame([("ring", "a")], "item_label STRING, brand STRING")
    matcher = prepare_matcher(normalise_catalogue(pairs))
    tables = Failing(str(tmp_path / "tables"))
    ledger = Ledger(tables, "points", POINTS)
    arrive(tmp_path / "in", "1.json", message(1, "a ring"), message(2, "string"))

    def run():
        stream = message_stream(spark, "text", {}, str(tmp_path / "in"))
        query = stream_brand_points(stream, matcher, ledger_points(ledger), str(tmp_path / "mark"), trigger=ONCE)
        query.awaitTermination(120)

    tables.fail_at.append("_commits")
    with pytest.raises(StreamingQueryException):
        run()
    assert rows(ledger.rows(spark)) == []
    run()
    run()
    assert rows(ledger.rows(spark), "brand") == [("A",), ("A",)]


def test_a_batch_that_finds_nothing_when_run_again_takes_its_points_back(spark, tmp_path):
    write = parquet_points(str(tmp_path / "points"))
    points = spark.createDataFrame([("A", 10)], POINTS)
    for batch in (0, 1):
        write(points, batch)
    write.on_empty(points.limit(0), 1)
    write.on_empty(points.limit(0), 2)  # nothing was there, and nothing is written
    assert rows(spark.read.parquet(str(tmp_path / "points")), "brand", "batch") == [("A", 0)]
    assert not (tmp_path / "points" / "batch=2").exists()


# --- the running total ------------------------------------------------------------------------------------


def test_total_is_the_same_however_often_it_is_folded(spark, tmp_path):
    points, snapshots = str(tmp_path / "points"), str(tmp_path / "snapshots")
    assert rows(live_total(spark, points, snapshots)) == []
    assert fold_live_total(spark, points, snapshots) == -1
    write, sum_of = parquet_points(points), {}
    for batch in range(5):
        names = "AB" if batch % 2 else "A"
        write(spark.createDataFrame([(n, 10) for n in names], POINTS), batch)
        for n in names:
            sum_of[n] = sum_of.get(n, 0) + 10
        if batch in (0, 2, 3):
            # The newest may run again, so it is not folded.
            assert fold_live_total(spark, points, snapshots) == batch - 1
            assert fold_live_total(spark, points, snapshots) == batch - 1
        assert dict(rows(live_total(spark, points, snapshots))) == sum_of
    write(spark.createDataFrame([("C", 10)], POINTS), 4)
    assert dict(rows(live_total(spark, points, snapshots))) == {"A": 40, "B": 20, "C": 10}


def test_a_fold_without_its_mark_does_not_count(spark, tmp_path):
    points, snapshots = str(tmp_path / "points"), str(tmp_path / "snapshots")
    write = parquet_points(points)
    for batch in range(3):
        write(spark.createDataFrame([("A", 10)], POINTS), batch)
    broken = spark.createDataFrame([("A", 999)], POINTS)
    broken.write.parquet(f"{snapshots}/totals/through=1")  # as a fold leaves it that stops before its mark
    assert rows(live_total(spark, points, snapshots)) == [("A", 30)]
    assert fold_live_total(spark, points, snapshots) == 1
    assert rows(live_total(spark, points, snapshots)) == [("A", 30)]


def test_a_folded_total_reads_later_batches_only(spark, tmp_path):
    points, snapshots = str(tmp_path / "points"), str(tmp_path / "snapshots")
    for batch in range(4):
        parquet_points(points)(spark.createDataFrame([("A", 10)], POINTS), batch)
    fold_live_total(spark, points, snapshots)
    plan = live_total(spark, points, snapshots)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*batch#\d+ > 2\)", plan)


# --- the archive ------------------------------------------------------------------------------------------


def test_compacted_archive_has_each_comment_once(spark, tmp_path):
    archive, compacted = str(tmp_path / "raw"), str(tmp_path / "compacted")
    for part in range(4):
        arrive(tmp_path / "in", f"{part}.json", message(part, f"two\nlines {part}"), message(f"{part}x", None), "no json")
        stream = message_stream(spark, "text", {}, str(tmp_path / "in"))
        archive_comments(stream, archive, str(tmp_path / "mark"), trigger=ONCE).awaitTermination(120)
        want = tuples(read_archive(spark, archive))
        assert tuples(read_compacted(spark, archive, compacted)) == want
        if part:
            versions = compact_archive(spark, archive, compacted)
            assert tuples(read_compacted(spark, archive, compacted)) == want
            assert compact_archive(spark, archive, compacted) == versions  # nothing new is closed
    assert versions >= 1 and len(want) == 12
    for version in (tmp_path / "compacted").glob("version-*"):
        for day in version.glob("ingest_date=*"):
            assert len(list(day.glob("*.parquet"))) == 1
    # A version that stopped before its manifest row is replaced.
    spark.range(1).write.parquet(f"{compacted}/version-{versions}")
    assert tuples(read_compacted(spark, archive, compacted)) == want


# --- the mark of the collector ----------------------------------------------------------------------------


def test_comments_of_one_second_are_taken_once_each(spark, tmp_path):
    ddl, kept = "comment_id STRING, created_utc DOUBLE", str(tmp_path / "kept")
    draw = random.Random(1)
    every = [(f"c{i}", float(i // 4)) for i in range(40)] + [("late", None)]
    seen, taken = [], []
    for stop in (0, 1, 2, 2, 7, 8, 21, 23, 24, 40):
        seen = every[:stop]
        draw.shuffle(seen)
        new = not_taken(spark.createDataFrame(seen + every[40:], ddl), kept)
        got = rows(new)
        save_taken(spark.createDataFrame(got, ddl), kept)
        save_taken(spark.createDataFrame(got, ddl), kept)  # a mark that is saved again
        taken += got
    assert sorted(taken) == sorted(every[:40])


# --- a stream itself --------------------------------------------------------------------------------------


def test_a_stream_is_matched_without_state(spark, tmp_path):
    path = str(tmp_path / "catalogue")
    ddl = "item_label_upper STRING, brand_upper STRING"
    spark.createDataFrame([("RING", "A"), ("RING PRO", "B")], ddl).write.parquet(path)
    matcher = prepare_matcher(spark.read.parquet(path), strategy="in_row")
    spark.createDataFrame([("RING", "WRONG")], ddl).write.mode("overwrite").parquet(path)
    found = []
    for part, text in enumerate(["a ring", "Ring Pro!", "string", None, "nothing"]):
        arrive(tmp_path / "in", f"{part}.json", message(part, text))
        stream = parse_comments(message_stream(spark, "text", {}, str(tmp_path / "in")))
        query = (
            match_stream(stream, matcher).writeStream.format("parquet").option("path", str(tmp_path / "found"))
            .option("checkpointLocation", str(tmp_path / "mark")).trigger(**ONCE).start()
        )
        query.awaitTermination(120)
        assert not query.lastProgress or not query.lastProgress["stateOperators"]
    found = rows(spark.read.parquet(str(tmp_path / "found")), "comment_id", "matched_item_label", "matched_brand")
    assert sorted(found) == [("c0", "RING", "A"), ("c1", "RING PRO", "B"), ("c2", "RING", "A")]
    with pytest.raises(ValueError, match="micro-batch"):
        match_stream(stream, prepare_matcher(spark.createDataFrame([("RING", "A")], ddl), strategy="by_position"))


# --- rejects ----------------------------------------------------------------------------------------------

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


def test_rejected_lines_are_kept_with_a_reason(spark, tmp_path):
    good = ["2020-04-01 00:05:00 UTC,view,1,10,a.b,x,1.5,1,s", "no time,view,1,10,,\"a, b\",,,", ",,,,,,,,"]
    short, long = "2020-04-01 00:05:00 UTC,view,1,10,a.b,x,1.5,1", good[0] + ",more"
    worded, both = good[0].replace("1.5", "cheap"), short.replace("1.5", "cheap")
    (tmp_path / "in.csv").write_text("\n".join([HEADER, *good, short, worded, both, long, worded]) + "\n")
    kept, rejects = route_event_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "routed"))
    assert sorted(rows(rejects)) == sorted(
        [(short, "number of fields"), (long, "number of fields"), (both, "number of fields")]
        + [(worded, "unreadable value")] * 2
    )
    whole = spark.read.csv(str(tmp_path / "in.csv"), header=True)
    assert kept.columns == read_event_csv(spark, str(tmp_path / "in.csv")).columns and len(whole.columns) == 9
    assert kept.count() == kept.select("brand").count() == len(kept.collect()) == 3
    assert sorted(rows(kept, "brand"), key=repr) == [("a, b",), ("x",), (None,)]
    (tmp_path / "empty.csv").write_text(HEADER + "\n")
    kept, rejects = route_event_csv(spark, str(tmp_path / "empty.csv"), str(tmp_path / "none"))
    assert kept.count() == rejects.count() == 0


# --- whole words by hash ----------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_word_runs_give_the_same_winners(spark, broadcast_bytes):
    draw = random.Random(4)
    words = ["ring", "pro", "max", "x", "a1", "dé"]
    labels = [(" ".join(draw.choices(words, k=draw.randint(1, 4))), f"b{i % 7}") for i in range(60)]
    labels += [(" ".join(["long"] * 40), "long"), (" ".join(["long"] * 32 + ["end"]), "end"), ("--", "no")]
    texts = [" ".join(draw.choices([*words, "other", "RING,", "-"], k=draw.randint(0, 9))) for _ in range(200)]
    texts += ["a ring"] * 50 + ["long " * 39, "long " * 41, "long " * 33 + "end", None, "", "string", "--"]
    comments = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    clean = normalise_catalogue(spark.createDataFrame(labels, "item_label STRING, brand STRING"))
    got, want = (
        tuples(match_labels(comments, prepare_matcher(clean, strategy=s, whole_words=True, broadcast_bytes=broadcast_bytes)))
        for s in ("by_words", "in_row")
    )
    assert got == want and len(want) > 100
    with pytest.raises(ValueError, match="whole words"):
        prepare_matcher(clean, strategy="by_words")
