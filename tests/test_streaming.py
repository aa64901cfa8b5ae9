"""Comment streams over files of JSON lines, each run until its input is used up."""

from __future__ import annotations

import json
import re

import pytest
from samples import rows
from pyspark.sql import functions as F

from cartlens.operators.brands import combined_popularity
from cartlens.operators.labels import match_labels, normalise_catalogue, prepare_matcher
from cartlens.operators.listings import flatten_listing, parse_comments, since, with_ingest_columns
from cartlens.sinks.marks import load_mark, save_mark
from cartlens.sources.comments import kafka_options, message_stream, read_archive
from cartlens.sources.files import read_recursive
from cartlens.streaming import archive_comments, jdbc_points, parquet_points, stream_brand_points

ONCE = {"availableNow": True}


def message(number, text, **other):
    fields = {"post_id": "p", "comment_id": f"c{number}", "author": "u", "text": text, "created_utc": 100}
    return json.dumps(fields | other)


@pytest.fixture
def inbox(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def arrive(inbox, name, *messages):
    (inbox / "in" / name).write_text("\n".join(messages) + "\n")


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


@pytest.fixture
def matcher(spark):
    pairs = [("ring", "a"), ("ring pro", "b")]
    return prepare_matcher(normalise_catalogue(spark.createDataFrame(pairs, "item_label STRING, brand STRING")))


def test_archive_files_messages_by_arrival_and_goes_on_after_a_restart(spark, inbox):
    def archive():
        stream = message_stream(spark, "text", {}, str(inbox / "in"))
        run(archive_comments(stream, str(inbox / "raw"), str(inbox / "mark"), trigger=ONCE))
        return spark.read.csv(str(inbox / "raw"), header=True)

    arrive(inbox, "1.json", message(1, "  padded "), message(2, 'quoted, "text"'), "no json")
    first = archive()
    readable = first.where("comment_id IS NOT NULL")
    assert sorted(rows(readable, "comment_id", "text")) == [("c1", "  padded "), ("c2", 'quoted, "text"')]
    assert first.count() == 3
    folders = {p.relative_to(inbox / "raw").parent.as_posix() for p in (inbox / "raw").rglob("*.csv")}
    assert all(re.fullmatch(r"ingest_date=\d{4}-\d\d-\d\d/ingest_time=\d\d-\d\d-\d\d", f) for f in folders)

    assert archive().count() == 3
    arrive(inbox, "2.json", message(3, "later"))
    assert archive().count() == 4


def test_archive_may_file_by_date_only(spark, inbox):
    arrive(inbox, "1.json", message(1, "x"))
    stream = message_stream(spark, "text", {}, str(inbox / "in"))
    run(archive_comments(stream, str(inbox / "raw"), str(inbox / "mark"), partition_by=["ingest_date"], trigger=ONCE))
    assert "ingest_time" in spark.read.csv(str(inbox / "raw"), header=True).columns


@pytest.mark.parametrize("strategy", ["in_row", "by_position"])
def test_points_are_awarded_once(spark, inbox, strategy):
    pairs = [("ring", "a"), ("ring pro", "b")]
    clean = normalise_catalogue(spark.createDataFrame(pairs, "item_label STRING, brand STRING"))
    chosen = prepare_matcher(clean, strategy=strategy)

    def award():
        stream = message_stream(spark, "text", {}, str(inbox / "in"))
        points = str(inbox / "points")
        run(stream_brand_points(stream, chosen, parquet_points(points), str(inbox / "mark"), trigger=ONCE))
        return sorted(rows(spark.read.parquet(points), "brand", "total_long_term_brand_popularity_index"))

    arrive(inbox, "1.json", message(1, "a ring"), message(2, "Ring Pro!"), message(3, "nothing"), message(4, None), "{")
    assert award() == [("A", 10), ("B", 10)]
    assert award() == [("A", 10), ("B", 10)]
    arrive(inbox, "2.json", message(5, "string"))
    assert award() == [("A", 10), ("A", 10), ("B", 10)]


@pytest.mark.parametrize("strategy", ["in_row", "by_position"])
def test_a_stream_itself_is_not_matched(spark, inbox, strategy):
    clean = normalise_catalogue(spark.createDataFrame([("ring", "a")], "item_label STRING, brand STRING"))
    arriving = parse_comments(message_stream(spark, "text", {}, str(inbox / "in")))
    with pytest.raises(ValueError, match="micro-batches"):
        match_labels(arriving, prepare_matcher(clean, strategy=strategy))


@pytest.mark.parametrize("strategy", ["in_row", "by_position"])
def test_the_catalogue_is_pinned(spark, tmp_path, strategy):
    path = str(tmp_path / "catalogue")
    spark.createDataFrame([("ring", "a")], "item_label STRING, brand STRING").write.parquet(path)
    matcher = prepare_matcher(normalise_catalogue(spark.read.parquet(path)), strategy=strategy)
    spark.createDataFrame([("cord", "b")], "item_label STRING, brand STRING").write.mode("overwrite").parquet(path)
    texts = spark.createDataFrame([("a ring",), ("a cord",)], "text STRING")
    assert rows(match_labels(texts, matcher), "text", "matched_brand") == [("a ring", "A")]


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    write = parquet_points(str(tmp_path / "points"))
    points = spark.createDataFrame([("A", 10)], "brand STRING, total_long_term_brand_popularity_index BIGINT")
    for batch in (0, 1, 1):
        write(points, batch)
    assert spark.read.parquet(str(tmp_path / "points")).count() == 2


def test_batches_without_a_match_are_not_written(spark, inbox, matcher):
    written = []
    arrive(inbox, "1.json", message(1, "nothing"))
    stream = message_stream(spark, "text", {}, str(inbox / "in"))
    note = lambda points, batch: written.append(batch)
    run(stream_brand_points(stream, matcher, note, str(inbox / "mark"), trigger=ONCE))
    assert written == []


def test_points_go_to_a_table_by_append(monkeypatch):
    calls = []
    monkeypatch.setattr("cartlens.streaming.points.write_jdbc", lambda *args, **options: calls.append((args, options)))
    jdbc_points("live", "target")("points", 7)
    assert calls == [(("points", "live", "target"), {"mode": "append"})]


def test_kafka_options():
    assert kafka_options("h:1", "t", starting="earliest", max_offsets=5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5",
    }
    assert kafka_options("h:1", "t")["startingOffsets"] == "latest"


def test_messages(spark):
    texts = [message(1, "x"), "no json", message(2, "y", created_utc=1700000000.0), message(3, "z", created_utc="soon")]
    frame = spark.createDataFrame([(t,) for t in texts], "value STRING")
    good = ("p", "c1", "u", "x", 100)
    assert rows(parse_comments(frame)) == [
        good, (None,) * 5, ("p", "c2", "u", "y", 1700000000), ("p", "c3", "u", "z", None),
    ]
    assert rows(parse_comments(frame, lenient_time=False))[2] == ("p", "c2", "u", "y", None)
    assert rows(parse_comments(frame.selectExpr("CAST(value AS BINARY) AS value")))[0] == good


def test_arrival_defaults_to_now(spark):
    row = with_ingest_columns(spark.createDataFrame([("c",)], "comment_id STRING")).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", row["ingest_date"]) and re.fullmatch(r"\d\d-\d\d-\d\d", row["ingest_time"])


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kathmandu"])
def test_arrival_is_filed_in_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.timestamp_seconds(F.lit(1585779185.25))
        frame = with_ingest_columns(spark.createDataFrame([("c",)], "comment_id STRING"), at=at)
        assert rows(frame, "ingest_date", "ingest_time") == [("2020-04-01", "22-13-05")]
        wall = with_ingest_columns(frame.select("comment_id"), at=F.expr("TIMESTAMP_NTZ '2020-03-08 02:30:00'"))
        assert rows(wall, "ingest_date", "ingest_time") == [("2020-03-08", "02-30-00")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_listing_pages_and_mark(spark):
    def child(kind, name, at):
        return {"kind": kind, "data": {"id": name, "author": None, "body": name + "!", "created_utc": at}}

    page = json.dumps([
        {"data": {"children": [child("t3", "post", 1.0)]}},
        {"data": {"children": [child("t1", "a", 100.0), child("more", "b", 300.0), child("t1", "c", 200.5)]}},
    ])
    pages = spark.createDataFrame([("p", page), ("q", "[]"), ("r", "no json")], "post_id STRING, page STRING")
    comments = flatten_listing(pages)
    assert rows(comments) == [("p", "a", None, "a!", 100.0), ("p", "c", None, "c!", 200.5)]
    assert rows(since(comments, 150), "comment_id") == [("c",)]
    assert rows(since(comments, 200.5)) == []
    assert since(comments, None).count() == 2


def test_mark_is_kept_between_runs(spark, tmp_path):
    base = str(tmp_path / "mark")
    assert load_mark(spark, base) == 0.0
    for start in (1700000000.25, 1700000300.5):
        save_mark(spark, base, start)
        assert load_mark(spark, base) == start


def test_batch_and_live_points_together(spark):
    ddl = "brand STRING, total_long_term_brand_popularity_index BIGINT"
    batch = spark.createDataFrame([("acme", 7), ("BOLT", 1)], ddl)
    live = spark.createDataFrame([("ACME", 10), ("BOLT", 10)], ddl)
    assert rows(combined_popularity(batch, live)) == [("BOLT", 11), ("ACME", 10), ("acme", 7)]
    assert rows(combined_popularity(batch, live, fold_case=True)) == [("ACME", 17), ("BOLT", 11)]


def test_archived_texts_read_back_whole(spark, inbox):
    texts = ["two\nlines", 'a "quote", a comma', "ends in \\", 'all \\" of\n,"it"', "  pad ", "é漢"]
    arrive(inbox, "1.json", *(message(i, text) for i, text in enumerate(texts)))
    stream = message_stream(spark, "text", {}, str(inbox / "in"))
    run(archive_comments(stream, str(inbox / "raw"), str(inbox / "mark"), trigger=ONCE))
    archive = read_archive(spark, str(inbox / "raw"))
    assert sorted(rows(archive, "text")) == sorted((text,) for text in texts)
    assert rows(archive.select("created_utc").distinct()) == [(100,)]
    assert archive.where("ingest_ts IS NULL OR ingest_date IS NULL").count() == 0


def test_recursive_read_of_the_archive(spark, inbox):
    arrive(inbox, "1.json", message(1, "x"))
    stream = message_stream(spark, "text", {}, str(inbox / "in"))
    run(archive_comments(stream, str(inbox / "raw"), str(inbox / "mark"), trigger=ONCE))
    assert read_recursive(spark, str(inbox / "raw"), "csv").count() >= 1
