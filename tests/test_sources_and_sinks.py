from __future__ import annotations

import pytest
from samples import GOLDEN, rows

from cartlens.operators import brands
from cartlens.plans.published import (
    TABLES,
    keep_monthly_index,
    publish,
    publish_first_look,
    publish_total,
    run_period,
    total_index,
)
from cartlens.schema import BRAND_EVENT_COUNT_DDL, EVENT_COLUMNS
from cartlens.session import shared_folder
from cartlens.sinks.counts import keep_brand_event_counts, running_brand_event_counts
from cartlens.sinks.files import convert_format, stage_events, write_files
from cartlens.sinks.jdbc import JdbcTarget, write_jdbc
from cartlens.sources import tables
from cartlens.sources.files import (
    read_catalogue_csv,
    read_event_csv,
    read_or_empty,
    read_period,
    read_recursive,
    read_staged_events,
    read_text_event_csv,
)


def same(left, right):
    return sorted(rows(left), key=repr) == sorted(rows(right), key=repr)


def test_unreadable_and_empty_fields_are_null(spark, tmp_path):
    lines = [
        ",".join(EVENT_COLUMNS),
        'bad,view,x,1,,"",abc,7,s',
        "2020-04-01 10:00:00 UTC,view,5",
        "too,many,1,1,a,b,1.5,2,s,extra",
    ]
    (tmp_path / "e.csv").write_text("\n".join(lines) + "\n")
    first, short, long = rows(read_event_csv(spark, str(tmp_path / "e.csv")))
    assert first == (None, "view", None, 1, None, None, None, 7, "s")
    assert short[1:3] == ("view", 5) and short[3:] == (None,) * 6 and short[0] is not None
    assert long[1:9] == ("many", 1, 1, "a", "b", 1.5, 2, "s")


def test_time_may_be_left_as_text(spark, raw_folder):
    text = read_event_csv(spark, f"{raw_folder}/2020-Apr.csv", parse_time=False)
    assert dict(text.dtypes)["event_time"] == "string"
    assert read_period(spark, raw_folder + "/", "2020-Apr").count() == 15


def test_short_lines_are_dropped_whatever_is_read(spark, tmp_path):
    (tmp_path / "e.csv").write_text(GOLDEN + "2020-04-03 05:00:00 UTC,cart,1\n")
    events = read_text_event_csv(spark, str(tmp_path / "e.csv"))
    assert events.count() == 15
    assert events.where("event_type = 'cart'").select("event_type").count() == 4
    assert set(dict(events.dtypes).values()) == {"string"}


def test_catalogue_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,item_label,brand,more\n1,Ring,a,x\n2,,b,\n")
    assert rows(read_catalogue_csv(spark, str(tmp_path / "c.csv"))) == [("Ring", "a"), (None, "b")]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
def test_files_keep_blanks_and_nulls(spark, golden, tmp_path, fmt):
    frame = golden.select("event_type", "brand", "price")
    write_files(frame, str(tmp_path / "out"), fmt=fmt)
    reader = spark.read.schema(frame.schema).format(fmt)
    assert same(reader.options(header=True).load(str(tmp_path / "out")), frame)


def test_write_modes(spark, golden, tmp_path):
    counts = brands.brand_event_count(golden)

    def after(mode):
        path = str(tmp_path / mode)
        for period in ("2020-Apr", "2020-May", "2020-May"):
            labelled = counts.selectExpr("*", f"'{period}' AS batch_processing")
            write_files(labelled, path, mode=mode)
        kept = spark.read.parquet(path).groupBy("batch_processing").count()
        return dict(rows(kept))

    assert after("append") == {"2020-Apr": 8, "2020-May": 16}
    assert after("overwrite") == {"2020-May": 8}
    assert after("replace_period") == {"2020-Apr": 8, "2020-May": 8}
    with pytest.raises(ValueError):
        write_files(counts, str(tmp_path / "x"), mode="upsert")


def test_staged_events_are_pruned_by_period_and_type(spark, golden, tmp_path):
    path = str(tmp_path / "staged")
    for period in ("2020-Apr", "2020-May", "2020-Apr"):
        stage_events(golden, path, period)
    april = read_staged_events(spark, path, "2020-Apr")
    assert same(april.select(*EVENT_COLUMNS), golden)
    assert read_staged_events(spark, path).count() == 30
    plan = april.where("event_type = 'purchase'").select("price")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "event_type" in scan.split("PushedFilters")[0] and "period" in scan.split("PushedFilters")[0]
    assert "ReadSchema: struct<price:double>" in scan


def test_numeric_looking_periods_stay_text(spark, golden, tmp_path):
    stage_events(golden, str(tmp_path / "s"), "202004")
    assert read_staged_events(spark, str(tmp_path / "s"), "202004").count() == 15


def test_missing_path_reads_as_empty_but_other_failures_do_not(spark, tmp_path):
    assert rows(read_or_empty(spark, str(tmp_path / "none"), BRAND_EVENT_COUNT_DDL)) == []
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "broken"), BRAND_EVENT_COUNT_DDL).collect()


def test_counts_kept_again_replace_their_period(spark, golden, tmp_path):
    base = str(tmp_path / "counts")
    new = brands.brand_event_count(golden)
    assert rows(running_brand_event_counts(spark, base)) == []
    for period, times in (("2020-Apr", 1), ("2020-May", 2), ("2020-May", 2)):
        keep_brand_event_counts(new, base, period)
        kept = dict((row[:2], row[2]) for row in rows(running_brand_event_counts(spark, base)))
        assert kept[("samsung", "purchase")] == 3 * times and len(kept) == 8
    keep_brand_event_counts(new.limit(0), base, "2020-Apr")
    kept = dict((row[:2], row[2]) for row in rows(running_brand_event_counts(spark, base)))
    assert kept[("samsung", "purchase")] == 3


def test_a_period_is_replaced_as_a_whole(spark, golden, tmp_path):
    path = str(tmp_path / "staged")
    for period in ("2020-Apr", "2020-May"):
        stage_events(golden, path, period)
    stage_events(golden.where("event_type = 'view'"), path, "2020-Apr")
    kept = dict(rows(read_staged_events(spark, path).groupBy("period").count()))
    assert kept == {"2020-Apr": golden.where("event_type = 'view'").count(), "2020-May": 15}
    stage_events(golden.limit(0), path, "2020-Apr")
    assert read_staged_events(spark, path, "2020-Apr").count() == 0
    with pytest.raises(ValueError):
        stage_events(golden, path, "../other")


def test_events_of_other_types_can_be_read_when_staged(spark, raw_folder, tmp_path):
    text_time = read_event_csv(spark, f"{raw_folder}/2020-Apr.csv", parse_time=False)
    stage_events(text_time.withColumn("price", text_time["price"].cast("string")), str(tmp_path / "s"), "2020-Apr")
    assert read_staged_events(spark, str(tmp_path / "s"), "2020-Apr").count() == 15


def test_a_corrected_file_leaves_nothing_of_the_old_one(spark, tmp_path):
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    view = "2020-04-01 00:05:00 UTC,view,1,10,c,samsung,100.00,1,s1\n"
    (tmp_path / "raw").mkdir()
    for lines in (head + view + view.replace("view", "purchase"), head + view):
        (tmp_path / "raw" / "2020-Apr.csv").write_text(lines)
        folders = [str(tmp_path / name) for name in ("raw", "staged", "out")]
        run_period(spark, *folders, "2020-Apr", "replace_period")
    assert spark.read.schema("total_revenue DOUBLE").parquet(str(tmp_path / "out/brand_revenue_rank")).count() == 0
    total = spark.read.csv(str(tmp_path / "out/long_term_brand_popularity_index_total"), header=True)
    assert rows(total) == [("samsung", "1")]


def test_recursive_read_ignores_folder_names(spark, golden, tmp_path):
    write_files(golden.select("price", "event_type"), str(tmp_path / "r/a/b"), partition_by=["event_type"])
    write_files(golden.select("price"), str(tmp_path / "r/c"))
    assert read_recursive(spark, str(tmp_path / "r")).count() == 30


def test_conversion_to_other_formats(spark, golden, tmp_path):
    write_files(golden, str(tmp_path / "p"))
    convert_format(spark, str(tmp_path / "p"), "parquet", str(tmp_path / "o"), "orc")
    assert same(spark.read.orc(str(tmp_path / "o")), golden)


def test_catalog_tables(spark, golden, raw_folder, tmp_path):
    tables.create_database(spark, "shop_db", str(tmp_path / "db"))
    try:
        tables.create_external_csv_table(spark, "shop_db.events", raw_folder)
        external = tables.read_table(spark, "shop_db.events")
        assert external.count() == 15  # the header is no row
        assert dict(external.dtypes)["price"] == "decimal(10,2)"
        assert same(brands.brand_event_count(external), brands.brand_event_count(golden))

        text = golden.selectExpr("string(event_time) AS event_time", *EVENT_COLUMNS[1:])
        tables.create_managed_text_table(spark, "shop_db.text_events")
        tables.insert_events(text, "shop_db.text_events")
        managed = tables.read_table(spark, "shop_db.text_events")
        assert same(managed.select("brand", "user_session"), text.select("brand", "user_session"))

        tables.create_category_partitioned_table(spark, "shop_db.by_category")
        tables.insert_events(text, "shop_db.by_category")
        by_category = spark.table("shop_db.by_category")
        assert same(by_category.select("category_code", "brand"), text.select("category_code", "brand"))
        assert spark.sql("SHOW PARTITIONS shop_db.by_category").count() == 6
    finally:
        spark.sql("DROP DATABASE shop_db CASCADE")


class Recorder:
    """Stands in for a frame and its writer: no database is started for a test."""

    def __init__(self):
        self.calls, self.settings = [], {}

    write = property(lambda self: self)

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def options(self, **given):
        self.settings.update(given)
        return self

    def option(self, name, value):
        self.settings[name] = value
        return self

    def mode(self, name):
        self.calls.append(("mode", name))
        return self

    def save(self):
        self.calls.append(("save",))


def test_jdbc_options_and_modes(monkeypatch):
    monkeypatch.setenv("JDBC_USER", "someone")
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    target = JdbcTarget.from_environment("jdbc:x://h/db", "x.Driver", table_options="ORDER BY brand")
    assert "secret" not in repr(target)
    frame = Recorder()
    write_jdbc(frame, "t", target, mode="overwrite", truncate=True)
    assert frame.calls == [("format", "jdbc"), ("mode", "overwrite"), ("save",)]
    assert frame.settings == {
        "url": "jdbc:x://h/db",
        "dbtable": "t",
        "driver": "x.Driver",
        "user": "someone",
        "password": "secret",
        "createTableOptions": "ORDER BY brand",
        "numPartitions": "16",
        "truncate": "true",
    }
    assert "user" not in JdbcTarget("u", "d").options("t")
    with pytest.raises(ValueError):
        write_jdbc(frame, "t", target, mode="replace_period")


def test_publish_to_a_database_keeps_each_table_mode(spark, golden, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(
        "cartlens.plans.published.write_jdbc",
        lambda frame, table, target, mode: written.append((table, mode, "batch_processing" in frame.columns)),
    )
    publish(golden, "2020-Apr", database=JdbcTarget("u", "d"))
    assert written == [(name, table.mode, True) for name, table in TABLES.items()]
    keep_monthly_index(golden, "2020-Apr", str(tmp_path / "monthly"))
    publish_total(spark, str(tmp_path / "monthly"), database=JdbcTarget("u", "d"))
    assert written[-1] == ("long_term_brand_popularity_index_total", "overwrite", False)


def test_whole_period(spark, raw_folder, tmp_path):
    for _ in range(2):  # a rerun changes nothing
        run_period(spark, raw_folder, str(tmp_path / "staged"), str(tmp_path / "out"), "2020-Apr", "replace_period")
    assert {p.name for p in (tmp_path / "out").iterdir()} > set(TABLES)
    revenue = spark.read.parquet(str(tmp_path / "out/brand_revenue_rank"))
    assert sorted(rows(revenue)) == [
        ("APPLE", 30.0, "2020-Apr"), ("SAMSUNG", 170.0, "2020-Apr"), ("WITHOUT BRAND", 60.0, "2020-Apr"),
    ]
    total = spark.read.csv(str(tmp_path / "out/long_term_brand_popularity_index_total"), header=True)
    assert ("samsung", "36") in rows(total) and total.count() == 5


def test_total_spans_the_kept_periods(spark, golden, tmp_path):
    folder = str(tmp_path / "monthly")
    for period in ("2020-Apr", "2020-May", "2020-May"):
        keep_monthly_index(golden, period, folder)
    assert rows(total_index(spark, folder))[0] == ("samsung", 72)


def test_shared_folder_comes_from_the_session(spark):
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


class SessionWithoutFolder:
    class conf:
        get = staticmethod(lambda key, default=None: {"spark.sql.warehouse.dir": "hdfs://w/"}.get(key, default))


def test_the_warehouse_is_shared_too():
    assert shared_folder(SessionWithoutFolder()).startswith("hdfs://w/cartlens-")


def test_a_period_goes_to_a_database_too(spark, raw_folder, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(
        "cartlens.plans.published.write_jdbc", lambda frame, table, target, mode: written.append((table, mode))
    )
    folders = [str(tmp_path / "staged"), str(tmp_path / "out")]
    run_period(spark, raw_folder, *folders, "2020-Apr", "replace_period", JdbcTarget("u", "d"))
    expected = {name: table.mode for name, table in TABLES.items()}
    assert dict(written) == expected | {"long_term_brand_popularity_index_total": "overwrite"}


def test_first_look(spark, golden, tmp_path):
    publish_first_look(golden, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "views_by_brand")).count() > 0
    assert spark.read.parquet(str(tmp_path / "cart_conversion_rate")).count() == 1
