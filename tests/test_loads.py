"""Replays: reload, slices, watermarks, manifest, file stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import parsing
from tallyhouse.streaming import file_stream, incremental, loads, manifest, reload

COLS = "store string, day date, v int"


def d(n):
    return dt.date(2026, 1, n)


def table(spark, tmp_path, df, *partitions):
    return reload.Table(spark, str(tmp_path / "target table"), df.schema, partitions)


def rows(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_range_reload_replaces_and_empties_days(spark, tmp_path):
    first = spark.createDataFrame([("a", d(i), 1) for i in range(1, 8)], COLS)
    t = table(spark, tmp_path, first, "day")
    assert reload.reload_range(first, t, "day") == 7
    second = spark.createDataFrame([("a", d(3), 2), ("a", d(3), 2), ("a", d(5), 2)], COLS)
    for _ in range(2):  # a repeated load changes nothing
        assert reload.reload_range(second, t, "day") == 3
        assert rows(t) == [("a", d(1), 1), ("a", d(2), 1), ("a", d(3), 2), ("a", d(3), 2), ("a", d(5), 2),
                           ("a", d(6), 1), ("a", d(7), 1)]


@pytest.mark.parametrize("partitions", [("day",), ("store", "day")])
def test_scoped_reload_spares_other_stores(spark, tmp_path, partitions):
    first = spark.createDataFrame([(s, d(i), 1) for s in ("a b", "c") for i in (1, 2, 3)], COLS)
    t = table(spark, tmp_path, first, *partitions)
    reload.load([first.filter("store = 'a b'"), first.filter("store = 'c'")], t, "day", "store")
    mine = spark.createDataFrame([("a b", d(1), 2), ("a b", d(3), 2)], COLS)
    reload.reload_range(mine, t, "day", "store")
    assert rows(t) == [("a b", d(1), 2), ("a b", d(3), 2), ("c", d(1), 1), ("c", d(2), 1), ("c", d(3), 1)]


def test_scope_must_be_one_value(spark, tmp_path):
    both = spark.createDataFrame([("a", d(1), 1), ("b", d(1), 1)], COLS)
    none = spark.createDataFrame([(None, d(1), 1)], COLS)
    t = table(spark, tmp_path, both, "day")
    for bad in (both, none):
        with pytest.raises(ValueError, match="exactly one"):
            reload.reload_range(bad, t, "day", "store")
    assert reload.reload_range(both.limit(0), t, "day", "store") == 0


def test_full_refresh(spark, tmp_path):
    first = spark.createDataFrame([("a", d(1), 1), ("a", d(2), 1)], COLS)
    t = table(spark, tmp_path, first, "day")
    reload.load([first], t, "day")
    again = spark.createDataFrame([("a", d(9), 2)], COLS)
    reload.load([again], t, "day", full_refresh=True)
    assert rows(t) == [("a", d(9), 2)]


def test_slice_replace_keeps_other_slices(spark, tmp_path):
    first = spark.createDataFrame([("a", d(1), 1), ("a", d(2), 1), ("b", d(1), 1)], COLS)
    t = table(spark, tmp_path, first, "store", "day")
    reload.replace_slice(first, t)
    reload.replace_slice(spark.createDataFrame([("a", d(1), 5), ("a", d(1), 6)], COLS), t)
    assert rows(t) == [("a", d(1), 5), ("a", d(1), 6), ("a", d(2), 1), ("b", d(1), 1)]


def test_entries_need_a_unique_key(spark, tmp_path):
    cols = "store string, day date, order_id string, entry_id string"
    good = spark.createDataFrame([("a", d(1), "1", "x"), ("a", d(1), "1", "y")], cols)
    t = table(spark, tmp_path, good, "store", "day")
    reload.replace_entries(good, t)
    with pytest.raises(ValueError, match="duplicate key"):
        reload.replace_entries(good.union(good), t)
    assert t.read().count() == 2


STG = "store_name string, sale_date date, order_ref string, v int, _source_system string, _ingested_at timestamp"


def at(n):
    return dt.datetime(2026, 2, n, 8)


def test_late_row_is_picked_up_by_load_time(spark, tmp_path):
    held = spark.createDataFrame([("a", d(5), "1", 1, "x", at(5)), ("b", d(5), "2", 1, "x", at(5))], STG)
    t = table(spark, tmp_path, held, "store_name", "sale_date")
    t.replace_partitions(held)
    late = spark.createDataFrame([("a", d(1), "3", 1, "x", at(6))], STG)
    incremental.upsert_slices(held.union(late), t)
    incremental.upsert_slices(held.union(late), t)
    assert sorted(r.order_ref for r in t.read().collect()) == ["1", "2", "3"]


def test_marks_are_per_source(spark):
    held = spark.createDataFrame([("a", d(5), "1", 1, "x", at(9))], STG)
    new = spark.createDataFrame(
        [("a", d(1), "2", 1, "y", at(3)), ("a", d(1), "3", 1, "x", at(9)), ("a", d(1), "4", 1, "x", at(10))], STG)
    pick = lambda df: sorted(r.order_ref for r in df.collect())
    assert pick(incremental.newer_than_target(new, held, inclusive=False)) == ["2", "4"]
    assert pick(incremental.newer_than_target(new, held)) == ["2", "3", "4"]
    assert pick(incremental.newer_than_target(new, held, per_source=False, inclusive=False)) == ["4"]
    assert pick(incremental.newer_than_target(new, held.limit(0))) == ["2", "3", "4"]
    assert pick(incremental.newer_than_target(new, held.limit(0), per_source=False)) == ["2", "3", "4"]


def test_lookback(spark):
    held = spark.createDataFrame([(d(20),)], "sale_date date")
    new = spark.createDataFrame([(d(i),) for i in (9, 10, 11, 25)], "sale_date date")
    got = incremental.since_lookback(new, held, 10)
    assert sorted(r[0] for r in got.collect()) == [d(11), d(25)]
    assert incremental.since_lookback(new, held.limit(0), 10).count() == 4


def test_delete_insert_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([("1", 1), ("1", 2), ("2", 1)], "k string, v int")
    batch = spark.createDataFrame([("1", 9), ("1", 9), ("3", 9)], "k string, v int")
    got = incremental.delete_insert(target, batch, ["k"])
    assert sorted(map(tuple, got.collect())) == [("1", 9), ("1", 9), ("2", 1), ("3", 9)]


def test_refreshed_months_lose_what_silver_lost(spark, tmp_path):
    cols = "sale_month date, order_ref string, v int"
    jan, feb, mar = dt.date(2026, 1, 1), dt.date(2026, 2, 1), dt.date(2026, 3, 1)
    silver = spark.createDataFrame([(jan, "1", 1), (jan, "1", 1), (feb, "2", 1), (mar, "3", 1)], cols)
    build = lambda s: s.groupBy("sale_month", "order_ref").agg(F.sum("v").cast("int").alias("v"))
    t = table(spark, tmp_path, silver, "sale_month")
    incremental.refresh_months(silver, silver, build, t)
    assert rows(t) == [(jan, "1", 2), (feb, "2", 1), (mar, "3", 1)]
    later = spark.createDataFrame([(jan, "9", 5), (mar, "3", 7)], cols)  # order 1 and February vanished
    touched = spark.createDataFrame([(jan,), (feb,)], "sale_month date")
    incremental.refresh_months(later, touched, build, t)
    assert rows(t) == [(jan, "9", 5), (mar, "3", 1)]


def test_late_arrivals(spark):
    held = spark.createDataFrame([("a", dt.date(2026, 2, 1), "1", 1, "x", at(n)) for n in (1, 3, 4, 9)], STG)
    got = incremental.late_arrivals(held).head()
    assert (got.row_count, got.late_rows, float(got.late_share)) == (4, 2, 0.5)


def test_csv_supersedes_xml_in_silver(spark, tmp_path):
    api = spark.createDataFrame([("a", d(1), "1", 1, "feed_c", at(1))], STG)
    t = table(spark, tmp_path, api, "store_name", "sale_date")
    t.replace_partitions(api)
    csv_rows = spark.createDataFrame([("a", d(1), "7", 1, "feed_a", at(2))], STG)
    incremental.upsert_slices(csv_rows, t)
    assert [r._source_system for r in t.read().collect()] == ["feed_a"]


def test_manifest(spark, tmp_path):
    for n in ("DDBB_Jan_26.csv", "DDBB_Feb_26.csv", "x.csv"):
        (tmp_path / n).write_text("h\n1\n")
    files = manifest.list_files(spark, f"{tmp_path}/*DDBB_*.csv", parsing.FEED_A_FILE, "feed_a")
    assert files.count() == 2
    known = manifest.empty_manifest(spark)
    assert manifest.new_files(files, known).count() == 2
    batch = spark.createDataFrame([("feed_a", "DDBB_Jan_26.csv")] * 3, "_source_system string, _source_file string")
    known = manifest.mark_processed(known, manifest.loaded_counts(batch, at(1)))
    assert [r.filename for r in manifest.new_files(files, known).collect()] == ["DDBB_Feb_26.csv"]
    known = manifest.mark_processed(known, manifest.loaded_counts(batch.limit(2), at(2)))
    assert [(r.row_count, r.loaded_at) for r in known.collect()] == [(2, at(2))]
    assert manifest.clear_source(known, "feed_a").count() == 0


def test_file_stream_takes_only_new_files(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "chk")
    first = spark.createDataFrame([("a", d(1), 1), ("b", d(1), 1)], "store_name string, sale_date date, v int")
    t = table(spark, tmp_path, first, "store_name", "sale_date")
    first.write.parquet(source)
    for expected in (2, 2):
        file_stream.ingest_available(file_stream.stream_files(spark, source, first.schema), t, checkpoint)
        assert t.read().count() == expected
    spark.createDataFrame([("a", d(1), 5), ("c", d(2), 1)], first.schema).write.mode("append").parquet(source)
    file_stream.ingest_available(file_stream.stream_files(spark, source, first.schema), t, checkpoint)
    assert rows(t) == [("a", d(1), 1), ("a", d(1), 5), ("b", d(1), 1), ("c", d(2), 1)]


def test_file_stream_does_not_depend_on_triggers(spark, tmp_path):
    source = str(tmp_path / "in")
    first = spark.createDataFrame([("a", d(1), 1), ("b", d(1), 1)], "store_name string, sale_date date, v int")
    for more in (first, spark.createDataFrame([("a", d(1), 5), ("c", d(2), 1)], first.schema)):
        more.coalesce(1).write.mode("append").parquet(source)
    found = []
    for per_trigger in (None, 1):
        t = reload.Table(spark, str(tmp_path / f"t{per_trigger}"), first.schema, ("store_name", "sale_date"))
        stream = file_stream.stream_files(spark, source, first.schema, per_trigger)
        file_stream.ingest_available(stream, t, str(tmp_path / f"chk{per_trigger}"))
        found.append(rows(t))
    assert found[0] == found[1] == [("a", d(1), 1), ("a", d(1), 5), ("b", d(1), 1), ("c", d(2), 1)]


def test_upsert_drops_emptied_slices(spark, tmp_path):
    held = spark.createDataFrame([("a", d(1), "1", 1, "x", at(1)), ("b", d(1), "2", 1, "x", at(1))], STG)
    t = table(spark, tmp_path, held, "store_name", "sale_date")
    t.replace_partitions(held)
    incremental.upsert_slices(held.filter("store_name = 'a'"), t)
    assert [r.store_name for r in t.read().collect()] == ["a"]


def test_failed_refresh_keeps_the_table(spark, tmp_path):
    first = spark.createDataFrame([("a", d(1), 1), ("b", d(2), 1)], COLS)
    t = table(spark, tmp_path, first, "day")
    reload.load([first], t, "day")
    with pytest.raises(ValueError, match="exactly one"):
        reload.load([first.filter("store = 'a'"), first], t, "day", "store", full_refresh=True)
    assert rows(t) == [("a", d(1), 1), ("b", d(2), 1)]


def test_new_files_load_once(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()

    def put(name, *lines):
        (folder / name).write_text("\n".join(["store,day,v", *lines]) + "\n")

    put("DDBB_Jan_26.csv", "a,2026-01-01,1", "a,2026-01-02,1")
    put("DDBB_Feb_26.csv", "a,2026-02-01,1")
    put("DDBB_Zero.csv")
    target = reload.Table(spark, str(tmp_path / "t"), spark.createDataFrame([], COLS).schema, ("day",))
    known = loads.manifest_table(spark, str(tmp_path / "manifest"))

    def run(full_refresh=False):
        files = manifest.list_files(spark, f"{folder}/*DDBB_*.csv", parsing.FEED_A_FILE, "feed_a")
        read = lambda n: spark.read.schema(COLS).option("header", True).csv(f"{folder}/{n}")
        return loads.load_new_files("feed_a", files, read, target, known, "day", loaded_at=at(1),
                                    full_refresh=full_refresh)

    assert run() == 3 and run() == 0
    assert {r.filename: r.row_count for r in known.read().collect()} == {"DDBB_Jan_26.csv": 2, "DDBB_Feb_26.csv": 1}
    put("DDBB_Mar_26.csv", "a,2026-01-02,7", "a,2026-03-01,7")
    assert run() == 2
    assert rows(target) == [("a", dt.date(2026, 1, 1), 1), ("a", dt.date(2026, 1, 2), 7), ("a", dt.date(2026, 3, 1), 7)]
    assert run(full_refresh=True) == 5 and known.read().count() == 3
