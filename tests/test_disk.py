"""What a job leaves on the disk: its tables, not the rows on their way to them."""

import datetime as dt
import os
import time

from pyspark.sql import Observation

from tallyhouse.session import fresh_dir, passing_work, tune, work_root
from tallyhouse.sources import feeds
from tallyhouse.sources import schemas as S
from tallyhouse.streaming import file_stream
from tallyhouse.streaming.reload import Table
from test_feeds import row_a, write

DAY = dt.date(2026, 7, 1)


def work_files(spark):
    """Data files of this application below the work folder."""
    root = f"{work_root(spark)}/tallyhouse/{spark.sparkContext.applicationId}"
    return {f"{at}/{f}" for at, _, files in os.walk(root) for f in files if f.endswith(".parquet")}


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = {f"{at}/{f}" for d in manager.localDirsString() for at, _, files in os.walk(d) for f in files}
    return {f for f in found if "/shuffle_" in f}


def test_a_feed_stream_keeps_no_typed_rows_beside_bronze(spark, tmp_path):
    stage = lambda text, balance: feeds.staged_a(text, balance, dt.datetime(2026, 7, 1))
    inbox = tmp_path / "in"
    inbox.mkdir()
    write(inbox / "DDBB_Apr_25.csv", S.FEED_A_COLUMNS, [row_a(**{"Closed Date/Time": "4/14/2025 5:09 PM"})] * 3 + [["short"]])
    text = lambda: feeds.stream_feed_a_text(spark, str(inbox))
    schema = stage(spark.createDataFrame([], text().schema), Observation()).drop("_reason", "_line").schema
    target = Table(spark, str(tmp_path / "t"), schema, ("Date",))
    rejects = file_stream.rejects_table(spark, str(tmp_path / "bad"))
    held = work_files(spark)
    for late in (0, 1):
        if late:
            write(inbox / "DDBB_Late_25.csv", S.FEED_A_COLUMNS, [row_a(**{"Closed Date/Time": "4/14/2025 6:09 PM"})] * 2)
        file_stream.ingest_feed(text(), stage, target, rejects, str(tmp_path / "chk"))
        assert work_files(spark) == held
    assert target.read().count() == 5 and rejects.read().count() == 1


def test_a_file_stream_keeps_no_settled_rows(spark, tmp_path):
    rows = spark.createDataFrame([("x", DAY, 1), ("y", DAY, 2), (None, None, 3)], "store_name string, sale_date date, n int")
    rows.write.parquet(f"{tmp_path}/in")
    target = Table(spark, f"{tmp_path}/t", rows.schema, ("sale_date",))
    held = work_files(spark)
    file_stream.ingest_available(file_stream.stream_files(spark, f"{tmp_path}/in", rows.schema), target)
    assert work_files(spark) == held
    assert sorted(r.n for r in target.read().filter("sale_date is not null").collect()) == [1, 2]


def test_passing_work_goes_when_a_step_fails(spark):
    held = work_files(spark)
    try:
        with passing_work(spark):
            spark.range(3).write.parquet(fresh_dir(spark, "x"))
            assert work_files(spark) > held
            raise ValueError
    except ValueError:
        pass
    assert work_files(spark) == held


def test_shuffled_rows_go_with_their_query(spark, tmp_path):
    tune(spark)
    held = shuffle_files(spark)
    rows = spark.range(10_000).hint("rebalance", "id")
    rows.write.parquet(f"{tmp_path}/t")
    until = time.time() + 20
    while (left := shuffle_files(spark) - held) and time.time() < until:
        time.sleep(0.2)
    assert not left
    # a frame whose shuffled rows are gone shuffles them again
    counted = rows.groupBy("id").count()
    assert sorted(counted.collect()) == sorted(counted.collect()) and counted.count() == 10_000
