"""CSV feed files through the stream: rejects, balances, late files, and what a micro-batch reads."""

import datetime as dt

from pyspark.sql import Observation

from tallyhouse.sources import feeds
from tallyhouse.sources import schemas as S
from tallyhouse.streaming import file_stream
from tallyhouse.streaming.reload import Table
from test_feeds import row_a, write

LOADED = dt.datetime(2026, 7, 1, 6, 0)


def lines(day, n, **over):
    return [row_a(**({"Closed Date/Time": f"{day} 5:09 PM", "Order ID": f"{day}-{i}"} | over)) for i in range(n)]


def test_feed_files_stream(spark, tmp_path):
    stage = lambda text, balance: feeds.staged_a(text, balance, LOADED)
    inbox = tmp_path / "in"
    inbox.mkdir()
    write(inbox / "DDBB_Apr_25.csv", S.FEED_A_COLUMNS, lines("4/14/2025", 3) + lines("someday", 2) + [["short", "line"]])
    write(inbox / "notes.csv", S.FEED_A_COLUMNS, lines("4/14/2025", 1))
    text = feeds.stream_feed_a_text(spark, str(inbox), 1)
    schema = stage(spark.createDataFrame([], text.schema), Observation()).drop("_reason", "_line").schema
    target = Table(spark, str(tmp_path / "t"), schema, ("Date",))
    bronze = file_stream.bronze_table(target, day="Date")
    rejects = file_stream.rejects_table(spark, str(tmp_path / "bad"))
    run = lambda: file_stream.ingest_feed(
        feeds.stream_feed_a_text(spark, str(inbox), 1), stage, target, rejects, str(tmp_path / "chk"), bronze
    )
    balances = run()
    assert [tuple(b.values()) for b in balances] == [(6, 3, 0, 3)]
    assert sorted((r._reason, r._source_file) for r in rejects.read().collect()) == [
        ("malformed line", "DDBB_Apr_25.csv"), ("unreadable date", "DDBB_Apr_25.csv"), ("unreadable date", "DDBB_Apr_25.csv"),
    ]
    # a late file of a known store-day, and another day
    write(inbox / "DDBB_Late_25.csv", S.FEED_A_COLUMNS, lines("4/14/2025", 2, **{"Net Sales": "$1.00"}))
    write(inbox / "DDBB_May_25.csv", S.FEED_A_COLUMNS, lines("5/2/2025", 4))
    assert sum(b["kept_lines"] for b in run()) == 6
    assert run() == []
    held = {(r.Date, r["_source_file"]): r["count"] for r in target.read().groupBy("Date", "_source_file").count().collect()}
    april, may = dt.date(2025, 4, 14), dt.date(2025, 5, 2)
    assert held == {(april, "DDBB_Apr_25.csv"): 3, (april, "DDBB_Late_25.csv"): 2, (may, "DDBB_May_25.csv"): 4}
    plan = file_stream.of_days(bronze, "Date", [april])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert all("Date=2025-04-14" in f for f in {r[0] for r in file_stream.of_days(bronze, "Date", [april]).selectExpr("input_file_name()").collect()})
