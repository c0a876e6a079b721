"""A stream writes each row no oftener than it has to."""

import datetime as dt

from tallyhouse.streaming import file_stream
from tallyhouse.streaming.reload import Table
from test_spread import rebalanced

DAY = dt.date(2026, 7, 1)


def test_stream_gathers_rows_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(s, DAY + dt.timedelta(d), n) for s in "xy" for d in range(3) for n in range(4)], "store_name string, sale_date date, n int")
    rows.repartition(4).write.parquet(f"{tmp_path}/in")
    target = Table(spark, f"{tmp_path}/t", rows.schema, ("sale_date",))
    bronze = file_stream.bronze_table(target)
    held = spark.createDataFrame([("x", DAY, 99), ("z", DAY, 7)], rows.schema)
    asked = rebalanced(spark, monkeypatch)
    for known in (False, True):
        if known:
            late = rows.filter("n = 0 and store_name = 'y'").withColumn("n", rows.n + 50)
            target.replace_slices(held.filter("store_name = 'z'"), ["store_name", "sale_date"])
            late.write.mode("append").parquet(f"{tmp_path}/in")
        asked.clear()
        stream = file_stream.stream_files(spark, f"{tmp_path}/in", rows.schema)
        file_stream.ingest_available(stream, target, f"{tmp_path}/check", bronze)
        # bronze only: the target's rows come from files of one day each
        assert asked == [("sale_date", file_stream.BATCH)]
    want = rows.collect() + late.collect() + [("z", DAY, 7)]
    assert sorted(map(tuple, target.read().collect())) == sorted(map(tuple, want))
