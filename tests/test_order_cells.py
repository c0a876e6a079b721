"""Distinct orders of cells and their roll-ups."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators import facts


def test_cells_hold_a_row_an_order(spark):
    day, later = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    sold = [(day, "S", "E", "o1"), (day, "S", "E", "o1"), (day, "S", "nobody", "o1"), (later, "S", "E", "o1"), (day, "S", "E", "o2"), (day, "S", "E", None), (day, "S", "E", " ")]
    stg = spark.createDataFrame(sold, "sale_date date, store_name string, employee_name string, order_ref string")
    dates = spark.createDataFrame([(20250101, day), (20250102, later)], "date_key int, date date")
    stores = spark.createDataFrame([(1, "S")], "store_key long, store_name string")
    staff = spark.createDataFrame([(0, "UNKNOWN"), (7, "E")], "employee_key long, employee_name string")
    cells = facts.order_cells(stg, dates, stores, staff)
    assert sorted((r.date_key, r.employee_key, r.order_ref) for r in cells.collect()) == [
        (20250101, 0, "o1"), (20250101, 7, "o1"), (20250101, 7, "o2"), (20250102, 7, "o1")]
    assert "binary" not in dict(cells.dtypes).values()
    by_day = facts.distinct_orders(cells, "date_key").collect()
    assert sorted(map(tuple, by_day)) == [(20250101, 2), (20250102, 1)]
    assert facts.distinct_orders(cells, "sale_month").head().order_count == 2
    assert facts.distinct_orders(cells, *facts.CELL).agg(F.sum("order_count")).head()[0] == 4
