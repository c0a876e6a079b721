"""Real files through the feed readers."""

import csv
import datetime as dt
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import bronze
from tallyhouse.sources import feeds, orders_xml
from tallyhouse.sources import schemas as S

LOADED = dt.datetime(2026, 7, 1, 6, 0)


def row_a(**over):
    base = dict.fromkeys(S.FEED_A_COLUMNS, "") | {
        "Location": "Bluebird Coffee Berkeley", "Closed Date/Time": "4/14/2025 5:09 PM",
        "Employee Name": "John", "Item ID": "7", "Item Name": "Latte", "Item PLU": "70",
        "Price": "$5.00", "Discount Total": "$0.00", "Promotion Total": "$0.00", "Taxes": "$0.50",
        "Net Sales": "$4.50", "Gross Sales": "$5.00", "Total Sales": "$5.50",
        "Revenue Center": "Beverages", "Has Employee Discount": "False", "Destination": "Dine-in",
        "Voided": "False", "Has Customer": "True", "Is Modifier": "False", "Order ID": "ORD001",
    }
    return [(base | over)[c] for c in S.FEED_A_COLUMNS]


def row_b(**over):
    base = dict.fromkeys(S.FEED_B_COLUMNS, "") | {
        "Identifier": "1", "Date": "4/1/26 9:00 AM", "Account": "A1", "Staff": "Ana",
        "Reference": "R1", "Type": "SALE", "Qty": "1.0", "UnitPrice": "5", "FinalPrice": "5",
        "Discount": "0", "Item": "Café Latte", "Group": "Beverages(1)", "TaxAmount": "0.4",
    }
    return [(base | over)[c] for c in S.FEED_B_COLUMNS]


def write(path, header, rows, sep=",", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        csv.writer(f, delimiter=sep).writerows([header, *rows])


def test_feed_a(spark, tmp_path):
    write(tmp_path / "DDBB_Apr_25.csv", S.FEED_A_COLUMNS, [
        row_a(),
        row_a(**{"Net Sales": "$1,234.50", "Closed Date/Time": "06/03/2026 05:30:55 PM"}),
        row_a(**{"Net Sales": "(1.00)", "Voided": "True"}),
        row_a(**{"Net Sales": "n/a", "Is Modifier": "True"}),
    ])
    write(tmp_path / "DDBB_May_25.csv", S.FEED_A_COLUMNS, [])
    write(tmp_path / "other.csv", S.FEED_A_COLUMNS, [row_a()])
    got = feeds.read_feed_a(spark, str(tmp_path), LOADED).orderBy(F.col("Net Sales").desc_nulls_last(), "Voided").collect()
    assert [r["Net Sales"] for r in got] == [Decimal("1234.50"), Decimal("4.50"), None, None]
    assert [r["Date"] for r in got] == [dt.date(2026, 6, 3)] + [dt.date(2025, 4, 14)] * 3
    assert [r["Voided"] for r in got] == [False, False, False, True]
    assert {r["_source_file"] for r in got} == {"DDBB_Apr_25.csv"}
    assert {r["_source_system"] for r in got} == {"feed_a"}
    assert {r["_ingested_at"] for r in got} == {LOADED}


def test_feed_a_can_accept_parentheses(spark, tmp_path):
    write(tmp_path / "DDBB_x.csv", S.FEED_A_COLUMNS, [row_a(**{"Net Sales": "($1.00)"})])
    text = feeds.read_feed_a_text(spark, f"{tmp_path}/DDBB_x.csv")
    assert feeds.type_feed_a(text, accept_parentheses=True).head()["Net Sales"] == Decimal("-1.00")


def test_feed_b(spark, tmp_path):
    name = "bluebirdcoffee-hqaccount_bluebirdcoffeeberkeley_transactions_20260401_20260501.csv"
    kinds = ["SALE", "UPDATE", "TRANSITORY_COMP", "TRANSITORY_OPEN", "VOID"]
    write(tmp_path / name, S.FEED_B_COLUMNS, [row_b(Type=k) for k in kinds], ";", "latin-1")
    got = feeds.read_feed_b(spark, str(tmp_path), loaded_at=LOADED).collect()
    assert sorted(r["Type"] for r in got) == ["SALE", "UPDATE"]
    assert {r["Location"] for r in got} == {"Bluebird Coffee Berkeley"}
    assert {r["Item"] for r in got} == {"Café Latte"}
    assert {r["Date"] for r in got} == {dt.date(2026, 4, 1)}
    assert {r["_source_file"] for r in got} == {name}


def test_feed_b_without_sales_is_empty(spark, tmp_path):
    write(tmp_path / "bluebirdcoffee-hqaccount_x_transactions_1.csv", S.FEED_B_COLUMNS, [row_b(Type="VOID")], ";")
    assert feeds.read_feed_b(spark, str(tmp_path)).count() == 0


def test_counts_do_not_depend_on_columns(spark, tmp_path):
    name = "bluebirdcoffee-hqaccount_bluebirdcoffeeberkeley_transactions_1.csv"
    lines = [row_b(), row_b()[:-3], [*row_b(), "more", "cells"], row_b(Date="soon"), row_b(Type="VOID")]
    write(tmp_path / name, S.FEED_B_COLUMNS, lines, ";", "latin-1")
    write(tmp_path / "old_DDBB_x.csv", S.FEED_A_COLUMNS, [row_a()])
    text = feeds.read_feed_b_text(spark, f"{tmp_path}/{feeds.FEED_B_GLOB}")
    assert text.count() == text.select("Item").count() == len(text.collect()) == 5
    assert feeds.read_feed_b(spark, str(tmp_path)).count() == 1
    assert sorted(r.reason for r in feeds.rejects(text, "Date").collect()) == ["malformed line"] * 2 + ["unreadable date"]
    sale = F.col("Type") == "SALE"
    (row,) = feeds.line_balance(text, "Date", sale, r"(bluebird[^/]*)").collect()
    assert tuple(row)[1:] == (5, 1, 1, 2, 1)
    assert feeds.read_feed_a(spark, str(tmp_path)).count() == 0


def test_read_many(spark, tmp_path):
    write(tmp_path / "a.csv", ["x", "y"], [["1", "2"]])
    write(tmp_path / "b.csv", ["y", "z"], [["3", "4"], ["5", "6", "7"]])
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    by_name = feeds.read_many(spark, paths)
    assert by_name.columns == ["x", "y", "z"]
    assert sorted(map(tuple, by_name.collect()), key=str) == [("1", "2", None), (None, "3", "4")]
    by_position = feeds.read_many(spark, paths, by="position")
    assert sorted(map(tuple, by_position.collect())) == [("1", "2"), ("3", "4")]


def test_seed_without_rows(spark, tmp_path):
    write(tmp_path / "seed.csv", ["product_canonical_name", "campaign_name", "campaign_start_date", "campaign_end_date"], [])
    seed = feeds.load_seed(spark, str(tmp_path / "seed.csv"))
    assert seed.count() == 0 and dict(seed.dtypes)["campaign_start_date"] == "date"


def test_since_is_strict(spark):
    df = spark.sql("select explode(sequence(date'2026-01-01', date'2026-01-04')) as d")
    assert feeds.since(df, "d", dt.date(2026, 1, 2)).count() == 2


XSI = 'xmlns:i="http://www.w3.org/2001/XMLSchema-instance"'


def payload(orders, code="0", message=""):
    return (f"<GetOrdersResult {XSI}><ResultCode>{code}</ResultCode><Message>{message}</Message>"
            f"<Orders>{orders}</Orders></GetOrdersResult>")


def order(oid, entries, extra=""):
    return f"<Order><Id>{oid}</Id>{extra}<Entries>{entries}</Entries></Order>"


def entry(eid, net="1.50", extra=""):
    return f"<OrderEntry><Id>{eid}</Id><ItemId>7</ItemId><ItemNetSales>{net}</ItemNetSales>{extra}</OrderEntry>"


def land(root, store, day, text):
    folder = root / f"store={store}" / f"date={day}"
    folder.mkdir(parents=True)
    (folder / "orders.xml").write_text(text)


def test_orders_flatten(spark, tmp_path):
    land(tmp_path, "Berkeley", "2026-05-27", payload(
        order("1", entry("a") + entry("b", net="oops", extra="<IsVoided>TRUE</IsVoided>"),
              "<Tax>0.80</Tax><IsClosed>True</IsClosed><EmployeeId>55</EmployeeId><DestinationId>3</DestinationId>")
        + order("2", entry("c"), '<Tax i:nil="true"/><Total>x</Total>')
        + order("3", "")))
    land(tmp_path, "A+B %Vegas", "2026-05-28", payload(order("9", entry("z"))))
    orders, entries = orders_xml.flatten_orders(spark, str(tmp_path))
    heads = {r.order_id: r for r in orders.collect()}
    assert sorted(heads) == ["1", "2", "3", "9"] and len(orders.columns) == 20
    assert heads["1"].tax == Decimal("0.80") and heads["1"].is_closed is True
    assert heads["2"].tax is None and heads["2"].total is None and heads["2"].is_voided is None
    assert heads["9"].business_date == dt.date(2026, 5, 28)
    assert heads["9"].store_name == "A+B %Vegas"
    lines = {r.entry_id: r for r in entries.collect()}
    assert sorted(lines) == ["a", "b", "c", "z"]
    assert lines["b"].net_sales is None and lines["b"].is_voided is True and lines["a"].is_voided is None

    stamp = F.lit(LOADED)
    rows = orders_xml.entries_to_bronze(orders, entries, stamp)
    direct = orders_xml.nested_to_bronze(orders_xml.read_orders(spark, str(tmp_path)), stamp)
    assert sorted(map(str, rows.collect())) == sorted(map(str, direct.collect()))
    by_entry = {r.entry_id: r for r in rows.collect()}
    assert by_entry["a"]["Taxes"] == by_entry["b"]["Taxes"] == Decimal("0.80")
    assert by_entry["a"]["Voided"] is False and by_entry["a"]["Is Modifier"] is False
    assert by_entry["a"]["Employee Name"] == "55" and by_entry["a"]["Item Name"] is None
    assert by_entry["a"]["_source_system"] == "feed_c" and by_entry["a"]["Total Sales"] is None
    assert len(rows.columns) == 24


def test_one_day_of_orders_opens_one_folder(spark, tmp_path):
    land(tmp_path, "A", "2026-05-27", payload(order("1", entry("a"))))
    land(tmp_path, "A", "2026-05-28", payload(order("2", entry("b"))))
    one = orders_xml.read_orders(spark, str(tmp_path)).filter(F.col("business_date") == dt.date(2026, 5, 28))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*date#\d+ = 2026-05-28", plan)
    assert [r.Id for r in one.collect()] == ["2"]


def test_one_failed_payload_spares_the_others(spark, tmp_path):
    land(tmp_path, "A", "2026-05-27", payload(order("1", entry("a"))))
    land(tmp_path, "B", "2026-05-27", payload(order("2", entry("b")), code="5", message="no access"))
    good, failed = orders_xml.read_good_orders(spark, str(tmp_path))
    assert [r.Id for r in good.collect()] == ["1"]
    with pytest.raises(ValueError, match="B 2026-05-27: ResultCode=5: no access"):
        orders_xml.raise_failures(failed)


def test_repeated_order_ids_take_the_last_closed(spark):
    cols = "store_name string, business_date date, order_id string, order_number string, closed_time string, opened_time string, tax decimal(18,2), employee_id string, destination_id string"
    day = dt.date(2026, 1, 1)
    orders = spark.createDataFrame([("A", day, "1", "7", t, None, None, who, "1") for t, who in (("09:00", "x"), ("10:00", "y"), ("08:00", "z"))], cols)
    entries = spark.createDataFrame([("A", day, "1", "e", "7", None, None, None, None, False, False)], "store_name string, business_date date, order_id string, entry_id string, item_id string, revenue_center_id string, net_sales decimal(18,2), gross_sales decimal(18,2), display_price decimal(18,2), is_voided boolean, is_deleted boolean")
    assert orders_xml.entries_to_bronze(orders, entries, F.lit(LOADED)).head()["Employee Name"] == "y"


def test_failed_payload_is_an_error(spark, tmp_path):
    land(tmp_path, "A", "2026-05-27", payload("", code="5", message="no access"))
    with pytest.raises(ValueError, match="ResultCode=5: no access"):
        orders_xml.flatten_orders(spark, str(tmp_path))


def test_csv_beats_xml_per_store_day(spark):
    cols = 'Location string, Date date, `Net Sales` int'
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    csv_rows = spark.createDataFrame([("A", d1, 1), ("A", d1, 2)], cols)
    api = spark.createDataFrame([("A", d1, 9), ("A", d2, 8), ("B", d1, 7)], cols).withColumn("entry_id", F.lit("e"))
    got = bronze.bronze_a(csv_rows, api)
    assert sorted(r["Net Sales"] for r in got.collect()) == [1, 2, 7, 8]
    assert got.filter("entry_id is null").count() == 2


def test_split_refuses_full_targets(spark):
    mixed = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "_source_system string")
    parts = bronze.split_by_source(mixed, ["x", "y"])
    assert {k: v.count() for k, v in parts.items()} == {"x": 2, "y": 1}
    assert bronze.split_balance(mixed, parts).head().asDict() == {
        "total_rows": 4, "x_rows": 2, "y_rows": 1, "unassigned_rows": 1
    }
    bronze.assert_empty({"t": mixed.limit(0)})
    with pytest.raises(ValueError, match="t"):
        bronze.assert_empty({"t": mixed})


def test_each_payload_is_parsed_once(spark, tmp_path):
    land(tmp_path, "A", "2026-05-27", payload(order("1", entry("a")) + order("2", entry("b") + entry("c"))))
    land(tmp_path, "A", "2026-05-28", payload(""))
    land(tmp_path, "B", "2026-05-27", payload(order("3", entry("d")))[:-30])
    land(tmp_path, "C", "2026-05-27", payload(order("4", entry("e")), code="7", message="no"))
    rows = orders_xml._payload_orders(spark, str(tmp_path), None)
    assert rows.count() == 5 and rows.filter("_order is null").count() == 2
    good, failed = orders_xml.read_good_orders(spark, str(tmp_path))
    assert "xml" not in good._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(r.Id for r in good.collect()) == ["1", "2"]
    told = {(r.store, r.ResultCode, r.Message) for r in failed.collect()}
    assert told == {("B", None, "the payload cannot be parsed"), ("C", "7", "no")}


def test_newest_payload_of_a_day_counts(spark, tmp_path):
    land(tmp_path, "A", "2026-05-27", payload(order("1", entry("a")) + order("2", entry("b"))))
    land(tmp_path, "B", "2026-05-27", payload(order("1", entry("z"))))
    folder = tmp_path / "store=A" / "date=2026-05-27"
    (folder / "later.xml").write_text(payload(order("2", entry("x") + entry("y"))))
    os.utime(folder / "orders.xml", (1_000_000_000, 1_000_000_000))
    good, _ = orders_xml.read_good_orders(spark, str(tmp_path))
    got = {(r.store_name, r.Id): [e.Id for e in r.Entries.OrderEntry] for r in good.collect()}
    assert got == {("A", "1"): ["a"], ("A", "2"): ["x", "y"], ("B", "1"): ["z"]}
    direct = orders_xml.read_orders(spark, str(tmp_path))
    assert sorted(map(str, direct.select(*good.columns).collect())) == sorted(map(str, good.collect()))
