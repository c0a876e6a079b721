"""Silver, dimensions and facts on small hand-computed frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import checks, dimensions, facts, silver

D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
T0 = dt.datetime(2025, 1, 3, 8)

BRONZE_A = (
    "Location string, Date date, `Employee Name` string, `Item ID` bigint, `Item Name` string, "
    "`Item PLU` double, `Discount Total` decimal(18,2), Taxes decimal(18,2), "
    "`Net Sales` decimal(18,2), `Revenue Center` string, Destination string, Voided boolean, "
    "`Is Modifier` boolean, `Order ID` string, _source_system string, _ingested_at timestamp"
)


def a(**over):
    base = {
        "Location": "Bluebird Coffee Berkeley", "Date": D1, "Employee Name": "alice ", "Item ID": 1,
        "Item Name": " 16 oz Latte", "Item PLU": 1.0, "Discount Total": Decimal("0.50"),
        "Taxes": Decimal("0.40"), "Net Sales": Decimal("5.00"), "Revenue Center": "Beverages",
        "Destination": "to go", "Voided": False, "Is Modifier": False, "Order ID": "O1",
        "_source_system": "feed_a", "_ingested_at": T0,
    }
    return tuple((base | over).values())


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(
        [
            a(),
            a(**{"Net Sales": None}),
            a(Voided=True),
            a(**{"Is Modifier": True}),
            a(Voided=None),
            a(**{"Item Name": None, "Revenue Center": "640207795", "_source_system": "feed_c",
                 "Employee Name": "12345", "Order ID": "O2"}),
            a(**{"Item ID": 99, "Item Name": None, "Revenue Center": "640207795", "Order ID": "O3"}),
        ],
        BRONZE_A,
    )


def test_catalog_takes_the_latest_name(spark):
    rows = spark.createDataFrame(
        [
            a(**{"Item Name": "old", "Date": D1}),
            a(**{"Item Name": "zeta", "Date": D2}),
            a(**{"Item Name": "beta", "Date": D2, "Item PLU": 2.0}),
            a(**{"Item Name": "beta", "Date": D2, "Item PLU": 1.0}),
            a(**{"Item Name": "  ", "Date": dt.date(2026, 1, 1)}),
            a(**{"Item ID": None}),
        ],
        BRONZE_A,
    )
    got = silver.item_catalog(rows).collect()
    assert [(r.item_id, r.item_name, r.item_plu, r.revenue_center) for r in got] == [
        (1, "BETA", 1.0, "Beverages")
    ]


def test_stg_a(spark, bronze):
    catalog = silver.item_catalog(bronze)
    rows = silver.stg_a(silver.enrich(bronze, catalog)).orderBy("order_ref").collect()
    assert [r.order_ref for r in rows] == ["O1", "O2", "O3"]
    first, named, lost = rows
    assert (first.store_name, first.product_name, first.product_canonical_name) == (
        "BERKELEY", "16 OZ LATTE", "LATTE")
    assert (first.destination, first.employee_name, first.revenue_center) == ("TO GO", "ALICE", "Beverage")
    assert (first.qty, first.tip_amount, first.order_id) == (1, 0, "O1")
    assert (named.product_name, named.revenue_center) == ("16 OZ LATTE", "Beverage")
    assert (lost.product_name, lost.revenue_center) == (None, "Other")
    assert tuple(first.asDict()) == silver.STG_COLUMNS


def test_stg_b(spark):
    schema = (
        "Location string, Date date, Account string, Staff string, Reference string, Type string, "
        "Qty decimal(18,3), FinalPrice decimal(18,2), Discount decimal(18,2), Item string, "
        "`Group` string, TaxAmount decimal(18,2), _ingested_at timestamp"
    )
    one = ("Bluebird Las Vegas", D1, "A1", "Bob", "R1", "SALE", Decimal(-2), Decimal("5"), Decimal(0),
           "iced latte (16 oz) m", "Beverages(1)", Decimal("0.1"), T0)
    rows = spark.createDataFrame(
        [one, one[:10] + ("Modifiers(2)",) + one[11:], one[:10] + (None,) + one[11:],
         one[:7] + (None,) + one[8:]], schema)
    got = silver.stg_b(rows).collect()
    assert len(got) == 1
    assert (got[0].order_id, got[0].order_ref, got[0].qty) == ("A1", "R1", Decimal(-2))
    assert (got[0].store_name, got[0].destination) == ("LAS VEGAS", None)
    assert got[0].product_canonical_name == "ICED LATTE"


def test_calendar(spark):
    rows = {r.date: r for r in dimensions.dim_date(spark, dt.date(2024, 7, 1), dt.date(2027, 1, 3)).collect()}
    assert len(rows) == 917
    assert rows[dt.date(2024, 7, 1)].date_key == 20240701
    assert all(r.is_weekend == (d.isoweekday() > 5) and r.day_of_week == d.isoweekday() for d, r in rows.items())
    assert all(r.week_number == d.isocalendar().week for d, r in rows.items())
    assert all((r.day_name, r.month_name) == (d.strftime("%A"), d.strftime("%B")) for d, r in rows.items())


def test_feed_a_decides_on_products(spark, bronze):
    b = spark.createDataFrame(
        [("16 oz Latte", "Food(1)", "SALE"), ("Scone (4 oz) S", "Bakery(2)", "UPDATE"),
         ("Shot", "Modifiers(3)", "SALE"), ("UNKNOWN", "Food(1)", "SALE"), ("Gone", "Food(1)", "VOID"),
         ("Twin", "Food(1)", "SALE"), ("Twin", "Retail(1)", "SALE")],
        "Item string, `Group` string, Type string")
    got = {r.product_name: r for r in dimensions.dim_product(bronze, b).collect()}
    assert sorted(got) == ["16 OZ LATTE", "SCONE (4 OZ) S", "TWIN", "UNKNOWN"]
    assert got["16 OZ LATTE"].revenue_center_name == "Beverage"
    assert got["SCONE (4 OZ) S"].product_canonical_name == "SCONE"
    assert got["TWIN"].revenue_center_name == "Food"
    assert got["UNKNOWN"].product_key == 0


def test_literal_unknown_does_not_twin_member_zero(spark, bronze):
    rows = bronze.withColumn("Destination", F.lit("unknown"))
    got = dimensions.dim_destination(rows).collect()
    assert [(r.destination_key, r.destination_name, r.channel) for r in got] == [(0, "UNKNOWN", "Unknown")]


def test_employees(spark, bronze):
    b = spark.createDataFrame([("bob",), ("ALICE",), ("777",), (" ",), (None,)], "Staff string")
    got = {r.employee_name for r in dimensions.dim_employee(bronze, b).collect()}
    assert got == {"ALICE", "BOB", "777", "UNKNOWN"}


def test_campaign_seed(spark):
    seed = spark.createDataFrame(
        [("iced latte", "summer", D1, D2), ("mocha", "summer", D1, D2), ("classic", "forever", None, None),
         ("x", " ", None, None), (None, "y", None, None)],
        "product_canonical_name string, campaign_name string, campaign_start_date date, campaign_end_date date")
    rows = dimensions.dim_campaign(seed).collect()
    assert len(rows) == 4 and len({r.campaign_key for r in rows}) == 3
    assert [r.campaign_name for r in rows if r.campaign_key == 0] == ["NO CAMPAIGN"]


@pytest.mark.parametrize(
    "product, day, want",
    [("ICED LATTE", dt.date(2025, 7, 15), "SUMMER"), ("ICED LATTE", dt.date(2025, 6, 1), "SUMMER"),
     ("ICED LATTE", dt.date(2025, 10, 1), None), ("CLASSIC", dt.date(1999, 1, 1), "FOREVER"),
     ("WINTER ONLY", dt.date(2024, 12, 31), None), ("WINTER ONLY", dt.date(2030, 1, 1), "WINTER"),
     ("NONE", dt.date(2025, 7, 15), None)],
)
def test_campaign_interval(spark, product, day, want):
    seed = spark.createDataFrame(
        [("iced latte", "summer", dt.date(2025, 6, 1), dt.date(2025, 8, 31)), ("classic", "forever", None, None),
         ("winter only", "winter", dt.date(2025, 1, 1), None)],
        "product_canonical_name string, campaign_name string, campaign_start_date date, campaign_end_date date")
    sales = spark.createDataFrame([(product, day)], "product_canonical_name string, d date")
    got = facts.attribute_campaigns(sales, dimensions.dim_campaign(seed), "d").collect()
    assert [r.campaign_name for r in got] == [want]


# --- facts ----------------------------------------------------------------------

STG = (
    "sale_date date, store_name string, revenue_center string, net_sales decimal(18,2), "
    "order_id string, order_ref string, qty decimal(18,3), tip_amount decimal(18,2), "
    "destination string, employee_name string, tax_amount decimal(18,2), "
    "discount_total decimal(18,2), product_name string, product_canonical_name string, "
    "_source_system string, _ingested_at timestamp"
)


def line(day, net, order, dest, product, employee=None, qty=1, source="feed_a", tax="0.5", disc="0.1"):
    return (day, "BERKELEY", "Beverage", Decimal(net), order, order, Decimal(qty), Decimal(0), dest,
            employee, Decimal(tax), Decimal(disc), product, product, source, T0)


@pytest.fixture
def star(spark):
    stg = spark.createDataFrame(
        [
            line(D1, "10", "A001", "DINE IN", "16 OZ ICED LATTE", "ALICE"),
            line(D1, "15", "A002", "DINE IN", "16 OZ ICED LATTE", "ALICE"),
            line(D1, "5", "A001", "DINE IN", "CLASSIC", "BOB"),
            line(D2, "8", "A003", "TO GO", "CLASSIC", None),
            line(D2, "8", "A003", None, "CLASSIC", "ALICE", qty=-2, source="feed_b"),
            line(D2, "1", " ", None, "CLASSIC"),
            line(D2, "1", None, None, "CLASSIC"),
            line(dt.date(2031, 1, 1), "99", "A009", "DINE IN", "CLASSIC"),
        ],
        STG,
    )
    dates = dimensions.dim_date(spark, D1, D2)
    stores = dimensions.dim_store(stg)
    dest = spark.createDataFrame([(1, "DINE IN", "In-Store"), (0, "UNKNOWN", "Unknown")],
                                 "destination_key bigint, destination_name string, channel string")
    prod = spark.createDataFrame(
        [(1, "16 OZ ICED LATTE", "ICED LATTE", "Beverage"), (2, "CLASSIC", "CLASSIC", "Food"),
         (0, "UNKNOWN", "UNKNOWN", "Other")],
        "product_key bigint, product_name string, product_canonical_name string, revenue_center_name string")
    emp = spark.createDataFrame([(1, "ALICE"), (2, "BOB"), (0, "UNKNOWN")], "employee_key bigint, employee_name string")
    return stg, dates, stores, dest, prod, emp


def test_fact_order(star):
    stg, dates, stores, dest, *_ = star
    got = {(r.source_system, r.order_id): r for r in facts.fact_order(stg, dates, stores, dest).collect()}
    assert sorted(got) == [("feed_a", "A001"), ("feed_a", "A002"), ("feed_a", "A003"), ("feed_b", "A003")]
    assert got["feed_a", "A001"].order_net_sales == Decimal("15.00")
    assert got["feed_a", "A001"].destination_key == 1
    assert got["feed_a", "A003"].destination_key == 0  # not in the dimension
    assert got["feed_b", "A003"].destination_key == 0  # missing
    assert {r.order_count for r in got.values()} == {1}
    assert got["feed_a", "A001"].sale_month == dt.date(2025, 1, 1)


def test_fact_order_detail(star):
    stg, dates, stores, dest, *_ = star
    got = {(r.source_system, r.order_id): r for r in facts.fact_order_detail(stg, dates, stores, dest).collect()}
    assert (got["feed_a", "A001"].tax_amount, got["feed_a", "A001"].discount_total) == (Decimal("1.00"), Decimal("0.20"))


def test_fact_sale_item_is_net_of_returns(star):
    stg, dates, stores, dest, prod, _ = star
    rows = facts.fact_sale_item(stg, dates, stores, prod, dest).collect()
    assert len(rows) == 5
    assert sum(r.qty for r in rows) == Decimal(2)


def test_fact_by_employee(star):
    stg, dates, stores, _, _, emp = star
    got = {(r.date_key, r.employee_key): r for r in facts.fact_by_employee(stg, dates, stores, emp).collect()}
    assert sorted(got) == [(20250101, 1), (20250101, 2), (20250102, 0), (20250102, 1)]
    assert (got[20250101, 1].order_count, got[20250101, 1].avg_ticket) == (2, Decimal("12.50"))


def test_bitmaps_count_distinct_orders_at_every_level(star):
    stg, dates, stores, _, _, emp = star
    bitmaps = facts.order_bitmaps(stg, dates, stores, emp)
    cells = facts.distinct_orders(bitmaps, "date_key", "store_key", "employee_key")
    fact = facts.fact_by_employee(stg, dates, stores, emp).select(*cells.columns)
    assert sorted(cells.collect()) == sorted(fact.collect())
    whole = facts._placed_lines(stg, dates, stores).select("order_ref").distinct().count()
    assert facts.distinct_orders(bitmaps, "sale_month").head().order_count == whole


def test_bitmaps_of_orders_beyond_one_bucket(spark):
    dates = spark.sql("select 20250101 + id as date_key, date_add(date'2025-01-01', cast(id as int)) as date from range(3)")
    stores = spark.sql("select id as store_key, concat('S', id) as store_name from range(2)")
    emp = spark.sql("select id as employee_key, if(id = 0, 'UNKNOWN', concat('E', id)) as employee_name from range(3)")
    # 70,000 orders, each on two days, so that days add up to twice the month
    stg = spark.sql("""select date_add(date'2025-01-01', cast(day as int)) as sale_date, concat('S', if(id % 3 = 0, 1, 0)) as store_name,
        concat('E', id % 4) as employee_name, concat('o', id) as order_ref
        from range(70000) join (select id as day from range(2))""")
    bitmaps = facts.order_bitmaps(stg, dates, stores, emp)
    assert facts.distinct_orders(bitmaps, "sale_month").head().order_count == 70_000
    days = {r.date_key: r.order_count for r in facts.distinct_orders(bitmaps, "date_key").collect()}
    assert days == {20250101: 70_000, 20250102: 70_000}
    by_store = {r.store_key: r.order_count for r in facts.distinct_orders(bitmaps, "store_key").collect()}
    assert by_store == {1: 23_334, 0: 46_666}
    assert facts.order_bitmaps(stg.limit(0), dates, stores, emp).count() == 0


def test_legacy_cells_count_orders_twice(star):
    stg, dates, stores, dest, prod, _ = star
    cells = facts.legacy_sales_cells(stg, dates, stores, prod, dest)
    days = {r[0]: r[1] for r in cells.groupBy("date_key").agg(F.sum("order_count")).collect()}
    assert days[20250101] == 3  # two real orders
    gaps = checks.order_count_gaps(cells, stg, dates, stores).collect()
    assert [(g.date_key, g.summed_orders, g.distinct_orders) for g in gaps if g.date_key == 20250101] == [(20250101, 3, 2)]


def test_reconciliation_passes_on_the_facts(star):
    stg, dates, stores, dest, prod, _ = star
    orders = facts.fact_order(stg, dates, stores, dest)
    items = facts.fact_sale_item(stg, dates, stores, prod, dest)
    assert checks.order_count_gaps(orders, stg, dates, stores).count() == 0
    assert checks.quantity_gaps(items, stg, dates, stores).count() == 0
    assert checks.items_without_order(items, orders).count() == 0
    lost = checks.items_without_order(items, orders.filter("order_id <> 'A001'")).collect()
    assert [tuple(r) for r in lost] == [("feed_a", "A001")]
    assert checks.quantity_gaps(items.filter("qty > 0"), stg, dates, stores).count() == 1


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "c", None), (2, None, 0)], "k int, v string, n int")
    found = checks.run_checks(
        df,
        [checks.not_null("k"), checks.not_null("v", F.col("k") == 2), checks.accepted_values("v", ["a", "b"]),
         checks.non_negative("n")], "t")
    assert [(r.check_name, r.failures) for r in found.collect()] == [
        ("not_null(k)", 1), ("not_null(v) where", 1), ("accepted_values(v)", 1), ("non_negative(n)", 1)]
    assert [r.v for r in checks.offending(df, checks.non_negative("n")).collect()] == ["b"]
    assert [tuple(r) for r in checks.not_unique(df, "k").collect()] == [(1, 2)]


def test_line_sequence_numbers_every_line_once(spark):
    rows = [(None, 1, f"v{i % 700}") for i in range(2000)] + [("o", 1, "x"), ("o", 1, "x"), ("o", 2, "y")]
    df = spark.createDataFrame(rows, "o string, i int, v string")
    got = checks.line_sequence(df, ["o", "i"], ["v"]).collect()
    assert sorted(r.line_seq for r in got if r.o is None) == list(range(1, 2001))
    assert sorted((r.o, r.i, r.line_seq) for r in got if r.o) == [("o", 1, 1), ("o", 1, 2), ("o", 2, 1)]


def test_line_sequence_splits_equal_lines(spark):
    df = spark.createDataFrame([(None, 1, "same")] * 4000, "o string, i int, v string").repartition(8)
    got = checks.line_sequence(df, ["o", "i"], ["v"])
    assert sorted(r.line_seq for r in got.collect()) == list(range(1, 4001))
    window = got._jdf.queryExecution().executedPlan().toString()
    assert "_task" in window  # numbered within the task that read them, 500 lines each here


def test_coverage_finds_a_dropped_day(spark, bronze):
    stg = silver.stg_a(silver.enrich(bronze, silver.item_catalog(bronze)))
    late = bronze.unionByName(spark.createDataFrame([a(Date=D2), a(Date=dt.date(2025, 1, 9), Voided=True)], BRONZE_A))
    assert checks.coverage_a(bronze, stg).count() == 0
    assert [r.sale_date for r in checks.coverage_a(late, stg).collect()] == [D2]


def test_latest_month_opens_one_partition(spark):
    from tallyhouse.plans import dashboard
    from tallyhouse.plans.warehouse import open_warehouse, written_months

    w = open_warehouse(spark, "/root/testdata/sf0.001")
    months = written_months(w.fact_order)
    assert months == sorted(months) and months[-1] == w.stg_orders.agg(F.max("sale_month")).first()[0]
    plan = dashboard.in_latest_month(w.fact_order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and f"= {months[-1]}" in plan.split("PartitionFilters")[1].split("]")[0]
    assert w.as_of == w.stg_orders.agg(F.max("sale_date")).first()[0]


def test_no_line_is_lost_between_tables_and_silver(spark):
    from tallyhouse.plans.warehouse import open_warehouse

    folder = "/root/testdata/sf0.001"
    w = open_warehouse(spark, folder)
    assert w.lines.count() == spark.read.parquet(f"{folder}/lineitem.parquet").count()
    dates = w.dim_date.agg(F.min("date"), F.max("date")).first()
    sales = w.stg_orders.agg(F.min("sale_date"), F.max("sale_date")).first()
    assert dates[0] <= sales[0] and sales[1] <= dates[1]
