"""Adapter: order, line and master tables as the three point-of-sale feeds.

Even order keys are feed A (of those, keys ending in 4 arrive through the order
XML, feed C), odd ones are feed B. Every rule is a pure function of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.parsing import MONEY
from tallyhouse.settings import FEED_A, FEED_B, FEED_C, Settings
from tallyhouse.sources.schemas import FEED_B_COLUMNS

# Fixed values of the adapter: table codes as the feeds would spell them.
REVENUE_CENTER_A = {
    "STANDARD": "Beverages",
    "PROMO": "FOOD",
    "LARGE": "Retail",
    "SMALL": "Combo Meal",
    "ECONOMY": "NO TAX",
    "MEDIUM": "Hot Food",
}
GROUP_B = {
    "STANDARD": "Beverages(1024306750423249)",
    "PROMO": "Bottled Drinks(2024)",
    "LARGE": "Retail Items(3024)",
    "SMALL": "Bakery(4024)",
    "ECONOMY": "Gift Cards(5024)",
    "MEDIUM": "Grab & Go(6024)",
}
DESTINATION_A = {
    "1-URGENT": "Dine In",
    "2-HIGH": "DRIVE THRU",
    "3-MEDIUM": "To Go",
    "4-NOT SPECIFIED": "Delivery",
    "5-LOW": "Catering",
}
STORE_OF_NATION = {1: "Las Vegas", 2: "Meijer Midtown"}

# Lines that a task of the join of lines and orders takes.
LINES_PER_TASK = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(pairs: dict, col: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, value in pairs.items():
        out = out.when(col == F.lit(key), F.lit(value))
    return out


def money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, store, item and employee: one pass over the tables.

    Orders meet customer and nation first, so the line side crosses the network
    once per large join and the smaller tables are broadcast when their size allows.
    Lines and orders are the two tables that always grow together: a task hashes its orders
    and lines stream past, so lines are neither broadcast nor sorted. Where the session's
    shuffle partitions are too few for the lines, both are dealt into more.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    tasks = -(-lineitem.count() // LINES_PER_TASK)
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    headers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        lineitem, headers = lineitem.repartition(tasks, "l_orderkey"), headers.repartition(tasks, "o_orderkey")
    lines = (
        lineitem.join(headers.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    key = F.col("o_orderkey")
    feed = (
        F.when(F.pmod(key, F.lit(2)) == 1, F.lit(FEED_B))
        .when(F.pmod(key, F.lit(10)) == 4, F.lit(FEED_C))
        .otherwise(F.lit(FEED_A))
    )
    # Narrow decimals: products stay within 18 digits, where Spark computes on longs.
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    rate, tax_rate = [F.col(c).cast("decimal(4,2)") for c in ("l_discount", "l_tax")]
    return lines.select(
        key.alias("order_key"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_orderpriority").alias("priority"),
        money("o_totalprice").alias("order_total"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("employee_no"),
        F.col("l_quantity").cast("decimal(18,3)").alias("quantity"),
        money(price).alias("price"),
        money(price * rate).alias("discount"),
        money(price * (F.lit(1).cast("decimal(1,0)") - rate)).alias("net"),
        money(price * tax_rate).alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("p_name").alias("part_name"),
        F.col("p_type").alias("part_type"),
        F.col("p_size").alias("part_size"),
        F.col("s_name").alias("employee"),
        F.col("n_nationkey").alias("nation_key"),
        F.coalesce(_lookup(STORE_OF_NATION, F.col("n_nationkey")), "n_name").alias("store"),
        feed.alias("feed"),
    )


def ingested_at() -> Column:
    """Loaded 0 to 4 days after the sale, at 08:00 UTC."""
    late = F.date_add("sale_date", F.pmod("order_key", F.lit(5)).cast("int"))
    return F.to_timestamp(F.concat(late.cast("string"), F.lit(" 08:00:00+00:00")))


def closed_at() -> Column:
    """Closing minute of an order, spread over the day; wall-clock text, no zone."""
    minute = F.pmod(F.col("order_key") * 37, F.lit(1440))
    return F.concat_ws(
        " ",
        F.date_format("sale_date", "yyyy-MM-dd"),
        F.concat(
            F.lpad((minute / 60).cast("int").cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad(F.pmod(minute, F.lit(60)).cast("string"), 2, "0"),
        ),
    )


def _location(settings: Settings) -> Column:
    """Store as feed A spells it: long prefix, short prefix in capitals, or bare."""
    long, short = settings.brand.prefixes
    style = F.pmod("nation_key", F.lit(3))
    return (
        F.when(style == 0, F.concat(F.lit(long), "store"))
        .when(style == 1, F.concat(F.lit(short.upper()), "store"))
        .otherwise(F.concat(F.lit(" "), "store", F.lit(" ")))
    )


def _item_name_a() -> Column:
    """Items were renamed in mid 1998: the size lost, then regained, its space."""
    size = F.col("part_size").cast("string")
    old = F.concat(size, F.lit("OZ "), "part_name")
    new = F.concat(size, F.lit(" OZ "), "part_name", F.lit(" "))
    return F.when(F.col("sale_date") < F.lit("1998-07-01").cast("date"), old).otherwise(new)


def _employee_a() -> Column:
    last = F.pmod("employee_no", F.lit(10))
    return (
        F.when(last == 0, F.lit(None).cast("string"))
        .when(last == 1, (F.col("employee_no") + 673508000).cast("string"))
        .otherwise(F.concat(F.lower("employee"), F.lit(" ")))
    )


def _file_a() -> Column:
    return F.concat(F.lit("DDBB_"), F.date_format("sale_date", "MMM_yy"), F.lit(".csv"))


def file_b(settings: Settings) -> Column:
    slug = F.lower(F.regexp_replace("store", " ", "_"))
    brand = settings.brand.slug
    return F.concat(F.lit(f"{brand}-hqaccount_{brand}"), slug, F.lit("_transactions_all.csv"))


def store_aliases(settings: Settings) -> dict[str, str]:
    """Stores whose names hold spaces, as a feed-B file name spells them and as they are."""
    prefix = settings.brand.display_prefix
    return {f"{prefix}{name.replace(' ', '_')}": f"{prefix}{name}" for name in STORE_OF_NATION.values()}


def _void() -> Column:
    return (F.col("line_no") == 7) & (F.col("return_flag") == "R")


def _modifier() -> Column:
    return (F.col("line_no") == 6) & (F.col("return_flag") == "R")


def raw_feed_a(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Bronze rows of the item-line CSV feed."""
    nothing = F.lit(0).cast(MONEY)
    return lines.filter(F.col("feed") == FEED_A).select(
        _location(settings).alias("Location"),
        F.col("sale_date").alias("Date"),
        _employee_a().alias("Employee Name"),
        F.col("part_key").alias("Item ID"),
        _item_name_a().alias("Item Name"),
        (F.col("part_key") * 10).cast("double").alias("Item PLU"),
        F.col("price").alias("Price"),
        F.col("discount").alias("Discount Total"),
        nothing.alias("Promotion Total"),
        F.col("tax").alias("Taxes"),
        F.col("net").alias("Net Sales"),
        F.col("price").alias("Gross Sales"),
        money(F.col("net") + F.col("tax")).alias("Total Sales"),
        _lookup(REVENUE_CENTER_A, F.col("part_type")).alias("Revenue Center"),
        F.lit(False).alias("Has Employee Discount"),
        F.when(
            F.pmod("customer_key", F.lit(50)) != 0, _lookup(DESTINATION_A, F.col("priority"))
        ).alias("Destination"),
        _void().alias("Voided"),
        F.lit(True).alias("Has Customer"),
        _modifier().alias("Is Modifier"),
        F.col("order_key").cast("string").alias("Order ID"),
        _file_a().alias("_source_file"),
        F.lit(FEED_A).alias("_source_system"),
        ingested_at().alias("_ingested_at"),
    )


def _entry_id() -> Column:
    return F.concat_ws(
        "-", "line_no", "part_key", "employee_no", F.col("quantity").cast("int").cast("string")
    )


def _day_part() -> Column:
    return (F.col("part_size") + 640207700).cast("string")


def _order_tax() -> Column:
    return money(F.col("order_total") * F.lit("0.05").cast(MONEY))


def raw_feed_c(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Bronze rows of the order XML feed: ids only, order tax on every entry."""
    none = F.lit(None)
    return lines.filter(F.col("feed") == FEED_C).select(
        _location(settings).alias("Location"),
        F.col("sale_date").alias("Date"),
        (F.pmod("order_key", F.lit(7)) + 5000).cast("string").alias("Employee Name"),
        F.col("part_key").alias("Item ID"),
        none.cast("string").alias("Item Name"),
        none.cast("double").alias("Item PLU"),
        F.col("price").alias("Price"),
        none.cast(MONEY).alias("Discount Total"),
        none.cast(MONEY).alias("Promotion Total"),
        _order_tax().alias("Taxes"),
        F.col("net").alias("Net Sales"),
        F.col("price").alias("Gross Sales"),
        F.col("price").alias("Total Sales"),
        _day_part().alias("Revenue Center"),
        none.cast("boolean").alias("Has Employee Discount"),
        F.substring("priority", 1, 1).alias("Destination"),
        _void().alias("Voided"),
        none.cast("boolean").alias("Has Customer"),
        F.lit(False).alias("Is Modifier"),
        F.col("order_key").cast("string").alias("Order ID"),
        none.cast("string").alias("_source_file"),
        F.lit(FEED_C).alias("_source_system"),
        ingested_at().alias("_ingested_at"),
        _entry_id().alias("entry_id"),
    )


def raw_feed_c_entries(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Flattened entries of the order XML feed, as kept for replay."""
    return lines.filter(F.col("feed") == FEED_C).select(
        F.col("order_key").cast("string").alias("order_id"),
        _entry_id().alias("entry_id"),
        F.col("part_key").cast("string").alias("item_id"),
        _day_part().alias("revenue_center_id"),
        F.col("net").alias("net_sales"),
        F.col("price").alias("gross_sales"),
        F.col("price").alias("display_price"),
        _void().alias("is_voided"),
        F.lit(False).alias("is_deleted"),
        _location(settings).alias("store_name"),
        F.col("sale_date").alias("business_date"),
        ingested_at().alias("_ingested_at"),
    )


def raw_feed_b(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Bronze rows of the one-store-per-file feed: the columns later steps read."""
    returned = F.col("return_flag") == "R"
    sign = F.when(returned, F.lit(-1)).otherwise(F.lit(1))
    kind = (
        F.when(_void(), F.lit("VOID"))
        .when(F.col("line_no") == 3, F.lit("UPDATE"))
        .otherwise(F.lit("SALE"))
    )
    group = F.when(_modifier(), F.lit("Modifiers(7024)")).otherwise(
        _lookup(GROUP_B, F.col("part_type"))
    )
    staff = F.when(F.pmod("employee_no", F.lit(10)) != 0, F.col("employee"))
    rows = lines.filter(F.col("feed") == FEED_B).select(
        F.concat_ws("-", "order_key", "line_no", "part_key", "employee_no").alias("Identifier"),
        F.col("sale_date").alias("Date"),
        F.col("customer_key").cast("string").alias("Account"),
        staff.alias("Staff"),
        F.col("order_key").cast("string").alias("Reference"),
        kind.alias("Type"),
        (F.col("quantity") * sign).cast("decimal(18,3)").alias("Qty"),
        F.col("price").alias("UnitPrice"),
        money(F.col("net") * sign).alias("FinalPrice"),
        F.col("discount").alias("Discount"),
        F.concat(
            F.lit(" "), "part_name", F.lit(" ("), F.col("part_size").cast("string"), F.lit(" oz) m")
        ).alias("Item"),
        group.alias("Group"),
        F.col("tax").alias("TaxAmount"),
        F.concat(F.lit(settings.brand.display_prefix), "store").alias("Location"),
        file_b(settings).alias("_source_file"),
        F.lit(FEED_B).alias("_source_system"),
        ingested_at().alias("_ingested_at"),
    )
    return rows.filter(F.col("Type").isin("SALE", "UPDATE"))


def campaign_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign map derived from the item master: one rule per leading word."""
    word = F.substring_index("p_name", " ", 1)
    rules = {
        "red": ("spring launch", "2000-03-01", "2000-05-31"),
        "blue": ("spring launch", "2000-03-01", "2000-05-31"),
        "hot": ("winter menu", "2000-11-01", None),
        "cold": ("summer menu", None, "1999-08-31"),
        "new": ("all year", None, None),
    }
    items = table(spark, sf_dir, "part").select("p_name").distinct()
    parts = [_lookup({k: v[i] for k, v in rules.items() if v[i]}, word) for i in range(3)]
    return items.select(
        F.col("p_name").alias("product_canonical_name"),
        parts[0].alias("campaign_name"),
        parts[1].cast("date").alias("campaign_start_date"),
        parts[2].cast("date").alias("campaign_end_date"),
    )


# --- the feeds as text, the way the files spell them ---------------------------

# Fixed values of the adapter: item words as dessert spellings.
DESSERT_FIRST = {
    "small": "Mini Gluten Red Velvet",
    "red": "Red Velvet",
    "blue": "Pistashio",
    "hot": "Choc Ganache",
    "old": "Carot",
    "large": "Tiramiso",
    "new": "Ricota",
    "cold": "Strabery",
}
DESSERT_SECOND = {
    "ring": "Cake",
    "widget": "Chees Cake",
    "bolt": "Cupcake",
    "gear": "Tart",
    "gizmo": "Latte",
    "plate": "Ladyfinger",
    "rod": "Brawni Cheesecake",
    "anvil": "Individual",
}


def dessert_name() -> Column:
    words = F.split("part_name", " ")
    return F.concat_ws(
        " ", _lookup(DESSERT_FIRST, words[0]), _lookup(DESSERT_SECOND, words[1])
    )


def _dollars(col: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(col, 2))


def _closed_text(pattern: str) -> Column:
    return F.date_format(F.to_timestamp_ntz(closed_at(), F.lit("yyyy-MM-dd HH:mm")), pattern)


def feed_a_text(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Feed A as its CSV spells it; line 5 of a return shows its money in parentheses."""
    typed = raw_feed_a(lines, settings).schema.names
    minus = (F.col("line_no") == 5) & (F.col("return_flag") == "R")
    shown = F.when(minus, F.concat(F.lit("("), _dollars("net"), F.lit(")"))).otherwise(
        _dollars("net")
    )
    closed = F.when(
        F.pmod("order_key", F.lit(4)) == 0, _closed_text("M/d/yyyy h:mm a")
    ).otherwise(_closed_text("MM/dd/yyyy hh:mm:ss a"))
    flag = lambda c: F.when(c, F.lit("True")).otherwise(F.lit("False"))
    text = {
        "Location": _location(settings),
        "Closed Date/Time": closed,
        "Employee Name": _employee_a(),
        "Item ID": F.col("part_key").cast("string"),
        "Item Name": dessert_name(),
        "Item PLU": (F.col("part_key") * 10).cast("string"),
        "Price": _dollars("price"),
        "Discount Total": _dollars("discount"),
        "Promotion Total": F.lit("$0.00"),
        "Taxes": _dollars("tax"),
        "Net Sales": shown,
        "Gross Sales": _dollars("price"),
        "Total Sales": _dollars(F.col("net") + F.col("tax")),
        "Revenue Center": _lookup(REVENUE_CENTER_A, F.col("part_type")),
        "Has Employee Discount": F.lit("False"),
        "Destination": F.when(
            F.pmod("customer_key", F.lit(50)) != 0, _lookup(DESTINATION_A, F.col("priority"))
        ),
        "Voided": flag(_void()),
        "Has Customer": F.lit("True"),
        "Is Modifier": flag(_modifier()),
        "Order ID": F.col("order_key").cast("string"),
    }
    assert set(text) - {"Closed Date/Time"} <= set(typed)
    return lines.filter(F.col("feed") == FEED_A).select(
        *[c.alias(n) for n, c in text.items()], _file_a().alias("file")
    )


def feed_b_text(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Feed B as its CSV spells it, internal record types included."""
    returned = F.col("return_flag") == "R"
    sign = F.when(returned, F.lit(-1)).otherwise(F.lit(1))
    kind = (
        F.when(_void(), F.lit("VOID"))
        .when(F.col("line_no") == 3, F.lit("UPDATE"))
        .when((F.col("line_no") == 4) & returned, F.lit("TRANSITORY_COMP"))
        .otherwise(F.lit("SALE"))
    )
    known = {
        "Identifier": F.concat_ws("-", "order_key", "line_no", "part_key", "employee_no"),
        "Date": _closed_text("M/d/yy h:mm a"),
        "Account": F.col("customer_key").cast("string"),
        "Staff": F.when(F.pmod("employee_no", F.lit(10)) != 0, F.col("employee")),
        "Reference": F.col("order_key").cast("string"),
        "Type": kind,
        "Qty": (F.col("quantity") * sign).cast("string"),
        "UnitPrice": F.col("price").cast("string"),
        "FinalPrice": (F.col("net") * sign).cast("string"),
        "Discount": F.col("discount").cast("string"),
        "Item": F.when(
            F.col("part_name").startswith("new "), F.lit("Ricotta & Pistachio Cake ")
        ).otherwise(dessert_name()),
        "Group": F.when(_modifier(), F.lit("Modifiers(7024)")).otherwise(
            _lookup(GROUP_B, F.col("part_type"))
        ),
        "TaxAmount": F.col("tax").cast("string"),
    }
    none = F.lit(None).cast("string")
    return lines.filter(F.col("feed") == FEED_B).select(
        *[known.get(n, none).alias(n) for n in FEED_B_COLUMNS], file_b(settings).alias("file")
    )


def nested_orders(lines: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Feed C as nested orders, one drop per store and day, stores spelled as in feed A.

    Collecting entries is bounded by the lines of one order.
    """
    entry = F.struct(
        _entry_id().alias("Id"),
        F.col("part_key").cast("string").alias("ItemId"),
        _day_part().alias("DayPartId"),
        F.col("net").cast("string").alias("ItemNetSales"),
        F.col("price").cast("string").alias("ItemGrossSales"),
        F.col("price").cast("string").alias("DisplayPrice"),
        F.when(_void(), F.lit("true")).otherwise(F.lit("false")).alias("IsVoided"),
        F.lit("false").alias("IsDeleted"),
    )
    header = {
        "Id": F.col("order_key").cast("string"),
        "Number": F.pmod("order_key", F.lit(1000)).cast("string"),
        "IsClosed": F.lit("True"),
        "IsRefund": F.lit("false"),
        "IsVoided": F.lit("false"),
        "Total": F.col("order_total").cast("string"),
        "Tax": _order_tax().cast("string"),
        "ClosedTime": closed_at(),
        "EmployeeId": (F.pmod("order_key", F.lit(7)) + 5000).cast("string"),
        "DestinationId": F.substring("priority", 1, 1),
        "store": _location(settings),
        "date": F.col("sale_date"),
    }
    rows = lines.filter(F.col("feed") == FEED_C).select(
        *[c.alias(n) for n, c in header.items()], entry.alias("entry")
    )
    orders = rows.groupBy(*header).agg(F.collect_list("entry").alias("OrderEntry"))
    return orders.select(
        *[n for n in header if n not in ("store", "date")],
        F.struct("OrderEntry").alias("Entries"),
        "store",
        "date",
    )
