"""Facts (D1-D5) and campaign attribution.

Dimension sides carry no broadcast hint: they are written tables, so Spark
knows their size, broadcasts the ones under its threshold and merge-joins (with
skew splitting) the ones above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.functions.measures import month_start, ratio
from tallyhouse.settings import UNKNOWN
from tallyhouse.storage import settle

ORDER_KEY = ["source_system", "order_id"]
CELL = ("date_key", "store_key", "employee_key")


def keyed_lines(stg: DataFrame) -> DataFrame:
    """Lines that carry an order key."""
    return stg.filter(C.has_text("order_ref"))


def _with_dates(df: DataFrame, dim_date: DataFrame) -> DataFrame:
    dates = dim_date.select("date_key", F.col("date").alias("sale_date"))
    return df.join(dates, "sale_date")


def _with_stores(df: DataFrame, dim_store: DataFrame) -> DataFrame:
    return df.join(dim_store.select("store_key", "store_name"), "store_name")


def _with_member(df: DataFrame, dim: DataFrame, name: Column, dim_name: str, key: str) -> DataFrame:
    """Left lookup of a dimension key by name, 0 where there is none."""
    side = dim.select(F.col(key).alias("_key"), F.col(dim_name).alias("_name"))
    joined = df.join(side, F.coalesce(name, F.lit(UNKNOWN)) == F.col("_name"), "left")
    return joined.withColumn(key, F.coalesce("_key", F.lit(0))).drop("_key", "_name")


ORDER_COLUMNS = (
    "date_key", "store_key", "destination_key", "source_system", "order_id",
    "order_net_sales", "order_count", "_ingested_at", "sale_month",
)
DETAIL_COLUMNS = (
    "date_key", "store_key", "destination_key", "source_system", "order_id",
    "discount_total", "tax_amount", "tip_amount", "_ingested_at", "sale_month",
)


def order_grain(stg, dim_date, dim_store, dim_destination) -> DataFrame:
    """One row per (source, order) with the measures of both order facts.

    Lines are rolled up first and keys looked up afterwards, so names are probed
    once per order. Both facts are column selections of this: built together, they
    cost one scan and one shuffle of the lines.
    """
    money = ("discount_total", "tax_amount", "tip_amount")
    orders = (
        keyed_lines(stg)
        .groupBy(F.col("_source_system").alias("source_system"), F.col("order_ref").alias("order_id"))
        .agg(
            F.max("store_name").alias("store_name"),
            F.max("destination").alias("destination"),
            F.max("sale_date").alias("sale_date"),
            F.sum("net_sales").alias("order_net_sales"),
            *[F.sum(c).alias(c) for c in money],
            F.max("_ingested_at").alias("_ingested_at"),
        )
    )
    placed = _with_stores(_with_dates(orders, dim_date), dim_store)
    keyed = _with_member(
        placed, dim_destination, F.col("destination"), "destination_name", "destination_key"
    )
    return keyed.select(
        *ORDER_COLUMNS[:6], *money, F.lit(1).alias("order_count"), "_ingested_at",
        month_start("sale_date").alias("sale_month"),
    )


def fact_order(stg, dim_date, dim_store, dim_destination) -> DataFrame:
    """Order grain with an additive count of 1."""
    return order_grain(stg, dim_date, dim_store, dim_destination).select(*ORDER_COLUMNS)


def fact_order_detail(stg, dim_date, dim_store, dim_destination) -> DataFrame:
    """Order grain with discount, tax and tip."""
    return order_grain(stg, dim_date, dim_store, dim_destination).select(*DETAIL_COLUMNS)


def _placed_lines(stg, dim_date, dim_store) -> DataFrame:
    return _with_stores(_with_dates(keyed_lines(stg), dim_date), dim_store)


def fact_sale_item(stg, dim_date, dim_store, dim_product, dim_destination) -> DataFrame:
    """Order and product grain; quantity is net of returns."""
    lines = _placed_lines(stg, dim_date, dim_store)
    lines = _with_member(lines, dim_product, C.tidy("product_name"), "product_name", "product_key")
    lines = _with_member(
        lines, dim_destination, F.col("destination"), "destination_name", "destination_key"
    )
    return (
        lines.groupBy(
            "date_key", "store_key", "product_key", "destination_key",
            F.col("_source_system").alias("source_system"),
            F.col("order_ref").alias("order_id"),
            month_start("sale_date").alias("sale_month"),
        )
        .agg(
            F.sum("qty").alias("qty"),
            F.sum("net_sales").alias("item_net_sales"),
            F.max("_ingested_at").alias("_ingested_at"),
        )
    )


def fact_by_employee(stg, dim_date, dim_store, dim_employee) -> DataFrame:
    """Day, store and employee grain; the order count is distinct, so not additive."""
    lines = _placed_lines(stg, dim_date, dim_store)
    lines = _with_member(
        lines, dim_employee, F.col("employee_name"), "employee_name", "employee_key"
    )
    day = lines.groupBy(
        "date_key", "store_key", "employee_key", month_start("sale_date").alias("sale_month")
    ).agg(
        F.sum("net_sales").alias("net_sales"),
        F.count_distinct("order_ref").alias("order_count"),
        F.sum("tip_amount").alias("tip_amount"),
        F.sum("tax_amount").alias("tax_amount"),
        F.sum("discount_total").alias("discount_total"),
        F.max("_ingested_at").alias("_ingested_at"),
    )
    return day.withColumn("avg_ticket", ratio(F.col("net_sales"), F.col("order_count"), 2))


def order_cells(stg, dim_date, dim_store, dim_employee) -> DataFrame:
    """The distinct orders of each day, store and employee, a row each; they count any roll-up exactly.

    Most cells hold an order or two, so a row an order takes far less than a bitmap a cell.
    """
    lines = _with_member(
        _placed_lines(stg, dim_date, dim_store), dim_employee, F.col("employee_name"), "employee_name", "employee_key"
    )
    return lines.select(*CELL, month_start("sale_date").alias("sale_month"), "order_ref").distinct()


#: Name of the table when it held bitmaps of order numbers.
order_bitmaps = order_cells


def distinct_orders(cells: DataFrame, *keys: str) -> DataFrame:
    """Distinct orders by ``keys``, any columns of the cells' grain; equal to a distinct count over the lines.

    By the whole cell the rows are distinct as they are; a coarser level drops repeats first, on the map side where it can.
    """
    rows = cells.select(*keys, "order_ref")
    rows = rows if set(CELL) <= set(keys) else rows.distinct()
    return rows.groupBy(*keys).agg(F.count("*").alias("order_count"))


def legacy_sales_cells(stg, dim_date, dim_store, dim_product, dim_destination) -> DataFrame:
    """Day, store, product and destination cells with distinct orders per cell.

    Kept to show why the count must not be summed: an order with two products
    counts in two cells.
    """
    lines = _placed_lines(stg, dim_date, dim_store)
    lines = _with_member(lines, dim_product, C.tidy("product_name"), "product_name", "product_key")
    lines = _with_member(
        lines, dim_destination, F.col("destination"), "destination_name", "destination_key"
    )
    cells = lines.groupBy("date_key", "store_key", "product_key", "destination_key").agg(
        F.sum("net_sales").alias("net_sales"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum("tip_amount").alias("tip_amount"),
        F.sum("tax_amount").alias("tax_amount"),
        F.sum("discount_total").alias("discount_total"),
    )
    return cells.withColumn("avg_ticket", ratio(F.col("net_sales"), F.col("order_count"), 2))


def attribute_campaigns(sales: DataFrame, campaigns: DataFrame, day: str) -> DataFrame:
    """Left interval join: a missing start or end leaves that side open.

    ``sales`` should already be one row per product and day. A campaign has a row for each month of the
    sales that it meets, and the month is part of the join key: a product's day meets the campaigns of its
    month only, however many campaigns the product ever had, and a long campaign is split over tasks.
    """
    sales = settle(sales)
    first, last = (F.lit(d) for d in sales.agg(F.min(day), F.max(day)).head())
    start, end = F.col("campaign_start_date"), F.col("campaign_end_date")
    spans = campaigns.filter(F.col("product_canonical_name").isNotNull()).select(
        F.col("product_canonical_name").alias("_product"),
        "campaign_key", "campaign_name", "campaign_start_date", "campaign_end_date",
        F.greatest(start, first.cast("date")).alias("_from"), F.least(end, last.cast("date")).alias("_to"),
    )
    months = F.sequence(F.trunc("_from", "MM"), F.trunc("_to", "MM"), F.expr("interval 1 month"))
    binned = spans.filter("_from <= _to").withColumn("_month", F.explode(months)).drop("_from", "_to")
    begun = start.isNull() | (F.col(day) >= start)
    open_ = end.isNull() | (F.col(day) <= end)
    same = (F.col("product_canonical_name") == F.col("_product")) & (F.trunc(F.col(day), "MM") == F.col("_month"))
    return sales.join(binned, same & begun & open_, "left").drop("_product", "_month")
