"""Single operators on the built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.functions.measures import ratio, share_of_rows
from tallyhouse.operators import facts
from tallyhouse.operators.facts import ORDER_KEY, attribute_campaigns
from tallyhouse.plans.dashboard import (
    days,
    latest_month,
    month_label,
    net_sum,
    order_sum,
    store_names,
)
from tallyhouse.plans.warehouse import MONTH, Warehouse

# --- joins --------------------------------------------------------------------


def sales_by_store(w: Warehouse) -> DataFrame:
    """Inner lookup of store attributes on already rolled-up keys."""
    rows = w.fact_order.groupBy("store_key").agg(net_sum().alias("net_sales"), order_sum().alias("orders"))
    return store_names(rows, w, "royalty_rate").drop("store_key")


def lines_by_destination(w: Warehouse) -> DataFrame:
    """Left lookup where a missing name falls to the unknown member."""
    names = w.stg_orders.groupBy("destination").agg(F.count("*").alias("lines"))
    dim = w.dim_destination.select("destination_name", "channel", "destination_key")
    name = F.coalesce("destination", F.lit("UNKNOWN"))
    joined = names.join(dim, name == F.col("destination_name"), "left")
    key = F.coalesce("destination_key", F.lit(0)).alias("destination_key")
    return joined.groupBy(key, "channel").agg(F.sum("lines").alias("lines"))


def lines_by_category(w: Warehouse) -> DataFrame:
    """Left lookup on an expression of the line's product name."""
    per_name = w.stg_orders.groupBy(C.tidy("product_name").alias("name")).agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )
    joined = per_name.join(w.dim_product, F.col("name") == F.col("product_name"), "left")
    return joined.groupBy("revenue_center_name").agg(
        F.sum("lines").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def store_days_only_in_xml(w: Warehouse) -> DataFrame:
    """Anti join on two keys."""
    days_c = w.raw_c.groupBy("Location", "Date").agg(F.count("*").alias("lines"))
    gaps = days_c.join(w.raw_a.select("Location", "Date").distinct(), ["Location", "Date"], "left_anti")
    return gaps.select(F.col("Location").alias("location"), F.col("Date").alias("day"), "lines")


def orders_with_detail(w: Warehouse) -> DataFrame:
    """One-to-one join of the order facts.

    The shared month joins too, so each side's months meet only their twins.
    """
    key = [*ORDER_KEY, MONTH]
    detail = w.fact_order_detail.select(*key, "discount_total", "tax_amount")
    both = w.fact_order.join(detail, key)
    return both.groupBy("source_system", "store_key").agg(
        net_sum().alias("net_sales"),
        F.sum("discount_total").alias("discount_total"),
        F.sum("tax_amount").alias("tax_amount"),
        order_sum().alias("orders"),
    )


def net_by_day_both_facts(w: Warehouse) -> DataFrame:
    """Full outer reconciliation of order and employee sales by day."""
    a = w.fact_order.groupBy("date_key").agg(net_sum().alias("order_net"))
    b = w.fact_by_employee.groupBy("date_key").agg(F.sum("net_sales").alias("employee_net"))
    gap = F.coalesce("order_net", F.lit(0)) - F.coalesce("employee_net", F.lit(0))
    return a.join(b, "date_key", "full_outer").withColumn("gap", gap)


def store_share(w: Warehouse) -> DataFrame:
    """Each store against the one-row total, a scalar subquery."""
    rows = w.fact_order.groupBy("store_key").agg(net_sum().alias("net_sales"))
    total = w.fact_order.select(net_sum()).scalar()
    shared = rows.withColumn("share", ratio(F.col("net_sales"), total, 4))
    return store_names(shared, w).select("store_name", "net_sales", "share")


def campaign_sales(w: Warehouse) -> DataFrame:
    """Sales by campaign (J8); lines are one row per product and day before the interval test."""
    daily = w.stg_orders.groupBy("product_canonical_name", "sale_date").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("qty").alias("qty")
    )
    placed = attribute_campaigns(daily, w.dim_campaign, "sale_date")
    name = F.coalesce("campaign_name", F.lit("NO CAMPAIGN")).alias("campaign_name")
    key = F.coalesce("campaign_key", F.lit(0)).alias("campaign_key")
    return placed.groupBy(key, name).agg(
        F.sum("net_sales").alias("net_sales"), F.sum("qty").alias("items_sold")
    )


def latest_months(w: Warehouse) -> DataFrame:
    """Sales of each fact in its own latest month, by a scalar subquery."""

    def last(fact: DataFrame, label: str, measure: str) -> DataFrame:
        rows = fact.filter(F.col(MONTH) == latest_month(fact)).groupBy(MONTH)
        return rows.agg(F.sum(measure).alias("net_sales")).select(
            F.lit(label).alias("fact"), F.col(MONTH).alias("latest_month"), "net_sales"
        )

    return (
        last(w.fact_order, "order", "order_net_sales")
        .unionByName(last(w.fact_sale_item, "item", "item_net_sales"))
        .unionByName(last(w.fact_by_employee, "employee", "net_sales"))
    )


# --- aggregates ---------------------------------------------------------------


def unknown_staff_by_store(w: Warehouse) -> DataFrame:
    """Filtered sum and filtered distinct count, NULL where nothing fits."""
    unknown = F.col("employee_key") == 0
    rows = w.fact_by_employee.groupBy("store_key").agg(
        F.sum(F.when(unknown, F.col("net_sales"))).alias("unknown_net"),
        F.sum(F.when(~unknown, F.col("net_sales"))).alias("named_net"),
        F.count_distinct(F.when(~unknown, F.col("employee_key"))).alias("named_employees"),
    )
    return store_names(rows, w).drop("store_key")


def source_orders_by_month(w: Warehouse) -> DataFrame:
    """Conditional sums with 0 for the other rows."""
    of = lambda tag: F.sum(F.when(F.col("source_system") == tag, F.col("order_count")).otherwise(0))
    rows = w.fact_order.groupBy(MONTH).agg(
        *[of(tag).alias(f"{tag}_orders") for tag in ("feed_a", "feed_b", "feed_c")]
    )
    return rows.select(month_label(), "feed_a_orders", "feed_b_orders", "feed_c_orders")


def order_flags(w: Warehouse) -> DataFrame:
    """Flags per order as the largest of 0 and 1."""
    names = w.dim_product.select("product_key", F.col("revenue_center_name").alias("category"))
    lines = w.fact_sale_item.join(names, "product_key")
    flag = lambda c: F.max(F.when(F.col("category") == c, 1).otherwise(0))
    return lines.groupBy(*ORDER_KEY).agg(
        flag("Beverage").alias("has_beverage"), flag("Food").alias("has_food"),
        flag("Retail").alias("has_retail"),
    )


def null_counts(w: Warehouse) -> DataFrame:
    """Missing values per source."""
    cols = ("destination", "employee_name", "discount_total", "product_name")
    return w.stg_orders.groupBy(F.col("_source_system").alias("source")).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    )


def busy_store_days(w: Warehouse, min_orders: int) -> DataFrame:
    """Groups kept by their own aggregate."""
    rows = w.fact_order.groupBy("store_key", "date_key").agg(
        order_sum().alias("orders"), net_sum().alias("net_sales")
    )
    return store_names(rows.filter(F.col("orders") >= min_orders), w).drop("store_key")


def mean_day_by_store(w: Warehouse) -> DataFrame:
    """Daily sums first, their mean afterwards."""
    daily = w.fact_order.groupBy("store_key", "date_key").agg(
        net_sum().alias("net"), order_sum().alias("orders")
    )
    rows = daily.groupBy("store_key").agg(
        ratio(F.sum("net"), F.count("*"), 2).alias("avg_day"),
        ratio(F.sum("orders"), F.count("*"), 2).alias("avg_orders"),
    )
    return store_names(rows, w).drop("store_key")


def store_by_source(w: Warehouse, fill: bool) -> DataFrame:
    """Pivot over fixed sources; absent cells NULL or 0."""
    rows = w.fact_order.groupBy(MONTH, "store_key", "source_system").agg(net_sum().alias("net"))
    tags = ["feed_a", "feed_b", "feed_c"]
    wide = rows.groupBy(MONTH, "store_key").pivot("source_system", tags).sum("net")
    return store_names(wide.na.fill(0) if fill else wide, w).drop("store_key")


def global_figures(w: Warehouse) -> DataFrame:
    """Distinct and global aggregates over silver."""
    return w.stg_orders.agg(
        F.count("*").alias("lines"),
        F.count_distinct("order_ref").alias("order_refs"),
        F.sum("net_sales").alias("net_sales"),
        F.min("sale_date").alias("first_day"),
        F.max("sale_date").alias("last_day"),
    )


# --- windows ------------------------------------------------------------------


def last_order_per_store(w: Warehouse) -> DataFrame:
    """Latest order of each store.

    The filter on rank 1 becomes a group limit before the shuffle: every task
    passes on one order per store.
    """
    newest = Window.partitionBy("store_key").orderBy(
        F.col("date_key").desc(), F.col("order_id").desc(), "source_system"
    )
    first = w.fact_order.withColumn("rn", F.row_number().over(newest)).filter("rn = 1")
    return store_names(first, w).select("store_name", "date_key", "order_id", "order_net_sales")


def first_category_per_canonical(w: Warehouse) -> DataFrame:
    """One category per canonical product by a fixed priority."""
    priority = (
        F.when(F.col("revenue_center_name") == "Beverage", 1)
        .when(F.col("revenue_center_name") == "Food", 2)
        .when(F.col("revenue_center_name") == "Retail", 3)
        .otherwise(4)
    )
    pairs = w.dim_product.select(
        "product_canonical_name", "revenue_center_name", priority.alias("priority")
    ).distinct()
    order = Window.partitionBy("product_canonical_name").orderBy("priority")
    return pairs.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def store_month_lag(w: Warehouse) -> DataFrame:
    """Previous month of each store."""
    rows = w.fact_order.groupBy("store_key", MONTH).agg(net_sum().alias("net_sales"))
    order = Window.partitionBy("store_key").orderBy(MONTH)
    lagged = rows.withColumn("prev_net_sales", F.lag("net_sales").over(order))
    return store_names(lagged, w).select(
        "store_name", month_label(), "net_sales", "prev_net_sales"
    )


def running_sales(w: Warehouse) -> DataFrame:
    """Running sales over all days.

    Months are summed first, so the ordered pass over one partition sees one row
    per month; days then run inside their month.
    """
    daily = w.fact_order.groupBy(MONTH, "date_key").agg(net_sum().alias("net_sales"))
    monthly = daily.groupBy(MONTH).agg(F.sum("net_sales").alias("_month"))
    before = Window.orderBy(MONTH).rowsBetween(Window.unboundedPreceding, -1)
    starts = monthly.select(MONTH, F.coalesce(F.sum("_month").over(before), F.lit(0)).alias("_start"))
    inside = F.sum("net_sales").over(Window.partitionBy(MONTH).orderBy("date_key"))
    rows = daily.withColumn("_inside", inside).join(starts, MONTH)
    return rows.select(
        "date_key", "net_sales", (F.col("_start") + F.col("_inside")).alias("running_net_sales")
    )


def source_share(w: Warehouse) -> DataFrame:
    """Share of the total over aggregated rows."""
    rows = w.fact_order.groupBy("source_system").agg(net_sum().alias("net_sales"), order_sum().alias("orders"))
    return rows.withColumn("share", share_of_rows("net_sales"))


# --- order, limit, sets ---------------------------------------------------------


def discounts_nulls_last(w: Warehouse) -> DataFrame:
    """Discount by source, unknown discounts at the end."""
    rows = w.fact_order_detail.groupBy("source_system").agg(
        F.sum("discount_total").alias("discount_total")
    )
    return rows.orderBy(F.col("discount_total").desc_nulls_last(), "source_system")


def top_orders(w: Warehouse, k: int) -> DataFrame:
    """Largest orders, ties by key."""
    return w.fact_order.select(*ORDER_KEY, "order_net_sales").orderBy(
        F.col("order_net_sales").desc(), *ORDER_KEY
    ).limit(k)


def weekdays_in_order(w: Warehouse) -> DataFrame:
    """Rows in a hand-written order, weekend first (S3)."""
    daily = w.fact_order.groupBy("date_key").agg(order_sum().alias("orders"))
    rows = days(daily, w, "day_name").groupBy("day_name").agg(F.sum("orders").alias("orders"))
    place = F.when(F.col("day_name") == "Saturday", 1).when(F.col("day_name") == "Sunday", 2)
    return rows.withColumn("place", place.otherwise(3)).orderBy("place", "day_name")


def source_rows(w: Warehouse) -> DataFrame:
    """Union of the feeds that keeps every row."""
    both = w.stg_a.select("_source_system").unionByName(w.stg_b.select("_source_system"))
    return both.groupBy("_source_system").agg(F.count("*").alias("lines"))


def staff_names(w: Warehouse) -> DataFrame:
    """Union of the feeds' staff without duplicates."""
    a = w.raw_a.select(C.tidy("Employee Name").alias("employee_name"))
    b = w.raw_b.select(C.tidy("Staff").alias("employee_name"))
    return a.union(b).distinct()


def distinct_orders_by_level(w: Warehouse) -> DataFrame:
    """Distinct orders of each month, of its stores and of its employees, from one table of orders by cell."""
    stores = facts.distinct_orders(w.order_cells, "sale_month", "store_key")
    staff = facts.distinct_orders(w.order_cells, "sale_month", "employee_key")
    months = facts.distinct_orders(w.order_cells, "sale_month")

    def level(name, rows, member):
        return rows.select(F.lit(name).alias("level"), "sale_month", member.cast("bigint").alias("member_key"), "order_count")

    return level("store", stores, F.col("store_key")).unionByName(level("employee", staff, F.col("employee_key"))).unionByName(level("month", months, F.lit(None)))
