"""Dashboard reports (Q1-Q52).

Facts are partitioned by month, so a report on the latest month opens one
partition, and a monthly report groups by the partition column without a
calendar join. Money is rolled up on surrogate keys first; names are looked up
on the few rows that remain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.measures import month_start, ratio, rounded, share_of_rows
from tallyhouse.plans import marts
from tallyhouse.plans.warehouse import MONTH, Warehouse, day_key, written_months
from tallyhouse.settings import UNKNOWN

ALL_STORES = "All Stores"

# The size menu and its order.
SIZES = ("All", "12oz", "16oz", "20oz", "24oz", "32oz", "Food")


def net_sum() -> Column:
    return F.sum("order_net_sales")


def order_sum() -> Column:
    return F.sum("order_count")


# --- shared steps ------------------------------------------------------------


def latest_month(fact: DataFrame) -> Column:
    """Last month present, from the folder names: the scan then opens that partition only."""
    months = written_months(fact)
    return F.lit(months[-1] if months else None).cast("date")


def in_latest_month(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col(MONTH) == latest_month(fact))


def between_days(fact: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Day range that also prunes months."""
    return fact.filter(
        F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last))
        & F.col("date_key").between(day_key(first), day_key(last))
    )


def year_to_date(fact: DataFrame, as_of: dt.date) -> DataFrame:
    return between_days(fact, as_of.replace(month=1, day=1), as_of)


def one_store(fact: DataFrame, w: Warehouse, store: str) -> DataFrame:
    chosen = w.dim_store.filter(F.col("store_name") == store).select("store_key")
    return fact.join(chosen, "store_key", "left_semi")


def store_names(df: DataFrame, w: Warehouse, *more: str) -> DataFrame:
    return df.join(w.dim_store.select("store_key", "store_name", *more), "store_key")


def days(df: DataFrame, w: Warehouse, *cols: str) -> DataFrame:
    return df.join(w.dim_date.select("date_key", *cols), "date_key")


def channels(df: DataFrame, w: Warehouse) -> DataFrame:
    return df.join(w.dim_destination, "destination_key")


def products(df: DataFrame, w: Warehouse) -> DataFrame:
    return df.join(w.dim_product, "product_key")


def month_label() -> Column:
    return F.date_format(MONTH, "yyyy-MM").alias("year_month")


def ticket(name: str = "avg_ticket") -> Column:
    return ratio(net_sum(), order_sum(), 2).alias(name)


def sales(name: str = "net_sales") -> Column:
    return net_sum().alias(name)


def orders(name: str = "order_count") -> Column:
    return order_sum().alias(name)


# --- overview ----------------------------------------------------------------


def kpi_current_month(w: Warehouse) -> DataFrame:
    return in_latest_month(w.fact_order).agg(sales(), orders(), ticket())


def kpi_ytd(w: Warehouse) -> DataFrame:
    return year_to_date(w.fact_order, w.as_of).agg(
        sales("net_sales_ytd"), orders("order_count_ytd"), ticket("avg_ticket_ytd")
    )


def kpi_items_current_month(w: Warehouse) -> DataFrame:
    return in_latest_month(w.fact_sale_item).agg(F.sum("qty").alias("items_sold"))


def kpi_items_ytd(w: Warehouse) -> DataFrame:
    ytd = year_to_date(w.fact_sale_item, w.as_of)
    return ytd.agg(F.sum("qty").alias("items_sold_ytd"))


def daily_last_90(w: Warehouse) -> DataFrame:
    """The last day with data and the 89 days before it."""
    fact = w.fact_order
    last_key = in_latest_month(fact).select(F.max("date_key")).scalar()
    last = F.to_date(last_key.cast("string"), "yyyyMMdd")
    first = F.date_sub(last, 89)
    recent = fact.filter(
        (F.col(MONTH) >= month_start(first))
        & (F.col("date_key") >= F.date_format(first, "yyyyMMdd").cast("int"))
    )
    daily = recent.groupBy("date_key").agg(sales())
    return days(daily, w, "date").select("date", "net_sales").orderBy("date")


def net_sales_ytd_daily(w: Warehouse) -> DataFrame:
    """Daily and running sales of the last year with data."""
    fact = w.fact_order
    year = fact.filter(F.col(MONTH) >= F.trunc(latest_month(fact), "YEAR"))
    daily = days(year.groupBy("date_key").agg(sales()), w, "date")
    running = F.sum("net_sales").over(Window.orderBy("date"))
    return daily.select("date", "net_sales", running.alias("cumulative_net_sales")).orderBy("date")


def store_leaderboard_mom(w: Warehouse) -> DataFrame:
    """Latest month against the one before, best growth first."""
    fact = w.fact_order
    this = latest_month(fact)
    before = F.add_months(this, -1)
    two = fact.filter(F.col(MONTH) >= before).groupBy("store_key", MONTH).agg(sales())
    per_store = two.groupBy("store_key").agg(
        F.sum(F.when(F.col(MONTH) == this, F.col("net_sales"))).alias("current_month_sales"),
        F.sum(F.when(F.col(MONTH) == before, F.col("net_sales"))).alias("prev_month_sales"),
    )
    change = F.col("current_month_sales") - F.col("prev_month_sales")
    return (
        store_names(per_store, w)
        .select(
            "store_name",
            F.concat(F.lit("/stores/"), "store_name").alias("store_url"),
            "current_month_sales",
            "prev_month_sales",
            ratio(change, F.col("prev_month_sales"), 4).alias("mom_growth_pct"),
        )
        .orderBy(F.col("mom_growth_pct").desc_nulls_last(), "store_name")
    )


def store_month_matrix(w: Warehouse) -> DataFrame:
    """Store by month matrix, laid out as rows of a fixed schema: every store in every month, absent cells NULL.

    The months that exist decide the pivot's columns; unpivoting them keeps the empty cells.
    """
    months = [f"{m:%Y-%m}" for m in written_months(w.fact_order)]
    cells = w.fact_order.groupBy("store_key", MONTH).agg(sales())
    labelled = store_names(cells, w).select("store_name", month_label(), "net_sales")
    matrix = labelled.groupBy("store_name").pivot("year_month", months).sum("net_sales")
    return unpivoted(matrix, months).orderBy("store_name", "year_month")


def unpivoted(matrix: DataFrame, months: list[str]) -> DataFrame:
    """Rows (store_name, year_month, net_sales) of a matrix; without months there are no rows."""
    if not months:
        return matrix.select("store_name", F.lit("").alias("year_month"), F.lit(None).cast("decimal(38,2)").alias("net_sales")).limit(0)
    return matrix.unpivot("store_name", [F.col(f"`{m}`") for m in months], "year_month", "net_sales")


def store_month_options(w: Warehouse) -> DataFrame:
    return w.dim_store.select("store_name").orderBy("store_name")


def store_monthly_sales(w: Warehouse, store: str) -> DataFrame:
    monthly = one_store(w.fact_order, w, store).groupBy(MONTH).agg(sales())
    return monthly.select(
        F.lit(store).alias("store_name"), F.col(MONTH).alias("month"), month_label(), "net_sales"
    ).orderBy("month")


def labor_efficiency(w: Warehouse) -> DataFrame:
    """Named sales per named employee; a store without named staff keeps a row."""
    fact = in_latest_month(w.fact_by_employee)
    named = F.col("employee_key") != 0
    per_store = fact.groupBy("store_key").agg(
        F.sum(F.when(named, F.col("net_sales"))).alias("net_sales"),
        F.count_distinct(F.when(named, F.col("employee_key"))).alias("active_employees"),
    )
    score = ratio(F.col("net_sales"), F.col("active_employees"), 2)
    return (
        store_names(per_store, w)
        .select("store_name", "net_sales", "active_employees", score.alias("sales_per_employee"))
        .orderBy(F.col("sales_per_employee").desc_nulls_last(), "store_name")
    )


def royalties_current_month(w: Warehouse) -> DataFrame:
    per_store = in_latest_month(w.fact_order).groupBy("store_key").agg(sales())
    due = rounded(F.col("net_sales") * F.col("royalty_rate"), 2)
    return (
        store_names(per_store, w, "royalty_rate")
        .select("store_name", "royalty_rate", "net_sales", due.alias("royalty_due"))
        .orderBy(F.col("royalty_due").desc(), "store_name")
    )


# --- channels ----------------------------------------------------------------


def _by_channel(fact: DataFrame, w: Warehouse) -> DataFrame:
    per_destination = fact.groupBy("destination_key").agg(
        net_sum().alias("order_net_sales"), order_sum().alias("order_count")
    )
    known = channels(per_destination, w).filter(F.col("channel") != "Unknown")
    return known.groupBy("channel").agg(sales(), orders(), ticket())


def channel_comparison(w: Warehouse) -> DataFrame:
    rows = _by_channel(in_latest_month(w.fact_order), w)
    return rows.withColumn("pct_of_total", share_of_rows("net_sales")).orderBy(
        F.col("net_sales").desc(), "channel"
    )


def delivery_leakage(w: Warehouse) -> DataFrame:
    """Discount share of delivery sales, from the two order facts joined one to one.

    Both sides are cut to the latest month before they meet. An order without a
    discount value adds to the sales but not to the leakage base.
    """
    fact = w.fact_order
    this = latest_month(fact)
    delivery = w.dim_destination.filter(F.col("channel") == "Delivery")
    sold = fact.filter(F.col(MONTH) == this).join(
        delivery.select("destination_key", "destination_name"), "destination_key"
    )
    detail = w.fact_order_detail.filter(F.col(MONTH) == this).select(
        "source_system", "order_id", "discount_total"
    )
    both = sold.join(detail, ["source_system", "order_id"])
    base = F.sum(F.col("order_net_sales") + F.col("discount_total"))
    discount = F.sum("discount_total")
    return (
        both.groupBy("destination_name")
        .agg(
            sales(),
            discount.alias("discount_total"),
            ratio(discount, base, 4).alias("discount_leakage_pct"),
        )
        .orderBy(F.col("discount_total").desc_nulls_last(), "destination_name")
    )


def drivethu_monthly(w: Warehouse) -> DataFrame:
    lane = w.dim_destination.filter(F.col("channel") == "Drive-Thru").select("destination_key")
    monthly = w.fact_order.join(lane, "destination_key", "left_semi").groupBy(MONTH)
    rows = monthly.agg(sales(), orders(), ticket())
    return rows.select(month_label(), "net_sales", "order_count", "avg_ticket").orderBy(
        "year_month"
    )


def _unknown_destination(w: Warehouse, unknown_name: str) -> DataFrame:
    unknown = F.sum(F.when(F.col("destination_key") == 0, F.col("order_count")).otherwise(0))
    monthly = w.fact_order.groupBy(MONTH).agg(
        unknown.alias(unknown_name), orders("total_orders"), ratio(unknown, order_sum(), 4).alias("unknown_pct")
    )
    return monthly.select(month_label(), unknown_name, "total_orders", "unknown_pct").orderBy(
        "year_month"
    )


def unknown_destination_trend(w: Warehouse) -> DataFrame:
    return _unknown_destination(w, "unknown_orders")


# --- items -------------------------------------------------------------------


def store_list(w: Warehouse) -> DataFrame:
    everything = w.spark.range(1).select(
        F.lit(ALL_STORES).alias("store_name"), F.lit(0).alias("sort_order")
    )
    each = w.dim_store.select("store_name", F.lit(1).alias("sort_order"))
    return everything.unionByName(each).orderBy("sort_order", "store_name")


def size_options(w: Warehouse) -> DataFrame:
    """The fixed size menu in order."""
    menu = F.explode(
        F.arrays_zip(
            F.array(*[F.lit(s) for s in SIZES]).alias("size_name"),
            F.array(*[F.lit(i) for i in range(len(SIZES))]).alias("sort_order"),
        )
    )
    options = w.spark.range(1).select(menu.alias("m")).select("m.size_name", "m.sort_order")
    return options.orderBy("sort_order")


def size_menu(w: Warehouse) -> DataFrame:
    """The size menu with the number of products behind each entry."""
    counts = w.dim_product.agg(*[F.count_if(_size_test(s)).alias(s) for s in SIZES])
    wide = ", ".join(f"'{s}', `{s}`" for s in SIZES)
    long = counts.select(F.expr(f"stack({len(SIZES)}, {wide}) as (size_name, products)"))
    return size_options(w).join(long, "size_name").orderBy("sort_order")


def _size_test(size: str) -> Column:
    if size == "All":
        return F.lit(True)
    if size == "Food":
        return F.col("revenue_center_name") == "Food"
    ounces = size.removesuffix("oz")
    name = F.col("product_name")
    return name.startswith(f"{ounces} OZ ") | name.startswith(f"{ounces}OZ ")


def _store_filter(fact: DataFrame, w: Warehouse, store: str) -> DataFrame:
    return fact if store in (ALL_STORES, "") else one_store(fact, w, store)


def overall_performance(w: Warehouse, store: str = ALL_STORES) -> DataFrame:
    per_store = (
        _store_filter(w.fact_sale_item, w, store)
        .groupBy("store_key")
        .agg(F.sum("item_net_sales").alias("net_sales"), F.sum("qty").alias("items_sold"))
    )
    return store_names(per_store, w).select("store_name", "net_sales", "items_sold").orderBy(
        F.col("net_sales").desc(), "store_name"
    )


def size_breakdown(w: Warehouse, store: str = ALL_STORES, size: str = "All") -> DataFrame:
    """Top 200 products of a size by net sales with their share of that selection.

    The total is a scalar subquery; no window gathers the products in one task.
    Size variants stay separate rows of one canonical name.
    """
    chosen = w.dim_product.filter((F.col("product_name") != UNKNOWN) & _size_test(size))
    per_product = (
        _store_filter(w.fact_sale_item, w, store)
        .groupBy("product_key")
        .agg(F.sum("item_net_sales").alias("net_sales"), F.sum("qty").alias("items_sold"))
        .join(chosen, "product_key")
    )
    total = per_product.agg(F.sum("net_sales")).scalar()
    return (
        per_product.filter("net_sales > 0")
        .orderBy(F.col("net_sales").desc(), "product_name")
        .limit(200)
        .select(
            "product_canonical_name",
            "revenue_center_name",
            "net_sales",
            "items_sold",
            ratio(F.col("net_sales"), total, 4).alias("pct_of_sales"),
        )
    )


# --- menu --------------------------------------------------------------------


def attachment_rate_kpi(w: Warehouse) -> DataFrame:
    beverage, paired = F.sum("beverage_orders"), F.sum("paired_orders")
    return marts.attachment_rate_monthly(w).agg(
        beverage.alias("beverage_orders"),
        paired.alias("paired_orders"),
        ratio(paired, beverage, 4).alias("attachment_rate_pct"),
    )


def attachment_rate_trend(w: Warehouse) -> DataFrame:
    return marts.attachment_rate_monthly(w).select(
        "year_month", "beverage_orders", "paired_orders", "attachment_rate_pct"
    ).orderBy("year_month")


def _items_since(w: Warehouse, start: dt.date) -> DataFrame:
    return w.fact_sale_item.filter(
        (F.col(MONTH) >= F.lit(start.replace(day=1))) & (F.col("date_key") >= day_key(start))
    )


def retail_evolution(w: Warehouse, start: dt.date = dt.date(2024, 7, 1)) -> DataFrame:
    retail = w.dim_product.filter("revenue_center_name = 'Retail'").select("product_key")
    monthly = _items_since(w, start).join(retail, "product_key", "left_semi").groupBy(MONTH)
    rows = monthly.agg(F.sum("item_net_sales").alias("net_sales"), F.sum("qty").alias("items_sold"))
    return rows.select(month_label(), "net_sales", "items_sold").orderBy("year_month")


def product_mix_by_category(w: Warehouse, start: dt.date = dt.date(2024, 7, 1)) -> DataFrame:
    per_product = _items_since(w, start).groupBy(MONTH, "product_key").agg(
        F.sum("item_net_sales").alias("net_sales")
    )
    four = products(per_product, w).filter(
        F.col("revenue_center_name").isin("Beverage", "Food", "Retail", "Other")
    )
    rows = four.groupBy(MONTH, "revenue_center_name").agg(F.sum("net_sales").alias("net_sales"))
    return rows.select(month_label(), "revenue_center_name", "net_sales").orderBy(
        "year_month", "revenue_center_name"
    )


def _latest_items_by_product(w: Warehouse) -> DataFrame:
    per_product = in_latest_month(w.fact_sale_item).groupBy("product_key").agg(
        F.sum("item_net_sales").alias("item_net_sales"), F.sum("qty").alias("qty")
    )
    return products(per_product, w)


def top_products_by_revenue(w: Warehouse, k: int = 30) -> DataFrame:
    net, qty = F.sum("item_net_sales"), F.sum("qty")
    named = _latest_items_by_product(w).filter(F.col("product_name") != UNKNOWN)
    rows = named.groupBy("product_canonical_name", "revenue_center_name").agg(
        net.alias("net_sales"), qty.alias("items_sold"), ratio(net, qty, 2).alias("avg_unit_price")
    )
    return rows.orderBy(
        F.col("net_sales").desc(), "product_canonical_name", "revenue_center_name"
    ).limit(k)


def category_volume(w: Warehouse) -> DataFrame:
    rows = _latest_items_by_product(w).groupBy(
        F.col("revenue_center_name").alias("revenue_center")
    ).agg(F.sum("qty").alias("total_qty"), F.sum("item_net_sales").alias("net_sales"))
    return rows.withColumn("pct_of_total", share_of_rows("net_sales")).orderBy(
        F.col("net_sales").desc(), "revenue_center"
    )


# --- operations --------------------------------------------------------------


def recent_month(w: Warehouse) -> DataFrame:
    return w.fact_by_employee.agg(F.max(MONTH).alias("month_start"))


def _named_staff(w: Warehouse) -> DataFrame:
    """Employee-store totals of the latest month, unknown staff left out."""
    fact = in_latest_month(w.fact_by_employee).filter("employee_key <> 0")
    return fact.groupBy("employee_key", "store_key").agg(
        F.sum("net_sales").alias("net_sales"),
        F.sum("order_count").alias("orders"),
        F.sum("discount_total").alias("discount_total"),
        F.sum(F.col("net_sales") + F.col("discount_total")).alias("gross"),
    )


def _staff_names(df: DataFrame, w: Warehouse) -> DataFrame:
    return store_names(df.join(w.dim_employee, "employee_key"), w)


def upselling_leaderboard(w: Warehouse, min_orders: int = 20, k: int = 20) -> DataFrame:
    busy = _named_staff(w).filter(F.col("orders") >= min_orders)
    ranked = busy.withColumn("avg_ticket", ratio(F.col("net_sales"), F.col("orders"), 2))
    return (
        _staff_names(ranked, w)
        .select("employee_name", "store_name", "net_sales", "orders", "avg_ticket")
        .orderBy(F.col("avg_ticket").desc(), "employee_name", "store_name")
        .limit(k)
    )


def discount_audit(w: Warehouse, k: int = 20) -> DataFrame:
    rows = _named_staff(w).withColumn(
        "discount_pct", ratio(F.col("discount_total"), F.col("gross"), 4)
    )
    return (
        _staff_names(rows, w)
        .select("employee_name", "store_name", "discount_total", "net_sales", "discount_pct")
        .orderBy(F.col("discount_total").desc_nulls_last(), "employee_name", "store_name")
        .limit(k)
    )


def shift_productivity(w: Warehouse) -> DataFrame:
    """Orders per employee-day, the finest grain the feeds allow."""
    fact = in_latest_month(w.fact_by_employee).filter("employee_key <> 0")
    per_store = fact.groupBy("store_key").agg(
        F.sum("order_count").alias("total_orders"), F.count("*").alias("employee_days")
    )
    rate = ratio(F.col("total_orders"), F.col("employee_days"), 1)
    return (
        store_names(per_store, w)
        .select("store_name", "total_orders", "employee_days", rate.alias("orders_per_employee_day"))
        .orderBy(F.col("orders_per_employee_day").desc(), "store_name")
    )


# --- one store ---------------------------------------------------------------


def store_kpis(w: Warehouse, store: str) -> DataFrame:
    fact = w.fact_order
    month = fact.filter(F.col(MONTH) == latest_month(fact))
    return one_store(month, w, store).agg(sales("net_sales_cm"), ticket("avg_ticket_cm"))


def store_kpi_ytd(w: Warehouse, store: str) -> DataFrame:
    """The whole year of the reporting date, without an upper day."""
    year = w.as_of.year
    fact = between_days(w.fact_order, dt.date(year, 1, 1), dt.date(year, 12, 31))
    return one_store(fact, w, store).agg(sales("net_sales_ytd"))


def store_net_sales_history(w: Warehouse, store: str) -> DataFrame:
    monthly = one_store(w.fact_order, w, store).groupBy(F.col(MONTH).alias("month"))
    return monthly.agg(sales(), orders()).orderBy("month")


def dow_heatmap(w: Warehouse, store: str) -> DataFrame:
    """Mean day per weekday and month over the year before the reporting date."""
    as_of = w.as_of
    leap_day = as_of.month == 2 and as_of.day == 29
    first = as_of.replace(year=as_of.year - 1, day=28 if leap_day else as_of.day)
    recent = w.fact_order.filter(
        (F.col(MONTH) >= F.lit(first.replace(day=1))) & (F.col("date_key") >= day_key(first))
    )
    daily = one_store(recent, w, store).groupBy("date_key").agg(sales(), orders())
    named = days(daily, w, "day_name", "day_of_week", "month_name", "month", "year")
    grid = named.groupBy(
        F.col("day_name").alias("day_of_week"),
        F.col("day_of_week").alias("dow_num"),
        "month_name",
        F.col("month").alias("month_num"),
        "year",
    ).agg(
        ratio(F.sum("net_sales"), F.count("*"), 2).alias("avg_daily_sales"),
        ratio(F.sum("order_count"), F.count("*"), 1).alias("avg_orders"),
    )
    period = F.concat_ws(" ", F.col("year").cast("string"), "month_name")
    return grid.withColumn("period", period).orderBy("year", "month_num", "dow_num")


def category_mix(w: Warehouse, store: str) -> DataFrame:
    fact = w.fact_sale_item
    month = one_store(fact.filter(F.col(MONTH) == latest_month(fact)), w, store)
    per_product = month.groupBy("product_key").agg(F.sum("item_net_sales").alias("net_sales"))
    three = products(per_product, w).filter(
        F.col("revenue_center_name").isin("Beverage", "Food", "Retail")
    )
    rows = three.groupBy("revenue_center_name").agg(F.sum("net_sales").alias("net_sales"))
    return rows.withColumn("pct_of_total", share_of_rows("net_sales")).orderBy(
        F.col("net_sales").desc(), "revenue_center_name"
    )


def channels_this_store(w: Warehouse, store: str) -> DataFrame:
    fact = w.fact_order
    month = one_store(fact.filter(F.col(MONTH) == latest_month(fact)), w, store)
    return _by_channel(month, w).orderBy(F.col("net_sales").desc(), "channel")


def top_employees(w: Warehouse, store: str, k: int = 10) -> DataFrame:
    fact = w.fact_by_employee
    month = one_store(fact.filter(F.col(MONTH) == latest_month(fact)), w, store)
    staff = month.filter("employee_key <> 0").groupBy("employee_key").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("order_count").alias("orders")
    )
    rows = staff.join(w.dim_employee, "employee_key").select(
        "employee_name",
        "net_sales",
        "orders",
        ratio(F.col("net_sales"), F.col("orders"), 2).alias("avg_ticket"),
    )
    return rows.orderBy(F.col("net_sales").desc(), "employee_name").limit(k)


# --- trends ------------------------------------------------------------------


def _monthly(w: Warehouse) -> DataFrame:
    rows = w.fact_order.groupBy(MONTH).agg(sales(), orders())
    return rows.select(
        F.year(MONTH).alias("year"),
        F.month(MONTH).alias("month"),
        F.date_format(MONTH, "MMMM").alias("month_name"),
        month_label(),
        "net_sales",
        "order_count",
    )


def monthly_sales(w: Warehouse) -> DataFrame:
    return _monthly(w).orderBy("year", "month")


def mom_growth(w: Warehouse) -> DataFrame:
    """Growth on the previous month with data; a window over months only."""
    order = Window.orderBy("year", "month")
    lagged = _monthly(w).select(
        "*",
        F.lag("net_sales").over(order).alias("prev_net_sales"),
        F.lag("order_count").over(order).alias("prev_order_count"),
    )
    d_sales = F.col("net_sales") - F.col("prev_net_sales")
    d_orders = F.col("order_count") - F.col("prev_order_count")
    return lagged.select(
        "year_month", "month_name", "year", "net_sales", "order_count", "prev_net_sales",
        ratio(d_sales, F.col("prev_net_sales"), 4).alias("mom_sales_pct"),
        ratio(d_orders, F.col("prev_order_count"), 4).alias("mom_orders_pct"),
    ).orderBy("year_month")


def yoy_comparison(w: Warehouse, years: tuple[int, ...] = (2024, 2025, 2026)) -> DataFrame:
    chosen = w.fact_order.filter(F.year(MONTH).isin(*years)).groupBy(MONTH).agg(sales(), orders())
    return chosen.select(
        F.month(MONTH).alias("month"),
        F.date_format(MONTH, "MMMM").alias("month_name"),
        F.year(MONTH).cast("string").alias("year"),
        "net_sales",
        "order_count",
    ).orderBy("month", "year")


def _daily(w: Warehouse) -> DataFrame:
    return w.fact_order.groupBy("date_key").agg(sales(), orders())


def day_of_week(w: Warehouse) -> DataFrame:
    net, count = F.sum("net_sales"), F.sum("order_count")
    rows = days(_daily(w), w, "day_of_week", "day_name").groupBy("day_of_week", "day_name").agg(
        ratio(net, F.count("*"), 2).alias("avg_net_sales"),
        ratio(count, F.count("*"), 1).alias("avg_orders"),
        ratio(net, count, 2).alias("avg_ticket"),
    )
    return rows.orderBy("day_of_week")


def weekend_vs_weekday(w: Warehouse) -> DataFrame:
    net, count = F.sum("net_sales"), F.sum("order_count")
    rows = days(_daily(w), w, "is_weekend").groupBy("is_weekend").agg(
        ratio(net, F.count("*"), 2).alias("avg_daily_sales"),
        ratio(count, F.count("*"), 1).alias("avg_daily_orders"),
        ratio(net, count, 2).alias("avg_ticket"),
    )
    kind = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return rows.orderBy("is_weekend").select(
        kind.alias("day_type"), "avg_daily_sales", "avg_daily_orders", "avg_ticket"
    )


def quarterly_sales(w: Warehouse) -> DataFrame:
    rows = w.fact_order.groupBy(
        F.year(MONTH).alias("year"), F.quarter(MONTH).alias("quarter")
    ).agg(sales(), orders(), ticket())
    period = F.concat(F.col("year").cast("string"), F.lit(" Q"), F.col("quarter").cast("string"))
    return rows.withColumn("period", period).orderBy("year", "quarter")


# --- data quality ------------------------------------------------------------


def source_reconciliation(w: Warehouse) -> DataFrame:
    per_row = ratio(F.col("net_sales"), F.col("row_count"), 2)
    return (
        marts.source_summary(w)
        .withColumnRenamed("_source_system", "source")
        .withColumn("avg_net_sales_per_row", per_row)
        .orderBy(F.col("net_sales").desc(), "source")
    )


def source_by_month_data(w: Warehouse) -> DataFrame:
    return marts.source_by_month(w).select(
        "source", "year_month", "net_sales", "order_count"
    ).orderBy("year_month", "source")


def _unknown_staff(fact: DataFrame, key: str) -> DataFrame:
    unknown = F.sum(F.when(F.col("employee_key") == 0, F.col("net_sales")))
    total = F.sum("net_sales")
    return fact.groupBy(key).agg(
        unknown.alias("unknown_net_sales"),
        total.alias("total_net_sales"),
        ratio(unknown, total, 4).alias("unknown_pct"),
    )


def unknown_employee_by_month(w: Warehouse) -> DataFrame:
    rows = _unknown_staff(w.fact_by_employee, MONTH)
    return rows.select(
        month_label(), "unknown_net_sales", "total_net_sales", "unknown_pct"
    ).orderBy("year_month")


def unknown_employee_by_store(w: Warehouse) -> DataFrame:
    rows = _unknown_staff(in_latest_month(w.fact_by_employee), "store_key")
    return store_names(rows, w).select(
        "store_name", "unknown_net_sales", "total_net_sales", "unknown_pct"
    ).orderBy(F.col("unknown_pct").desc_nulls_last(), "store_name")


def unknown_destination(w: Warehouse) -> DataFrame:
    return _unknown_destination(w, "unknown_dest_orders")


def unknown_totals(w: Warehouse) -> DataFrame:
    staff = w.dim_employee.filter(F.col("employee_name") == UNKNOWN)
    return w.fact_order.filter("destination_key = 0").agg(
        staff.select(F.count("*")).scalar().alias("unknown_employee_rows"),
        orders("unknown_dest_orders"),
    )


def freshness_monitor(w: Warehouse, k: int = 20) -> DataFrame:
    return marts.freshness_data(w).orderBy(
        F.col("loaded_at").desc(), "source_name", "filename"
    ).limit(k)


def freshness_summary(w: Warehouse) -> DataFrame:
    return marts.freshness_data(w).groupBy("source_name").agg(
        F.max("loaded_at").alias("last_loaded_at"),
        F.sum("row_count").alias("total_rows_ingested"),
        F.count("*").alias("files_processed"),
    ).orderBy(F.col("last_loaded_at").desc(), "source_name")


def data_watermark(w: Warehouse) -> DataFrame:
    ends = w.fact_order.agg(F.max("date_key").alias("hi"), F.min("date_key").alias("lo"))
    last, first = [F.to_date(F.col(c).cast("string"), "yyyyMMdd") for c in ("hi", "lo")]
    return ends.select(
        last.alias("latest_sale_date"),
        first.alias("earliest_sale_date"),
        F.datediff(F.lit(w.as_of), last).alias("days_since_last_data"),
    )
