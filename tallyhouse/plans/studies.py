"""Ad-hoc analyses over the feed text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import parsing as P
from tallyhouse.functions.classify import PRODUCTS, classify_by_keyword, classify_by_name
from tallyhouse.functions.measures import ratio, share_of_rows
from tallyhouse.settings import FEED_A, FEED_B
from tallyhouse.storage import settle


def _zero() -> Column:
    return F.lit(0).cast(P.MONEY)


# --- dessert sales (P3, P4) -----------------------------------------------------


def food_fact(a: DataFrame, b: DataFrame, feed_b_store: str = "Feed B") -> DataFrame:
    """Classified lines of both feeds; money that is no number counts as 0.

    Feed A loses rows without a readable date, feed B keeps its sales only.
    """
    live = a.filter(P.flag_is_false("Voided") & P.flag_is_false("Is Modifier"))
    sold = b.filter(F.col("Type") == "SALE")
    from_a = _classified(live, "Item Name", classify_by_keyword).select(
        P.parse_mixed_date("Closed Date/Time").alias("sale_date"),
        F.col("Location").alias("location"),
        F.col("product"),
        F.coalesce(P.clean_currency("Net Sales"), _zero()).alias("net_sales"),
        F.col("Item Name").alias("item_name"),
        F.lit(FEED_A).alias("source"),
    ).filter(F.col("sale_date").isNotNull())
    from_b = _classified(sold, "Item", classify_by_name).select(
        P.parse_any_date("Date").alias("sale_date"),
        F.lit(feed_b_store).alias("location"),
        F.col("product"),
        F.coalesce(F.col("FinalPrice").try_cast(P.MONEY), _zero()).alias("net_sales"),
        F.col("Item").alias("item_name"),
        F.lit(FEED_B).alias("source"),
    )
    return from_a.unionByName(from_b)


def _classified(lines: DataFrame, item: str, classify: Callable[[str], Column]) -> DataFrame:
    """Lines whose item has a class, with the class.

    The ladder of patterns runs once per distinct name of the menu, not per line.
    """
    names = settle(lines.select(item).distinct().select(item, classify(item).alias("product")))
    return lines.join(names.filter(F.col("product").isNotNull()), item)


def _month() -> Column:
    return F.date_format("sale_date", "yyyy-MM").alias("month")


def _totals() -> list[Column]:
    return [F.sum("net_sales").alias("net_sales"), F.count("*").alias("units")]


def _per_unit() -> Column:
    return ratio(F.col("net_sales"), F.col("units"), 2).alias("avg_ticket")


def food_by_month(food: DataFrame) -> DataFrame:
    return food.groupBy(_month(), "product").agg(*_totals()).orderBy("month", "product")


def food_pivot(food: DataFrame, measure: str = "net_sales") -> DataFrame:
    """Month rows, one column per product in report order, 0 where nothing sold."""
    wide = food_by_month(food).groupBy("month").pivot("product", list(PRODUCTS)).sum(measure)
    return wide.na.fill(0).orderBy("month")


def food_by_month_store(food: DataFrame) -> DataFrame:
    rows = food.groupBy(_month(), "location", "product").agg(*_totals())
    return rows.withColumn("avg_ticket", _per_unit()).orderBy("month", "location", "product")


def food_by_store(food: DataFrame) -> DataFrame:
    rows = food.groupBy("location", "product").agg(F.sum("net_sales").alias("net_sales"))
    return rows.orderBy(F.col("net_sales").desc(), "location", "product")


def food_totals(food: DataFrame) -> DataFrame:
    """Products in report order; one that never sold shows no totals."""
    rows = food.groupBy("product").agg(*_totals()).withColumn("avg_ticket", _per_unit())
    menu = F.posexplode(F.array(*[F.lit(p) for p in PRODUCTS])).alias("rank", "product")
    listed = food.sparkSession.range(1).select(menu)
    return listed.join(rows, "product", "left").orderBy("rank")


# --- drive-thru against the rest (P5, P6) ----------------------------------------


def channel_lines(a: DataFrame, store: str) -> DataFrame:
    """Live lines of the stores whose name holds ``store``, modifiers included."""
    lane = F.coalesce(F.col("Destination") == "DRIVE THRU", F.lit(False))
    return a.filter(F.col("Location").contains(store) & P.flag_is_false("Voided")).select(
        P.parse_mixed_date("Closed Date/Time").alias("day"),
        F.col("Destination").alias("destination"),
        P.accounting_or_zero("Net Sales").alias("net_sales"),
        lane.alias("drive_thru"),
        P.flag_is_false("Is Modifier").alias("is_item"),
    )


def _channel_split(lines: DataFrame, *keys: Column | str) -> DataFrame:
    lane, item, net = F.col("drive_thru"), F.col("is_item"), F.col("net_sales")
    return lines.groupBy(*keys).agg(
        F.sum(F.when(lane, net).otherwise(_zero())).alias("drive_sales"),
        F.count_if(lane & item).alias("drive_items"),
        F.sum(F.when(~lane, net).otherwise(_zero())).alias("other_sales"),
        F.count_if(~lane & item).alias("other_items"),
        F.sum(net).alias("total_sales"),
        F.count_if(item).alias("total_items"),
    )


def channel_daily(lines: DataFrame) -> DataFrame:
    return _channel_split(lines, "day").orderBy("day")


def channel_weekly(lines: DataFrame) -> DataFrame:
    """Weeks start on Monday."""
    week = F.date_trunc("week", "day").cast("date").alias("week_start")
    return _channel_split(lines, week).orderBy("week_start")


def channel_checks(lines: DataFrame) -> DataFrame:
    """Totals of the daily, the weekly and the raw rows; ``agrees`` is the cross-check."""

    def whole(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(
            F.lit(name).alias("level"),
            F.sum("drive_sales").alias("drive_sales"),
            F.sum("total_sales").alias("total_sales"),
            F.sum("total_items").alias("total_items"),
        )

    levels = (
        whole(channel_daily(lines), "daily")
        .unionByName(whole(channel_weekly(lines), "weekly"))
        .unionByName(whole(_channel_split(lines), "raw"))
    )
    three = Window.partitionBy()
    equal = F.lit(True)
    for measure in ("drive_sales", "total_sales", "total_items"):
        equal = equal & F.min(measure).over(three).eqNullSafe(F.max(measure).over(three))
    return levels.withColumn("agrees", equal)


def destination_breakdown(lines: DataFrame) -> DataFrame:
    known = lines.filter(F.col("destination").isNotNull())
    return known.groupBy("destination").agg(F.sum("net_sales").alias("net_sales")).orderBy(
        F.col("net_sales").desc(), "destination"
    )


# --- hours of the day (P7, P8) ----------------------------------------------------


def hourly_lines(a: DataFrame, store_like: str) -> DataFrame:
    closed = P.parse_mixed_ts("Closed Date/Time")
    live = P.flag_is_false("Voided") & P.flag_is_false("Is Modifier")
    return a.filter(F.col("Location").like(store_like) & live).select(
        F.hour(closed).alias("hour"),
        F.to_date(closed).alias("sale_date"),
        F.col("Order ID").alias("order_id"),
        P.clean_accounting("Net Sales").alias("net_sales"),
    )


def _hour_label() -> Column:
    return F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00"))


def _orders_and_net() -> list[Column]:
    return [F.count_distinct("order_id").alias("orders"), F.sum("net_sales").alias("net_sales")]


def hourly_summary(lines: DataFrame) -> DataFrame:
    rows = lines.groupBy("hour").agg(*_orders_and_net())
    return rows.select(
        "hour",
        _hour_label().alias("hour_label"),
        "orders",
        "net_sales",
        ratio(F.col("net_sales"), F.col("orders"), 2).alias("avg_ticket"),
        (share_of_percent("net_sales")).alias("pct_of_sales"),
    ).orderBy("hour")


def share_of_percent(measure: str) -> Column:
    """Share of the total in percent with two places, over at most 24 rows."""
    return (share_of_rows(measure, places=4) * 100).cast("decimal(18,2)")


def hourly_by_month(lines: DataFrame) -> DataFrame:
    """Hours by calendar month, months in calendar order inside an hour."""
    rows = lines.groupBy(
        F.date_format("sale_date", "MMMM").alias("month"),
        F.month("sale_date").alias("month_no"),
        "hour",
    ).agg(*_orders_and_net())
    return rows.withColumn("hour_label", _hour_label()).orderBy("hour", "month_no")


def daily_summary(lines: DataFrame) -> DataFrame:
    rows = lines.groupBy(
        "sale_date", F.date_format("sale_date", "EEEE").alias("day_of_week")
    ).agg(*_orders_and_net())
    return rows.orderBy("sale_date")


# --- one item (P9, P10) -------------------------------------------------------------


def item_lines(
    a: DataFrame, store_like: str, item: str, first: dt.date, before: dt.date
) -> DataFrame:
    """Live lines of one item in ``[first, before)``, item compared without case."""
    closed = P.parse_mixed_ts("Closed Date/Time")
    day = F.to_date(closed)
    chosen = a.filter(
        F.col("Location").like(store_like)
        & (F.lower("Item Name") == item.lower())
        & P.flag_is_false("Voided")
    )
    return chosen.select(
        day.alias("sale_date"),
        F.col("Employee Name").alias("employee"),
        F.col("Destination").alias("destination"),
        F.col("Order ID").alias("order_id"),
        P.clean_accounting("Net Sales").alias("net_sales"),
        P.clean_accounting("Discount Total").alias("discount_total"),
        P.clean_accounting("Gross Sales").alias("gross_sales"),
    ).filter((F.col("sale_date") >= F.lit(first)) & (F.col("sale_date") < F.lit(before)))


def _item_measures(mean: bool = False) -> list[Column]:
    average = [ratio(F.sum("net_sales"), F.count("net_sales"), 2).alias("avg_net_sales")]
    return [
        F.count("*").alias("transactions"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("net_sales").alias("net_sales"),
        *(average if mean else []),
        F.sum("gross_sales").alias("gross_sales"),
        F.sum("discount_total").alias("total_discounts"),
    ]


def item_daily(lines: DataFrame) -> DataFrame:
    return lines.groupBy("sale_date").agg(*_item_measures(mean=True)).orderBy("sale_date")


def item_weekly(lines: DataFrame) -> DataFrame:
    week = F.date_trunc("week", "sale_date").cast("date").alias("week_start")
    return lines.groupBy(week).agg(*_item_measures()).orderBy("week_start")


def item_monthly(lines: DataFrame) -> DataFrame:
    rows = lines.groupBy(
        F.date_format("sale_date", "yyyy-MM").alias("year_month"),
        F.date_format("sale_date", "MMMM").alias("month_name"),
    ).agg(*_item_measures())
    return rows.orderBy("year_month")


def item_by_employee(lines: DataFrame) -> DataFrame:
    return lines.groupBy("employee").agg(
        F.count("*").alias("transactions"),
        F.sum("net_sales").alias("net_sales"),
        ratio(F.sum("net_sales"), F.count("net_sales"), 2).alias("avg_net_sales"),
    ).orderBy(F.col("net_sales").desc(), "employee")


def item_by_destination(lines: DataFrame) -> DataFrame:
    return lines.groupBy("destination").agg(
        F.count("*").alias("transactions"), F.sum("net_sales").alias("net_sales")
    ).orderBy(F.col("net_sales").desc(), "destination")
