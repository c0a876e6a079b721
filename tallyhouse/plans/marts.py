"""Source marts (M1-M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.functions.measures import ratio
from tallyhouse.plans.warehouse import MONTH, Warehouse


def attachment_rate_monthly(w: Warehouse) -> DataFrame:
    """Share of orders with a beverage that also hold food, by month.

    Grouped by ``order_id``, which in feed B is the account, as the report
    defines it. Flags are integers, so both aggregates hash and combine early.
    """
    names = w.dim_product.select(
        F.col("product_name").alias("_name"), F.col("revenue_center_name").alias("category")
    )
    lines = w.stg_orders.filter("net_sales > 0").join(
        names, C.tidy("product_name") == F.col("_name")
    )
    orders = lines.groupBy("order_id", "sale_date", MONTH).agg(
        F.max(F.when(F.col("category") == "Beverage", 1).otherwise(0)).alias("drink"),
        F.max(F.when(F.col("category") == "Food", 1).otherwise(0)).alias("food"),
    )
    beverage = F.count_if(F.col("drink") == 1)
    paired = F.count_if((F.col("drink") == 1) & (F.col("food") == 1))
    rows = orders.groupBy(MONTH).agg(
        beverage.alias("beverage_orders"),
        paired.alias("paired_orders"),
        ratio(paired, beverage, 4).alias("attachment_rate_pct"),
    )
    return rows.select(
        F.date_format(MONTH, "yyyy-MM").alias("year_month"),
        F.col(MONTH).alias("month_date"),
        "beverage_orders",
        "paired_orders",
        "attachment_rate_pct",
    ).orderBy("month_date")


def source_by_month(w: Warehouse) -> DataFrame:
    rows = w.stg_orders.filter("net_sales > 0").groupBy(
        F.col("_source_system").alias("source"), MONTH
    ).agg(F.sum("net_sales").alias("net_sales"), F.count_distinct("order_id").alias("order_count"))
    return rows.select(
        "source", F.date_format(MONTH, "yyyy-MM").alias("year_month"), "net_sales", "order_count"
    ).orderBy("year_month", "source")


def source_summary(w: Warehouse) -> DataFrame:
    return w.stg_orders.groupBy("_source_system").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count("*").alias("row_count"),
        F.sum("net_sales").alias("net_sales"),
        F.sum("tax_amount").alias("tax_amount"),
        F.sum("discount_total").alias("discount_total"),
        F.count_if(F.col("destination").isNull()).alias("null_destination"),
        F.count_if(F.col("employee_name").isNull()).alias("null_employee"),
    )


def freshness_data(w: Warehouse) -> DataFrame:
    return w.manifest.select("source_name", "filename", "row_count", "loaded_at").orderBy(
        F.col("loaded_at").desc(), "source_name", "filename"
    )
