"""Raw rows to one item-line table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.functions.parsing import MONEY
from tallyhouse.settings import FEED_B, Brand

QTY = "decimal(18,3)"

STG_COLUMNS = (
    "sale_date", "store_name", "revenue_center", "net_sales", "order_id", "order_ref", "qty",
    "tip_amount", "destination", "employee_name", "tax_amount", "discount_total", "product_name",
    "product_canonical_name", "_source_system", "_ingested_at",
)


def item_catalog(csv: DataFrame) -> DataFrame:
    """Latest name, PLU and category per item id.

    Each spelling keeps its last day first (a hash aggregate that combines on
    the map side), so the ranking sees a handful of rows per item however often
    one item sells. Ties on the day: name, PLU, category ascending.
    """
    spellings = (
        csv.filter(F.col("Item ID").isNotNull() & C.has_text("Item Name"))
        .groupBy(
            F.col("Item ID").alias("item_id"),
            C.tidy("Item Name").alias("item_name"),
            F.col("Item PLU").alias("item_plu"),
            F.col("Revenue Center").alias("revenue_center"),
        )
        .agg(F.max("Date").alias("last_day"))
    )
    newest = Window.partitionBy("item_id").orderBy(
        F.col("last_day").desc_nulls_last(),
        F.col("item_name"),
        F.col("item_plu").asc_nulls_last(),
        F.col("revenue_center").asc_nulls_last(),
    )
    ranked = spellings.withColumn("rn", F.row_number().over(newest))
    return ranked.filter("rn = 1").select("item_id", "item_name", "item_plu", "revenue_center")


def takes_from_catalog() -> Column:
    """Lines whose name or category :func:`enrich` fills in."""
    return F.coalesce(F.col("Revenue Center").rlike("^[0-9]+$"), F.lit(False)) | C.tidy("Item Name").isNull()


def enrich(bronze: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add the effective category and name: catalog values where the feed has only ids.

    Lines that bring both themselves do not meet the catalog, so they are not shuffled for it.
    """
    cat = catalog.select(
        F.col("item_id").alias("_item_id"),
        F.col("item_name").alias("_name"),
        F.col("revenue_center").alias("_center"),
    )
    center = F.col("Revenue Center")
    looked_up = (
        bronze.filter(takes_from_catalog())
        .join(cat, F.col("Item ID") == F.col("_item_id"), "left")
        .withColumn(
            "eff_revenue_center", F.when(center.rlike("^[0-9]+$"), F.col("_center")).otherwise(center)
        )
        .withColumn("eff_item_name", F.coalesce(C.tidy("Item Name"), F.col("_name")))
        .drop("_item_id", "_name", "_center")
    )
    own = bronze.filter(~takes_from_catalog()).withColumns(
        {"eff_revenue_center": center, "eff_item_name": C.tidy("Item Name")}
    )
    return own.unionByName(looked_up)


def filter_a() -> Column:
    """Neither voided nor modifier, with money; an unknown flag drops the row."""
    return ~F.col("Voided") & ~F.col("Is Modifier") & F.col("Net Sales").isNotNull()


def filter_b() -> Column:
    """Group is known and no modifier group, price present."""
    grouped = ~F.lower(C.group_label("Group")).contains("modifier")
    return grouped & F.col("FinalPrice").isNotNull()


def stg_a(enriched: DataFrame, brand: Brand = Brand()) -> DataFrame:
    """Feeds A and C as item lines; both sell one unit per line."""
    return enriched.filter(filter_a()).select(
        F.col("Date").cast("date").alias("sale_date"),
        C.norm_store("Location", brand.prefixes).alias("store_name"),
        C.category_a("eff_revenue_center").alias("revenue_center"),
        F.col("Net Sales").cast(MONEY).alias("net_sales"),
        F.col("Order ID").alias("order_id"),
        F.col("Order ID").alias("order_ref"),
        F.lit(1).cast(QTY).alias("qty"),
        F.lit(0).cast(MONEY).alias("tip_amount"),
        C.tidy("Destination").alias("destination"),
        C.tidy("Employee Name").alias("employee_name"),
        F.col("Taxes").cast(MONEY).alias("tax_amount"),
        F.col("Discount Total").cast(MONEY).alias("discount_total"),
        F.col("eff_item_name").alias("product_name"),
        C.canon_a("eff_item_name").alias("product_canonical_name"),
        "_source_system",
        "_ingested_at",
    )


def stg_b(bronze: DataFrame, brand: Brand = Brand()) -> DataFrame:
    """Feed B as item lines; ``Account`` groups several receipts, ``Reference`` is one."""
    item = C.tidy("Item")
    return bronze.filter(filter_b()).select(
        F.col("Date").cast("date").alias("sale_date"),
        C.norm_store("Location", brand.prefixes).alias("store_name"),
        C.category_b("Group").alias("revenue_center"),
        F.col("FinalPrice").cast(MONEY).alias("net_sales"),
        F.col("Account").alias("order_id"),
        F.col("Reference").alias("order_ref"),
        F.col("Qty").cast(QTY).alias("qty"),
        F.lit(0).cast(MONEY).alias("tip_amount"),
        F.lit(None).cast("string").alias("destination"),
        C.tidy("Staff").alias("employee_name"),
        F.col("TaxAmount").cast(MONEY).alias("tax_amount"),
        F.col("Discount").cast(MONEY).alias("discount_total"),
        item.alias("product_name"),
        C.canon_b(item).alias("product_canonical_name"),
        F.lit(FEED_B).alias("_source_system"),
        "_ingested_at",
    )


def stg_orders(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*STG_COLUMNS).unionByName(b.select(*STG_COLUMNS))
