"""Dimensions and their unknown members."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.settings import UNKNOWN


def with_member_zero(df: DataFrame, name_col: str, values: list) -> DataFrame:
    """Append the key-0 row; a literal ``UNKNOWN`` in the data must not twin it."""
    named = df.filter(F.col(name_col) != values[1])
    zero = df.sparkSession.createDataFrame([tuple(values)], named.schema)
    return named.unionByName(zero)


def assert_distinct_keys(dim: DataFrame, key: str) -> None:
    """Raise if two members share a surrogate key (C7): 60 bits of md5 may meet, if hardly ever."""
    twice = dim.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").head(1)
    if twice:
        raise ValueError(f"{key} {twice[0][0]} stands for {twice[0].n} members")


def calendar_bounds(sales: DataFrame, years_ahead: int) -> tuple[dt.date | None, dt.date | None]:
    """First day of the first sale's year, last day of the year that is ``years_ahead`` after the last's."""
    first, last = sales.agg(F.min("sale_date"), F.max("sale_date")).first()
    if first is None:
        return None, None
    return dt.date(first.year, 1, 1), dt.date(last.year + years_ahead, 12, 31)


def dim_date(spark: SparkSession, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """One row per day; the number of rows is bounded by the two dates."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("date")
    )
    iso_day = F.weekday("date") + 1
    return days.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"),
        "date",
        iso_day.alias("day_of_week"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.weekofyear("date").alias("week_number"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        F.year("date").alias("year"),
        (iso_day >= 6).alias("is_weekend"),
    )


def dim_store(stg: DataFrame) -> DataFrame:
    stores = stg.select("store_name").distinct()
    return stores.select(
        C.surrogate_key("store_name").alias("store_key"),
        "store_name",
        C.royalty_rate("store_name").alias("royalty_rate"),
        F.lit(True).alias("is_active"),
    )


def _products(raw: DataFrame, name, canonical, category, priority: int) -> DataFrame:
    """Clean names and categories of distinct raw spellings, not of every line."""
    return raw.distinct().select(
        name.alias("product_name"),
        canonical.alias("product_canonical_name"),
        category.alias("revenue_center_name"),
        F.lit(priority).alias("priority"),
    )


def dim_product(bronze_ac: DataFrame, bronze_b: DataFrame) -> DataFrame:
    """One row per product name; feed A decides where the feeds disagree.

    Distinct runs before the ranking, so a best seller is a few rows by then.
    Ties inside a feed go to the first category by name.
    """
    a_rows = bronze_ac.filter(
        C.has_text("Item Name") & ~F.col("Voided") & ~F.col("Is Modifier")
    ).select("Item Name", "Revenue Center")
    b_rows = bronze_b.filter(
        C.has_text("Item")
        & ~F.lower(C.group_label("Group")).contains("modifier")
        & F.col("Type").isin("SALE", "UPDATE")
    ).select("Item", "Group")
    a_name, b_name = C.tidy("Item Name"), C.tidy("Item")
    both = _products(
        a_rows, a_name, C.canon_a(a_name), C.category_a("Revenue Center"), 1
    ).unionByName(_products(b_rows, b_name, C.canon_b(b_name), C.category_b("Group"), 2))
    first = Window.partitionBy("product_name").orderBy(
        "priority", "revenue_center_name", "product_canonical_name"
    )
    unique = both.withColumn("rn", F.row_number().over(first)).filter("rn = 1")
    keyed = unique.select(
        C.surrogate_key("product_name").alias("product_key"),
        "product_name",
        "product_canonical_name",
        "revenue_center_name",
    )
    return with_member_zero(keyed, "product_name", [0, UNKNOWN, UNKNOWN, "Other"])


def dim_destination(bronze_ac: DataFrame) -> DataFrame:
    names = (
        bronze_ac.filter(C.has_text("Destination"))
        .select(C.tidy("Destination").alias("destination_name"))
        .distinct()
    )
    keyed = names.select(
        C.surrogate_key("destination_name").alias("destination_key"),
        "destination_name",
        C.channel("destination_name").alias("channel"),
    )
    return with_member_zero(keyed, "destination_name", [0, UNKNOWN, "Unknown"])


def dim_employee(bronze_ac: DataFrame, bronze_b: DataFrame) -> DataFrame:
    """Names of both feeds; ids that the XML feed writes as names are left out."""
    a_names = bronze_ac.filter(
        C.has_text("Employee Name") & ~F.col("Employee Name").rlike("^[0-9]+$")
    ).select(C.tidy("Employee Name").alias("employee_name"))
    b_names = bronze_b.filter(C.has_text("Staff")).select(
        C.tidy("Staff").alias("employee_name")
    )
    names = a_names.union(b_names).distinct()
    keyed = names.select(C.surrogate_key("employee_name").alias("employee_key"), "employee_name")
    return with_member_zero(keyed, "employee_name", [0, UNKNOWN])


def dim_campaign(seed: DataFrame) -> DataFrame:
    """Cleaned campaign map; a campaign has one key on all its products' rows."""
    clean = seed.filter(C.has_text("campaign_name") & C.has_text("product_canonical_name"))
    campaign = C.tidy("campaign_name")
    keyed = clean.select(
        C.surrogate_key(campaign).alias("campaign_key"),
        campaign.alias("campaign_name"),
        C.tidy("product_canonical_name").alias("product_canonical_name"),
        F.col("campaign_start_date").cast("date").alias("campaign_start_date"),
        F.col("campaign_end_date").cast("date").alias("campaign_end_date"),
    )
    return with_member_zero(keyed, "campaign_name", [0, "NO CAMPAIGN", None, None, None])
