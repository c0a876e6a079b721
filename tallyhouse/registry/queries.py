"""Name -> query. Names start with the id of the operator they exercise."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import checks as K
from tallyhouse.operators import facts
from tallyhouse.operators.silver import STG_COLUMNS
from tallyhouse.plans import dashboard as D
from tallyhouse.plans import marts as M
from tallyhouse.plans import rollups as R
from tallyhouse.plans import studies as S
from tallyhouse.plans.warehouse import Warehouse, open_warehouse
from tallyhouse.registry import feeds as A
from tallyhouse.sources import tables

Query = Callable[[Warehouse], DataFrame]

STORE = "LAS VEGAS"
START = dt.date(1999, 1, 1)


def _channel(w: Warehouse) -> DataFrame:
    return S.channel_lines(w.text_a, "NATION_1")


def _hours(w: Warehouse) -> DataFrame:
    return S.hourly_lines(w.text_a, "%NATION_2%")


def _item(w: Warehouse) -> DataFrame:
    return S.item_lines(
        w.text_a, "%NATION%", "red velvet CAKE", dt.date(1997, 3, 15), dt.date(2001, 3, 1)
    )


def _named_items(w: Warehouse, named) -> DataFrame:
    text = w.text_a.select(F.col("Item Name").alias("item_name"))
    return text.groupBy("item_name").agg(F.count("*").alias("lines")).withColumn(
        "product", named("item_name")
    )


def _item_names_b(w: Warehouse, named) -> DataFrame:
    text = w.text_b.select(F.col("Item").alias("item_name"))
    return text.groupBy("item_name").agg(F.count("*").alias("lines")).withColumn(
        "product", named("item_name")
    )


def _stg(w: Warehouse, df: DataFrame) -> DataFrame:
    return df.select(*STG_COLUMNS)


def _unknown_keys(w: Warehouse) -> DataFrame:
    items = w.fact_sale_item.groupBy("source_system").agg(
        F.count_if(F.col("product_key") == 0).alias("unknown_product"),
        F.count_if(F.col("destination_key") == 0).alias("unknown_destination"),
        F.count("*").alias("row_count"),
    )
    return items


def _product_keys(w: Warehouse) -> DataFrame:
    return w.dim_product.select("product_name", "product_key")


def _legacy_days(w: Warehouse) -> DataFrame:
    cells = facts.legacy_sales_cells(
        w.stg_orders, w.dim_date, w.dim_store, w.dim_product, w.dim_destination
    )
    return cells.select("date_key", "order_count")


def _legacy(w: Warehouse) -> DataFrame:
    return facts.legacy_sales_cells(
        w.stg_orders, w.dim_date, w.dim_store, w.dim_product, w.dim_destination
    )


def _null_checks(w: Warehouse) -> DataFrame:
    tables_ = {
        "fact_order": ["date_key", "store_key", "order_id", "order_count"],
        "fact_sale_item": ["date_key", "store_key", "order_id", "qty"],
        "fact_order_detail": ["date_key", "store_key", "source_system", "order_id", "discount_total"],
        "fact_by_employee": ["date_key", "store_key", "employee_key", "discount_total"],
        "stg_orders": [
            "sale_date", "store_name", "revenue_center", "net_sales", "order_id", "destination",
            "employee_name", "product_canonical_name",
        ],
    }
    out = None
    for name, cols in tables_.items():
        rows = K.run_checks(getattr(w, name), [K.not_null(c) for c in cols], name)
        out = rows if out is None else out.unionByName(rows)
    return out


def _conditional_nulls(w: Warehouse) -> DataFrame:
    where = F.col("_source_system") != "feed_b"
    check = K.not_null("employee_name", where)
    return K.offending(w.stg_orders, check).groupBy("_source_system", "store_name").agg(
        F.count("*").alias("lines")
    )


def _named_when_categorised(w: Warehouse) -> DataFrame:
    where = F.col("revenue_center") != "Other"
    return K.run_checks(
        w.stg_orders, [K.not_null("product_canonical_name", where)], "stg_orders"
    )


def _unique_dims(w: Warehouse) -> DataFrame:
    """Repeated keys of dims and of the composite fact keys, as counts per key."""
    keys = {
        "dim_store": ["store_key"], "dim_date": ["date_key"], "dim_product": ["product_key"],
        "dim_destination": ["destination_key"], "dim_employee": ["employee_key"],
        "dim_campaign": ["campaign_key"],
        "fact_order": ["source_system", "order_id"],
        "fact_sale_item": ["source_system", "order_id", "product_key"],
        "fact_by_employee": ["date_key", "store_key", "employee_key"],
    }
    out = None
    for name, cols in keys.items():
        rows = K.not_unique(getattr(w, name), *cols).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("repeated_keys")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _accepted(w: Warehouse) -> DataFrame:
    a = K.run_checks(
        w.dim_product,
        [K.accepted_values("revenue_center_name", ["Beverage", "Food", "Retail", "Other"])],
        "dim_product",
    )
    b = K.run_checks(
        w.stg_orders, [K.accepted_values("revenue_center", ["Beverage", "Food", "Retail"])], "stg_orders"
    )
    return a.unionByName(b)


def _negative(w: Warehouse) -> DataFrame:
    rows = K.offending(w.fact_sale_item, K.non_negative("qty"))
    return rows.select("source_system", "order_id", "product_key", "qty")


def _order_gaps(w: Warehouse, days: DataFrame) -> DataFrame:
    return K.order_count_gaps(days, w.stg_orders, w.dim_date, w.dim_store)


def _qty_gaps(w: Warehouse, items: DataFrame) -> DataFrame:
    return K.quantity_gaps(items, w.stg_orders, w.dim_date, w.dim_store)


def _line_sequence(w: Warehouse) -> DataFrame:
    rows = w.bronze_ac.select(
        A.col("Order ID"), A.col("Item ID"), A.col("Net Sales"), A.col("Price"),
    )
    return K.line_sequence(rows, ["order_id", "item_id"], ["net_sales", "price"])


def _cardinality(w: Warehouse) -> DataFrame:
    return K.key_cardinality(w.raw_b, ["Identifier", "Reference", "Account"])


def _without_returns(w: Warehouse) -> DataFrame:
    return w.fact_sale_item.filter("qty > 0")


def _big_orders(w: Warehouse) -> DataFrame:
    return w.fact_order.filter("order_net_sales > 100000")


QUERIES: dict[str, Query] = {
    # sources, sinks, loads
    "A1_feed_a_scan": A.feed_a_scan,
    "A2_feed_b_scan": A.feed_b_scan,
    "A3_mixed_dates": A.mixed_dates,
    "A4_feed_b_dates": A.feed_b_dates,
    "A5_clean_currency": A.currency,
    "A6_clean_accounting": A.accounting,
    "A7_lineage": A.lineage,
    "A2_line_balance": A.line_balance,
    "A8_store_from_filename": A.stores_from_files,
    "A9_order_rows": A.xml_orders,
    "A9_entry_rows": A.xml_entries,
    "A10_entries_to_bronze": A.xml_to_bronze,
    "A10_entries_to_bronze_direct": A.xml_to_bronze_direct,
    "A11_replace_slice": A.replaced_slices,
    "A12_replace_entries": A.replaced_entries,
    "A13_new_files": A.unseen_files,
    "A14_reload_range": A.reloaded_range,
    "A15_reload_scope": A.reloaded_scope,
    "A16_full_refresh": A.refreshed,
    "A17_mark_processed": A.upserted_manifest,
    "A18_load_seed": A.seed,
    "A19_split_by_source": A.split_parts,
    "A20_as_utc": A.utc_instants,
    "A21_read_many": A.many_files,
    "A22_since": A.since_day,
    "A23_publish": A.published,
    "A24_bronze_b": A.bronze_b_rows,
    "A24_incremental_to_gold": A.incremental_to_gold,
    "A24_files_to_gold": A.files_to_gold,
    # silver
    "B1_source_precedence": A.precedence,
    "B2_item_catalog": lambda w: w.item_catalog,
    "B3_enrich": A.enriched,
    "B4_store_name": A.store_names,
    "B5_category_a": A.categories_a,
    "B6_category_b": A.categories_b,
    "B7_canonical_a": A.canonical_a,
    "B8_canonical_b": A.canonical_b,
    "B9_filter_a": A.kept_a,
    "B10_filter_b": A.kept_b,
    "B11_stg_a": lambda w: _stg(w, w.stg_a),
    "B12_stg_b": lambda w: _stg(w, w.stg_b),
    "B13_stg_orders": lambda w: _stg(w, w.stg_orders),
    # dimensions
    "C1_dim_date": lambda w: w.dim_date,
    "C2_dim_store": lambda w: w.dim_store,
    "C3_dim_product": lambda w: w.dim_product,
    "C4_dim_destination": lambda w: w.dim_destination,
    "C5_dim_employee": lambda w: w.dim_employee,
    "C6_dim_campaign": lambda w: w.dim_campaign,
    "C7_surrogate_key": _product_keys,
    "C8_unknown_member": _unknown_keys,
    # joins
    "J1_inner_dim": R.sales_by_store,
    "J2_left_default_key": R.lines_by_destination,
    "J3_left_expression": R.lines_by_category,
    "J4_anti_two_keys": R.store_days_only_in_xml,
    "J5_fact_to_fact": R.orders_with_detail,
    "J6_full_outer": R.net_by_day_both_facts,
    "J7_one_row_total": R.store_share,
    "J8_campaign_interval": R.campaign_sales,
    "J9_scalar_subquery": R.latest_months,
    # facts and aggregates
    "D1_fact_order": lambda w: w.fact_order,
    "D2_fact_order_detail": lambda w: w.fact_order_detail,
    "D3_fact_sale_item": lambda w: w.fact_sale_item,
    "D4_fact_by_employee": lambda w: w.fact_by_employee,
    "D4_distinct_day_cells": lambda w: facts.distinct_orders(w.order_cells, "date_key", "store_key", "employee_key"),
    "D4_distinct_roll_ups": R.distinct_orders_by_level,
    "D5_legacy_cells": _legacy,
    "D6_filtered_aggregate": R.unknown_staff_by_store,
    "D7_conditional_sum": R.source_orders_by_month,
    "D8_flag_rollup": R.order_flags,
    "D9_null_count": R.null_counts,
    "D10_having": lambda w: R.busy_store_days(w, 2),
    "D11_two_level": R.mean_day_by_store,
    "D12_pivot": lambda w: R.store_by_source(w, fill=False),
    "D12_pivot_filled": lambda w: R.store_by_source(w, fill=True),
    "D13_global": R.global_figures,
    # windows
    "W1_row_number": R.last_order_per_store,
    "W2_distinct_on": R.first_category_per_canonical,
    "W3_lag": R.store_month_lag,
    "W4_running_sum": R.running_sales,
    "W5_share_of_total": R.source_share,
    # order, limit, sets
    "S1_nulls_last": R.discounts_nulls_last,
    "S2_top_k": lambda w: R.top_orders(w, 20),
    "S3_custom_order": R.weekdays_in_order,
    "S4_union_all": R.source_rows,
    "S5_union_distinct": R.staff_names,
    # marts
    "M1_attachment_rate_monthly": M.attachment_rate_monthly,
    "M2_source_by_month": M.source_by_month,
    "M3_source_summary": M.source_summary,
    "M4_freshness_data": M.freshness_data,
    # dashboard
    "Q1_kpi_current_month": D.kpi_current_month,
    "Q2_kpi_ytd": D.kpi_ytd,
    "Q3_kpi_items_current_month": D.kpi_items_current_month,
    "Q4_kpi_items_ytd": D.kpi_items_ytd,
    "Q5_daily_last_90": D.daily_last_90,
    "Q6_net_sales_ytd_daily": D.net_sales_ytd_daily,
    "Q7_store_leaderboard_mom": D.store_leaderboard_mom,
    "Q8_store_month_matrix": D.store_month_matrix,
    "Q9_store_month_options": D.store_month_options,
    "Q10_store_monthly_sales": lambda w: D.store_monthly_sales(w, STORE),
    "Q11_labor_efficiency": D.labor_efficiency,
    "Q12_royalties_current_month": D.royalties_current_month,
    "Q13_channel_comparison": D.channel_comparison,
    "Q14_delivery_leakage": D.delivery_leakage,
    "Q15_drivethu_monthly": D.drivethu_monthly,
    "Q16_unknown_destination_trend": D.unknown_destination_trend,
    "Q17_store_list": D.store_list,
    "Q18_size_options": D.size_menu,
    "Q19_overall_performance": D.overall_performance,
    "Q19_overall_performance_store": lambda w: D.overall_performance(w, STORE),
    "Q20_size_breakdown": D.size_breakdown,
    "Q20_size_breakdown_16oz": lambda w: D.size_breakdown(w, STORE, "16oz"),
    "Q20_size_breakdown_food": lambda w: D.size_breakdown(w, "", "Food"),
    "Q21_attachment_rate_kpi": D.attachment_rate_kpi,
    "Q22_attachment_rate_trend": D.attachment_rate_trend,
    "Q23_retail_evolution": lambda w: D.retail_evolution(w, START),
    "Q24_product_mix_by_category": lambda w: D.product_mix_by_category(w, START),
    "Q25_top_products_by_revenue": D.top_products_by_revenue,
    "Q26_category_volume": D.category_volume,
    "Q27_recent_month": D.recent_month,
    "Q28_upselling_leaderboard": lambda w: D.upselling_leaderboard(w, min_orders=2),
    "Q29_discount_audit": D.discount_audit,
    "Q30_shift_productivity": D.shift_productivity,
    "Q31_store_kpis": lambda w: D.store_kpis(w, STORE),
    "Q32_store_kpi_ytd": lambda w: D.store_kpi_ytd(w, STORE),
    "Q33_store_net_sales_history": lambda w: D.store_net_sales_history(w, STORE),
    "Q34_dow_heatmap": lambda w: D.dow_heatmap(w, STORE),
    "Q35_category_mix": lambda w: D.category_mix(w, STORE),
    "Q36_channels_this_store": lambda w: D.channels_this_store(w, STORE),
    "Q37_top_employees": lambda w: D.top_employees(w, STORE),
    "Q38_monthly_sales": D.monthly_sales,
    "Q39_mom_growth": D.mom_growth,
    "Q40_yoy_comparison": lambda w: D.yoy_comparison(w, (1999, 2000, 2001)),
    "Q41_day_of_week": D.day_of_week,
    "Q42_weekend_vs_weekday": D.weekend_vs_weekday,
    "Q43_quarterly_sales": D.quarterly_sales,
    "Q44_source_reconciliation": D.source_reconciliation,
    "Q45_source_by_month_data": D.source_by_month_data,
    "Q46_unknown_employee_by_month": D.unknown_employee_by_month,
    "Q47_unknown_employee_by_store": D.unknown_employee_by_store,
    "Q48_unknown_destination": D.unknown_destination,
    "Q49_unknown_totals": D.unknown_totals,
    "Q50_freshness_monitor": D.freshness_monitor,
    "Q51_freshness_summary": D.freshness_summary,
    "Q52_data_watermark": D.data_watermark,
    # studies
    "P1_classify_keyword": lambda w: _named_items(w, S.classify_by_keyword),
    "P2_classify_exact": lambda w: _item_names_b(w, S.classify_by_name),
    "P3_food_fact": lambda w: w.food,
    "P4_food_pivot_sales": lambda w: S.food_pivot(w.food, "net_sales"),
    "P4_food_pivot_units": lambda w: S.food_pivot(w.food, "units"),
    "P4_food_by_month_store": lambda w: S.food_by_month_store(w.food),
    "P4_food_by_store": lambda w: S.food_by_store(w.food),
    "P4_food_totals": lambda w: S.food_totals(w.food),
    "P5_channel_daily": lambda w: S.channel_daily(_channel(w)),
    "P6_channel_weekly": lambda w: S.channel_weekly(_channel(w)),
    "P6_channel_checks": lambda w: S.channel_checks(_channel(w)),
    "P6_destination_breakdown": lambda w: S.destination_breakdown(_channel(w)),
    "P7_hourly_summary": lambda w: S.hourly_summary(_hours(w)),
    "P8_hourly_by_month": lambda w: S.hourly_by_month(_hours(w)),
    "P8_daily_summary": lambda w: S.daily_summary(_hours(w)),
    "P9_item_daily": lambda w: S.item_daily(_item(w)),
    "P9_item_weekly": lambda w: S.item_weekly(_item(w)),
    "P9_item_monthly": lambda w: S.item_monthly(_item(w)),
    "P10_item_by_employee": lambda w: S.item_by_employee(_item(w)),
    "P10_item_by_destination": lambda w: S.item_by_destination(_item(w)),
    # incremental
    "I1_load_watermark": A.watermark_rows,
    "I2_partition_replace": A.upserted_slices,
    "I3_delete_insert": A.delete_insert,
    "I3_refresh_months": A.refreshed_fact,
    "I4_lookback": A.lookback_rows,
    "I5_file_stream": A.streamed_files,
    "I5_feed_stream": A.streamed_feeds,
    "I6_late_arrivals": A.late_arrivals,
    # data quality
    "T1_not_null": _null_checks,
    "T2_not_null_where": _conditional_nulls,
    "T2_named_when_categorised": _named_when_categorised,
    "T3_unique": _unique_dims,
    "T4_accepted_values": _accepted,
    "T5_non_negative": _negative,
    "T6_order_count_additive": lambda w: _order_gaps(w, w.fact_order),
    "T6_legacy_count_not_additive": lambda w: _order_gaps(w, _legacy_days(w)),
    "T7_qty_additive": lambda w: _qty_gaps(w, w.fact_sale_item),
    "T7_qty_without_returns": lambda w: _qty_gaps(w, _without_returns(w)),
    "T8_items_have_orders": lambda w: K.items_without_order(w.fact_sale_item, w.fact_order),
    "T8_items_of_small_orders": lambda w: K.items_without_order(w.fact_sale_item, _big_orders(w)),
    "T9_coverage_a": lambda w: K.coverage_a(w.bronze_ac, w.stg_orders),
    "T9_coverage_a_before_precedence": lambda w: K.coverage_a(w.raw_c, w.stg_orders),
    "T9_coverage_b": lambda w: K.coverage_b(w.raw_b, w.stg_orders, "feed_b"),
    "T10_lost_slices": lambda w: K.lost_slices(
        tables.raw_feed_c_entries(w.lines, w.settings),
        w.bronze_ac.filter("_source_system = 'feed_c'"),
    ),
    "T11_source_profile": lambda w: K.source_profile(w.bronze_ac),
    "T11_two_source_days": lambda w: K.two_source_store_days(
        w.raw_a.unionByName(w.raw_c, allowMissingColumns=True)
    ).select(A.col("Location"), A.col("Date", "sale_date"), "sources", "row_count"),
    "T12_duplicate_items": lambda w: K.duplicate_order_items(w.bronze_ac),
    "T12_missing_order_ids": lambda w: K.missing_order_ids(w.bronze_ac),
    "T12_line_sequence": _line_sequence,
    "T13_catalog_coverage": lambda w: K.catalog_coverage(w.raw_a),
    "T14_named_against_unknown": lambda w: K.named_against_unknown(w.fact_by_employee),
    "T15_key_cardinality": _cardinality,
}


def present(df: DataFrame) -> DataFrame:
    """Comparable types at the edge: decimals as doubles, instants as UTC text."""

    def show(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return c

    return df.select(*[show(f) for f in df.schema.fields])


def _bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(query(open_warehouse(spark, sf_dir)))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query) for name, query in QUERIES.items()}
