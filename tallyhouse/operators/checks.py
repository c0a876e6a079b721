"""Data-quality checks (T1-T15). A check returns the offending rows; none is a pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.functions.measures import month_start, ratio, share_of_rows
from tallyhouse.operators import silver
from tallyhouse.operators.facts import ORDER_KEY, keyed_lines
from tallyhouse.settings import UNKNOWN
from tallyhouse.storage import settle

# --- column checks (T1-T5) ------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named row predicate that is true for an offending row."""

    name: str
    offends: Column


def not_null(col: str, where: Column | None = None) -> Check:
    offends = F.col(col).isNull()
    label = f"not_null({col})" if where is None else f"not_null({col}) where"
    return Check(label, offends if where is None else where & offends)


def accepted_values(col: str, values: list[str]) -> Check:
    return Check(f"accepted_values({col})", ~F.col(col).isin(*values))


def non_negative(col: str) -> Check:
    return Check(f"non_negative({col})", F.col(col) < 0)


def offending(df: DataFrame, check: Check) -> DataFrame:
    return df.filter(F.coalesce(check.offends, F.lit(False)))


def not_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    rows = df.filter(F.col(cols[0]).isNotNull()).groupBy(*cols).agg(F.count("*").alias("n_records"))
    return rows.filter("n_records > 1")


def run_checks(df: DataFrame, checks: list[Check], table: str) -> DataFrame:
    """Failures of every check in one scan of the table."""
    counts = df.agg(*[F.count_if(c.offends).alias(f"c{i}") for i, c in enumerate(checks)])
    pairs = ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(checks))
    long = counts.select(F.expr(f"stack({len(checks)}, {pairs}) as (check_name, failures)"))
    return long.select(F.lit(table).alias("table_name"), "check_name", "failures")


# --- reconciliation (T6-T9) -----------------------------------------------------


def _placed(stg: DataFrame, dim_date: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Keyed lines whose day and store the dimensions cover."""
    dates = dim_date.select("date_key", F.col("date").alias("sale_date"))
    stores = dim_store.select("store_name")
    return keyed_lines(stg).join(dates, "sale_date").join(stores, "store_name", "left_semi")


def order_count_gaps(fact_days: DataFrame, stg, dim_date, dim_store) -> DataFrame:
    """Days whose summed order count differs from the orders counted in silver.

    ``fact_days`` is (date_key, order_count) at any grain. Only distinct orders
    and then days are shuffled on the independent side.
    """
    order_days = (
        _placed(stg, dim_date, dim_store)
        .groupBy("_source_system", "order_ref")
        .agg(F.max("date_key").alias("date_key"))
    )
    truth = order_days.groupBy("date_key").agg(F.count("*").alias("distinct_orders"))
    summed = fact_days.groupBy("date_key").agg(F.sum("order_count").alias("summed_orders"))
    both = summed.join(truth, "date_key", "full_outer")
    return both.filter(
        F.coalesce("summed_orders", F.lit(0)) != F.coalesce("distinct_orders", F.lit(0))
    ).select("date_key", "summed_orders", "distinct_orders")


def _marks(source: str, order: str, qty: str) -> list[Column]:
    """Two sums of quantity times a number drawn from the order key.

    They are linear in the quantity: lines and rows rolled up from them give the same sums, in any order.
    """
    drawn = [F.pmod(F.xxhash64(source, order, F.lit(n)), F.lit(2**31 - 1)).cast("decimal(10,0)") for n in (1, 2)]
    return [F.sum(F.col(qty) * d).cast("decimal(38,3)").alias(f"_mark{n}") for n, d in enumerate(drawn)]


def differing_months(fact_items: DataFrame, lines: DataFrame) -> list:
    """Months in which some order's quantity differs; one row a month is grouped, no order is shuffled.

    A month without a difference never comes out; one with a difference is missed with odds of 2^-62.
    """
    fact = fact_items.groupBy("sale_month").agg(*_marks(*ORDER_KEY, "qty"))
    truth = lines.groupBy("sale_month").agg(*_marks("_source_system", "order_ref", "qty"))
    none = F.lit(0)
    unlike = [F.coalesce(fact[m], none) != F.coalesce(truth[m], none) for m in ("_mark0", "_mark1")]
    both = fact.join(truth, fact.sale_month.eqNullSafe(truth.sale_month), "full_outer").filter(unlike[0] | unlike[1])
    return [r[0] for r in both.select(F.coalesce(fact.sale_month, truth.sale_month)).collect()]


def _gaps(fact_items: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders of unlike quantity by full outer join."""
    truth = lines.groupBy(
        F.col("_source_system").alias("source_system"), F.col("order_ref").alias("order_id")
    ).agg(F.sum("qty").alias("truth_qty"))
    fact = fact_items.groupBy(*ORDER_KEY).agg(F.sum("qty").alias("fact_qty"))
    none = F.lit(0)
    both = fact.join(truth, ORDER_KEY, "full_outer")
    return both.filter(F.coalesce("fact_qty", none) != F.coalesce("truth_qty", none)).select(
        *ORDER_KEY, "fact_qty", "truth_qty"
    )


def quantity_gaps(fact_items: DataFrame, stg, dim_date, dim_store) -> DataFrame:
    """Orders whose item quantity differs from the quantity in silver.

    Months are compared first; orders are joined only within months that differ, none where all agree. An
    order that differs there is then summed over all its months, as it may have lines in others.
    """
    lines = _placed(stg, dim_date, dim_store).withColumn("sale_month", month_start("sale_date"))
    months = differing_months(fact_items, lines)
    known = F.col("sale_month").isin([m for m in months if m is not None])
    within = known | F.col("sale_month").isNull() if None in months else known
    if not months:
        return _gaps(fact_items.filter(within), lines.filter(within))
    orders = settle(_gaps(fact_items.filter(within), lines.filter(within)).select(*ORDER_KEY))
    of_lines = orders.toDF("_source_system", "order_ref")
    return _gaps(
        fact_items.join(orders, ORDER_KEY, "left_semi"), lines.join(of_lines, of_lines.columns, "left_semi")
    )


def items_without_order(fact_items: DataFrame, fact_order: DataFrame) -> DataFrame:
    """Orders that have item rows and no order row."""
    children = fact_items.select(*ORDER_KEY).distinct()
    return children.join(fact_order.select(*ORDER_KEY), ORDER_KEY, "left_anti")


def _uncovered(bronze_days: DataFrame, stg: DataFrame) -> DataFrame:
    """Source-days of bronze that silver lacks; both sides are distinct first."""
    have = stg.select(F.col("_source_system").alias("source_system"), "sale_date").distinct()
    return bronze_days.distinct().join(have, ["source_system", "sale_date"], "left_anti")


def coverage_a(bronze_ac: DataFrame, stg: DataFrame) -> DataFrame:
    days = bronze_ac.filter(silver.filter_a()).select(
        F.col("_source_system").alias("source_system"), F.col("Date").cast("date").alias("sale_date")
    )
    return _uncovered(days, stg)


def coverage_b(bronze_b: DataFrame, stg: DataFrame, tag: str) -> DataFrame:
    days = bronze_b.filter(silver.filter_b()).select(
        F.lit(tag).alias("source_system"), F.col("Date").cast("date").alias("sale_date")
    )
    return _uncovered(days, stg)


# --- reports (T10-T15) -----------------------------------------------------------


def lost_slices(entries: DataFrame, target: DataFrame) -> DataFrame:
    """Store-days kept in the raw entries that the target no longer holds."""
    present = target.select(
        F.col("Location").alias("store_name"), F.col("Date").alias("business_date")
    ).distinct()
    slices = entries.groupBy("store_name", "business_date").agg(F.count("*").alias("entry_rows"))
    return slices.join(present, ["store_name", "business_date"], "left_anti").orderBy(
        F.col("business_date").desc(), "store_name"
    )


def source_profile(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(F.col("_source_system").alias("source_system")).agg(
        F.count("*").alias("row_count"),
        F.min("Date").alias("first_day"),
        F.max("Date").alias("last_day"),
    ).orderBy("source_system")


def two_source_store_days(bronze: DataFrame) -> DataFrame:
    """Store-days that more than one source delivers: the double-count risk."""
    sources = bronze.groupBy("Location", "Date").agg(
        F.count_distinct("_source_system").alias("sources"), F.count("*").alias("row_count")
    )
    return sources.filter("sources > 1")


def duplicate_order_items(bronze: DataFrame) -> DataFrame:
    rows = bronze.groupBy("Order ID", "Item ID").agg(F.count("*").alias("lines"))
    return rows.filter("lines > 1").select(
        F.col("Order ID").alias("order_id"), F.col("Item ID").alias("item_id"), "lines"
    )


def missing_order_ids(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(F.col("_source_system").alias("source_system")).agg(
        F.count_if(C.is_blank("Order ID")).alias("rows_without_order")
    ).orderBy("source_system")


SLICE_DIGITS = 3


def line_sequence(lines: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """Number the lines of each key from 1, in the order of a digest of their content.

    Lines without an order id all share one key, and all of them may be equal, so neither a
    group nor a digest has a size bound. Lines with equal digests are interchangeable: each is
    numbered within the task that read it (a cell of group, digest and task), and only cell sizes
    are summed up over a group, first by the digest's leading digits (at most 4,096 slices
    a group), then by digest and task within a slice. No task ever holds a group.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in content]
    digest = F.md5(F.concat_ws("|", *text))
    group = [f"_key{i}" for i in range(len(keys))]
    # written, so that every later step sees a line in the same task's cell
    marked = settle(
        lines.select(
            "*",
            *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(g) for k, g in zip(keys, group)],
            digest.alias("_digest"),
            F.substring(digest, 1, SLICE_DIGITS).alias("_slice"),
            F.spark_partition_id().alias("_task"),
        )
    )
    cell = [*group, "_slice", "_digest", "_task"]
    cells = settle(marked.groupBy(*cell).agg(F.count("*").alias("_size")))
    sizes = cells.groupBy(*group, "_slice").agg(F.sum("_size").alias("_size"))
    to_here = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_slice", F.sum("_size").over(to_here(*group).orderBy("_slice")).alias("_start"))
    within = F.sum("_size").over(to_here(*group, "_slice").orderBy("_digest", "_task"))
    placed = cells.select(*cell, within.alias("_within")).join(starts, [*group, "_slice"])
    placed = placed.select(*cell, (F.coalesce("_start", F.lit(0)) + F.coalesce("_within", F.lit(0))).alias("_before"))
    inside = Window.partitionBy(*cell).orderBy(F.lit(0))
    numbered = marked.withColumn("_rank", F.row_number().over(inside))
    # a cell that begins at 0 needs no lookup
    return numbered.join(settle(placed.filter("_before > 0")), cell, "left").select(
        *lines.columns, (F.coalesce("_before", F.lit(0)) + F.col("_rank")).cast("bigint").alias("line_seq")
    )


def catalog_coverage(csv: DataFrame) -> DataFrame:
    """Items, how many have a name, how many have several."""
    named = F.when(C.has_text("Item Name"), C.tidy("Item Name"))
    items = (
        csv.filter(F.col("Item ID").isNotNull())
        .groupBy("Item ID")
        .agg(F.count_distinct(named).alias("names"))
    )
    return items.agg(
        F.count("*").alias("items"),
        F.count_if(F.col("names") > 0).alias("named_items"),
        F.count_if(F.col("names") > 1).alias("ambiguous_items"),
        ratio(F.count_if(F.col("names") > 0), F.count("*"), 4).alias("named_share"),
    )


def named_against_unknown(fact_by_employee: DataFrame) -> DataFrame:
    """Rows, employees and sales of named and unknown staff with their shares."""
    bucket = F.when(F.col("employee_key") == 0, F.lit(UNKNOWN)).otherwise(F.lit("named"))
    rows = fact_by_employee.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("row_count"),
        F.count_distinct("employee_key").alias("employees"),
        F.sum("net_sales").alias("net_sales"),
    )
    return rows.select(
        "*",
        share_of_rows("row_count").alias("row_share"),
        share_of_rows("net_sales").alias("net_share"),
    ).orderBy("bucket")


def key_cardinality(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Distinct values, lines per value and the largest group of each candidate key.

    Each candidate is counted with a plain two-step aggregate; no value list is
    ever held in one place.
    """

    def profile(name: str) -> DataFrame:
        groups = df.filter(C.has_text(F.col(name).cast("string"))).groupBy(name).agg(
            F.count("*").alias("n")
        )
        return groups.agg(
            F.lit(name).alias("candidate"),
            F.count("*").alias("distinct_values"),
            F.sum("n").alias("row_count"),
            ratio(F.sum("n"), F.count("*"), 2).alias("lines_per_value"),
            F.max("n").alias("largest_group"),
        )

    out = profile(candidates[0])
    for name in candidates[1:]:
        out = out.unionByName(profile(name))
    return out.orderBy("candidate")
