"""The written layers: lines -> bronze views -> silver -> dimensions and facts.

Each table is built on first use and written below the shared work folder, so
reports read small, month-partitioned files instead of repeating the joins, and
a lost executor only costs the tasks it was running.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.measures import month_start
from tallyhouse.operators import bronze, dimensions, facts, silver
from tallyhouse.plans.studies import food_fact
from tallyhouse.session import fresh_dir, tune
from tallyhouse.settings import Settings
from tallyhouse.sources import feeds, orders_xml, tables
from tallyhouse.storage import write_table

MONTH = "sale_month"
# Lines from which a task's rows fill a file of each month without being gathered by month.
SPREAD_LINES = 10_000_000


def written_months(table: DataFrame) -> list[dt.date]:
    """Months of a table written by month, from its folder names; no file is opened."""
    found = {m for f in table.inputFiles() for m in re.findall(rf"/{MONTH}=(\d+-\d+-\d+)/", f)}
    return sorted(map(dt.date.fromisoformat, found))


class Warehouse:
    """Tables of one data folder; every attribute is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = Settings()):
        self.spark = spark
        self.sf_dir = sf_dir
        self.settings = settings
        self.root = fresh_dir(spark, "warehouse")

    def _keep(
        self, name: str, build: Callable[[], DataFrame], partition: str | None = None
    ) -> DataFrame:
        return write_table(build(), f"{self.root}/{name}", partition, bool(partition) and self.spread)

    @cached_property
    def spread(self) -> bool:
        """Whether the lines fill so many tasks that folders are written where the rows are; counted from file footers."""
        return self.lines.count() > SPREAD_LINES

    # --- landing and bronze -------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        """Joined lines, one folder per feed; the only scan of the source tables.

        Written without a rebalance: the join already spreads the rows, and a
        task writes at most one file per feed.
        """
        path = f"{self.root}/lines"
        df = tables.sale_lines(self.spark, self.sf_dir)
        df.write.mode("overwrite").partitionBy("feed").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def raw_a(self) -> DataFrame:
        return tables.raw_feed_a(self.lines, self.settings)

    @cached_property
    def raw_b(self) -> DataFrame:
        return tables.raw_feed_b(self.lines, self.settings)

    @cached_property
    def raw_c(self) -> DataFrame:
        return tables.raw_feed_c(self.lines, self.settings)

    @cached_property
    def text_a(self) -> DataFrame:
        """Feed A as its file spells it, for the studies."""
        return tables.feed_a_text(self.lines, self.settings)

    @cached_property
    def text_b(self) -> DataFrame:
        return tables.feed_b_text(self.lines, self.settings)

    @cached_property
    def food(self) -> DataFrame:
        """Classified dessert lines, written because five reports read them."""
        return self._keep("food", lambda: food_fact(self.text_a, self.text_b))

    @cached_property
    def store_days(self) -> DataFrame:
        return self._keep("store_days", lambda: bronze.store_days(self.raw_a))

    @cached_property
    def bronze_ac(self) -> DataFrame:
        return bronze.bronze_a(self.raw_a, self.raw_c, self.store_days)

    # --- silver ---------------------------------------------------------------

    @cached_property
    def item_catalog(self) -> DataFrame:
        return self._keep("item_catalog", lambda: silver.item_catalog(self.raw_a))

    @cached_property
    def stg_a(self) -> DataFrame:
        return silver.stg_a(silver.enrich(self.bronze_ac, self.item_catalog), self.settings.brand)

    @cached_property
    def stg_b(self) -> DataFrame:
        return silver.stg_b(self.raw_b, self.settings.brand)

    @cached_property
    def stg_orders(self) -> DataFrame:
        def build():
            both = silver.stg_orders(self.stg_a, self.stg_b)
            return both.withColumn(MONTH, month_start("sale_date"))

        return self._keep("stg_orders", build, MONTH)

    # --- dimensions -------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        """Whole years from the first sale to some years after the last one: no sale falls outside."""
        first, last = dimensions.calendar_bounds(self.stg_orders, self.settings.calendar_years_ahead)
        return self._keep("dim_date", lambda: dimensions.dim_date(self.spark, first, last).coalesce(1))

    @cached_property
    def as_of(self) -> dt.date | None:
        """The reporting date of the settings, else the last sale date."""
        if self.settings.as_of:
            return self.settings.as_of
        last = written_months(self.stg_orders)[-1:]
        return self.stg_orders.filter(F.col(MONTH).isin(last)).agg(F.max("sale_date")).first()[0]

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._keep("dim_store", lambda: dimensions.dim_store(self.stg_orders))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._keep("dim_product", lambda: dimensions.dim_product(self.bronze_ac, self.raw_b))

    @cached_property
    def dim_destination(self) -> DataFrame:
        return self._keep("dim_destination", lambda: dimensions.dim_destination(self.bronze_ac))

    @cached_property
    def dim_employee(self) -> DataFrame:
        return self._keep(
            "dim_employee", lambda: dimensions.dim_employee(self.bronze_ac, self.raw_b)
        )

    @cached_property
    def campaign_seed(self) -> DataFrame:
        return tables.campaign_seed(self.spark, self.sf_dir)

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return self._keep("dim_campaign", lambda: dimensions.dim_campaign(self.campaign_seed))

    # --- facts ------------------------------------------------------------------

    @cached_property
    def order_grain(self) -> DataFrame:
        """The files behind both order facts."""
        return self._keep(
            "order_grain",
            lambda: facts.order_grain(
                self.stg_orders, self.dim_date, self.dim_store, self.dim_destination
            ),
            MONTH,
        )

    @cached_property
    def fact_order(self) -> DataFrame:
        return self.order_grain.select(*facts.ORDER_COLUMNS)

    @cached_property
    def fact_order_detail(self) -> DataFrame:
        return self.order_grain.select(*facts.DETAIL_COLUMNS)

    @cached_property
    def fact_sale_item(self) -> DataFrame:
        return self._keep(
            "fact_sale_item",
            lambda: facts.fact_sale_item(
                self.stg_orders, self.dim_date, self.dim_store, self.dim_product,
                self.dim_destination,
            ),
            MONTH,
        )

    @cached_property
    def fact_by_employee(self) -> DataFrame:
        return self._keep(
            "fact_by_employee",
            lambda: facts.fact_by_employee(
                self.stg_orders, self.dim_date, self.dim_store, self.dim_employee
            ),
            MONTH,
        )

    @cached_property
    def order_cells(self) -> DataFrame:
        return self._keep(
            "order_cells",
            lambda: facts.order_cells(
                self.stg_orders, self.dim_date, self.dim_store, self.dim_employee
            ),
            MONTH,
        )

    # --- load manifest -----------------------------------------------------------

    @cached_property
    def manifest(self) -> DataFrame:
        """Files behind the two CSV feeds with their rows and last load instant."""

        def build():
            cols = ["_source_system", "_source_file", "_ingested_at"]
            rows = self.raw_a.select(*cols).unionByName(self.raw_b.select(*cols))
            return rows.groupBy(
                F.col("_source_system").alias("source_name"), F.col("_source_file").alias("filename")
            ).agg(F.count("*").alias("row_count"), F.max("_ingested_at").alias("loaded_at"))

        return self._keep("manifest", build)

    def publish(self, name: str, sink: str) -> DataFrame:
        """Write a dimension or fact below a sink folder for downstream tools; returns what was written."""
        return write_table(getattr(self, name), f"{sink}/{name}")


class FeedWarehouse(Warehouse):
    """The same tables from landed feed files instead of the given tables.

    Feed A, feed B and the order XML lie in folders of their own; the campaign map
    is a seed CSV. Bronze is written once, stamped with one load instant.
    """

    def __init__(
        self,
        spark: SparkSession,
        feed_a: str,
        feed_b: str,
        orders: str,
        seed: str,
        loaded_at: dt.datetime,
        settings: Settings = Settings(),
        store_aliases: dict[str, str] | None = None,
    ):
        """``store_aliases`` maps feed-B names that a file name cannot spell to the store's own."""
        super().__init__(spark, "", settings)
        self.store_aliases = store_aliases or {}
        self.feed_a, self.feed_b, self.orders, self.seed = feed_a, feed_b, orders, seed
        self.loaded_at = loaded_at

    @cached_property
    def spread(self) -> bool:
        return sum(raw.count() for raw in (self.raw_a, self.raw_b, self.raw_c)) > SPREAD_LINES

    @cached_property
    def raw_a(self) -> DataFrame:
        return self._keep("raw_a", lambda: feeds.read_feed_a(self.spark, self.feed_a, self.loaded_at))

    @cached_property
    def raw_b(self) -> DataFrame:
        def build():
            rows = feeds.read_feed_b(self.spark, self.feed_b, self.settings.brand, self.loaded_at)
            return rows.replace(self.store_aliases, subset=["Location"]) if self.store_aliases else rows

        return self._keep("raw_b", build)

    @cached_property
    def raw_c(self) -> DataFrame:
        def build():
            nested, self.failed_payloads = orders_xml.read_good_orders(self.spark, self.orders)
            return orders_xml.nested_to_bronze(nested, F.lit(self.loaded_at))

        return self._keep("raw_c", build)

    @cached_property
    def text_a(self) -> DataFrame:
        return feeds.read_feed_a_text(self.spark, f"{self.feed_a}/{feeds.FEED_A_GLOB}")

    @cached_property
    def text_b(self) -> DataFrame:
        return feeds.read_feed_b_text(self.spark, f"{self.feed_b}/{feeds.FEED_B_GLOB}")

    @cached_property
    def campaign_seed(self) -> DataFrame:
        return feeds.load_seed(self.spark, self.seed)


_open: dict[tuple, Warehouse] = {}


def open_warehouse(
    spark: SparkSession, sf_dir: str, settings: Settings = Settings()
) -> Warehouse:
    """The warehouse of a data folder, built once per Spark application."""
    tune(spark)
    key = (spark.sparkContext.applicationId, sf_dir, settings)
    if key not in _open:
        _open[key] = Warehouse(spark, sf_dir, settings)
    return _open[key]


def day_key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day
