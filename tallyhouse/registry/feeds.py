"""Feed, load and cleansing queries (A*, B*, I*) over data derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyhouse.functions import cleansing as C
from tallyhouse.functions import parsing as P
from tallyhouse.operators import bronze, facts, silver
from tallyhouse.plans.live import LiveWarehouse
from tallyhouse.plans.warehouse import FeedWarehouse, Warehouse
from tallyhouse.session import fresh_dir, together
from tallyhouse.sources import feeds, landing, orders_xml, tables
from tallyhouse.sources import schemas as S
from tallyhouse.streaming import file_stream, incremental, manifest, reload

LOADED = dt.datetime(2001, 8, 10, 6, 0, 0)
RENAMED = {"Location": "location", "Date": "sale_date", "Order ID": "order_id"}


def col(name: str, alias: str | None = None) -> Column:
    return F.col(f"`{name}`").alias(alias or name.lower().replace(" ", "_"))


class Landed:
    """Feed files written once per warehouse."""

    def __init__(self, w: Warehouse):
        self.w = w
        self._done: dict[str, str] = {}

    def _once(self, name: str, write) -> str:
        if name not in self._done:
            self._done[name] = write(fresh_dir(self.w.spark, f"landing-{name}"))
        return self._done[name]

    @property
    def a(self) -> str:
        return self._once(
            "a", lambda d: landing.land_feed_a(self.w.text_a, d, spread=self.w.spread)
        )

    @property
    def b(self) -> str:
        return self._once(
            "b", lambda d: landing.land_feed_b(self.w.text_b, d, spread=self.w.spread)
        )

    @property
    def xml(self) -> str:
        return self._once(
            "xml",
            lambda d: landing.land_orders(tables.nested_orders(self.w.lines, self.w.settings), d),
        )

    @property
    def seed(self) -> str:
        def write(d: str) -> str:
            self.w.campaign_seed.write.option("header", True).csv(d)
            return d

        return self._once("seed", write)

    @property
    def compact(self) -> str:
        """A later CSV layout: fewer columns, another order, one new column."""

        def write(d: str) -> str:
            self.w.raw_c.select(
                col("Order ID", "Order ID"), col("Location", "Location"),
                col("Destination", "Promo Code"),
            ).write.option("header", True).option("compression", landing.COMPRESSION).csv(d)
            return d

        return self._once("compact", write)


_landed: dict[int, Landed] = {}


def landed(w: Warehouse) -> Landed:
    return _landed.setdefault(id(w), Landed(w))


# --- scans and parsing ----------------------------------------------------------


def feed_a_scan(w: Warehouse) -> DataFrame:
    df = feeds.read_feed_a(w.spark, landed(w).a, LOADED)
    return df.select(
        col("Location"), col("Date", "sale_date"), col("Employee Name"), col("Item ID"),
        col("Item Name"), col("Price"), col("Net Sales"), col("Voided"), col("Is Modifier"),
        col("Destination"), col("Order ID"), col("_source_file"), col("_source_system"),
    )


def feed_b_scan(w: Warehouse) -> DataFrame:
    df = feeds.read_feed_b(w.spark, landed(w).b, w.settings.brand, LOADED)
    return df.select(
        col("Location"), col("Date", "sale_date"), col("Account"), col("Staff"), col("Reference"),
        col("Type"), col("Qty"), col("FinalPrice", "final_price"), col("Item"),
        col("Group", "item_group"), col("_source_file"),
    )


def line_balance(w: Warehouse) -> DataFrame:
    """Raw, kept, filtered and rejected lines of every file of both CSV feeds."""
    text_a = feeds.read_feed_a_text(w.spark, f"{landed(w).a}/{feeds.FEED_A_GLOB}")
    text_b = feeds.read_feed_b_text(w.spark, f"{landed(w).b}/{feeds.FEED_B_GLOB}")
    sale = F.coalesce(F.col("Type").isin(*S.FEED_B_SALE_TYPES), F.lit(False))
    a = feeds.line_balance(text_a, "Closed Date/Time", F.lit(True), P.FEED_A_FILE)
    return a.unionByName(feeds.line_balance(text_b, "Date", sale, P.FEED_B_FILE))


def mixed_dates(w: Warehouse) -> DataFrame:
    text = w.text_a
    parsed = P.parse_mixed_ts("Closed Date/Time")
    rows = text.groupBy(F.to_date(parsed).alias("day"), F.hour(parsed).alias("hour"))
    return rows.agg(F.count("*").alias("lines"))


def feed_b_dates(w: Warehouse) -> DataFrame:
    text = w.text_b
    return text.groupBy(P.parse_feed_b_date("Date").alias("day")).agg(F.count("*").alias("lines"))


def _money_by_file(w: Warehouse, value: Column) -> DataFrame:
    text = w.text_a
    return text.groupBy("file").agg(
        F.sum(value).alias("net_sales"), F.count_if(value.isNull()).alias("unreadable")
    )


def currency(w: Warehouse) -> DataFrame:
    return _money_by_file(w, P.clean_currency("Net Sales"))


def accounting(w: Warehouse) -> DataFrame:
    return _money_by_file(w, P.clean_accounting("Net Sales"))


def lineage(w: Warehouse) -> DataFrame:
    df = feeds.read_feed_a(w.spark, landed(w).a, LOADED)
    return df.groupBy("_source_file", "_source_system", "_ingested_at").agg(
        F.count("*").alias("lines")
    )


def stores_from_files(w: Warehouse) -> DataFrame:
    text = w.text_b
    files = text.groupBy("file").agg(F.count("*").alias("lines"))
    return files.withColumn("store", P.store_from_filename("file", w.settings.brand))


def xml_orders(w: Warehouse) -> DataFrame:
    orders, _ = orders_xml.flatten_orders(w.spark, landed(w).xml)
    return orders


def xml_entries(w: Warehouse) -> DataFrame:
    _, entries = orders_xml.flatten_orders(w.spark, landed(w).xml)
    return entries


def _xml_bronze_columns(df: DataFrame) -> DataFrame:
    return df.select(
        col("Location"), col("Date", "sale_date"), col("Employee Name"), col("Item ID"),
        col("Price"), col("Taxes"), col("Net Sales"), col("Total Sales"), col("Revenue Center"),
        col("Destination"), col("Voided"), col("Is Modifier"), col("Order ID"), "entry_id",
    )


def xml_to_bronze(w: Warehouse) -> DataFrame:
    orders, entries = orders_xml.flatten_orders(w.spark, landed(w).xml)
    return _xml_bronze_columns(orders_xml.entries_to_bronze(orders, entries, F.lit(LOADED)))


def xml_to_bronze_direct(w: Warehouse) -> DataFrame:
    nested = orders_xml.read_orders(w.spark, landed(w).xml)
    return _xml_bronze_columns(orders_xml.nested_to_bronze(nested, F.lit(LOADED)))


# --- loads ------------------------------------------------------------------------


def _new_table(w: Warehouse, df: DataFrame, partitions: tuple[str, ...]) -> reload.Table:
    return reload.Table(w.spark, fresh_dir(w.spark, "table"), df.schema, partitions)


def _slices(w: Warehouse) -> DataFrame:
    """Feed-C rows as store-day slices."""
    return w.raw_c.select(
        F.trim("Location").alias("store"), col("Date", "sale_date"),
        col("Order ID"), "entry_id", col("Net Sales"),
    )


def _slice_totals(df: DataFrame, *more: Column) -> DataFrame:
    return df.groupBy("store", "sale_date").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales"), *more
    )


def replaced_slices(w: Warehouse) -> DataFrame:
    """All slices, then a second delivery of the year 2000 with one unit more per line."""
    rows = _slices(w)
    target = _new_table(w, rows, ("store", "sale_date"))
    reload.replace_slice(rows, target)
    again = rows.filter(F.year("sale_date") == 2000).withColumn(
        "net_sales", (F.col("net_sales") + 1).cast(P.MONEY)
    )
    reload.replace_slice(again, target)
    return _slice_totals(target.read())


def replaced_entries(w: Warehouse) -> DataFrame:
    """Raw entries with a unique key; the second delivery lacks the void entries of 1999.

    A store-day that holds voids only is not in the delivery at all, so its slice stays.
    """
    rows = tables.raw_feed_c_entries(w.lines, w.settings).select(
        F.trim("store_name").alias("store"), F.col("business_date").alias("sale_date"),
        "order_id", "entry_id", "net_sales", "is_voided",
    )
    target = _new_table(w, rows, ("store", "sale_date"))
    reload.replace_entries(rows, target)
    reload.replace_entries(rows.filter((F.year("sale_date") == 1999) & ~F.col("is_voided")), target)
    return _slice_totals(target.read(), F.count_if("is_voided").alias("voided"))


def unseen_files(w: Warehouse) -> DataFrame:
    """Feed-A files on disk that a manifest of the loads before 2000 does not name."""
    found = manifest.list_files(
        w.spark, f"{landed(w).a}/{feeds.FEED_A_GLOB}", P.FEED_A_FILE, "feed_a"
    )
    known = w.manifest.filter(F.col("loaded_at") < F.lit("2000-01-01").cast("timestamp"))
    return manifest.new_files(found, known)


def _days(df: DataFrame, money: str = "Net Sales") -> DataFrame:
    """Rows of a delivery with the day that range reloads go by."""
    return df.select(
        F.trim("Location").alias("store"), col("Date", "sale_date"),
        col(money, "net_sales"), F.lit(1).alias("version"),
    )


def _by_version(df: DataFrame) -> DataFrame:
    return df.groupBy("sale_date", "version").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def _second_version(df: DataFrame) -> DataFrame:
    """Mid 2000 again, without July."""
    month = F.trunc("sale_date", "MM").cast("string")
    chosen = df.filter(month.isin("2000-05-01", "2000-06-01", "2000-08-01"))
    return chosen.withColumn("version", F.lit(2))


def reloaded_range(w: Warehouse) -> DataFrame:
    """A reload of May to August 2000 that lacks July: July goes, the rest is replaced."""
    rows = _days(w.raw_a)
    target = _new_table(w, rows, ("sale_date",))
    reload.load([rows, _second_version(rows)], target, "sale_date")
    return _by_version(target.read())


def reloaded_scope(w: Warehouse) -> DataFrame:
    """The same reload by one store leaves the other stores alone."""
    rows = _days(w.raw_b, "FinalPrice")
    target = _new_table(w, rows, ("sale_date",))
    reload.load([rows], target, "sale_date")
    mine = rows.filter(F.col("store").endswith("NATION_5"))
    reload.load([_second_version(mine)], target, "sale_date", scope_col="store")
    return target.read().groupBy("store", "sale_date", "version").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def refreshed(w: Warehouse) -> DataFrame:
    """A full refresh keeps nothing of the table it finds."""
    rows = _days(w.raw_a)
    target = _new_table(w, rows, ("sale_date",))
    reload.load([rows], target, "sale_date")
    reload.load([_second_version(rows)], target, "sale_date", full_refresh=True)
    return _by_version(target.read())


def upserted_manifest(w: Warehouse) -> DataFrame:
    """Files of 2001 loaded again with one row more: one manifest row per file."""
    late = F.col("loaded_at") >= F.lit("2001-01-01").cast("timestamp")
    again = w.manifest.filter(late).select(
        "source_name", "filename", (F.col("row_count") + 1).alias("row_count"),
        F.lit(LOADED).alias("loaded_at"),
    )
    return manifest.mark_processed(w.manifest, again)


def seed(w: Warehouse) -> DataFrame:
    return feeds.load_seed(w.spark, landed(w).seed)


def split_parts(w: Warehouse) -> DataFrame:
    mixed = w.raw_a.unionByName(w.raw_c, allowMissingColumns=True)
    parts = bronze.split_by_source(mixed, ["feed_a", "feed_c"])
    targets = {t: _new_table(w, p, ("Location",)) for t, p in parts.items()}
    bronze.write_parts(parts, targets)
    written = [targets[t].read().select(F.count("*")).scalar().alias(f"{t}_written") for t in parts]
    return bronze.split_balance(mixed, parts).select("*", *written)


def utc_instants(w: Warehouse) -> DataFrame:
    events = tables.table(w.spark, w.sf_dir, "events")
    return events.select("event_id", F.unix_micros(P.as_utc("ts")).alias("utc_micros"))


def many_files(w: Warehouse) -> DataFrame:
    """Two CSV layouts by name: what one lacks is NULL."""
    both = feeds.read_many(w.spark, [f"{landed(w).a}/{feeds.FEED_A_GLOB}", landed(w).compact])
    return both.groupBy(F.trim("Location").alias("location"), col("Promo Code")).agg(
        F.count("*").alias("lines"), F.count("Net Sales").alias("priced_lines")
    )


def since_day(w: Warehouse) -> DataFrame:
    recent = feeds.since(w.raw_a, "Date", dt.date(2000, 12, 31))
    return recent.groupBy(col("Date", "sale_date")).agg(F.count("*").alias("lines"))


PUBLISHED = (
    "dim_date", "dim_destination", "dim_employee", "dim_product", "dim_store",
    "fact_order", "fact_order_detail", "fact_sale_item", "fact_by_employee",
)


def published(w: Warehouse) -> DataFrame:
    """Row counts of every published table, read back from the sink."""
    sink = fresh_dir(w.spark, "published")
    sizes = [
        w.publish(n, sink).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count"))
        for n in PUBLISHED
    ]
    out = sizes[0]
    for size in sizes[1:]:
        out = out.unionByName(size)
    return out


def bronze_b_rows(w: Warehouse) -> DataFrame:
    return w.raw_b.select(
        col("Identifier"), col("Date", "sale_date"), col("Account"), col("Staff"),
        col("Reference"), col("Type"), col("Qty"), col("FinalPrice", "final_price"),
        col("Discount"), col("Item"), col("Group", "item_group"), col("TaxAmount", "tax_amount"),
        col("Location"), "_source_file", "_ingested_at",
    )


def files_to_gold(w: Warehouse) -> DataFrame:
    """The whole way from landed feed files to the order and item facts."""
    files = landed(w)
    built = FeedWarehouse(w.spark, files.a, files.b, files.xml, files.seed, LOADED, w.settings, tables.store_aliases(w.settings))
    # feeds do not wait for each other, nor do dimensions: the many small XML files leave cores idle that the CSV lines take
    together(lambda: built.raw_a, lambda: built.raw_b, lambda: built.raw_c)
    built.stg_orders  # written once, before the dimensions read it
    together(lambda: built.dim_date, lambda: built.dim_store, lambda: built.dim_product, lambda: built.dim_destination)
    orders = built.fact_order.groupBy("source_system", "store_key").agg(
        F.count("*").alias("orders"), F.sum("order_net_sales").alias("net_sales")
    )
    items = built.fact_sale_item.groupBy("source_system", "store_key").agg(
        F.sum("qty").alias("items_sold"), F.sum("item_net_sales").alias("item_net_sales")
    )
    both = orders.join(items, ["source_system", "store_key"], "full_outer")
    return both.join(built.dim_store.select("store_key", "store_name"), "store_key").drop("store_key")


def incremental_to_gold(w: Warehouse) -> DataFrame:
    """Three deliveries through the whole warehouse, the first of which breaks off after its load.

    The first lacks feed A's file of June 2000; its run dies when bronze is written. The second brings that
    file late, together with a corrected file for May 2000 in which every line costs seven. The third brings new
    order payloads for the known store-days of April 2000, in which every entry costs five. Each run opens the tables anew.
    """
    base = fresh_dir(w.spark, "deliveries")
    files = landed(w)
    late, wrong = F.col("file") == "DDBB_Jun_00.csv", F.col("file") == "DDBB_May_00.csv"
    orders = tables.nested_orders(w.lines, w.settings)
    xml = landing.land_orders(orders, f"{base}/xml")
    feed_a, feed_b = landing.land_feed_a(w.text_a.filter(~late), f"{base}/a", spread=w.spread), files.b
    root, aliases = f"{base}/warehouse", tables.store_aliases(w.settings)

    def open_live() -> LiveWarehouse:
        return LiveWarehouse(w.spark, root, w.settings, aliases)

    open_live().load(feed_a, feed_b, xml, LOADED)
    fixed = w.text_a.filter(wrong).withColumns({"Net Sales": F.lit("$7.00"), "file": F.lit("DDBB_May_00_fixed.csv")})
    landing.land_feed_a(w.text_a.filter(late).unionByName(fixed), feed_a, mode="append")
    open_live().run(feed_a, feed_b, xml, LOADED + dt.timedelta(days=1))
    entries = F.transform("Entries.OrderEntry", lambda e: e.withField("ItemNetSales", F.lit("5.00")))
    april = orders.filter(F.col("date").between(F.lit("2000-04-01").cast("date"), F.lit("2000-04-30").cast("date")))
    landing.land_orders(april.withColumn("Entries", F.struct(entries.alias("OrderEntry"))), xml, mode="append")
    live = open_live()
    live.run(feed_a, feed_b, xml, LOADED + dt.timedelta(days=2))
    by = ["source_system", "sale_month"]
    orders_told = live.fact_order.groupBy(*by).agg(F.count("*").alias("orders"), F.sum("order_net_sales").alias("net_sales"))
    items = live.fact_sale_item.groupBy(*by).agg(F.sum("qty").alias("items_sold"))
    staff = live.fact_by_employee.groupBy("sale_month").agg(F.sum("net_sales").alias("staff_net_sales"))
    return orders_told.join(items, by, "full_outer").join(staff, "sale_month", "left")


# --- cleansing ----------------------------------------------------------------------


def precedence(w: Warehouse) -> DataFrame:
    return w.bronze_ac.groupBy(col("Location"), col("Date", "sale_date"), "_source_system").agg(
        F.count("*").alias("lines"), F.sum("Net Sales").alias("net_sales")
    )


def enriched(w: Warehouse) -> DataFrame:
    rows = silver.enrich(w.bronze_ac, w.item_catalog)
    return rows.select(
        col("Order ID"), col("Item ID"), col("Net Sales"), "_source_system",
        "eff_revenue_center", "eff_item_name",
    )


def _mapped(df: DataFrame, raw: str, value: Column) -> DataFrame:
    return df.groupBy(col(raw, "raw"), value.alias("clean")).agg(F.count("*").alias("lines"))


def store_names(w: Warehouse) -> DataFrame:
    return _mapped(w.raw_a, "Location", C.norm_store("Location", w.settings.brand.prefixes))


def categories_a(w: Warehouse) -> DataFrame:
    return _mapped(w.bronze_ac, "Revenue Center", C.category_a("Revenue Center"))


def categories_b(w: Warehouse) -> DataFrame:
    return _mapped(w.raw_b, "Group", C.category_b("Group"))


def canonical_a(w: Warehouse) -> DataFrame:
    return _mapped(w.raw_a, "Item Name", C.canon_a(C.tidy("Item Name")))


def canonical_b(w: Warehouse) -> DataFrame:
    return _mapped(w.raw_b, "Item", C.canon_b(C.tidy("Item")))


def _kept(df: DataFrame, test: Column) -> DataFrame:
    return df.groupBy("_source_system").agg(
        F.count("*").alias("lines"), F.count_if(test).alias("kept")
    )


def kept_a(w: Warehouse) -> DataFrame:
    return _kept(w.bronze_ac, silver.filter_a())


def kept_b(w: Warehouse) -> DataFrame:
    return _kept(w.raw_b, silver.filter_b())


# --- incremental --------------------------------------------------------------------


def _silver(w: Warehouse) -> DataFrame:
    return w.stg_orders.select(*silver.STG_COLUMNS)


def _loaded_before(w: Warehouse, when: str) -> DataFrame:
    return _silver(w).filter(F.col("_ingested_at") < F.lit(when).cast("timestamp"))


def watermark_rows(w: Warehouse) -> DataFrame:
    """Rows newer than a target that was loaded up to the end of 2000, per source."""
    held = _loaded_before(w, "2001-01-01 00:00:00")
    new = incremental.newer_than_target(_silver(w), held, inclusive=False)
    return new.groupBy("_source_system", "sale_date").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def _store_days(w: Warehouse) -> DataFrame:
    return _silver(w).select(
        "store_name", "sale_date", "order_ref", "net_sales", "_source_system", "_ingested_at"
    )


def _upserted(w: Warehouse) -> reload.Table:
    rows = _store_days(w)
    target = _new_table(w, rows, ("sale_date",))
    early = rows.filter(F.col("_ingested_at") < F.lit("2000-07-01").cast("timestamp"))
    target.replace_partitions(early)
    incremental.upsert_slices(rows, target)
    return target


def upserted_slices(w: Warehouse) -> DataFrame:
    """A table loaded to mid 2000, then one incremental run over everything."""
    return _upserted(w).read().groupBy("store_name", "sale_date").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def delete_insert(w: Warehouse) -> DataFrame:
    """Orders of 2001 delivered again at twice the price: no order twice, all others as before."""
    keys = ["source_system", "order_id"]
    fact = w.fact_order.select(*keys, "date_key", "order_net_sales")
    batch = fact.filter(F.col("date_key") >= 20010101).withColumn(
        "order_net_sales", (F.col("order_net_sales") * 2).cast(P.MONEY)
    )
    return incremental.delete_insert(fact, batch, keys)


def refreshed_fact(w: Warehouse) -> DataFrame:
    """An order fact built to mid 2000, then the months that later loads touch."""

    def build(stg: DataFrame) -> DataFrame:
        return facts.fact_order(stg, w.dim_date, w.dim_store, w.dim_destination)

    held = w.stg_orders.filter(F.col("_ingested_at") < F.lit("2000-07-01").cast("timestamp"))
    first = build(held)
    target = _new_table(w, first, ("sale_month",))
    target.replace_partitions(first)
    new = incremental.newer_than_target(w.stg_orders, held)
    incremental.refresh_months(w.stg_orders, new, build, target)
    return target.read().groupBy("sale_month", "source_system").agg(
        F.count("*").alias("orders"), F.sum("order_net_sales").alias("net_sales")
    )


def lookback_rows(w: Warehouse) -> DataFrame:
    held = _silver(w).filter(F.col("sale_date") < F.lit("2001-03-01").cast("date"))
    new = incremental.since_lookback(_silver(w), held, 35)
    return new.groupBy("sale_date").agg(F.count("*").alias("lines"))


def streamed_files(w: Warehouse) -> DataFrame:
    """The silver table's own files through a file stream into store-day slices."""
    rows = _store_days(w)
    source = fresh_dir(w.spark, "stream-source")
    rows.write.parquet(source)
    target = _new_table(w, rows, ("sale_date",))
    stream = file_stream.stream_files(w.spark, source, rows.schema)
    file_stream.ingest_available(stream, target)
    return target.read().groupBy("store_name", "_source_system").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def streamed_feeds(w: Warehouse) -> DataFrame:
    """The landed CSV files of both feeds as streams of lines, through bronze into store-day slices."""
    sources = (
        ("feed_a", feeds.stream_feed_a_text(w.spark, landed(w).a), "Net Sales",
         lambda text, balance: feeds.staged_a(text, balance, LOADED)),
        ("feed_b", feeds.stream_feed_b_text(w.spark, landed(w).b), "FinalPrice",
         lambda text, balance: feeds.staged_b(text, balance, LOADED, w.settings.brand)),
    )
    found = []
    for name, text, amount, stage in sources:
        schema = stage(text.sparkSession.createDataFrame([], text.schema), Observation()).drop("_reason", "_line").schema
        target = reload.Table(w.spark, fresh_dir(w.spark, name), schema, ("Date",))
        rejects = file_stream.rejects_table(w.spark, fresh_dir(w.spark, f"{name}-rejects"))
        file_stream.ingest_feed(text, stage, target, rejects)
        slices = target.read().groupBy(F.col("Location").alias("location"), F.col("Date").alias("sale_date"))
        found.append(slices.agg(F.lit(name).alias("feed"), F.count("*").alias("lines"), F.sum(amount).alias("amount")))
    return found[0].unionByName(found[1])


def late_arrivals(w: Warehouse) -> DataFrame:
    return incremental.late_arrivals(w.stg_orders)
