"""Explicit schemas of the feeds and the tables they land in."""

from __future__ import annotations

from pyspark.sql import types as T

# Feed column names, in file order.
FEED_A_COLUMNS = (
    "Location", "Closed Date/Time", "Employee Name", "Item ID", "Item Name", "Item PLU", "Price",
    "Discount Total", "Promotion Total", "Taxes", "Net Sales", "Gross Sales", "Total Sales",
    "Revenue Center", "Has Employee Discount", "Destination", "Voided", "Has Customer",
    "Is Modifier", "Order ID",
)
FEED_B_COLUMNS = (
    "Identifier", "PeriodId", "YearId", "Device_Name", "Passive_Device", "Date", "Mode", "Account",
    "AccountName", "Staff", "Reference", "Type", "Qty", "UnitPrice", "FinalPrice", "Discount",
    "Loss", "Comp", "Charge", "SKU", "Item", "Group", "StatGroup", "TaxName", "TaxRate", "PreTax",
    "TaxAmount", "Profile",
)
FEED_A_MONEY = (
    "Price", "Discount Total", "Promotion Total", "Taxes", "Net Sales", "Gross Sales",
    "Total Sales",
)
FEED_A_FLAGS = ("Has Employee Discount", "Voided", "Has Customer", "Is Modifier")
FEED_B_MONEY = (
    "UnitPrice", "FinalPrice", "Discount", "Loss", "Comp", "Charge", "PreTax", "TaxAmount",
)
FEED_B_SALE_TYPES = ("SALE", "UPDATE")
LINEAGE = ("_source_file", "_source_system", "_ingested_at")


def all_text(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


FEED_A_TEXT = all_text(FEED_A_COLUMNS)
FEED_B_TEXT = all_text(FEED_B_COLUMNS)

# One nested order, every leaf read as text and cast later.
ORDER_LEAVES = (
    "Id", "Number", "IsClosed", "IsRefund", "IsVoided", "NetSales", "GrossSales", "Total",
    "SubTotal", "Tax", "GuestCount", "TipAmount", "OpenedTime", "ClosedTime", "TerminalId",
    "TillNumber", "EmployeeId", "DestinationId",
)
ENTRY_LEAVES = (
    "Id", "ItemId", "DayPartId", "ItemNetSales", "ItemGrossSales", "DisplayPrice", "IsVoided",
    "IsDeleted",
)
ORDER_XML = T.StructType(
    [
        *all_text(ORDER_LEAVES).fields,
        T.StructField(
            "Entries",
            T.StructType([T.StructField("OrderEntry", T.ArrayType(all_text(ENTRY_LEAVES)))]),
        ),
    ]
)
RESULT_XML = T.StructType(
    [T.StructField("ResultCode", T.StringType()), T.StructField("Message", T.StringType())]
)

#: A whole payload, orders in its envelope or alone; text that is not well-formed comes out in the last column alone.
PAYLOAD_XML = T.StructType(
    [
        *RESULT_XML.fields,
        T.StructField("Orders", T.StructType([T.StructField("Order", T.ArrayType(ORDER_XML))])),
        T.StructField("Order", T.ArrayType(ORDER_XML)),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

CAMPAIGN_SEED = "product_canonical_name string, campaign_name string, " \
    "campaign_start_date date, campaign_end_date date"
MANIFEST = "source_name string, filename string, row_count bigint, loaded_at timestamp"
