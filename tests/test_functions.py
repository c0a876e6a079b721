"""Column expressions on hand-made values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import classify, cleansing, measures, parsing
from tallyhouse.settings import Brand

D = dt.date


def test_mixed_timestamps(column):
    texts = [
        "4/14/2025 5:09 PM", "06/03/2026 05:30:55 PM", "1/2/2025 12:00 PM", "1/2/2025 12:00 AM",
        "1/2/2025 12:00:01 AM", " 11/30/2025 9:05 AM ", "2025-01-02", "not a date", "", None,
    ]
    got = column(texts, parsing.parse_mixed_ts)
    assert got[:6] == [
        dt.datetime(2025, 4, 14, 17, 9), dt.datetime(2026, 6, 3, 17, 30, 55),
        dt.datetime(2025, 1, 2, 12, 0), dt.datetime(2025, 1, 2, 0, 0),
        dt.datetime(2025, 1, 2, 0, 0, 1), dt.datetime(2025, 11, 30, 9, 5),
    ]
    assert got[6:] == [dt.datetime(2025, 1, 2)] + [None] * 3


def test_feed_b_dates_and_their_century(column):
    texts = ["4/1/26 9:00 AM", "12/31/25 12:00 AM", "2/29/96 1:00 PM", "1/1/69 1:00 PM",
             "1/1/68 1:00 PM", "x", None]
    assert column(texts, parsing.parse_feed_b_date) == [
        D(2026, 4, 1), D(2025, 12, 31), D(1996, 2, 29), D(1969, 1, 1), D(2068, 1, 1), None, None
    ]


def test_currency(column):
    texts = ["$1,234.50", "0", "-3.25", "$0.00", "(1.00)", "abc", "", None, "$1,000,000.00"]
    assert column(texts, parsing.clean_currency) == [
        Decimal("1234.50"), Decimal("0.00"), Decimal("-3.25"), Decimal("0.00"), None, None, None,
        None, Decimal("1000000.00"),
    ]


def test_accounting(column):
    texts = ["($1,234.50)", "$2.00", "(1.00)", "", "nan", None]
    assert column(texts, parsing.clean_accounting) == [
        Decimal("-1234.50"), Decimal("2.00"), Decimal("-1.00"), None, None, None
    ]
    assert column(texts, parsing.accounting_or_zero)[3:] == [Decimal("0.00")] * 3


@pytest.mark.parametrize(
    "text, want",
    [
        ("4/14/2025 5:09 PM", "2025-04-14 17:09:00"), ("06/03/2026 05:30:55 PM", "2026-06-03 17:30:55"),
        ("2025-04-14 17:09", "2025-04-14 17:09:00"), ("4/14/2025 17:09", "2025-04-14 17:09:00"),
        ("2025-04-14T17:09:01", "2025-04-14 17:09:01"), ("2025-04-14", "2025-04-14 00:00:00"),
        ("4/14/2025", "2025-04-14 00:00:00"), ("soon", None), ("13/45/2025 5:09 PM", None), ("", None),
    ],
)
def test_mixed_spellings(column, text, want):
    found = column([text], parsing.parse_mixed_ts)[0]
    assert (found and str(found)) == want


@pytest.mark.parametrize(
    "name, store",
    [
        ("bluebirdcoffee-hqaccount_bluebirdcoffeeberkeley_transactions_20260401.csv",
         "Bluebird Coffee Berkeley"),
        ("x/file=b-hqaccount_bluebirdcoffeenation_3b_transactions_all.csv/part-0.csv",
         "Bluebird Coffee Nation_3B"),
        ("b-hqaccount_bluebirdcoffee123_transactions_1.csv", "Bluebird Coffee 123"),
        ("b-hqaccount_bluebirdcoffeelas-vegas_transactions_1.csv", "Unknown"),
        ("b-hqaccount_bluebirdcoffee_transactions_1.csv", "Unknown"),
        ("other.csv", "Unknown"),
    ],
)
def test_store_from_filename(column, name, store):
    assert column([name], parsing.store_from_filename) == [store]


def test_as_utc_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2026-03-01 10:00:00.25' as t")
        got = df.select(F.unix_micros(parsing.as_utc("t"))).head()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = dt.datetime(2026, 3, 1, 10, 0, 0, 250000, dt.timezone.utc).timestamp()
    assert got == int(want * 1_000_000)


def test_store_names(column):
    brand = Brand("Bluebird")
    raw = ["Bluebird Coffee Berkeley", "BLUEBIRD COFFEE BERKELEY", "bluebird Las Vegas",
           "Downtown Market", "  Bluebird Coffee X ", "Bluebird Coffee  North  End", "**LAB-01**",
           "BluebirdCoffee", None]
    assert column(raw, lambda c: cleansing.norm_store(c, brand.prefixes)) == [
        "BERKELEY", "BERKELEY", "LAS VEGAS", "DOWNTOWN MARKET", "BLUEBIRD COFFEE X",
        "NORTH  END", "**LAB-01**", "BLUEBIRDCOFFEE", None,
    ]


def test_category_a(column):
    raw = ["Beverages", "FOOD", "Hot Food", "Combo Meal", "RETAIL", "NO TAX", "", "Beverage Food", None]
    assert column(raw, cleansing.category_a) == [
        "Beverage", "Food", "Food", "Food", "Retail", "Other", "Other", "Beverage", "Other"
    ]


def test_category_b(column):
    raw = ["Beverages(1)", "Bottled Drinks(2)", "Food(3)", "Bakery Items(4)", "Grab & Go(5)",
           "Taste of Italy(6)", "Combo Burgers(7)", "Cold Good Things(8)", "Retail Items(9)",
           "Unknown(10)", "Beverages", "Other (food)", None]
    assert column(raw, cleansing.category_b) == [
        "Beverage", "Beverage", "Food", "Food", "Food", "Food", "Food", "Food", "Retail", "Other",
        "Beverage", "Other", "Other",
    ]


def test_canonical_names(column):
    a = ["16 OZ ICED LATTE", "96OZ CARAFE DRIP", "LATTE 16 OZ", "OZ X", "ICED LATTE", None]
    assert column(a, cleansing.canon_a) == [
        "ICED LATTE", "CARAFE DRIP", "LATTE 16 OZ", "OZ X", "ICED LATTE", None
    ]
    b = ["ICED LATTE (16 OZ) M", "ESPRESSO (4OZ)", "MOCHA ( 12 OZ ) XL ", "A (4 OZ) B C",
         "X (16 OZ) LONG", "PLAIN"]
    assert column(b, cleansing.canon_b) == [
        "ICED LATTE", "ESPRESSO", "MOCHA", "A (4 OZ) B C", "X (16 OZ) LONG", "PLAIN"
    ]


def test_channel_order_matters(column):
    raw = ["DINE IN", "DRIVE THRU", "TO GO", "DELIVERY", "CATERING", "KIOSK", "GO DELIVERY"]
    assert column(raw, cleansing.channel) == [
        "In-Store", "Drive-Thru", "Takeout", "Delivery", "Catering", "Other", "Takeout"
    ]


def test_royalty(column):
    raw = ["MEIJER GRAND", "LAS VEGAS", "LAS VEGAS NORTH", "BERKELEY"]
    assert column(raw, cleansing.royalty_rate) == [
        Decimal("0.04"), Decimal("0.08"), Decimal("0.07"), Decimal("0.07")
    ]


def test_surrogate_keys_are_positive_and_differ(column):
    keys = column(["A", "B", "A"], cleansing.surrogate_key)
    assert keys[0] == keys[2] == 575429578143199482
    assert keys[0] != keys[1] and all(0 <= k < 2**60 for k in keys)


def test_ratio_rounds_half_away_and_survives_zero(spark):
    df = spark.sql("select * from values (24.69, 2), (-24.69, 2), (1.0, 0), (null, 1) as t(n, d)")
    got = [r[0] for r in df.select(measures.ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [Decimal("12.35"), Decimal("-12.35"), None, None]


CLASSES = {
    "Mini Gluten Free Red Velvet": "Cake Red Velvet Mini Gluten Free",
    "red velvet cake": "Cake Red Velvet",
    "Red Velvet Cupcake": None,
    "RV cake slice": "Cake Red Velvet",
    "chocolate temptation": "Cake Chocolate Temptation",
    "Ricota & Pistashio": "Cake Ricotta and Pistachio",
    "riotta cak": "Cake Ricotta and Pistachio",
    "ricotta pie": None,
    "Pistacio Chees Cake": "Cheesecake Pistachio",
    "pistachio latte": None,
    "french macarons": "Macarons French",
    "carot cake": "Cake Carrot",
    "carrot juice": None,
    "cappuccino cake": "Cake Cappuccino",
    "cappuccino": None,
    "dulce de leche": "Cheesecake Dulce de Leche",
    "strabery chz cake": "Cheesecake Strawberry",
    "fragola cheesecake": "Cheesecake Strawberry",
    "2 strawberry cakes": "Cheesecake Strawberry",
    "strawberry cake": None,
    "tiramisu ladyfinger": "Tiramisu With Ladyfingers",
    "taramisu": "Tiramisu",
    "tiramisu latte": None,
    "ganache chesecake": "Cheesecake Chocolate Ganache",
    "choc gan": "Cheesecake Chocolate Ganache",
    "torta nocciola": "Cake Torta Nocciola",
    "mixed berry tart": "Tart Mixed Berry",
    "mixed bery tar": "Tart Mixed Berry",
    "mixed berry target": None,
    "chocolate fondant": "Cake Chocolate Fondant",
    "tres lechs": "Cake Tres Leches",
    "brwni cheesecake": "Cheesecake Brownie",
    "brownie": None,
    "latte": None,
}


def test_keyword_classes(column):
    assert column(list(CLASSES), classify.classify_by_keyword) == list(CLASSES.values())
    assert column([" MACARON ", None], classify.classify_by_keyword) == ["Macarons French", None]


def test_exact_names_come_first(column):
    names = list(classify.EXACT_NAMES)
    shown = [f" {n.title()} " for n in names] + ["choc gan", "latte", None]
    want = list(classify.EXACT_NAMES.values()) + ["Cheesecake Chocolate Ganache", None, None]
    assert column(shown, classify.classify_by_name) == want
