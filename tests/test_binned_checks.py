"""Month-binned campaign join and reconciliation by month marks, against plain code."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from tallyhouse.operators import checks, facts

DAY = dt.date(2024, 1, 15)


def test_campaigns_against_all_pairs(spark):
    rng = random.Random(3)
    day = lambda: DAY + dt.timedelta(days=rng.randrange(-200, 700))
    seed = [(rng.choice("AB"), i, f"C{i}", rng.choice([None, day(), day()]), rng.choice([None, day(), day()])) for i in range(120)]
    sales = [(p, DAY + dt.timedelta(days=n)) for p in ("A", "B", "C", None) for n in range(0, 400, 9)] + [("A", None)]
    campaigns = spark.createDataFrame(
        seed + [(None, 900, "none", None, None)],
        "product_canonical_name string, campaign_key long, campaign_name string, campaign_start_date date, campaign_end_date date")
    sold = spark.createDataFrame(sales, "product_canonical_name string, d date")
    got = facts.attribute_campaigns(sold, campaigns, "d")
    want = []
    for product, d in sales:
        met = [c[1] for c in seed if d and c[0] == product and (c[3] is None or d >= c[3]) and (c[4] is None or d <= c[4])]
        want += [(str(product), str(d), k) for k in met] or [(str(product), str(d), None)]
    assert sorted(map(repr, want)) == sorted(repr((str(r[0]), str(r.d), r.campaign_key)) for r in got.collect())
    assert facts.attribute_campaigns(sold.limit(0), campaigns, "d").count() == 0


LINES = "sale_date date, store_name string, order_ref string, qty decimal(18,3), _source_system string"
ITEMS = "source_system string, order_id string, sale_month date, qty decimal(18,3)"
JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


@pytest.mark.parametrize(
    "change, months, want",
    [
        ({}, set(), []),
        ({0: Decimal(5)}, {JAN}, [("a", "1", Decimal(8), Decimal(5))]),  # order 1 lies in both months
        ({0: Decimal(3), 1: Decimal(2)}, {JAN, FEB}, []),  # moved between months: no gap of the order
        ({2: None}, {JAN}, [("b", "1", None, Decimal(7))]),
    ],
)
def test_quantities_by_month_marks(spark, change, months, want):
    sold = [(JAN, "1", 2, "a"), (FEB, "1", 3, "a"), (JAN, "1", 7, "b"), (FEB, "2", 0, "a")]
    stg = spark.createDataFrame([(d, "s", o, Decimal(q), src) for d, o, q, src in sold], LINES)
    items = [[src, o, d, Decimal(q)] for d, o, q, src in sold]
    for i, qty in change.items():
        items[i][3] = qty
    fact = spark.createDataFrame([r for r in items if r[3] is not None], ITEMS)
    dates = spark.createDataFrame([(1, JAN), (2, FEB)], "date_key int, date date")
    stores = spark.createDataFrame([("s",)], "store_name string")
    lines = stg.selectExpr("*", "trunc(sale_date, 'MM') as sale_month")
    assert set(checks.differing_months(fact, lines)) == months
    got = [(r[0], r[1], r[2], r[3]) for r in checks.quantity_gaps(fact, stg, dates, stores).collect()]
    assert got == want
