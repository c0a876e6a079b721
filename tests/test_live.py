"""Incremental runs: broken ones, corrected files, rejects, and what a full rebuild would hold."""

import datetime as dt

import pytest

from tallyhouse.plans import live as L
from tallyhouse.sources import schemas as S
from tallyhouse.streaming import loads

DAY1, DAY2 = dt.datetime(2026, 7, 1, 6), dt.datetime(2026, 7, 2, 6)
FACTS = ("order_grain", "fact_sale_item", "fact_by_employee")
DIMS = ("dim_date", "dim_store", "dim_product", "dim_destination", "dim_employee")


def line_a(day, item, net, order, name="Latte", staff="Ann", store="Brand Berkeley", center="Beverage", dest="Dine In"):
    over = {"Location": store, "Closed Date/Time": f"{day:%m/%d/%Y} 10:30 AM", "Employee Name": staff, "Item ID": str(item), "Item Name": name,
            "Net Sales": net, "Revenue Center": center, "Destination": dest, "Voided": "False", "Is Modifier": "False", "Order ID": order}
    return [over.get(c, "") for c in S.FEED_A_COLUMNS]


def line_b(day, price, ref, kind="SALE", item="Mocha"):
    over = {"Date": f"{day:%m/%d/%y} 10:30 AM", "Account": "1", "Staff": "Bob", "Reference": ref, "Type": kind, "Qty": "1", "FinalPrice": price, "Item": item, "Group": "Drinks (1)"}
    return [over.get(c, "") for c in S.FEED_B_COLUMNS]


class Feeds:
    def __init__(self, root, settings):
        self.a, self.b, self.xml, self.slug = root / "a", root / "b", root / "xml", settings.brand.slug
        for folder in (self.a, self.b, self.xml):
            folder.mkdir(parents=True)

    def put_a(self, name, *lines):
        (self.a / f"DDBB_{name}.csv").write_text("\n".join([",".join(S.FEED_A_COLUMNS), *(x if isinstance(x, str) else ",".join(x) for x in lines)]) + "\n")

    def put_b(self, *lines):
        (self.b / f"{self.slug}-hqaccount_{self.slug}vegas_transactions_1.csv").write_text("\n".join([";".join(S.FEED_B_COLUMNS), *(";".join(x) for x in lines)]) + "\n", encoding="latin-1")

    def put_xml(self, store, day, payload, *orders, code="0"):
        folder = self.xml / f"store={store}" / f"date={day:%Y-%m-%d}"
        folder.mkdir(parents=True, exist_ok=True)
        body = "".join(
            f"<Order><Id>{o}</Id><EmployeeId>5</EmployeeId><DestinationId>1</DestinationId><Entries>"
            + "".join(f"<OrderEntry><Id>{o}-{k}</Id><ItemId>{item}</ItemId><DayPartId>3</DayPartId><ItemNetSales>{net}</ItemNetSales></OrderEntry>" for k, (item, net) in enumerate(lines))
            + "</Entries></Order>"
            for o, lines in orders
        )
        (folder / f"{payload}.xml").write_text(f"<GetOrdersResult><ResultCode>{code}</ResultCode><Message>m</Message><Orders>{body}</Orders></GetOrdersResult>")

    @property
    def folders(self):
        return str(self.a), str(self.b), str(self.xml)


JAN, FEB, MAR = dt.date(2026, 1, 5), dt.date(2026, 2, 6), dt.date(2026, 3, 7)


@pytest.fixture
def delivered(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield from _delivered(tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _delivered(tmp_path):
    feeds = Feeds(tmp_path / "in", L.Settings())
    feeds.put_a("Jan_26", line_a(JAN, 1, "3.00", "o1"), line_a(JAN, 2, "4.00", "o1", name="Tea"))
    feeds.put_a("Feb_26", line_a(FEB, 1, "5.00", "o2"), "too,short", line_a(FEB, 2, "1.00", "o9", name="Tea")[:1] + ["some day"] + line_a(FEB, 2, "1.00", "o9", name="Tea")[2:])
    feeds.put_b(line_b(FEB, "2.50", "r1"), line_b(FEB, "9.00", "r2", kind="VOID"))
    feeds.put_xml("Reno", JAN, "p1", ("x1", [(1, "6.00"), (2, "7.00")]))
    feeds.put_xml("Reno", MAR, "p1", ("x2", [(2, "8.00")]))
    yield feeds


def second(feeds):
    """A late file that covers an XML day, renames item 2, a corrected file, a second payload and a new day."""
    feeds.put_a("Mar_26", line_a(MAR, 2, "1.00", "o3", name="Green Tea"), line_a(MAR, 1, "2.00", "o4", store="Reno", staff="Zoe"))
    feeds.put_a("Jan_26", line_a(JAN, 1, "3.50", "o1", staff="Cleo"))
    feeds.put_xml("Reno", JAN, "p2", ("x1", [(1, "6.60")]), ("x5", [(2, "0.40")]))
    feeds.put_xml("Elko", FEB, "p1", ("x6", [(1, "1.10")]))


def state(spark, root):
    """What the tables say; load times and files aside."""
    live = L.LiveWarehouse(spark, root)
    out = {}
    for name in (*FACTS, "stg_orders"):
        rows = live._rows(name)
        out[name] = sorted(map(repr, rows.select(*sorted(c for c in rows.columns if c != "_ingested_at")).collect()))
    for name in DIMS:
        rows = live.dimension(name)
        out[name] = sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))
    return out


def rebuilt(spark, feeds, root):
    L.LiveWarehouse(spark, str(root)).run(*feeds.folders, DAY2)
    return state(spark, str(root))


class Killed(Exception):
    pass


def killed_after(monkeypatch, path, attempt):
    """The attempt dies right after its first write of the table."""

    def deadly(real):
        def write(self, *args, **kwargs):
            real(self, *args, **kwargs)
            if self.path == path:
                raise Killed

        return write

    with monkeypatch.context() as patched:
        for name in ("replace_partitions", "replace_all"):
            patched.setattr(loads.Table, name, deadly(getattr(loads.Table, name)))
        with pytest.raises(Killed):
            attempt()


def test_broken_runs_are_repaired(spark, tmp_path, delivered, monkeypatch):
    """Killed after bronze, the manifest, silver and the first fact: the next run ends as a rebuild does."""
    root = str(tmp_path / "live")
    live = L.LiveWarehouse(spark, root)
    live.run(*delivered.folders, DAY1)
    told = sorted((r.filename, r.reason, "short" in r.line or "some day" in r.line) for r in live.rejects.collect())
    assert told == [("DDBB_Feb_26.csv", "malformed line", True), ("DDBB_Feb_26.csv", "unreadable date", True)]
    counts = {r.source_name: (r.raw_lines, r.kept_lines, r.filtered_lines, r.rejected_lines) for r in live.balance.read().collect()}
    assert counts == {"feed_a": (5, 3, 0, 2), "feed_b": (2, 1, 1, 0)}
    # the same lines once more, with a new time
    delivered.put_a("Feb_26", line_a(FEB, 1, "5.00", "o2"), "too,short", line_a(FEB, 2, "1.00", "o9", name="Tea")[:1] + ["some day"] + line_a(FEB, 2, "1.00", "o9", name="Tea")[2:])
    assert live.run(*delivered.folders, DAY1) == [] and live.rejects.count() == 2
    second(delivered)
    for step in ("raw_a", "manifest", "stg_orders", "order_grain"):
        killed_after(monkeypatch, f"{root}/{step}", lambda: L.LiveWarehouse(spark, root).run(*delivered.folders, DAY2))
    months = L.LiveWarehouse(spark, root).run(*delivered.folders, DAY2)
    assert [m.month for m in months] == [1, 2, 3]
    got = state(spark, root)
    assert got == rebuilt(spark, delivered, tmp_path / "full")
    assert L.LiveWarehouse(spark, root)._pending_months() == []
    # the payload's newer order took the older one's place, the other order came in
    xml = L.LiveWarehouse(spark, root)._rows("stg_orders").filter("_source_system = 'feed_c'").collect()
    assert sorted((r.order_ref, float(r.net_sales), r.product_name) for r in xml) == [("x1", 6.6, "LATTE"), ("x5", 0.4, "GREEN TEA"), ("x6", 1.1, "LATTE")]
    assert "CLEO" in str(got["dim_employee"]) and "ZOE" in str(got["dim_employee"]) and "'TEA'" not in str(got["dim_product"])


def test_corrected_files_may_shrink_and_payloads_fail(spark, tmp_path, delivered):
    live = L.LiveWarehouse(spark, str(tmp_path / "live"))
    delivered.put_a("Jan_26", line_a(JAN, 1, "3.00", "o1"), line_a(FEB + dt.timedelta(3), 2, "4.00", "o7", name="Tea"))
    live.run(*delivered.folders, DAY1)
    delivered.put_a("Jan_26", line_a(JAN, 1, "3.00", "o1"))
    delivered.put_a("Feb_26")
    delivered.put_xml("Reno", JAN, "p2", code="5")
    with pytest.raises(ValueError, match="Reno 2026-01-05: ResultCode=5"):
        live.run(*delivered.folders, DAY2)
    held = live._rows("stg_orders").filter("_source_system = 'feed_c'").collect()
    assert {r.order_ref for r in held} == {"x1", "x2"} and live.rejects.count() == 0
    delivered.put_xml("Reno", JAN, "p2", ("x1", [(1, "1.00")]))
    live.run(*delivered.folders, DAY2)
    assert state(spark, live.root) == rebuilt(spark, delivered, tmp_path / "full")


def test_waves_keep_the_order_of_files_that_meet():
    span = lambda f, s, a, b: type("Span", (), {"file": f, "scope": s, "lo": dt.date(2026, 1, a), "hi": dt.date(2026, 1, b)})
    spans = [span("a", "x", 1, 5), span("b", "x", 6, 9), span("c", "x", 5, 6), span("d", "y", 1, 9), span("e", "x", 9, 9)]
    assert loads.waves(spans, "scope") == [["a", "b", "d"], ["c", "e"]]
    assert loads.waves(spans, None) == [["a", "b"], ["c"], ["d"], ["e"]]
