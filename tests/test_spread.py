"""Large tables are written where their rows are."""

from tallyhouse.plans import warehouse as W
from tallyhouse.sources import landing
from tallyhouse.storage import write_table


def rebalanced(spark, monkeypatch):
    """Names of the columns that frames were gathered by."""
    asked = []
    frame = type(spark.range(1))
    real = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *by: (asked.append(by), real(self, name, *by))[1])
    return asked


def test_many_lines_are_not_gathered_by_folder(spark, tmp_path, monkeypatch):
    asked = rebalanced(spark, monkeypatch)
    rows = spark.range(0, 1000, 1, 4).selectExpr("id", "if(id % 7 = 0, null, id % 3) m")
    want = sorted(map(repr, rows.collect()))
    for spread, calls in ((False, [("m",)]), (True, [])):
        asked.clear()
        got = write_table(rows, f"{tmp_path}/t{spread}", "m", spread)
        assert sorted(map(repr, got.collect())) == want and asked == calls
        text = rows.selectExpr("cast(id as string) id", "concat('f', id % 3, '.csv') file")
        asked.clear()
        landed = landing.land_feed_b(text, f"{tmp_path}/l{spread}", spread=spread)
        assert spark.read.csv(landed, sep=";", header=True).count() == 1000
        assert asked == ([] if spread else [("file",)])


def test_lines_from_which_tables_are_spread(spark, monkeypatch):
    few = W.Warehouse(spark, "")
    few.__dict__["lines"] = spark.range(5)
    assert not few.spread
    monkeypatch.setattr(W, "SPREAD_LINES", 4)
    many = W.Warehouse(spark, "")
    many.__dict__["lines"] = spark.range(5)
    assert many.spread
