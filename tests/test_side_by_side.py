"""Independent steps run side by side, and a table's first rows are written once."""

import threading

import pytest

from tallyhouse.plans import live
from tallyhouse.plans.live import LiveWarehouse
from tallyhouse.session import fresh_dir, together, work_scope


def test_steps_meet_and_an_error_waits_for_the_others(spark):
    meet = threading.Barrier(2, timeout=20)
    with work_scope("here"):
        told = together(lambda: (meet.wait(), fresh_dir(spark, "x"))[1], lambda: (meet.wait(), fresh_dir(spark, "y"))[1])
    assert all("/here/" in path for path in told)
    ended = []

    def fails():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        together(fails, lambda: (threading.Event().wait(0.2), ended.append(1)))
    assert ended == [1]


def test_a_first_refresh_is_written_once(spark, tmp_path, monkeypatch):
    staged = []
    real = live.settle
    monkeypatch.setattr(live, "settle", lambda df: (staged.append(1), real(df))[1])
    w = LiveWarehouse(spark, str(tmp_path))
    rows = spark.sql("select id, date'2000-01-01' sale_month from range(3)")
    w._refresh("t", rows, [])
    assert staged == [] and w._rows("t").count() == 3
    w._refresh("t", rows.limit(1), [])
    assert staged == [1] and w._rows("t").count() == 1
