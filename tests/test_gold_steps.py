"""The feeds of A24_files_to_gold are read side by side, and so are its dimensions built."""

import threading

import pytest

from tallyhouse.plans.warehouse import open_warehouse
from tallyhouse.registry import feeds as R


def test_feeds_and_dimensions_meet(spark, monkeypatch):
    class Reached(Exception):
        pass

    feeds_meet, dims_meet = threading.Barrier(3, timeout=20), threading.Barrier(4, timeout=20)

    class Steps:
        def __init__(self, *_):
            self.done = []

        def __getattr__(self, name):
            if name.startswith("raw_"):
                feeds_meet.wait()
            elif name.startswith("dim_"):
                assert "stg_orders" in self.done
                dims_meet.wait()
            elif name != "stg_orders":
                raise Reached(sorted(self.done))
            self.done.append(name)

    class Files:
        a = b = xml = seed = ""

    monkeypatch.setattr(R, "FeedWarehouse", Steps)
    monkeypatch.setattr(R, "landed", lambda w: Files)
    with pytest.raises(Reached) as told:
        R.files_to_gold(open_warehouse(spark, "/nowhere"))
    assert told.value.args[0] == ["dim_date", "dim_destination", "dim_product", "dim_store", "raw_a", "raw_b", "raw_c", "stg_orders"]
