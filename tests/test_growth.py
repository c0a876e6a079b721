"""What the shared build shuffles and sorts: joins that stream, lookups of needy lines only."""

import pytest

from tallyhouse.operators import silver
from tallyhouse.plans.warehouse import open_warehouse
from tallyhouse.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Forty orders of three lines each; two lines name an order that is not there, or none."""
    day = "date'2000-01-05'"
    made = {
        "nation": "select 1 n_nationkey, 'N' n_name",
        "customer": "select id c_custkey, 1 c_nationkey from range(5)",
        "part": "select id p_partkey, concat('red ', id) p_name, 'PROMO' p_type, 12 p_size from range(7)",
        "supplier": "select id s_suppkey, concat('S', id) s_name from range(3)",
        "orders": f"select id o_orderkey, id % 5 o_custkey, {day} o_orderdate, '1-URGENT' o_orderpriority, 10.0D o_totalprice from range(40)",
        "lineitem": """select if(o.id = 40, null, if(o.id = 41, 999, o.id)) l_orderkey, o.id % 7 l_partkey, o.id % 3 l_suppkey, cast(n.id as int) l_linenumber,
            2.0D l_quantity, 8.0D l_extendedprice, 0.1D l_discount, 0.05D l_tax, 'N' l_returnflag from range(42) o cross join range(3) n""",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_stream_past_hashed_orders(spark, sf_dir, monkeypatch):
    whole = tables.sale_lines(spark, sf_dir)
    assert "SortMergeJoin" not in plan(whole) and "ShuffledHashJoin [l_orderkey" in plan(whole)
    want = sorted(map(repr, whole.collect()))
    assert len(want) == 120
    # more tasks than shuffle partitions, where the lines need them
    monkeypatch.setattr(tables, "LINES_PER_TASK", 2)
    dealt = tables.sale_lines(spark, sf_dir)
    assert plan(dealt).count(", 63), REPARTITION_BY_NUM") == 2
    assert sorted(map(repr, dealt.collect())) == want


def test_writes_do_not_sort_by_folder(spark, sf_dir):
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")}
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "0")
    open_warehouse(spark, sf_dir)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 3
    assert spark.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold") == "64m"
    assert all(held)


def test_only_lines_that_lack_a_value_meet_the_catalog(spark):
    schema = "`Item ID` bigint, `Item Name` string, `Revenue Center` string, n int"
    rows = spark.createDataFrame(
        [(1, " own ", "Food", 1), (1, None, "Food", 2), (1, "own", "77", 3), (2, None, None, 4), (None, None, "5", 5), (1, "own", None, 6), (1, "", "x1", 7)],
        schema)
    catalog = spark.createDataFrame([(1, "CAT", "Beverages")], "item_id bigint, item_name string, revenue_center string")
    got = silver.enrich(rows, catalog)
    assert got.columns == [*rows.columns, "eff_revenue_center", "eff_item_name"]
    assert sorted((r.n, r.eff_revenue_center, r.eff_item_name) for r in got.collect()) == [
        (1, "Food", "OWN"), (2, "Food", "CAT"), (3, "Beverages", "OWN"), (4, None, None), (5, None, None), (6, None, "OWN"), (7, "x1", "")]
    # a repeated key would show on every line that meets the catalog
    twice = silver.enrich(rows, catalog.unionByName(catalog))
    assert sorted(r.n for r in twice.collect()) == [1, 2, 2, 3, 3, 4, 5, 6, 7]
