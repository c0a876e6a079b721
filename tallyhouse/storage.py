"""Written intermediate tables below the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.session import fresh_dir, spread_writers


def write_table(df: DataFrame, path: str, partition: str | None = None, spread: bool = False) -> DataFrame:
    """Write and read back with the same columns and types; a retry starts afresh.

    Partitioned tables are rebalanced on the partition column: adaptive
    execution splits a month that holds too much and merges the small ones, so
    file sizes stay even without a fixed number of buckets. Rows that fill many
    tasks (``spread``) are not sent over the network for that: each task writes
    a file to every month it holds.
    """
    writer = df.hint("rebalance", partition).write if partition and not spread else df.write
    if partition:
        writer = writer.partitionBy(partition)
    with spread_writers(df.sparkSession, spread):
        writer.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def settle(df: DataFrame) -> DataFrame:
    """Write a reduced side so that the planner knows its real size.

    Spark estimates an aggregate at the size of its input, and would shuffle the
    large side of a join before it learns that the other one is tiny. A written
    side is broadcast when it is under the threshold and merge-joined beyond it.
    """
    return write_table(df, fresh_dir(df.sparkSession, "settled"))
