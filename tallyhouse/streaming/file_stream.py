"""New files as a stream (I5): each micro-batch adds to bronze and rebuilds the slices it touches.

Bronze is partitioned by day and batch. A micro-batch opens the folders of its own days only, so what
it reads follows its days and not the history behind them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import fresh_dir, passing_work
from tallyhouse.sources.feeds import LINE, REASON
from tallyhouse.storage import settle
from tallyhouse.streaming.incremental import STORE_DAY, complete_slices, touched_slices
from tallyhouse.streaming.reload import Table

BATCH = "_batch"
LINEAGE = ["_source_file", "_source_system", "_ingested_at"]
REJECTED = "_source_file string, _source_system string, _ingested_at timestamp, _reason string, _line string, _batch long"
#: Slices that a join surely broadcasts, so that the rows they are looked up for stay where they are.
FEW_SLICES = 200_000
BALANCE = ("raw_lines", "kept_lines", "filtered_lines", "rejected_lines")


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as they appear."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def bronze_table(target: Table, path: str | None = None, day: str = "sale_date") -> Table:
    """The raw rows behind a target, one folder for each day and micro-batch."""
    fields = [f for f in target.schema.fields if f.name != BATCH]
    schema = T.StructType([*fields, T.StructField(BATCH, T.LongType())])
    return Table(target.spark, path or f"{target.path}.bronze", schema, (day, BATCH))


def rejects_table(spark: SparkSession, path: str) -> Table:
    """Lines that could not be loaded, one folder for each micro-batch."""
    return Table(spark, path, T._parse_datatype_string(REJECTED), (BATCH,))


def of_days(bronze: Table, day: str, days: list[dt.date | None]) -> DataFrame:
    """Bronze rows of the given days, by partition."""
    known = F.col(day).isin([d for d in days if d is not None])
    return bronze.read().filter(known | F.col(day).isNull() if None in days else known)


def _drain(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _add(rows: DataFrame, number: int, target: Table, bronze: Table, keys: list[str], day: str) -> None:
    """Put a batch's written rows in bronze and rebuild their slices from the bronze rows of their days."""
    bronze.replace_partitions(rows.withColumn(BATCH, F.lit(number).cast("long")))
    # one value a day that the batch touches
    days = [r[0] for r in rows.select(day).distinct().collect()]
    touched = settle(touched_slices(rows, keys))
    after = complete_slices(touched, of_days(bronze, day, days), keys)
    # bronze files hold one day each: their rows need not be gathered by day again, unless a large join dealt them out
    target.replace_slices(after, keys, gathered=touched.count() <= FEW_SLICES)


def ingest_available(
    stream: DataFrame, target: Table, checkpoint: str | None = None, bronze: Table | None = None
) -> None:
    """Process the files present now and stop; the checkpoint remembers them.

    A batch is written to bronze under its number, so a batch that is replayed after a
    failure replaces itself. Then the slices it touches are rebuilt from the bronze rows of their days:
    files of one store-day that arrive in different triggers end as if they had come together.
    """
    bronze = bronze or bronze_table(target)

    def load(batch: DataFrame, number: int) -> None:
        with passing_work(target.spark):
            _add(settle(batch), number, target, bronze, STORE_DAY, "sale_date")

    _drain(stream, load, checkpoint or fresh_dir(target.spark, "stream"))


def ingest_feed(
    text: DataFrame,
    stage: Callable[[DataFrame, Observation], DataFrame],
    target: Table,
    rejects: Table,
    checkpoint: str | None = None,
    bronze: Table | None = None,
) -> list[dict[str, int]]:
    """Stream the lines of feed files into store-day slices, and lines that cannot be loaded into ``rejects``.

    ``stage`` types the lines of a micro-batch (:func:`feeds.staged_a`, :func:`feeds.staged_b`); they are
    parsed and written once, and counted on the way. Returns the balance of each micro-batch of this run:
    raw = kept + filtered + rejected.
    """
    bronze = bronze or bronze_table(target, day="Date")
    balances: list[dict[str, int]] = []

    def load(batch: DataFrame, number: int) -> None:
        # a batch's typed rows lie in bronze when it ends
        with passing_work(target.spark):
            balance = Observation()
            rows = settle(stage(batch, balance))
            found = balance.get
            balances.append({name: found.get(name) or 0 for name in BALANCE})
            bad = rows.filter(F.col(REASON).isNotNull()).select(*LINEAGE, REASON, LINE)
            rejects.replace_partitions(bad.withColumn(BATCH, F.lit(number).cast("long")))
            good = rows.filter(F.col(REASON).isNull()).drop(REASON, LINE)
            _add(good, number, target, bronze, ["Location", "Date"], "Date")

    _drain(text, load, checkpoint or fresh_dir(target.spark, "stream"))
    return balances
