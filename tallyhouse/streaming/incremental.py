"""Load-time watermarks and keyed replacement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import settle
from tallyhouse.streaming.reload import Table

STORE_DAY = ["store_name", "sale_date"]


def newer_than_target(
    rows: DataFrame, target: DataFrame, per_source: bool = True, inclusive: bool = True
) -> DataFrame:
    """Rows loaded after the target's last load, whatever their sale date.

    The mark is kept per source: one source that loads late is not hidden by
    another that loaded later. ``per_source=False`` is the single mark.
    ``inclusive`` keeps rows that share the mark's instant, as a second load of the same
    moment would bring; the slices they fall in are replaced whole, so nothing doubles.
    """
    if not per_source:
        mark = target.select(F.max("_ingested_at")).scalar()
        late = F.col("_ingested_at") >= mark if inclusive else F.col("_ingested_at") > mark
        return rows.filter(mark.isNull() | late)
    # One row per source, whatever the size of the target.
    marks = target.groupBy(F.col("_source_system").alias("_src")).agg(
        F.max("_ingested_at").alias("_mark")
    )
    joined = rows.join(marks, F.col("_source_system") == F.col("_src"), "left")
    newer = F.col("_ingested_at") >= F.col("_mark") if inclusive else (
        F.col("_ingested_at") > F.col("_mark")
    )
    return joined.filter(F.col("_mark").isNull() | newer).drop("_src", "_mark")


def since_lookback(rows: DataFrame, target: DataFrame, days: int, col: str = "sale_date") -> DataFrame:
    """Rows within ``days`` before the target's last business date, or after it (I4)."""
    last = target.select(F.max(col)).scalar()
    return rows.filter(last.isNull() | (F.col(col) > F.date_sub(last, days)))


def touched_slices(new: DataFrame, keys: list[str] = STORE_DAY) -> DataFrame:
    return new.select(*keys).distinct()


def complete_slices(new: DataFrame, all_rows: DataFrame, keys: list[str] = STORE_DAY) -> DataFrame:
    """All source rows of the slices that a batch touches: what a replace must write."""
    return all_rows.join(settle(touched_slices(new, keys)), keys, "left_semi")


def upsert_slices(rows: DataFrame, target: Table) -> None:
    """Incremental silver run: find new rows, replace the store-days they touch.

    Store-days that the source no longer has are dropped from the target.
    """
    new = touched_slices(newer_than_target(rows, target.read()))
    lost = touched_slices(target.read()).join(touched_slices(rows), STORE_DAY, "left_anti")
    slices = settle(new.unionByName(lost).distinct())
    target.replace_slices(rows.join(slices, STORE_DAY, "left_semi"), STORE_DAY, slices)


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch as it is."""
    gone = settle(batch.select(*keys).distinct())
    return target.join(gone, keys, "left_anti").unionByName(batch)


def refresh_months(
    silver: DataFrame,
    new: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    target: Table,
    month: str = "sale_month",
) -> None:
    """Rebuild the months of a fact that a batch touches, from the silver table.

    ``new`` names the months (its ``month`` column); ``build`` makes the fact from
    silver rows and sees those months only. A month that lost all its rows goes too,
    which a keyed delete and insert would miss.
    """
    months = settle(new.select(month).distinct())
    fresh = settle(build(silver.join(months, month, "left_semi")))
    empty = []
    if target.exists():
        held = target.folders(F.lit(True)).join(months, month, "left_semi")
        gone = held.join(fresh.select(month).distinct(), month, "left_anti")
        empty = [r.folder for r in gone.select("folder").collect()]
    target.replace_partitions(fresh)
    target.drop_folders(empty)


def late_arrivals(rows: DataFrame, days: int = 2) -> DataFrame:
    """Share of rows loaded more than ``days`` after their sale."""
    age = F.datediff(F.to_date("_ingested_at"), F.col("sale_date"))
    late = F.count_if(age > days)
    return rows.groupBy(F.col("_source_system").alias("source_system")).agg(
        F.count("*").alias("row_count"),
        late.alias("late_rows"),
        F.round((late / F.count("*")).cast("decimal(38,10)"), 4).alias("late_share"),
    ).orderBy("source_system")
