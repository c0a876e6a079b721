"""Combining and splitting raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import settle

STORE_DAY = ["Location", "Date"]


def store_days(csv: DataFrame) -> DataFrame:
    """Store-days that CSV delivers."""
    return csv.select(*STORE_DAY).distinct()


def bronze_a(csv: DataFrame, api: DataFrame, covered: DataFrame | None = None) -> DataFrame:
    """All CSV rows, and XML rows of the store-days that CSV never delivered.

    The anti join probes distinct store-days, a small set next to the lines; as a
    written table (``covered``) it is broadcast when its size allows.
    """
    covered = settle(store_days(csv)) if covered is None else covered
    gaps = api.join(covered, STORE_DAY, "left_anti")
    return csv.unionByName(gaps, allowMissingColumns=True)


def split_by_source(mixed: DataFrame, tags: list[str], column: str = "_source_system") -> dict:
    """One frame per source tag."""
    return {tag: mixed.filter(F.col(column) == tag) for tag in tags}


def split_balance(mixed: DataFrame, parts: dict, column: str = "_source_system") -> DataFrame:
    """Row counts of the parts against the whole, in one scan of the whole.

    ``unassigned`` counts rows no part takes; a safe split has 0.
    """
    known = F.coalesce(F.col(column).isin(*parts), F.lit(False))
    return mixed.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(column) == tag).alias(f"{tag}_rows") for tag in parts],
        F.count_if(~known).alias("unassigned_rows"),
    )


def write_parts(parts: dict[str, DataFrame], targets: dict) -> None:
    """Write each part to its own table, all of which must be empty."""
    assert_empty({tag: targets[tag].read() for tag in parts})
    for tag, part in parts.items():
        targets[tag].replace_partitions(part)


def assert_empty(targets: dict[str, DataFrame]) -> None:
    """Refuse to split into targets that already hold rows."""
    full = [name for name, df in targets.items() if not df.isEmpty()]
    if full:
        raise ValueError(f"targets not empty: {', '.join(sorted(full))}")
