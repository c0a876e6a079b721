"""Documents under plain column names, so that no column of theirs meets one that an operator adds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, keep: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The documents with every column but the kept ones renamed by its place, and what gives the names back."""
    plain = [c if c in keep else f"_column_{i}" for i, c in enumerate(docs.columns)]

    def as_they_came(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(new).alias(old) for new, old in zip(plain, docs.columns)])

    return docs.select(*[F.col(f"`{old}`").alias(new) for new, old in zip(plain, docs.columns)]), as_they_came
