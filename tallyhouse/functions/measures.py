"""Exact rounding, safe ratios, calendar labels."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

WIDE = "decimal(38,10)"


def rounded(col: Column, places: int = 2) -> Column:
    """Round half away from zero on decimals, never on doubles."""
    return F.round(col.cast(WIDE), places)


def ratio(num: Column, den: Column, places: int) -> Column:
    """``num / den`` rounded; NULL where the denominator is 0 or missing."""
    safe = F.nullif(den.cast("decimal(28,4)"), F.lit(0).cast("decimal(28,4)"))
    return F.round((num.cast("decimal(28,4)") / safe).cast(WIDE), places)


def share_of_rows(measure: str, places: int = 4) -> Column:
    """Share of one row in the total; for already aggregated, short results."""
    whole = F.sum(measure).over(Window.partitionBy())
    return ratio(F.col(measure), whole, places)


def month_start(col: Column | str) -> Column:
    return F.trunc(col, "MM")
