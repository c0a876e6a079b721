"""Names, categories, channels and keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# First matching fragment decides, compared without case.
CATEGORY_A = (
    ("beverage", "Beverage"),
    ("food", "Food"),
    ("retail", "Retail"),
    ("combo", "Food"),
)
CATEGORY_B = (
    ("beverage", "Beverage"),
    ("bottled drink", "Beverage"),
    ("food", "Food"),
    ("bakery", "Food"),
    ("grab", "Food"),
    ("taste of italy", "Food"),
    ("combo", "Food"),
    ("cold good", "Food"),
    ("retail", "Retail"),
)
CHANNELS = (
    ("dine", "In-Store"),
    ("drive", "Drive-Thru"),
    ("go", "Takeout"),
    ("delivery", "Delivery"),
    ("cater", "Catering"),
)
CATEGORIES = ("Beverage", "Food", "Retail", "Other")

# Royalty by store name.
ROYALTY_BY_PREFIX = (("MEIJER", "0.04"),)
ROYALTY_BY_NAME = (("LAS VEGAS", "0.08"),)
ROYALTY_DEFAULT = "0.07"

# Size markers around a product name.
SIZE_PREFIX = r"^[0-9]+\s*OZ\s+"
SIZE_SUFFIX = r"\s*\(\s*[0-9]+\s*OZ\s*\)\s*[A-Z]{0,3}\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tidy(col: Column | str) -> Column:
    return F.upper(F.trim(_c(col)))


def has_text(col: Column | str) -> Column:
    """Not blank, for filters: NULL yields NULL, which drops the row."""
    return F.trim(_c(col)) != ""


def is_blank(col: Column | str) -> Column:
    """NULL, empty or only spaces."""
    return F.coalesce(F.trim(_c(col)) == "", F.lit(True))


def _ladder(text: Column, rungs, otherwise: str) -> Column:
    lowered = F.lower(text)
    start = F.when(F.lit(False), F.lit(None).cast("string"))
    chain = reduce(lambda acc, r: acc.when(lowered.contains(r[0]), F.lit(r[1])), rungs, start)
    return chain.otherwise(F.lit(otherwise))


def category_a(col: Column | str) -> Column:
    return _ladder(_c(col), CATEGORY_A, "Other")


def group_label(col: Column | str) -> Column:
    """Feed-B group text before its ``(id)``."""
    return F.substring_index(_c(col), "(", 1)


def category_b(col: Column | str) -> Column:
    return _ladder(group_label(col), CATEGORY_B, "Other")


def channel(col: Column | str) -> Column:
    return _ladder(_c(col), CHANNELS, "Other")


def norm_store(col: Column | str, prefixes: tuple[str, ...]) -> Column:
    """Strip the first brand prefix that fits, in any case, then tidy."""
    raw = _c(col)
    out = F.when(F.lit(False), raw)
    for prefix in prefixes:
        fits = F.lower(raw).startswith(prefix.lower())
        out = out.when(fits, F.substring(raw, len(prefix) + 1, 2_000_000_000))
    return tidy(out.otherwise(raw))


def canon_a(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), SIZE_PREFIX, "")


def canon_b(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), SIZE_SUFFIX, "")


def royalty_rate(store: Column | str) -> Column:
    name = _c(store)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for prefix, rate in ROYALTY_BY_PREFIX:
        out = out.when(name.startswith(prefix), F.lit(rate))
    for exact, rate in ROYALTY_BY_NAME:
        out = out.when(name == exact, F.lit(rate))
    return out.otherwise(F.lit(ROYALTY_DEFAULT)).cast("decimal(5,2)")


def surrogate_key(col: Column | str) -> Column:
    """60 bits of the md5 of a name: stable across engines and runs."""
    return F.conv(F.substring(F.md5(_c(col)), 1, 15), 16, 10).cast("bigint")
