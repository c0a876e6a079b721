"""Text to typed values: dates, money, flags, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.settings import Brand

MONEY = "decimal(18,2)"

# The feeds write M/d/yyyy h:mm a with or without seconds, or with a
# two-digit year, where 69 to 99 mean 19xx. Files that went through other tools hold a
# 24-hour clock, ISO dates, or no time at all.
STAMP = "M/d/yyyy h:mm:ss a"
STAMP_24 = "M/d/yyyy H:mm:ss"
DAY_ONLY = "M/d/yyyy"
NO_SECONDS = r"^(\S+[ T]\d{1,2}:\d{2})(?=$| )"
HALF_DAY = r"(?i)[ap]m$"
ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
YEAR_19 = r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)(?=$| )"
YEAR_20 = r"^(\d{1,2}/\d{1,2}/)(\d{2})(?=$| )"

# Where a file name starts and ends inside a path.
FEED_A_FILE = r"(?:^|/)(?:file=)?(DDBB_[^/]*\.csv)"
FEED_B_FILE = r"(?:^|/)(?:file=)?([^/=]*hqaccount_[^/]*_transactions_[^/]*\.csv)"


def parse_mixed_ts(col: Column | str) -> Column:
    """Feed-A timestamp in any of its spellings; anything else is NULL, for the rejects.

    The text's form picks the layout first: trying layouts in turn would raise
    and swallow an exception per row.
    """
    text = F.regexp_replace(F.trim(col), NO_SECONDS, "$1:00")
    return (
        F.when(text.rlike(HALF_DAY), F.try_to_timestamp(text, F.lit(STAMP)))
        .when(text.rlike(ISO), text.try_cast("timestamp"))
        .when(text.contains(":"), F.try_to_timestamp(text, F.lit(STAMP_24)))
        .otherwise(F.try_to_timestamp(text, F.lit(DAY_ONLY)))
    )


def parse_mixed_date(col: Column | str) -> Column:
    return F.to_date(parse_mixed_ts(col))


def parse_any_date(col: Column | str) -> Column:
    """Feed-A or feed-B spelling, for reports that read both."""
    text = F.regexp_replace(F.trim(col), YEAR_19, "$119$2")
    return parse_mixed_date(F.regexp_replace(text, YEAR_20, "$120$2"))


def parse_feed_b_date(col: Column | str) -> Column:
    """Feed-B date; its two-digit year would read as 20xx in Spark's own pattern."""
    return parse_any_date(col)


def clean_currency(col: Column | str) -> Column:
    """Drop ``$`` and ``,``; what is not a number then, ``(1.00)`` included, is NULL."""
    return _digits(col).try_cast(MONEY)


def _digits(col: Column | str) -> Column:
    """Trimmed text without ``$`` and ``,``; a pattern would take ten times as long."""
    return F.replace(F.replace(F.trim(col), F.lit("$")), F.lit(","))


def clean_accounting(col: Column | str) -> Column:
    """As :func:`clean_currency`, with ``(1.00)`` read as -1.00."""
    text = _digits(col)
    inner = F.regexp_extract(text, r"^\((.*)\)$", 1)
    return F.when(text.like("(%)"), -inner.try_cast(MONEY)).otherwise(text.try_cast(MONEY))


def accounting_or_zero(col: Column | str) -> Column:
    """Accounting money where blank or missing counts as 0."""
    return F.coalesce(clean_accounting(col), F.lit(0).cast(MONEY))


def flag_is_false(col: Column | str) -> Column:
    """Text flag equal to ``false`` in any case; missing is not false."""
    return F.coalesce(F.lower(F.trim(col)) == "false", F.lit(False))


def store_from_filename(path: Column | str, brand: Brand = Brand()) -> Column:
    """Store display name held in a feed-B file name, ``Unknown`` without one.

    Every run of letters is capitalised on its own, so ``nation_3b`` reads
    ``Nation_3B``. A hyphen ends the word pattern and gives ``Unknown``.
    """
    slug = F.regexp_extract(path, rf"(?U)hqaccount_{brand.slug}(\w+)_transactions", 1)
    runs = F.regexp_extract_all(slug, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    title = F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")
    return F.when(slug == "", F.lit("Unknown")).otherwise(
        F.concat(F.lit(brand.display_prefix), title)
    )


def file_of(path: Column | str, pattern: str) -> Column:
    """The feed file a row came from; Spark part files sit below it in the path."""
    return F.regexp_extract(path, pattern, 1)


def as_utc(col: Column | str) -> Column:
    """Naive timestamp that was recorded in UTC, as an instant."""
    naive = F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.to_timestamp(F.concat(naive, F.lit("Z")), "yyyy-MM-dd HH:mm:ss.SSSSSSX")


def xml_bool(col: Column | str) -> Column:
    """Missing stays NULL, ``true`` in any case is true, all else false."""
    return F.lower(col) == "true"
