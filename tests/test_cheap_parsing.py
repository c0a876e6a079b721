"""Per-line work of the feeds: the same values without patterns or wide decimals."""

from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.functions import parsing as P
from tallyhouse.streaming import manifest


def test_money_is_read_without_patterns(spark, column):
    texts = [" $1,234.50 ", "(1.00)", "", "$", ",", None, "1e3", "$-5", "- 5", "abc", "1.005", "9" * 21, "$$1,,2", "[1]"]
    plain = lambda c: F.regexp_replace(F.trim(c), "[$,]", "").try_cast(P.MONEY)
    assert column(texts, P.clean_currency) == column(texts, plain)
    assert column(["($1,2.00)", "(1)", "$3"], P.clean_accounting) == [Decimal("-12.00"), Decimal("-1.00"), Decimal("3.00")]
    plan = spark.createDataFrame([], "v string").select(P.clean_currency("v"))._jdf.queryExecution().toString()
    assert "regexp_replace" not in plan


def test_fingerprints_add_longs(spark, tmp_path):
    lines = [f"line {i}" for i in range(50)] + ["line 1", ""]
    (tmp_path / "f").write_text("\n".join(lines) + "\n")
    found = manifest.fingerprints(spark, [f"file:{tmp_path}/f"])
    total = spark.createDataFrame([(x,) for x in lines], "v string").agg(F.sum(F.xxhash64("v").cast("decimal(38,0)"))).first()[0]
    assert found.first().fingerprint == f"{len(lines)}-{total}"
    assert "sum(cast(" not in found._jdf.queryExecution().toString().lower()
