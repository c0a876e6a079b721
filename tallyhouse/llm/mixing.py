"""Temperature mixing of sources.

A source with share p of all tokens (words) gets weight p^a / sum of p^a. The exponent a in
[0, 1] is bisected: the largest one whose weights reach the target entropy, but not under the
smallest one with which no source is repeated more often than the limit. The target lies between the entropy
that the sources have by themselves and that of equal sources, ENTROPY_GAIN of the way, so that it asks
for something on any table whose sources differ; a fixed target (relative to equal sources) may be given. The budget is the
smallest with which every source is used once in whole, so no document is lost: a source of
weight w and share p is repeated (w / p) / min(w / p) times.

Whole repetitions take every document. The fraction that is left takes documents in the order
of a hash permutation (60 bits of md5) until its token budget is met: block totals (the hash's upper bits, at most
4,096 blocks a source) find the block where the budget ends, and only that block's documents
are put in order. Each source then has one number, the last hash value taken.

Defined cases: null and empty sources are one source; a source without words is kept once; equal
rows have equal hashes and are taken or left together; a null text has no words; an empty table
gives an empty mix. All other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.storage import settle

REPETITION_LIMIT = 1.5
ENTROPY_GAIN = 0.5
SEED = 20_260
BLOCK_BITS, PLACE_BITS = 12, 60
#: Sources whose plan (about 100 bytes each) may be broadcast.
BROADCAST_SOURCES = 50_000
#: Exponents are multiples of this; a job halves the interval four times.
GRID = 1 << 20
SOURCE, TOKENS, PLACE, COPIES = "__source", "__tokens", "__place", "__copies"


def _measured(docs: DataFrame, seed: int) -> dict[str, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if "doc_id" in docs.columns else F.lit("")
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    return {SOURCE: source, TOKENS: F.size(words).cast("long"), PLACE: _hashed(F.lit(str(seed)), key, text)}


def _hashed(*parts: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, PLACE_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def _repetition(a: Column | float) -> Column:
    """Of the least used source: the exponent's lowest w / p, as p^(a - 1) without the common factor."""
    return F.pow("share", F.lit(a) - 1)


def exponent(shares: DataFrame, repetition_limit: float | None, target_entropy: float | None, entropy_gain: float) -> float:
    """The exponent for sources (`share` > 0): bisected on a grid, fifteen values a job."""

    def last_true(holds) -> float:
        """The largest grid value for which `holds`, which is true at 0 and turns false once."""
        low, high = 0, GRID
        while high - low > 1:
            step = max((high - low) // 16, 1)
            tried = list(range(low + step, high, step))
            row = shares.agg(*[holds(x / GRID).alias(f"h{i}") for i, x in enumerate(tried)]).first()
            good = [x for x, h in zip(tried, row) if h]
            low, high = max([low, *good]), min([high, *[x for x, h in zip(tried, row) if not h]])
        return low / GRID

    def entropy(a: float) -> Column:
        total, logs = F.sum(F.pow("share", F.lit(a))), F.sum(F.pow("share", F.lit(a)) * F.log2("share") * a)
        return F.log2(total) - logs / total

    own, even = shares.agg(entropy(1.0), F.log2(F.count(F.lit(1)))).first()
    target = own + (even - own) * entropy_gain if target_entropy is None else target_entropy * even

    def rich(a: float) -> Column:
        return entropy(a) >= target

    def crowded(a: float) -> Column:
        return F.max(_repetition(a)) > F.min(_repetition(a)) * repetition_limit

    chosen = 1.0
    if own < target:
        chosen = last_true(rich)
    if repetition_limit is not None and shares.agg(crowded(chosen)).first()[0]:
        chosen = last_true(crowded) + 1 / GRID
    return chosen


def mixing_plan(measured: DataFrame, repetition_limit: float | None, target_entropy: float | None, entropy_gain: float) -> DataFrame:
    """source, weight, repetitions, whole, last_place: one row for each source."""
    block = F.shiftright(PLACE, PLACE_BITS - BLOCK_BITS)
    blocks = settle(measured.groupBy(SOURCE, block.alias("block")).agg(F.sum(TOKENS).alias("tokens")))
    totals = blocks.groupBy(SOURCE).agg(F.sum("tokens").alias("tokens"))
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = settle(totals.withColumn("share", F.col("tokens") / F.lit(max(everything, 1)).cast("double")))
    used = shares.filter("share > 0")
    if used.isEmpty():
        a, least, power = 1.0, 1.0, 1.0
    else:
        a = exponent(used, repetition_limit, target_entropy, entropy_gain)
        least, power = used.agg(F.min(_repetition(a)), F.sum(F.pow("share", F.lit(a)))).first()
    repeated = F.when(F.col("share") > 0, _repetition(a) / least).otherwise(1.0)
    plan = shares.select(
        SOURCE,
        F.when(F.col("share") > 0, F.pow("share", F.lit(a)) / power).otherwise(0.0).alias("weight"),
        repeated.alias("repetitions"),
        F.floor(repeated + 1e-9).alias("whole"),
        F.floor((repeated - F.floor(repeated + 1e-9)) * F.col("tokens")).alias("budget"),
    )
    # in the order of the hash, block by block
    before = Window.partitionBy(SOURCE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    lined = blocks.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    last = lined.join(plan.select(SOURCE, "budget"), SOURCE).filter("budget > 0 and before < budget and before + tokens >= budget")
    last = settle(last.select(F.col(SOURCE).alias("of"), F.col("block").alias("in_block"), F.col("budget") - F.col("before"), "budget").toDF("of", "in_block", "left", "budget"))
    inside = measured.withColumn("block", block).join(last, (F.col(SOURCE) == F.col("of")) & (F.col("block") == F.col("in_block")))
    lower = Window.partitionBy(SOURCE).orderBy(PLACE).rangeBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("taken", F.coalesce(F.sum(TOKENS).over(lower), F.lit(0))).filter(F.col("taken") < F.col("left"))
    ends = inside.groupBy(F.col(SOURCE).alias("of")).agg(F.max(PLACE).alias("last_place"))
    return settle(plan.join(ends, F.col(SOURCE) == F.col("of"), "left").drop("of", "budget"))


def mixed(
    docs: DataFrame,
    repetition_limit: float | None = REPETITION_LIMIT,
    target_entropy: float | None = None,
    entropy_gain: float = ENTROPY_GAIN,
    seed: int = SEED,
) -> DataFrame:
    """All columns with __source, __tokens, __place and __copies, one row a document."""
    columns = _measured(docs, seed)
    measured = settle(docs.select(*[value.alias(name) for name, value in columns.items()]))
    plan = mixing_plan(measured, repetition_limit, target_entropy, entropy_gain)
    plan = plan.select(F.col(SOURCE).alias("__of"), F.col("whole").alias("__whole"), F.col("last_place").alias("__last"))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    known = docs.withColumns(columns).join(plan, F.col(SOURCE) == F.col("__of"))
    more = F.coalesce(F.col(PLACE) <= F.col("__last"), F.lit(False)).cast("long")
    return known.withColumn(COPIES, F.col("__whole") + more).drop("__of", "__whole", "__last")


def realised(docs: DataFrame, **settings) -> DataFrame:
    """The documents as often as the mix takes them, only their own columns."""
    plain, as_they_came = set_aside(docs, ("doc_id", "text", "source"))
    return as_they_came(mixed(plain, **settings).withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col(COPIES)))))


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, n_tokens, epoch, place: the mix is read by epoch, then place."""
    seed = settings.get("seed", SEED)
    rows = mixed(docs.select("doc_id", "text", "source"), **settings).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col(COPIES))))
    return rows.select(
        "doc_id", F.col(SOURCE).alias("source"), F.col(TOKENS).alias("n_tokens"), "epoch",
        _hashed(F.lit(str(seed)), F.col("epoch").cast("string"), F.col(PLACE).cast("string")).alias("place"),
    )
