"""Quality rules: base counts, and divergence from the document's language.

Words are `[^\\x20\\x09-\\x0D]+` of the whole text. Two histograms describe a document:
its code points by character class, and its words by the language's most common words
(and "any other"). The reference of a `lang` value is the sum over its own documents that pass the
base rules, each scaled to parts per million so that no long document rules it. A document
is rejected when the Jensen-Shannon distance (square root of the divergence to base 2) of
either histogram is over the bound.

Guards: documents under `MIN_WORDS` words are left to the base rules; the word histogram
needs `MIN_WORDS_FOR_WORDS` words and a language with a word list; a reference needs
`MIN_REFERENCE` documents. Where a guard does not hold the distance is null and rejects nothing; `judged_by`
tells which rules a document met.

Everything is built-in functions. The references are one row for each `lang` value; they are broadcast while
they are few, else joined by language.

Defined cases: null text has no words; null `lang` is a language like any other, the same as an empty one;
without a `lang` column all rows are of it. Repeated rows each get their own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import settle

#: The most common words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"),
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with", "be", "by", "this", "as", "are", "at", "from"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur"),
}
N_COMMON = 20
CLASSES = ("lower", "upper", "digit", "white", "symbol", "punctuation", "wide")

MIN_WORDS = 50
MIN_WORDS_FOR_WORDS = 100
MIN_REFERENCE = 20
MAX_CLASS_DISTANCE = 0.3
#: A text without one common word comes to about 0.375, as `any other` holds three quarters of the references' words.
MAX_WORD_DISTANCE = 0.27
SCALE = 1_000_000
#: References (about 300 bytes each) that may be broadcast.
BROADCAST_LANGUAGES = 10_000
SPACES = r"[\x20\x09-\x0D]+"


def language(docs: DataFrame) -> Column:
    """The language of a row, an empty string without one."""
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def _repeated_words(words: str, size: int) -> list[tuple[str, str]]:
    """Columns, step by step, that end with the number of words in windows found twice or more."""
    last = size - 1
    grams = words
    for j in range(1, size):
        grams = f"zip_with({grams}, slice({words}, {j + 1}, greatest(n_words, 1)), (a, b) -> xxhash64(a, b))"
    return [
        ("__grams", f"case when n_words >= {size} then slice({grams}, 1, cast(n_words as int) - {last}) end"),
        ("__order", "case when size(array_distinct(__grams)) < size(__grams) then array_sort(transform(__grams, (h, i) -> struct(h, i))) end"),
        ("__twice", "array_sort(array_distinct(flatten(zip_with(slice(__order, 1, size(__order) - 1), slice(__order, 2, size(__order) - 1), (a, b) -> if(a.h = b.h, array(a.i, b.i), array())))))"),
        ("n_repeat_words", f"coalesce({size} + aggregate(zip_with(slice(__twice, 1, size(__twice) - 1), slice(__twice, 2, size(__twice) - 1), (a, b) -> least({size}, b - a)), 0L, (s, x) -> s + x), 0L)"),
    ]


def base_counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = 3) -> DataFrame:
    """The kept columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and both histograms."""
    df = docs.select(*[F.col(f"`{c}`") for c in keep], language(docs).alias("__lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    df = df.withColumn("__words", F.array_remove(F.split("__text", SPACES), ""))
    common = F.array()
    for lang, words in COMMON_WORDS.items():
        common = F.when(F.col("__lang") == lang, F.array(*map(F.lit, words))).otherwise(common)
    df = df.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "__lines": F.expr(r"filter(split(__text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"),
            "__rare": F.regexp_replace("__text", "[a-z ]+", ""),
            "__common": common,
        }
    )
    places = F.expr("array_remove(transform(__words, w -> array_position(__common, trim(trailing '.,;:!?' from lower(w)))), 0L)")
    df = df.withColumns({"n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"), "__places": places})
    for name, value in _repeated_words("__words", window):
        df = df.withColumn(name, F.expr(value))
    left = lambda pattern: F.length(F.regexp_replace("__rare", pattern, "")).cast("long")
    df = df.withColumns(
        {
            "n_symbols": left("[^#*$%&|<>]+"),
            "__upper": left("[^A-Z]+"),
            "__digit": left("[^0-9]+"),
            "__white": F.length("__text") - F.col("word_chars"),
            "__punctuation": left(r"[A-Za-z0-9#*$%&|<>\x20\x09-\x0D\x{80}-\x{10FFFF}]+"),
            "__wide": left(r"[\x00-\x7F]+"),
        }
    )
    rest = F.length("__text") - F.col("__upper") - F.col("__digit") - F.col("__white") - F.col("n_symbols") - F.col("__punctuation") - F.col("__wide")
    classes = [rest, *[F.col(c) for c in ("__upper", "__digit", "__white", "n_symbols", "__punctuation", "__wide")]]
    counts = [F.size("__places") - F.size(F.array_remove("__places", F.lit(i + 1).cast("long"))) for i in range(N_COMMON)]
    return df.select(
        *[F.col(f"`{c}`") for c in keep], "__lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(*[c.cast("long") for c in classes]).alias("__classes"),
        F.array(*[c.cast("long") for c in counts], F.col("n_words") - F.size("__places")).alias("__words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(counts: DataFrame) -> DataFrame:
    """__lang, n and both reference histograms as sums of parts per million."""
    fit = counts.filter(~base_failed())
    sums = [F.count(F.lit(1)).alias("__n")]
    for name, n in (("__classes", len(CLASSES)), ("__words", N_COMMON + 1)):
        total = F.expr(f"aggregate({name}, 0L, (s, x) -> s + x)")
        fit = fit.withColumn(f"{name}_total", total)
        for i in range(n):
            part = F.floor(F.col(name)[i] * SCALE / F.nullif(F.col(f"{name}_total"), F.lit(0)))
            sums.append(F.sum(part).alias(f"{name}_{i}"))
    got = fit.groupBy("__lang").agg(*sums)
    return got.select(
        F.col("__lang").alias("__of"),
        "__n",
        F.array(*[F.col(f"__classes_{i}") for i in range(len(CLASSES))]).alias("__ref_classes"),
        F.array(*[F.col(f"__words_{i}") for i in range(N_COMMON + 1)]).alias("__ref_words"),
    )


def js_distance(p: str, q: str) -> Column:
    """Square root of the Jensen-Shannon divergence of two arrays of counts; null if one has none."""
    share = lambda a: f"transform({a}, c -> c / nullif(aggregate({a}, 0D, (s, y) -> s + y), 0D))"
    term = lambda v: f"if({v} > 0, {v} * log2(2 * {v} / (x + y)), 0D)"
    parts = f"zip_with({share(p)}, {share(q)}, (x, y) -> {term('x')} + {term('y')})"
    return F.expr(f"sqrt(greatest(aggregate({parts}, 0D, (s, t) -> s + t) / 2, 0D))")


def judged(counts: DataFrame) -> DataFrame:
    """The counts with base_failed, class_distance, word_distance and kept."""
    known_languages = settle(references(counts))
    if known_languages.count() <= BROADCAST_LANGUAGES:
        known_languages = F.broadcast(known_languages)
    known = counts.join(known_languages, F.col("__lang") == F.col("__of"), "left")
    enough = (F.col("n_words") >= MIN_WORDS) & (F.col("__n") >= MIN_REFERENCE)
    listed = (F.col("n_words") >= MIN_WORDS_FOR_WORDS) & F.col("__lang").isin(*COMMON_WORDS)
    known = known.withColumns(
        {
            "class_distance": F.when(enough, js_distance("__classes", "__ref_classes")),
            "word_distance": F.when(enough & listed, js_distance("__words", "__ref_words")),
            "base_failed": base_failed(),
        }
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    rules = F.when(F.col("word_distance").isNotNull(), "classes and words").when(F.col("class_distance").isNotNull(), "classes").otherwise("base")
    return known.withColumns({"judged_by": rules, "kept": ~F.col("base_failed") & ~far})


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each document: its counts, distances and verdict."""
    counts = settle(base_counts(docs))
    return judged(counts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "judged_by", "kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they came."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *[c for c in ("text", "lang") if c in docs.columns])
    counts = settle(base_counts(packed, ("__row",)))
    return judged(counts).filter("kept").select("__row.*")
