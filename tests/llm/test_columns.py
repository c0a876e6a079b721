"""Columns that bear the names an operator uses inside come back as they were; rows are told apart."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import decontam, line_dedup, mixing, near_dedup, quality

NAMES = ["__copies", "__source", "__of", "__whole", "__last", "__epoch", "__tokens", "__place", "__n_words", "__spans", "__hits", "__items", "__gone", "__gone_of", "_gone", "_row", "__set_key", "__kept_id", "__kept_key", "__row", "_column_0", "odd name"]
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


@pytest.fixture(scope="module")
def docs(spark):
    text = " ".join(f"word{i} of the {i * 7 % 90} text" for i in range(60))
    rows = [(1, text, "en", "a"), (2, text + " more", "en", "a"), (3, f"x {PASSAGE} y", "en", "b"), (None, "lone " * 3, None, None), (4, " ".join(f"other{i}" for i in range(80)), "en", "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES})


STAGES = {
    "realised": lambda d, s: mixing.realised(d),
    "decontaminate": lambda d, s: decontam.decontaminate(d, s.createDataFrame([(1, PASSAGE)], "item_id long, text string")),
    "cut_spans": lambda d, s: decontam.cut_spans(d, s.createDataFrame([(1, PASSAGE)], "item_id long, text string")),
    "without_repeats": lambda d, s: line_dedup.without_repeats(d),
    "deduplicate": lambda d, s: near_dedup.deduplicate(d),
    "keep_good": lambda d, s: quality.keep_good(d),
}


@pytest.mark.parametrize("name", STAGES)
def test_values_come_through(spark, docs, name):
    out = STAGES[name](docs, spark)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        tail = "-" if r.doc_id is None else str(r.doc_id)
        assert all(r[n] == n + tail for n in NAMES)


def test_rows_of_one_id_or_none_keep_their_own_lines(spark):
    rows = [(0, "a copied line of words"), (1, "unique one here now\nv"), (1, "a copied line of words\nw"), (None, "nobody else says this"), (None, "a copied line of words\nlast"), (5, "twice in the table"), (5, "twice in the table")]
    frame = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    got = {r.n: r.text for r in line_dedup.without_repeats(frame.repartition(3)).collect()}
    assert [got[i] for i in range(5)] == ["a copied line of words", "unique one here now\nv", "w", "nobody else says this", "last"]
    assert sorted([got[5], got[6]]) == ["", "twice in the table"]
