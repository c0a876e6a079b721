"""The pipeline stage by stage against plain code on the smallest tables."""

import zlib
from collections import Counter

import corpus_pipeline as pipeline
import duckdb
import pytest

from plain import components, contamination
from tallyhouse.llm import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs}
    for name, stage in pipeline.STAGES:
        docs = pipeline.settle(stage(spark, docs, SF_DIR))
        out[name] = docs
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(steps):
    assert list(steps) == ["documents", "quality_rules", "minhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_ids"]
    assert all(steps[n].columns == steps["documents"].columns for n in list(steps)[:-1])


def test_quality(steps):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    want = {i for i, kept in con.sql(f"SELECT doc_id, kept FROM ({registry.TWINS['op2_quality_divergence']})").fetchall() if kept}
    assert set(texts(steps["quality_rules"])) == want


def test_dedup(steps):
    before = sorted(texts(steps["quality_rules"]).items())
    root, _ = components([t for _, t in before])
    assert set(texts(steps["minhash_near_dedup"])) == {before[r][0] for r in root}


def test_decontamination(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = {i for i, t in texts(steps["minhash_near_dedup"]).items() if not contamination(t, items)[-1]}
    assert set(texts(steps["benchmark_decontamination"])) == want


def test_mixing_keeps_all(steps):
    before, after = texts(steps["benchmark_decontamination"]), Counter(r.doc_id for r in steps["source_mixing"].collect())
    assert set(after) == set(before) and max(after.values()) <= 2


def test_tokens(steps):
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(registry.tokenizer_path()), 0
    rows = sorted((r.doc_id, r.text) for r in steps["source_mixing"].collect())
    for got, (doc, text) in zip(steps["token_ids"].orderBy("start").collect(), rows, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (got.doc_id, got.start, got.n_tokens) == (doc, start, len(ids))
        assert got.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        start += len(ids)


def test_run_is_the_last_stage(spark, steps):
    assert sorted(map(tuple, pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, steps["token_ids"].collect()))


def test_edges_pass_every_stage(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long, set_key string, __copies long"
    good = " ".join(f"Word{i} the text{i * 3} of number{i * 7}" for i in range(60)) + "."
    rows = [(1, good), (1, good), (2, good + " x"), (3, None), (4, ""), (None, good.replace("the", "a")), (5, "short"), (6, "z " * 50_000), (7, good[::-1])]
    docs = spark.createDataFrame([(i, t, None if n % 2 else "en", None, 1, "k", n) for n, (i, t) in enumerate(rows)], kind)
    folder = str(tmp_path / "t")
    spark.createDataFrame([(1, "no such words here"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = {}
    for table in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES[:-1]:
            whole = stage(spark, table, folder)
            assert whole.columns == docs.columns
            left.setdefault(name, whole.count())
        assert pipeline.STAGES[-1][1](spark, table, folder).count() == table.count()
    assert left == {"quality_rules": 5, "minhash_near_dedup": 7, "benchmark_decontamination": 9, "source_mixing": 9}
