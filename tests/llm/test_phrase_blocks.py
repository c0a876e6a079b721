"""Phrases in blocks: one index a shard, the same marks whatever the block size."""

import pyarrow as pa

from plain import contamination
from tallyhouse.llm import decontam

WORDS = [f"w{i % 97}x{i % 31}" for i in range(900)]
DOCS = [" ".join(WORDS[i : i + 140]) for i in range(0, 700, 35)] + ["", None, "short item", "before short item after"]
ITEMS = [("a", " ".join(WORDS[100:160])), ("b", "short item"), ("c", " ".join(WORDS[120:150])), (None, " ".join(WORDS[300:340])), ("d", ""), ("e", None)]


def test_one_index_for_all_blocks(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    paths = decontam.write_phrases(items, block=7)
    assert len(paths) > 5
    distinct = sum(len(decontam.read_phrases(p).lengths) for p in paths)
    assert distinct == 48 + 1 + 28  # c's windows are a's, too
    built = []
    index = decontam.FMIndex
    monkeypatch.setattr(decontam, "FMIndex", lambda symbols: built.append(1) or index(symbols))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(DOCS))), "text": pa.array(DOCS, pa.string())})
    out = [r for b in decontam._marker(paths, decontam.WINDOW, True)([batch]) for r in b.to_pylist()]
    assert built == [1]
    known = [(i, t) for i, t in ITEMS]
    for row in out:
        n_words, n_hit, n_items = contamination(row["text"], known)[:3]
        assert (row[decontam.N_WORDS], len(row[decontam.HITS]), len(row[decontam.ITEMS])) == (n_words, n_hit, n_items)
    assert sum(len(r[decontam.HITS]) > 0 for r in out) > 5
