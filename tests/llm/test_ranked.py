"""Ranked search against a plain one."""

import collections
import math
import random

import pytest

from plain import ALNUM, fold
from tallyhouse.llm import ranked


def plain(docs, items, k=ranked.TOP):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text)."""
    bags = [(i, collections.Counter(ALNUM.findall(fold(t)))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    n, total = len(bags), sum(size for *_, size in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag, size in bags:
            m = 50 + 50 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in set(ALNUM.findall(fold(text))) if t in bag
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort(key=lambda s: s[:3])
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def texts(rng, n, vocabulary=60, longest=60):
    words = [f"w{i}" for i in range(vocabulary)] + ["Straße", "日本", "X1"]
    power = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, power, k=rng.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 7, 50])
@pytest.mark.parametrize("sizes", [(1024, 4096, 1 << 22), (3, 2, 8)])
def test_all_items(spark, monkeypatch, k, sizes):
    """With blocks, query blocks and score tables of any size."""
    for name, size in zip(("BLOCK_DOCS", "QUERIES", "CELLS"), sizes):
        monkeypatch.setattr(ranked, name, size)
    rng = random.Random(k)
    docs = list(enumerate(texts(rng, 250)))
    docs += [(1000 + i, docs[3][1]) for i in range(120)] + [(3, docs[3][1]), (None, docs[3][1]), (None, docs[5][1]), (7, None), (8, ""), (9, " -\n")]
    items = [(i, t) for i, t in enumerate(texts(rng, 6, longest=12))] + [(0, docs[3][1]), (None, "w0 w1"), (50, None), (51, "?"), (52, "nowhere")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, m string, part int").repartition(5)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id int, text string, rank int")
    got = [tuple(r) for r in ranked.ranked(frame, asked, k).collect()]
    assert sorted(got, key=repr) == plain(docs, items, k)


def test_very_long_texts(spark):
    rng = random.Random(9)
    docs = [(i, t) for i, t in enumerate(texts(rng, 40))] + [(100, " ".join(f"u{i % 90_000} w{i % 50}" for i in range(150_000))), (101, "z" * 300_000)]
    items = [(1, "w3 u77 w1"), (2, docs[-1][1]), (3, docs[-2][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in ranked.ranked(frame, spark.createDataFrame(items, "item_id string, text string")).collect()]
    assert sorted(got, key=repr) == plain(docs, [(str(i), t) for i, t in items])


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert ranked.ranked(docs, items).collect() == []
    assert ranked.ranked(some, items.limit(0)).collect() == []
    assert [tuple(r) for r in ranked.ranked(some, items).collect()] == plain([(1, "a b"), (2, None)], [(1, "a")])


def test_strata_are_visited_by_bound(spark, monkeypatch):
    """Blocks that cannot reach a query's list are not scored."""
    scored = []
    real = ranked._Stratum.scores
    monkeypatch.setattr(ranked._Stratum, "scores", lambda self, *a: scored.append(self.docs) or real(self, *a))
    rng = random.Random(2)
    docs = [(i, "common " * rng.randint(1, 400)) for i in range(600)] + [(900 + i, "rare") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = ranked.build_index(frame)
    folder = spark.createDataFrame([(1, "rare common")], "item_id long, text string")
    rows = index.blocks.toArrow().to_batches()
    path = ranked.fresh_dir(spark, "q")
    manifest = list(ranked._query_files(path)(iter(folder.toArrow().to_batches())))
    import numpy as np

    found = list(ranked._searched(manifest[0].column(0)[0].as_py(), np.array([300, 3000]), 50)(iter(rows)))
    assert sum(b.num_rows for b in found) == 50
    assert len(scored) < index.blocks.count() / 2
