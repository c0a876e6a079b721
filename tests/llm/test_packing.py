"""Packing: ids against the library, a gapless whole, and few sequences."""

import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import packing, registry, textscan, word_ids
from tallyhouse.llm.registry import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def whole(rows, texts, capacity=packing.CAPACITY):
    """Every document in pieces, every sequence gapless; returns the number of sequences. texts: (doc_id, text)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        for k, at in enumerate(range(0, len(ids), capacity)):
            want[doc, k, at, len(ids[at : at + capacity]), crc(ids[at : at + capacity])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(parts[-1]) <= capacity
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(parts))
    return len(held)


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = registry.QUERIES["op12_configuration_packing"](spark, "/root/testdata/sf0.01").collect()
    tokens = sum(r.length for r in rows)
    assert whole(rows, [tuple(r) for r in docs]) <= -(-tokens // packing.CAPACITY) + 1


@pytest.mark.parametrize("rows", [[], [(1, None)], "many"])
def test_nulls_repeats_and_long_texts(spark, rows):
    if rows == "many":
        rows = [(i % 50, f"Some words, {i} of them. " * (i % 9)) for i in range(300)] + [(None, "lone"), (None, "lone"), (7, None), (8, ""), (9, " \n\t ")]
        rows += [(100, "word " * 9000), (101, "é—" * 5000), (102, "x" * 30000)]
    frame = spark.createDataFrame([(i, t, "a", 1, 2) for i, t in rows], "doc_id long, text string, ids string, task int, length int")
    placed = packing.packed(frame.repartition(5), PATH, with_ids=True)
    got = placed.collect()
    n = whole(got, rows)
    together = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    assert len(together) == n
    assert all(crc(together[r.sequence_id][r.offset : r.offset + r.length]) == r.ids_crc32 for r in got)


def histogram(lengths):
    return dict(collections.Counter(int(x) for x in lengths))


@pytest.mark.parametrize("kind", ["prose", "long", "hot", "thirds"])
def test_plan_is_near_the_bound(kind):
    rng = np.random.default_rng(1)
    told = {
        "prose": histogram(np.clip(rng.lognormal(6, 1.2, 50_000), 1, 2048)),
        "long": histogram(rng.integers(400, 1100, 20_000)),
        "hot": histogram([300] * 60_000 + [*rng.integers(1, 2049, 60_000)]),
        "thirds": {682: 300, 683: 600},
    }[kind]
    made = packing.plan(told)
    used = collections.Counter()
    for config, k in made.parts:
        assert k > 0 and sum(n * a for n, a in config) <= packing.CAPACITY
        used.update({n: a * k for n, a in config})
    assert used == told
    counts = np.zeros(packing.CAPACITY + 1, np.int64)
    counts[list(told)] = list(told.values())
    plain = sum(k for _, k in packing._best_fit(counts, packing.CAPACITY))
    assert made.bound - 1e-6 <= made.sequences <= 1.0005 * plain
    if kind == "long":
        assert made.sequences < 0.98 * plain


def test_a_large_table_needs_no_larger_plan():
    rng = np.random.default_rng(2)
    told = histogram(np.clip(rng.lognormal(6, 1.2, 100_000), 1, 2048))
    made = packing.plan({n: k * 1_000_003 for n, k in told.items()})
    assert len(made.ranges()["length"]) < 100_000 and made.sequences < 1.0001 * made.bound


def test_small_programs_against_all_packings():
    """No fewer sequences than the optimum, and at most one more, on all that fits a plain search."""
    rng = random.Random(5)

    def least(items, capacity):
        best = len(items)

        def go(k, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if k == len(items):
                best = len(rooms)
                return
            for i in sorted({r: i for i, r in enumerate(rooms) if r >= items[k]}.values()):
                go(k + 1, [*rooms[:i], rooms[i] - items[k], *rooms[i + 1 :]])
            go(k + 1, [*rooms, capacity - items[k]])

        go(0, [])
        return best

    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 10))), reverse=True)
        made = packing.plan(histogram(items), 20)
        assert made.bound - 1e-9 <= least(items, 20) <= made.sequences <= least(items, 20) + 1


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        encoder = word_ids.WordIds(f.read())
    assert encoder.by_word
    rng = random.Random(1)
    parts = [" ", "\n", "\t", "a", "B", "é", "É", "é", "́", "1", "'s", "'S", "'", "of", "  ", "\r\n", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "|>", "…", "—", "×", "÷", "ß", "İ", "Σ", "日本", " ", "　", "\x0b", "\x1c", "\x00", "\x7f", ".", ",", "(", "''", "'re", "½", "ª", "😀", "⃣", "ſ", "'ſ", "ﬁ", "K"]
    texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(8000))]
    ids, counts = encoder.encode(*textscan.text_buffer(pa.array(texts)))
    ends = np.cumsum(counts)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends)] == want
