"""The data structures below the operators, against plain code."""

import io
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from plain import SPACED, components, fold
from tallyhouse.llm import decontam, html_extract, id_coder, mixing, near_dedup, secret_scan, textscan, token_files, warc
from tallyhouse.llm.registry import tokenizer_path


def test_words_do_not_cross_texts(monkeypatch):
    monkeypatch.setattr(textscan, "PIECE", 16)
    rng = random.Random(0)
    texts = ["".join(rng.choice(" \n\tabABé漢") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", None, "x" * 200]
    data, offsets = textscan.text_buffer(pa.array(texts))
    words = textscan.scan_words(data, offsets, textscan.SPACED)
    want = [(i, w.encode()) for i, t in enumerate(texts) for w in SPACED.findall(t or "")]
    assert [(d, data[a:b].tobytes()) for d, a, b in zip(words.doc.tolist(), words.start, words.end)] == want
    by = {}
    for h, (_, w) in zip(words.hash.tolist(), want):
        assert by.setdefault(fold(w.decode()), h) == h
    assert len(set(by.values())) == len(by)


def test_fm_index():
    rng = np.random.default_rng(0)
    for _ in range(200):
        symbols = rng.integers(1, 4, int(rng.integers(1, 60)))
        index, text = decontam.FMIndex(symbols, sample=4), symbols.tolist()
        assert decontam.suffix_order(np.append(symbols, 0)).tolist() == sorted(range(len(text) + 1), key=lambda i: [*text, 0][i:])
        phrases, lengths = np.minimum(rng.integers(1, 4, (20, 3)), symbols.max()), rng.integers(1, 4, 20)
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high):
            want = [j for j in range(len(text) - n + 1) if text[j : j + n] == p[3 - n :].tolist()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_unpacked_suffix_order():
    symbols = np.append(np.random.default_rng(1).integers(1, 1 << 40, 500), 0)
    assert decontam.suffix_order(symbols).tolist() == sorted(range(501), key=lambda i: symbols[i:].tolist())


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 20_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 65536, n), rng.integers(0, 3, n), np.full(n, 65535), np.tile(np.arange(50), n)[:n]):
        assert id_coder.read_segment(io.BytesIO(id_coder.pack(ids))).tolist() == ids.tolist()


def test_coder_learns_and_checks():
    ids = np.tile(np.random.default_rng(0).integers(0, 50_000, 64), 128)
    packed = id_coder.pack(ids)
    assert len(packed) < len(ids) / 2
    with pytest.raises(ValueError):
        id_coder.read_segment(io.BytesIO(packed[:-200] + bytes(100) + packed[-100:]))
    with pytest.raises(ValueError):
        id_coder.pack(np.array([1 << 16]))


def test_pieces_equal_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    rng = random.Random(3)
    parts = [" ", "\n", "\t", "a", "B", "é", "1", "'s", "'", "#", " ", "　", "漢", "\U0001f600", "the", " of", "  ", "\r\n", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    with open(tokenizer_path(), encoding="utf-8") as f:
        pieces = token_files.Pieces(f.read())
    ids, counts = pieces.encode(*textscan.text_buffer(pa.array(texts)))
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_block_links_join_what_pairs_would():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = []
    for _ in range(40):
        keep = base[rng.random(60) < rng.uniform(0.6, 1)]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 60, int(rng.integers(0, 12))).astype(np.uint64)])))
    linked = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))

    def roots(edges):
        root = list(range(40))
        find = lambda i: i if root[i] == i else find(root[i])
        for a, b in edges:
            root[find(a)] = find(b)
        return [min(j for j in range(40) if find(j) == find(i)) for i in range(40)]

    want = roots([(i, j) for i, j in itertools.combinations(range(40), 2) if linked(sets[i], sets[j])])
    none = np.zeros(40, bool)
    assert roots(near_dedup.block_links(sets, list(range(40)), list(range(40)), none)) == want
    first = np.arange(40) < 20
    found = near_dedup.block_links(sets, list(range(40)), list(range(40)), first)
    for part in (range(20), range(20, 40)):
        found += near_dedup.block_links([sets[i] for i in part], list(part), list(part), np.zeros(20, bool))
    assert roots(found) == want


def test_tree_matching():
    a, b = ["b", [["x", []], ["y", [["z", []]]]]], ["b", [["w", []], ["y", [["q", []], ["z", []]]]]]
    wrapper = html_extract.merged(a, b)
    assert wrapper == ["b", [["x", []], ["w", []], ["y", [["q", []], ["z", []]]]]]
    assert html_extract.aligned(a, wrapper) == {0: 0, 1: 1, 2: 3, 3: 5}


def test_constants_of_a_host_go(spark):
    rows = [(i, f"http://h.com/{i}", f"<body><div>Shop name</div><div class=x>Item {i}</div><p>Call us now</p></body>") for i in range(12)]
    rows += [(20 + i, "http://few.com/", "<body><div>Shop name</div><p>Text</p></body>") for i in range(30)]
    got = {r.page_id: r.text for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Item 3" and got[20] == "Shop name\n\nText"


def test_page_parts():
    page = (
        '<html><head><title>t</title></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use</div><main><h1>T</h1>'
        "<p>a <b>b</b>&nbsp; c<ul><li>x<li>y</ul><form><p>f</p></form><script>if (a<b) '</p>'</script><div class=comments><p>no</p></div>"
        "</main><aside>s</aside><footer>f</footer>"
    )
    assert html_extract.main_blocks(page, set()) == ["T", "a b c", "x", "y"]


def test_page_without_an_article_element():
    page = (
        "<body><div class='header'>Shop</div><ul class=menu><li>Home</ul><div class=content><h2>T</h2><p>x<div class=cookieNotice>c</div>"
        "<p>y</div><div class='sidebar-left'>s</div><section id=comments><p>no</section><div class=footer>f</div></body>"
    )
    assert html_extract.main_blocks(page, set()) == ["T", "x", "y"]


def test_archive_members_open_alone(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "x" * i * 1000) for i in range(30)], "page_id long, url string, html string")
    archives = warc.write_archives(pages)
    index = warc.normalise(archives)
    assert index.count() == archives.agg({"n_records": "sum"}).first()[0] == 30
    assert warc.read_records(index.filter("record_id = '<urn:page:17>'")).first().payload_bytes == 17_000


def test_viterbi_is_exact():
    features, labels, sizes = secret_scan.training_windows([], 300)
    field = secret_scan.fit(features, labels, sizes)
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 7))
        scores = rng.normal(0, 3, (n, 3)).astype(np.float32)
        scores[:, 0] += rng.integers(0, 6)
        value = lambda p: sum(scores[i, p[i]] + field.moves[p[i - 1] if i else 0, p[i]] for i in range(n))  # noqa: B023, E731
        assert abs(value(field.tags(scores, np.zeros(n, int))) - max(map(value, itertools.product(range(3), repeat=n)))) < 1e-3


def test_held_out_accuracy():
    field = secret_scan.fit(*secret_scan.training_windows(["some plain words of a text"], 800))
    features, labels, sizes = secret_scan.training_windows(["other words in another text here"], 300, seed=99)
    inside = np.arange(features.shape[1])[None] < sizes[:, None]
    got = field.tags(field.scores(features[inside]), np.repeat(np.arange(300), sizes)) > 0
    want = labels[inside] > 0
    assert (got & want).sum() / got.sum() > 0.95 and (got & want).sum() / want.sum() > 0.95


def test_weights_meet_the_limit(spark):
    rows = [(i, "a b c d", "big" if i < 700 else f"s{i % 10}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit in (1.0, 1.5, 2.0):
        got = mixing.mixture(docs, repetition_limit=limit, target_entropy=1.0).groupBy("source").count().collect()
        used = {r.source: r["count"] / (700 if r.source == "big" else 30) for r in got}
        assert used.pop("big") == 1.0 and all(abs(u - limit) < 0.05 for u in used.values())


def test_a_family_of_copies(spark, monkeypatch):
    """Copies of one text, lightly and heavily edited, with blocks of few rows."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 400)}" for _ in range(150)]
    texts = [" ".join(words)]
    for _ in range(150):
        rate = rng.choice((0.01, 0.03, 0.05, 0.1))
        texts.append(" ".join(f"x{rng.randint(0, 9999)}" if rng.random() < rate else w for w in words))
    texts += [" ".join(f"y{rng.randint(0, 5000)}" for _ in range(80)) + " all rights reserved under the usual terms of use" for _ in range(60)]
    root, sizes = components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: (root[i], sizes[i]) for i in range(len(texts))}
    assert len(set(root)) > 62 and root.count(0) > 30
