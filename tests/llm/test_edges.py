"""Nulls, empty and very long texts, repeated rows, empty tables and extra columns."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from plain import base_counts, components, contamination, line_verdicts
from tallyhouse.llm import chat, decontam, html_extract, line_dedup, mixing, near_dedup, quality, secret_scan, token_files, warc
from tallyhouse.llm.registry import tokenizer_path

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000)) + "\n" + "z" * 300_000
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "Word"), (6, LONG), (7, LONG + " end"),
    (8, f"before {PASSAGE} after"), (8, f"before {PASSAGE} after"), (9, f"BEFORE {PASSAGE} after"),
    (10, "alpha beta gamma delta epsilon zeta\nalpha beta gamma DELTA epsilon zeta\nalpha beta gamma other epsilon zeta"),
    (None, "lone text with password=abcdefgh12 inside \U0001f600 of it"), (None, f"before {PASSAGE} after"), (11, "x y z " * 40),
]
EXTRA = "doc_id long, text string, lang string, source string, node string, __words string, set_key int, `odd name` string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if n % 3 else "en", None if n % 4 else "s", "n", "w", n, "o") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (None, "alpha beta"), (3, ""), (3, "word")], "item_id long, text string")


def rows_of(df, *names):
    return sorted(df.select(*names).collect(), key=repr)


def test_quality(docs, none):
    got = {(r.doc_id, r.n_words): r for r in quality.quality_rules(docs).collect()}
    for doc, text in TEXTS:
        want = base_counts(text)
        r = got[doc, want[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (want[-1] and r.kept)
    assert quality.quality_rules(none).count() == 0
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(none).columns == none.columns
    assert quality.quality_rules(docs.select("doc_id", "text")).count() == len(TEXTS)


def test_near_dedup(docs, none):
    comp, sizes = components([t for _, t in TEXTS])
    want = []
    for (doc, _), c, n in zip(TEXTS, comp, sizes):
        ids = [d for (d, _), x in zip(TEXTS, comp) if x == c and d is not None]
        want.append((doc, n, min(ids, default=None) if n else doc))
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got)
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 8, 10, 11, None]))
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.deduplicate(none).count() == 0


def test_decontamination(docs, none, items):
    known = [(r.item_id, r.text) for r in items.collect()]
    want = sorted(repr((d, *contamination(t, known))) for d, t in TEXTS)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for block in (decontam.BLOCK, 1):
        marked = decontam.marked_documents(docs, items, block=block)
        assert sorted(r[decontam.N_WORDS] for r in marked.collect()) == sorted(contamination(t, known)[0] for _, t in TEXTS)
    assert sorted(repr(tuple(r[n] for n in names)) for r in decontam.contamination(docs, items).collect()) == want
    left = decontam.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert left.count() == sum(not contamination(t, known)[-1] for _, t in TEXTS)
    cut = {r.text for r in decontam.cut_spans(docs.filter("doc_id = 8"), items).collect()}
    assert cut == {"before  after"}
    assert decontam.decontaminate(docs, items.limit(0)).count() == len(TEXTS)
    assert decontam.contamination(none, items).count() == 0


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = token_files.token_ids(docs, tokenizer_path()).orderBy("start").collect()
    ids = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in TEXTS]
    crc = lambda x: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x))
    assert sorted(repr((d, len(x), crc(x))) for d, x in ids) == sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got)
    assert [r.doc_id for r in got] == sorted((d for d, _ in TEXTS), key=lambda d: -1 if d is None else d)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert token_files.token_ids(none, tokenizer_path()).count() == 0


def test_line_dedup(docs, none):
    unique = docs.filter("doc_id is not null and doc_id <> 8")
    want = line_verdicts([(d, t) for d, t in TEXTS if d not in (None, 8)], line_dedup.MIN_WORDS)
    got = {(r.doc_id, r.line): (r.verdict, None if r.of_line is None else (r.of_doc, r.of_line)) for r in line_dedup.line_verdicts(unique).collect()}
    assert got == want
    cleaned = line_dedup.without_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(TEXTS)
    assert line_dedup.line_verdicts(docs).count() > 0
    assert line_dedup.line_verdicts(none).count() == 0 and line_dedup.without_repeats(none).count() == 0


def test_mixing(docs, none):
    mixed = mixing.realised(docs)
    assert mixed.columns == docs.columns
    assert mixed.select("set_key").distinct().count() == len(TEXTS)
    assert mixing.mixture(docs, repetition_limit=3.0, target_entropy=1.0).count() >= len(TEXTS)
    assert mixing.realised(none).count() == 0


def test_secrets(docs, none):
    got = secret_scan.secrets_of(docs).collect()
    assert len(got) == len(TEXTS)
    (hit,) = [r for r in got if r.n_assign]
    at = TEXTS[11][1].index("password")
    told = f"assign:{at}:{at + len('password=abcdefgh12')}"
    assert hit.base_sha256 == hashlib.sha256(told.encode()).hexdigest() and told in hit.spans.split(",")
    empty = [r for r in got if r.doc_id in (1, 2)]
    assert all((r.n_assign, r.n_access, r.n_hex, r.spans) == (0, 0, 0, "") for r in empty)
    assert secret_scan.secrets_of(none).count() == 0


PAGES = "page_id long, url string, html string, host string, digest string"
HTML = "<body><nav>menu</nav><article><h1>Title &amp; more</h1><p>One<p>Two&nbsp; three<div class='ad'>buy</div></article><div id=comments>hm</div>"


def test_pages(spark):
    rows = [(1, "http://a.b/x", HTML, "h", "d"), (1, "http://a.b/x", HTML, "h", "d"), (2, None, None, "h", "d"), (3, "odd\r\nurl", "", "h", "d"),
            (None, "http://a.b", HTML, "h", "d"), (5, "http://[bad", "<p" * 5000 + "<div>" * 3000 + "deep", "h", "d"), (6, "http://a.b/", LONG, "h", "d")]
    pages, none = spark.createDataFrame(rows, PAGES), spark.createDataFrame([], PAGES)
    texts = {(r.page_id, r.text, r.n_chars) for r in html_extract.extracted(pages).collect()}
    assert (1, "Title & more\n\nOne\n\nTwo three", 28) in texts and (2, "", 0) in texts and (3, "", 0) in texts
    assert html_extract.extracted(pages).count() == len(rows) and html_extract.extracted(none).count() == 0
    got = warc.archived(pages).collect()
    want = []
    for page, _, html, *_ in rows:
        same = [p for p, _, h, *_ in rows if (h or "") == (html or "") and p is not None]
        response = max(same, default=None)
        want.append((page, len((html or "").encode()), "revisit" if response != page and response is not None else "response", response if response != page else None))
    assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in got)
    assert warc.archived(none).count() == 0
    assert {r.record_type for r in warc.archived(pages, least_bytes=10**9).collect()} == {"response"}


def test_chat(spark):
    kind = "conv_id long, turn long, role string, text string, place string, of int"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"),
        (3, 2, "user", "<|end|> bye"), (4, 0, "user", "hi"), (4, 0, "user", "hi"), (5, 0, None, None), (None, 0, "user", "x"), (6, None, "user", "q"), (6, 1, "user", "r"),
    ]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], kind)
    got = chat.rendered(df).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.place, r.n_turns) for r in got] == [(None, 1, 1), (3, 1, 3), (3, 2, 3), (3, 3, 3), (5, 1, 1), (6, 1, 2), (6, 2, 2)]
    assert got[3].rendered == "<|user|>\n< |end|> bye<|end|>\n"
    assert chat.rendered(df.limit(0)).count() == 0


def test_a_long_conversation_spreads_over_tasks(spark):
    rows = [(c, t, "user", f"turn {t}") for c, n in ((1, 400), (2, 390), (3, 400)) for t in range(n)]
    rows += [(4, t, "user", f"turn {t}" if t < 399 else "other") for t in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    got = chat.rendered(df).groupBy("conv_id").agg(F.count("*").alias("n")).orderBy("conv_id").collect()
    assert [tuple(r) for r in got] == [(1, 400), (4, 400)]
