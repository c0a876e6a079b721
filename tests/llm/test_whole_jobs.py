"""Cases in which an operator once did less than the whole job."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plain import line_verdicts
from tallyhouse.llm import html_extract, line_dedup, near_dedup, quality, textscan, token_files
from tallyhouse.llm.registry import tokenizer_path


def test_word_rule_rejects_alone(spark):
    """No common words, and labelled word salad, go by the word distance; labelled good documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    plain = " ".join(f"{a}{b}{c}en" for a in "bdfgk" for b in "aeiou" for c in ("lt", "rm", "nd", "st", "rk", "mp"))
    added = spark.createDataFrame([(-1, f"{plain.capitalize()}.", "en")], docs.schema)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    found = quality.quality_rules(docs.union(added)).join(labels, "doc_id", "left").filter(~F.col("base_failed")).collect()
    (bare,) = [r for r in found if r.doc_id == -1]
    assert bare.n_words >= 100 and bare.class_distance <= quality.MAX_CLASS_DISTANCE and not bare.kept
    salad = [r for r in found if r.quality == 0 and r.word_distance is not None and r.class_distance <= quality.MAX_CLASS_DISTANCE]
    assert {212, 189, 811, 845, 233, 982, 981} <= {r.doc_id for r in salad} and not any(r.kept for r in salad)
    good = [r for r in found if r.quality == 1]
    assert len(good) > 300 and all(r.kept for r in good)


def verdicts(found):
    return {(r.doc_id, r.line): (r.verdict, None if r.of_line is None else (r.of_doc, r.of_line)) for r in found.collect()}


def test_shifted_lines(spark):
    """Lines that share a key with one that is two edits away still find their partner."""
    rng = random.Random(5)
    rows = [(1, "a b c d e f g"), (2, "b c d e f g"), (3, "b c d e f g h"), (4, "a b c d e f g h")]
    for i in range(40):
        words = [f"w{rng.randint(0, 3)}" for _ in range(40)]
        starts = [(rng.randint(0, 6), rng.randint(6, 9)) for _ in range(12)]
        lines = [" ".join(words[a : a + n]) for a, n in starts]
        rows.append((10 + i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = verdicts(line_dedup.line_verdicts(docs))
    assert got[3, 0] == ("near", (2, 0))
    assert got == line_verdicts(rows, line_dedup.MIN_WORDS)


def test_union_sketch_is_the_bottom_k(spark):
    """Subset pairs of 64 to 160 shingles: the estimate equals that on the k smallest fingerprints of the full union."""
    rng, rows, want = random.Random(6), [], {}
    for i in range(300):
        n = rng.randint(64, 160)
        words = [f"w{rng.randint(0, 10**9)}" for _ in range(n + 4)]
        texts = [" ".join(words), " ".join(words[: -(-3 * n // 4) + 4])]
        rows += [(2 * i, texts[0]), (2 * i + 1, texts[1])]
        values, bounds = near_dedup.shingle_sets(pa.array(texts))
        large, small = values[: bounds[1]], values[bounds[1] :]
        union = np.sort(np.union1d(large, small))[: near_dedup.SKETCH]
        want[2 * i] = np.isin(union, small).mean()
    found = near_dedup.sketched(spark.createDataFrame(rows, "doc_id long, text string"))
    a, b = (found.select((F.col("doc_id") - k).alias("pair"), F.col("sketch").alias(f"sketch_{s}")).filter("pair % 2 = 0") for k, s in ((0, "a"), (1, "b")))
    got = {r.pair: r.e for r in a.join(b, "pair").select("pair", near_dedup._estimate(near_dedup.SKETCH).alias("e")).collect()}
    assert len(got) == 300 and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    assert abs(sum(got.values()) / 300 - 0.75) < 0.02 and min(got.values()) > 0.425


def page_texts(spark, rows):
    return {r.page_id: r.text for r in html_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_template_of_a_small_host_goes(spark):
    page = "<body><div>Shop name</div><div><p>Article number {0} tells of {0} things at some length.</p></div><p>Call us now</p></body>"
    got = page_texts(spark, [(i, f"http://h{n}.com/{i}", page.format(i)) for n in (1, 2, 3) for i in range(10 * n, 11 * n)])
    assert got[10].startswith("Shop name") and all(got[i] == f"Article number {i} tells of {i} things at some length." for i in (20, 21, 30, 31, 32))


def test_special_tokens_as_the_library_reads_them(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(3)
    parts = [" ", "\n", "\t", "a", "B", "é", "1", "'s", " of", "  ", "\r\n", "<|endoftext|>", "<|endoftext|>", "<|endof", "|>"]
    texts = ["a <|endoftext|> b", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000))]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    with open(tokenizer_path(), encoding="utf-8") as f:
        pieces = token_files.Pieces(f.read(), special_as_text=False)
    ids, counts = pieces.encode(*textscan.text_buffer(pa.array(texts)))
    ends = np.cumsum(counts)
    assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends)] == want
    assert want[0] == [64, 220, 50256, 275]
    rows = list(enumerate(texts[:50]))
    got = token_files.token_ids(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()
    crc = lambda x: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x))
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {i: (len(want[i]) + 1, crc([*want[i], 2])) for i, _ in rows}


def test_short_lines_and_lines_without_spaces(spark):
    thai, han = "ภาษาไทยเขียนติดกัน", "今天的天气非常好我们去公园散步吧"
    lines = ["Menu", "menu", " Share this ", "share THIS", "", " ", "other", han, han, han[:5] + "们" + han[5:], han[:3] + "地" + han[4:], "地" + han[1:] + "们", thai, thai[:-1], "日本語", "日本話", "日 本 語", "l’eau…"]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "Menu\nnew")], "doc_id long, text string")
    got = verdicts(line_dedup.line_verdicts(docs, least=1))
    told = {0: ("first", None), 1: ("copy", (1, 0)), 2: ("first", None), 3: ("copy", (1, 2)), 6: ("first", None), 7: ("first", None), 8: ("copy", (1, 7))}
    told |= {9: ("near", (1, 7)), 10: ("near", (1, 7)), 11: ("first", None), 12: ("first", None), 13: ("near", (1, 12))}
    told |= {i: ("first", None) for i in (14, 15, 16, 17)}
    assert got == {(1, i): v for i, v in told.items()} | {(2, 0): ("copy", (1, 0)), (2, 1): ("first", None)}
    cleaned = {r.doc_id: r.text for r in line_dedup.without_repeats(docs).collect()}
    assert cleaned[2] == "new"


def test_copies_on_a_host_keep_their_text(spark):
    """One article under many addresses, with another advert or menu each time, is no template."""
    text = "<p>A first paragraph of the one article.</p><p>A second paragraph, longer than the first one of it.</p>"
    forms = (
        "<body><nav>menu {0}</nav><div>" + text + "</div><div class=ad>buy {0}</div></body>",
        "<body><nav>menu</nav><article>" + text + "<p>Seen {0} times</p></article></body>",
        "<body><div>" + text + "</div><div>buy {0}</div></body>",
    )
    got = page_texts(spark, [(100 * k + i, f"http://h{k}.com/?session={i}", form.format(i)) for k, form in enumerate(forms) for i in range(30)])
    both = "A first paragraph of the one article.\n\nA second paragraph, longer than the first one of it."
    assert all(got[i] == both for i in range(30))
    assert all(got[100 + i] == f"{both}\n\nSeen {i} times" for i in range(30))
    assert all(got[200 + i] == f"{both}\n\nbuy {i}" for i in range(30))
