"""Wrapper induction: alignment by enumeration, evidence of marked pages, and no names within articles."""

import itertools
import random
import re

from pyspark.sql import functions as F

from tallyhouse.llm import html_extract as H


def tree(rng, depth=3):
    return [rng.choice("ab"), [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []]


def best(a, b):
    """Most nodes in common, over all order-keeping pairings of children."""
    if a[0] != b[0]:
        return 0
    most = 0
    for k in range(min(len(a[1]), len(b[1])) + 1):
        for x in itertools.combinations(a[1], k):
            for y in itertools.combinations(b[1], k):
                most = max(most, sum(best(p, q) for p, q in zip(x, y)))
    return 1 + most


def labels(t):
    return [t[0], *(x for c in t[1] for x in labels(c))]


def test_alignment_against_enumeration():
    rng = random.Random(4)
    for _ in range(150):
        a, b = ["r", [tree(rng, 2) for _ in range(rng.randint(0, 3))]], ["r", [tree(rng, 2) for _ in range(rng.randint(0, 3))]]
        score, pairs = H._matching(a, b)
        assert score == best(a, b) and pairs == sorted(pairs) and all(x < z and y < w for (x, y), (z, w) in itertools.pairwise(pairs))
        wrapper = H.merged(a, b)
        assert len(labels(wrapper)) == len(labels(a)) + len(labels(b)) - score
        for t in (a, b):
            # a tree finds all its nodes in the wrapper, under their labels and in order
            found = H.aligned(t, wrapper)
            assert len(found) == len(labels(t)) and list(found.values()) == sorted(found.values())
            assert all(labels(t)[i] == labels(wrapper)[j] for i, j in found.items())


def texts(spark, rows):
    return {r.page_id: r.text for r in H.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_scrambled_class_names_change_nothing(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    plain = {r.page_id: r.text for r in H.extracted(pages).collect()}
    scrambled = pages.withColumn("html", F.regexp_replace("html", 'class="ad"', 'class="x7f"'))
    assert {r.page_id: r.text for r in H.extracted(scrambled).collect()} == plain
    found = H.templates(pages)
    several = pages.select("page_id", F.lower(F.regexp_extract("url", "//([^/:?#]*)", 1)).alias("host"), F.md5("html").alias("h")).groupBy("host").agg(F.countDistinct("h").alias("n"))
    assert {r.host for r in several.filter("n > 1").collect()} == {r.host for r in found.collect()}
    assert found.filter(F.size("template") == 0).isEmpty()


def test_marked_pages_tell_of_unmarked_ones(spark):
    """Parts that marked pages show outside their article are template on the host's other pages, whatever they are called."""
    marked = "<body><div class=q1>buy {0} now</div><article><p>Marked text {0} of some length.</p></article><div class=q2>more {0}</div></body>"
    bare = "<body><div class=q1>buy {0} here</div><div class=zz><p>Bare text {0} of some length.</p></div><p>And {0}.</p><div class=q2>extra {0}</div></body>"
    rows = [(i, f"http://h.com/{i}", marked.format(i)) for i in range(4)] + [(i, f"http://h.com/{i}", bare.format(i)) for i in range(10, 13)]
    rows += [(20, "http://other.com/1", bare.format(20))]
    got = texts(spark, rows)
    assert all(got[i] == f"Marked text {i} of some length." for i in range(4))
    assert all(got[i] == f"Bare text {i} of some length.\n\nAnd {i}." for i in range(10, 13))
    assert got[20].startswith("buy 20 here")


def test_words_in_class_names_take_nothing_from_a_marked_article(spark):
    names = ["related-work", "share-price", "ad-hoc", "menu-item", "toc", "notice-of-meeting", "promo", "hidden"]
    inner = "".join(f"<div class='{n}'>Text of {n}</div>" for n in names) + "<div hidden>kept</div><div class='box comments'>reader</div><div class=ad>buy</div><nav>n</nav><aside>s</aside><form>f</form>"
    got = texts(spark, [(1, "http://a.com/1", f"<body><div class=menu>m</div><article>{inner}</article></body>")])
    assert got[1] == "\n\n".join([*(f"Text of {n}" for n in names), "kept"])


def test_classes_beyond_the_third_tell_slots_apart():
    many = " ".join(f"c{i}" for i in range(40))
    page = H.Page(f"<body><div class='{many} x'>a</div><div class='{many} y'>b</div><div class='{many} x'>c</div></body>")
    _, slot_of = page.slots()
    a, b, c = (slot_of[node] for node, *_ in page.blocks)
    assert a == c != b
    assert re.fullmatch(r"div#-?[0-9a-f]+", page.labels[-1])
