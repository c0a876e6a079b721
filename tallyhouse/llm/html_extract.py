"""Main text of web pages by wrapper induction per host.

A page's block elements form a tree; siblings of one label (tag and classes) are one slot, as a
list's entries are. The distinct trees of all pages of a host, marked ones included, are merged by simple
tree matching, some at a time, into the host's wrapper, and each distinct tree is matched with the finished
wrapper. From two pages of distinct content of a host on (adverts and menus aside) its nodes are judged:

- a text that a node shows on nearly all of the host's pages is constant: template;
- a node of a class, or below one, that pages with an article or main element show outside of it, twice or
  more, is template whole;
- texts of the other, varying slots are content.

Where a page marks an article or main element, only that counts, and all of it: nothing in there is taken
for template, and only elements, roles and whole class names that say menu, form, advert or reader comments
are left out of it. Elsewhere parts that are no article are told by element, role and class words as well.

Pages are read twice and never shuffled while the template is small: the first pass sends trees and hashes of
block texts, grouped by host with partial sums; the second one parses each page, and gets the template of its
tree (a broadcast while there is little, else a join by host and tree). No task holds a host's pages.

A page that would lose more than nine tenths of its text to constants (half with two pages of evidence, two
thirds with three, and so on) is a copy of others rather than one of their template, and keeps it all.

Blocks are text between borders of block elements, character references decoded, white space as one
space, trimmed, joined by two line feeds in page order. Nothing else is dropped.

Defined cases: null html has empty text; a null or odd url has no host and no wrapper; pages of
a host with equal content count once as evidence; a host with one such page has no template; unclosed and
stray tags follow the usual repair rules; elements below depth 200 join their ancestor of that depth.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.textscan import chunks_of
from tallyhouse.storage import settle

#: Pages of distinct content of a host before anything counts as constant, and the share that must show it (up to 19 pages that is all).
MIN_PAGES = 2
CONSTANT_SHARE = 0.95
#: Constants that hold a larger share of a page's text than this, or than 1 - 1 / pages, tell of copies and not of a template.
MOST_TAKEN = 0.9
#: Trees merged in one task, round by round.
MERGED = 64
#: Template entries (about 32 bytes each) that may be broadcast.
BROADCAST_ENTRIES = 200_000
#: Stands for all texts of a node.
WHOLE = 0
MAX_DEPTH = 200
CHUNK = 4 << 20

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math canvas audio video object".split())
CLOSES_P = BLOCK_TAGS - {"body", "head", "html", "option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: A start tag ends an open element of these kinds, up to the given border.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
DROPPED_TAGS = frozenset("head nav footer aside form select menu dialog button".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup "
    "modal overlay newsletter subscribe subscription sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar "
    "comment comments reply replies disqus share sharing social related recommended widget login signup signin pagination pager skip toc".split()
)
#: Whole class names or ids that leave an element out of a marked article.
DROPPED_NAMES = frozenset("ad ads advert adverts advertisement comment comments comment-list comments-area disqus_thread newsletter sidebar".split())
#: Names of a page's head part; within an article they may hold its title.
HEADER_NAMES = frozenset(("header", "site-header", "page-header", "top-header", "site-title", "site-name", "logo"))
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _dropped(tag: str, told: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds what is no article."""
    if tag in DROPPED_TAGS or tag == "header" and not in_article or told.get("role", "").lower() in DROPPED_ROLES:
        return True
    names = f"{told.get('class', '')} {told.get('id', '')}"
    if in_article:
        return not DROPPED_NAMES.isdisjoint(names.lower().split())
    if "hidden" in told or told.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", told.get("style", "")):
        return True
    if not HEADER_NAMES.isdisjoint(names.lower().split()):
        return True
    return tag not in ("html", "body", "article", "main") and any(w.lower() in DROPPED_WORDS for w in WORD.findall(names)) or tag == "article" and any(
        w.lower() in ("comment", "comments", "reply", "related", "promo", "ad") for w in WORD.findall(names)
    )


def _label(tag: str, classes: str) -> str:
    """Tag and classes in any order; long lists by their hash."""
    names = ".".join(sorted(classes.split()))
    return f"{tag}.{names}" if len(names) <= 48 else f"{tag}#{_hash(names):x}"


class Page:
    """Blocks of a page as (node, text, dropped, main), and the element tree as (label, children)."""

    def __init__(self, html: str):
        self.labels, self.children, self.named = ["#"], [[]], [False]
        self.blocks: list[tuple[int, str, bool, bool]] = []
        self.open: list[tuple[str, int, bool, bool]] = [("#", 0, False, False)]
        self.texts: list[str] = []
        at, n = 0, len(html)
        while at < n:
            m = TOKEN.match(html, at)
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                if m[0][0] != "<" or m[0] == "<":
                    self.texts.append(entities.unescape(m[0]) if "&" in m[0] else m[0])
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._end(tag)
            elif tag in RAW_TAGS:
                if not (m[3] or m[6] or "").endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                    at = close.end() if close else n
            else:
                self._start(tag, m[3] or m[6] or "")
        self._flush()

    def _flush(self) -> None:
        if self.texts:
            text = " ".join("".join(self.texts).split())
            self.texts = []
            if text:
                _, node, dropped, main = self.open[-1]
                self.blocks.append((node, text, dropped, main))

    def _pop(self, place: int) -> None:
        self._flush()
        del self.open[place:]

    def _up(self, tags, border=()) -> int | None:
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place][0] in tags:
                return place
            if self.open[place][0] in border:
                return None
        return None

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in BLOCK_TAGS and tag not in ("button",):
            if tag == "br":
                self.texts.append(" ")
            return
        self._flush()
        if tag in CLOSES_P and (place := self._up({"p"}, {"table", "td", "th", "button"})) is not None:
            self._pop(place)
        if tag in SIBLINGS and (place := self._up(*SIBLINGS[tag])) is not None:
            self._pop(place)
        if tag in VOID_TAGS:
            return
        told = _attributes(attributes)
        _, above, dropped, main = self.open[-1]
        dropped = dropped or _dropped(tag, told, main)
        main = main or tag in ("article", "main") or told.get("role", "").lower() == "main"
        node = above
        if len(self.open) < MAX_DEPTH:
            node = len(self.labels)
            self.labels.append(_label(tag, told.get("class", "")))
            self.children.append([])
            self.named.append(self.named[above] or tag != "body" and bool(told.get("class", "").strip()))
            self.children[above].append(node)
        self.open.append((tag, node, dropped, main))

    def _end(self, tag: str) -> None:
        if tag == "br":
            self.texts.append(" ")
        elif tag in BLOCK_TAGS or tag == "button":
            place = self._up({tag}, () if tag in ("article", "body", "html", "main") else {"article", "td", "th"} - {tag})
            if place is not None:
                self._pop(place)
            else:
                self._flush()

    def slots(self) -> tuple[list, dict[int, int]]:
        """The tree of slots as nested [label, children], and the slot (in preorder) of each node."""
        slot_of: dict[int, int] = {}
        count = 0

        def merge(nodes: list[int]) -> list:
            nonlocal count
            mine, groups = count, {}
            count += 1
            for node in nodes:
                slot_of[node] = mine
                for child in self.children[node]:
                    groups.setdefault(self.labels[child], []).append(child)
            return [self.labels[nodes[0]], [merge(g) for g in groups.values()]]

        return merge([0]), slot_of

    def marked(self) -> bool:
        """Whether an article or main element holds the content."""
        return any(main and not dropped for _, _, dropped, main in self.blocks)

    def content(self) -> list[tuple[int, str]]:
        """Blocks that may be the article: (node, text)."""
        marked = self.marked()
        return [(node, text) for node, text, dropped, main in self.blocks if not dropped and (main or not marked)]

    def evidence(self, slot_of: dict[int, int]) -> set[tuple[int, int]]:
        """(slot, hash of the text) of blocks that may be template; of a marked page (slot, WHOLE) for slots outside, too."""
        marked = self.marked()
        outside = [(node, text) for node, text, dropped, main in self.blocks if not main]
        # a bare element may hold anything on another page; one of a class, or in such a one, is the same part
        whole = {(slot_of[node], WHOLE) for node, _ in outside if self.named[node]} if marked else set()
        return whole | {(slot_of[node], _hash(text)) for node, text in outside}


def _matching(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two trees of one label: nodes matched, and the pairs of children aligned."""
    rows, columns = a[1], b[1]
    score = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
    own = [[0] * len(columns) for _ in rows]
    for i, x in enumerate(rows):
        for j, y in enumerate(columns):
            if x[0] == y[0]:
                own[i][j] = _matching(x, y)[0]
            score[i + 1][j + 1] = max(score[i][j + 1], score[i + 1][j], score[i][j] + own[i][j])
    pairs, i, j = [], len(rows), len(columns)
    while i and j:
        if own[i - 1][j - 1] and score[i][j] == score[i - 1][j - 1] + own[i - 1][j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif score[i][j] == score[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return score[-1][-1] + 1, pairs[::-1]


def merged(a: list, b: list) -> list:
    """The wrapper of two trees of one label: matched nodes once, the others in their order."""
    _, pairs = _matching(a, b)
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a[1]), len(b[1]))]:
        out += a[1][i:x] + b[1][j:y]
        if x < len(a[1]):
            out.append(merged(a[1][x], b[1][y]))
        i, j = x + 1, y + 1
    return [a[0], out]


def _size(tree: list) -> int:
    return 1 + sum(_size(c) for c in tree[1])


def aligned(tree: list, wrapper: list, base: int = 0, at: int = 0) -> dict[int, int]:
    """Preorder numbers of the tree's nodes and of the wrapper nodes they match."""
    out = {at: base}
    mine, theirs = [at + 1], [base + 1]
    for c in tree[1]:
        mine.append(mine[-1] + _size(c))
    for c in wrapper[1]:
        theirs.append(theirs[-1] + _size(c))
    for i, j in _matching(tree, wrapper)[1]:
        out.update(aligned(tree[1][i], wrapper[1][j], theirs[j], mine[i]))
    return out


def _hash(*parts: object) -> int:
    text = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks_of(batches, "html", CHUNK):
        out: dict[str, list] = {"host": [], "page": [], "tree": [], "slots": [], "texts": []}
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host = host_of(url)
            if not host or not html:
                continue
            page = Page(html)
            content = page.content()
            if not content:
                continue
            tree, slot_of = page.slots()
            seen = sorted(page.evidence(slot_of))
            out["host"].append(host)
            out["page"].append(_hash(*[t for _, t in content]))
            out["tree"].append(json.dumps(tree, ensure_ascii=False, separators=(",", ":")))
            out["slots"].append([s for s, _ in seen])
            out["texts"].append([t for _, t in seen])
        kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def _merge_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, part, tree) sorted by the first two: one wrapper for each."""
    key, wrapper = None, None
    for batch in batches:
        done: list[tuple] = []
        for host, part, tree in zip(*[c.to_pylist() for c in batch.columns]):
            if (host, part) != key:
                if key:
                    done.append((key[0], json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))))
                key, wrapper = (host, part), json.loads(tree)
            else:
                wrapper = merged(wrapper, json.loads(tree))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["host", "tree"])
    if key:
        last = (key[0], json.dumps(wrapper, ensure_ascii=False, separators=(",", ":")))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in last], names=["host", "tree"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"host": [], "tree_key": [], "slots": [], "nodes": []}
        for host, tree, wrapper in zip(*[c.to_pylist() for c in batch.columns]):
            pairs = sorted(aligned(json.loads(tree), json.loads(wrapper)).items())
            out["host"].append(host)
            out["tree_key"].append(_hash(tree))
            out["slots"].append([a for a, _ in pairs])
            out["nodes"].append([b for _, b in pairs])
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def wrappers(trees: DataFrame) -> DataFrame:
    """host, tree: one wrapper for each host, from all its distinct trees, merged in rounds."""
    found = trees.select("host", "tree").distinct()
    while True:
        counted = settle(found)
        per_host = settle(counted.groupBy("host").agg(F.count(F.lit(1)).alias("n")))
        if per_host.filter("n > 1").isEmpty():
            return counted
        parts = counted.join(per_host, "host").withColumn("part", F.pmod(F.xxhash64("tree"), F.ceil(F.col("n") / MERGED)).cast("int"))
        parts = parts.select("host", "part", "tree").repartition("host", "part").sortWithinPartitions("host", "part", "tree")
        found = parts.mapInArrow(_merge_groups, "host string, tree string")


def templates(pages: DataFrame) -> DataFrame:
    """host, tree_key, template, pages: the (slot:text) entries of each distinct tree that are template, and the host's distinct pages."""
    rows = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    seen = settle(rows.mapInArrow(_survey, "host string, page long, tree string, slots array<int>, texts array<long>"))
    trees = settle(seen.select("host", "tree").distinct())
    wrapper = wrappers(trees).withColumnRenamed("tree", "wrapper")
    matched = trees.join(wrapper, "host").mapInArrow(_align, "host string, tree_key long, slots array<int>, nodes array<int>")
    nodes = settle(matched.select("host", "tree_key", F.explode(F.map_from_arrays("slots", "nodes")).alias("slot", "node")))
    keys = settle(trees.mapInArrow(_tree_keys, "host string, tree string, tree_key long"))
    pages_once = seen.groupBy("host", "page").agg(F.min("tree").alias("tree"), F.min(F.struct("tree", "slots", "texts")).alias("first"))
    once = settle(pages_once.join(keys, ["host", "tree"]).select("host", "page", "tree_key", F.col("first.slots").alias("slots"), F.col("first.texts").alias("texts")))
    total = settle(once.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= MIN_PAGES))
    shown = once.join(total, "host", "left_semi").select("host", "page", "tree_key", F.explode(F.arrays_zip("slots", "texts")).alias("b"))
    shown = shown.select("host", "tree_key", F.col("b.slots").alias("slot"), F.col("b.texts").alias("text"))
    counted = settle(shown.groupBy("host", "tree_key", "slot", "text").agg(F.count(F.lit(1)).alias("n")).filter("n > 0"))
    at_node = counted.join(nodes, ["host", "tree_key", "slot"]).groupBy("host", "node", "text").agg(F.sum("n").alias("n"))
    often = F.when(F.col("text") == WHOLE, F.col("n") >= MIN_PAGES).otherwise(F.col("n") >= F.col("pages") * CONSTANT_SHARE)
    constant = at_node.join(total, "host").filter(often).select("host", "node", "text")
    back = settle(constant).join(nodes, ["host", "node"]).select("host", "tree_key", "slot", "text").distinct()
    # of one tree: what nearly every page of that form shows
    grouped = back.groupBy("host", "tree_key").agg(F.sort_array(F.collect_list(F.concat_ws(":", "slot", "text"))).alias("template"))
    return settle(grouped.join(total, "host"))


def _tree_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([_hash(t) for t in batch.column(1).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], names=["host", "tree", "tree_key"])


def kept_blocks(found: list[tuple[int, str]], marked: bool, template: frozenset[str] | set[str], pages: int) -> list[str]:
    """The article's blocks among (slot, text), without the template that its host's distinct pages gave."""
    if template and found and not marked:
        left = [(slot, text) for slot, text in found if f"{slot}:{WHOLE}" not in template]
        kept = [(slot, text) for slot, text in left if f"{slot}:{_hash(text)}" not in template]
        size = sum(len(text) for _, text in left)
        if left and size - sum(len(text) for _, text in kept) <= size * min(MOST_TAKEN, 1 - 1 / pages):
            left = kept
        found = left or found
    return [text for _, text in found]


def main_blocks(html: str, template: frozenset[str] | set[str], pages: int = 100) -> list[str]:
    """The article's blocks of one page."""
    page = Page(html)
    _, slot_of = page.slots()
    return kept_blocks([(slot_of[node], text) for node, text in page.content()], page.marked(), template, pages)


BLOCKS = "page_id long, url string, host string, tree_key long, marked boolean, slots array<int>, texts array<string>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks_of(batches, "html", CHUNK):
        hosts, keys, marks, slots, texts = [], [], [], [], []
        for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            page = Page(html or "")
            content = page.content()
            tree, slot_of = page.slots()
            hosts.append(host_of(url))
            keys.append(_hash(json.dumps(tree, ensure_ascii=False, separators=(",", ":"))))
            marks.append(page.marked())
            slots.append([slot_of[node] for node, _ in content])
            texts.append([text for _, text in content])
        made = [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(marks, pa.bool_()), pa.array(slots, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["page_id", "url", "host", "tree_key", "marked", "slots", "texts"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, *columns = batch.columns
        out = ["\n\n".join(kept_blocks(list(zip(s, t)), m, set(c or ()), n or 1)) for m, s, t, c, n in zip(*[x.to_pylist() for x in columns])]
        yield pa.RecordBatch.from_arrays([ids, urls, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    known = templates(pages).withColumnsRenamed({"host": "of_host", "tree_key": "of_tree"})
    if (known.agg(F.sum(F.size("template"))).first()[0] or 0) <= BROADCAST_ENTRIES:
        known = F.broadcast(known)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.mapInArrow(_parsed, BLOCKS)
    rows = rows.join(known, (F.col("host") == F.col("of_host")) & (F.col("tree_key") == F.col("of_tree")), "left")
    rows = rows.select("page_id", "url", "marked", "slots", "texts", "template", "pages")
    return rows.mapInArrow(_joined, "page_id long, url string, text string, n_chars long")
