"""Plain, slow forms of the operators for small inputs."""

import collections
import hashlib
import itertools
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = SPACED.findall(fold(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(texts):
    """Smallest position reachable, for each text."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for a, b in {p for h in holders.values() for p in itertools.combinations(h, 2)}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def contamination(text, items):
    """n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = collections.defaultdict(set)
    for item, t in items:
        words = ALNUM.findall(fold(t))
        for i in range(max(len(words) - 12, 1 if words else 0)):
            windows[tuple(words[i : i + 13])].add(item)
    words, hit, told = ALNUM.findall(fold(text)), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if (key := tuple(words[i : i + size])) in windows:
                hit |= set(range(i, i + size))
                told |= windows[key]
    names = sorted(str(t) for t in told if t is not None)
    return len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = SPACED.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = collections.Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def lines_of(rows, least):
    """(doc_id, line, words) of lines that take part in line dedup; rows are (doc_id, text)."""
    out = []
    for doc, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            words = tuple(SPACED.findall(fold(line)))
            if len(words) >= least:
                out.append((doc, i, words))
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def line_verdicts(rows, least):
    first, out = {}, {}
    for doc, i, words in sorted(lines_of(rows, least), key=lambda r: r[:2]):
        if words in first:
            out[doc, i] = ("copy", first[words])
        else:
            near = [at for other, at in first.items() if one_edit(words, other)]
            out[doc, i] = ("near", min(near)) if near else ("first", None)
            first[words] = (doc, i)
    return out
