"""Secret scans: base patterns, and a linear-chain conditional random field over tokens.

Tokens are runs of letters, digits, `+/_.-` and non-ASCII characters. Each is tagged B (begins a
secret), I (goes on) or O (none) from its own shape, the marks before it, its neighbours' words and
shapes, and features of the whole file. Weights are fitted on the driver by maximum likelihood
(forward-backward, AdaGrad) on `TRAIN_WINDOWS` short windows of at most `TRAIN_DOCS` sampled
documents, into which made-up secrets and look-alikes are set, so labels are known. That sample is the
only bounded part; every text is tagged whole.

Decoding is exact Viterbi. A token whose score for O leads by more than any two transitions can make
up is O on the best path whatever its neighbours are (changing it to O would raise the score); the
others form short runs between such tokens, which are decoded side by side.

Spans of the model that overlap a base span are left out; base spans always stay.

Defined cases: a null text is empty and has no spans; repeated rows each get their own result;
a token of any length is counted whole; an empty table trains on made-up windows only.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.textscan import _fold_table, chunks_of, scan_words, text_buffer

TRAIN_DOCS, TRAIN_WINDOWS, WINDOW_TOKENS = 512, 1600, 40
ROUNDS, RATE, DECAY, SEED = 120, 0.5, 2e-4, 7
CHUNK = 2 << 20

#: The base patterns, their least lengths, and the kinds in order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
#: Words beside which secrets stand.
KEYWORDS = (
    "password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "key", "access_key",
    "secret_key", "private_key", "auth", "authorization", "bearer", "credential", "credentials", "client_secret", "access_token",
)

_TOKEN_BYTE = lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 or b in b"+/_.-"
TOKENS = _fold_table(_TOKEN_BYTE)


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are digits, upper, lower, hex letters and marks (a row each), and each byte's one class but hex."""
    rows = (b"0123456789", bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)), b"abcdefABCDEF", b"+/_.-")
    member, kind = np.zeros((len(rows), 256), bool), np.zeros(256, np.uint8)
    for i, row in enumerate(rows):
        member[i, list(row)] = True
        if i != 3:
            kind[list(row)] = i + 1
    return member, kind


MEMBER, KIND = _byte_classes()
SIZES = (10, 32, 10, 8, 8, 32, 2 * (len(KEYWORDS) + 1), 2, 2, 10, 12, 4, 10)
BASES = np.concatenate([[0], np.cumsum(SIZES)])


@dataclass
class Tokens:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    features: np.ndarray


def _keyword_hashes() -> np.ndarray:
    data, offsets = text_buffer(pa.array(KEYWORDS))
    return scan_words(data, offsets, TOKENS).hash


def _bucket(x: np.ndarray, edges) -> np.ndarray:
    return np.searchsorted(np.array(edges), x, "right")


def featured(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """The tokens of all texts with their feature numbers, one column a feature."""
    words = scan_words(data, offsets, TOKENS)
    n = len(words.hash)
    sums = np.zeros(len(data) + 1, np.int64)

    def held(member: np.ndarray) -> np.ndarray:
        np.cumsum(member[data], out=sums[1:])
        return sums[words.end] - sums[words.start]

    digit, upper, lower, hexes, mark = (held(member) for member in MEMBER)
    del sums
    kind = KIND[data]
    changes = np.zeros(len(data) + 1, np.int32)
    np.cumsum(kind[1:] != kind[:-1], out=changes[2:])
    change = changes[words.end] - changes[np.minimum(words.start + 1, words.end)]
    del changes, kind
    size = words.end - words.start
    other = size - digit - upper - lower - mark
    length = _bucket(size, (4, 8, 12, 16, 20, 32, 40, 64, 128))
    plain = (other == 0) & (digit + hexes == size)
    shape = (digit > 0) + 2 * (upper > 0) + 4 * (lower > 0) + 8 * (mark > 0) + 16 * (other > 0)
    share = _bucket(digit / np.maximum(size, 1), (0.001, 0.15, 0.3, 0.5))
    turns = _bucket(change / np.maximum(size, 1), (0.1, 0.25, 0.45))
    # what stands between a token and the one before: line feed, assignment mark, quote, anything else
    before = np.concatenate([[0], words.end[:-1]]) if n else np.zeros(0, np.int64)
    before = np.where(np.concatenate([[True], words.doc[1:] != words.doc[:-1]]) if n else before > 0, offsets[words.doc] if n else before, before)
    marks = np.zeros(n, np.int64)
    for bit, bytes_ in enumerate((b"\n", b"=", b":", b"\"'", b"@#*$%&|<>")):
        seen = np.zeros(len(data) + 1, np.int32)
        table = np.zeros(256, bool)
        table[list(bytes_)] = True
        np.cumsum(table[data], out=seen[1:])
        marks += (seen[words.start] > seen[before]).astype(np.int64) << bit
    assigned = (marks & 6) != 0
    hashes = _keyword_hashes()
    sorter = np.argsort(hashes)
    slot = np.minimum(np.searchsorted(hashes, words.hash, sorter=sorter), len(hashes) - 1)
    keyword = np.where(hashes[sorter[slot]] == words.hash, sorter[slot] + 1, 0)
    first = np.concatenate([[True], words.doc[1:] != words.doc[:-1]]) if n else np.zeros(0, bool)
    last = np.concatenate([first[1:], [True]]) if n else first
    back = lambda x, none=0: np.where(first, none, np.concatenate([x[:1], x[:-1]])) if n else x
    ahead = lambda x, none=0: np.where(last, none, np.concatenate([x[1:], x[-1:]])) if n else x
    per_doc = np.bincount(words.doc, minlength=len(offsets) - 1) if n else np.zeros(len(offsets) - 1)
    equals = np.bincount(words.doc[(marks & 2) != 0], minlength=len(offsets) - 1) if n else per_doc
    file_size = _bucket(per_doc, [2**i for i in range(2, 13)])
    file_marks = _bucket(equals / np.maximum(per_doc, 1), (0.001, 0.02, 0.1))
    columns = (
        length, shape, share + 5 * (size >= 16), plain + 2 * (digit > 0) + 4 * (size >= 16), turns + 4 * (size >= 12), marks,
        back(keyword) * 2 + assigned, (keyword > 0).astype(int), (back(back(keyword)) > 0).astype(int), back(length),
        file_size[words.doc] if n else length, file_marks[words.doc] if n else length, ahead(length),
    )
    features = np.stack([c + b for c, b in zip(columns, BASES)], axis=1).astype(np.int16)
    return Tokens(words.start, words.end, words.doc, features)


class Field:
    """Weights of a linear-chain field with labels O, B, I; a chain begins as after O."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def scores(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros((len(features), 3), np.float32)
        for column in range(features.shape[1]):
            total += self.weights[features[:, column]]
        return total

    def certain(self, scores: np.ndarray) -> np.ndarray:
        """Tokens that are O on the best path whatever stands beside them."""
        moves = self.moves
        out = np.ones(len(scores), bool)
        for y in (1, 2):
            most = max(moves[p, y] - moves[p, 0] for p in range(3)) + max(0.0, *(moves[y, n] - moves[0, n] for n in range(3)))
            out &= scores[:, 0] - scores[:, y] > most + 1e-3
        return out

    def tags(self, scores: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Best labels of all chains, one chain a document."""
        tag = np.zeros(len(scores), np.int8)
        open_ = np.flatnonzero(~self.certain(scores))
        if not len(open_):
            return tag
        opens = np.concatenate([[True], (np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])])
        start = open_[opens]
        size = np.diff(np.append(np.flatnonzero(opens), len(open_)))
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        # what follows a run is O or the end of the document, where nothing is added
        ends = start + size
        follows = (ends < len(doc)) & (doc[np.minimum(ends, len(doc) - 1)] == doc[start])
        best = scores[start] + self.moves[0]
        came = np.zeros((len(open_), 3), np.int8)
        row = np.concatenate([[0], np.cumsum(size)])[:-1]
        for t in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -t, "left"))
            way = best[:m, :, None] + self.moves[None]
            came[row[:m] + t] = way.argmax(axis=1)
            best[:m] = way.max(axis=1) + scores[start[:m] + t]
        now = (best + np.where(follows[:, None], self.moves[:, 0][None], 0)).argmax(axis=1)
        for t in range(int(size[0]) - 1, -1, -1):
            m = int(np.searchsorted(-size, -t, "left"))
            tag[start[:m] + t] = now[:m]
            now[:m] = came[row[:m] + t, now[:m]]
        return tag


def fit(features: np.ndarray, labels: np.ndarray, sizes: np.ndarray) -> Field:
    """Maximum likelihood over padded chains: features (chain, place, feature), labels (chain, place)."""
    chains, places, width = features.shape
    inside = np.arange(places)[None, :] < sizes[:, None]
    flat = features[inside]
    weights, moves = np.zeros((int(BASES[-1]), 3)), np.zeros((3, 3))
    power_w, power_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    gold = np.zeros((chains, places, 3))
    gold[inside, labels[inside]] = 1
    before = np.concatenate([np.zeros((chains, 1), int), labels[:, :-1]], axis=1)
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (before[inside], labels[inside]), 1)
    for _ in range(ROUNDS):
        score = np.zeros((chains, places, 3))
        score[inside] = sum(weights[flat[:, k]] for k in range(width))
        e, step = np.exp(score - score.max(axis=2, keepdims=True)), np.exp(moves)
        ahead, scale = np.zeros_like(e), np.ones((chains, places))
        now = step[0][None] * e[:, 0]
        for t in range(places):
            if t:
                now = np.where(inside[:, t, None], (now @ step) * e[:, t], now)
            scale[:, t] = now.sum(axis=1)
            now = now / scale[:, t, None]
            ahead[:, t] = now
        back = np.ones((chains, 3))
        seen, moved = np.zeros_like(e), np.zeros((3, 3))
        for t in range(places - 1, -1, -1):
            seen[:, t] = ahead[:, t] * back
            seen[:, t] /= seen[:, t].sum(axis=1, keepdims=True)
            live = inside[:, t, None]
            prior = ahead[:, t - 1] if t else np.tile([1.0, 0, 0], (chains, 1))
            both = prior[:, :, None] * step[None] * (e[:, t] * back)[:, None, :]
            both /= both.sum(axis=(1, 2), keepdims=True)
            moved += (both * live[:, :, None]).sum(axis=0)
            back = np.where(live, (e[:, t] * back) @ step.T, back)
            back /= back.sum(axis=1, keepdims=True)
        error = (gold - seen)[inside]
        slope = np.zeros_like(weights)
        for y in range(3):
            for k in range(width):
                slope[:, y] += np.bincount(flat[:, k], weights=error[:, y], minlength=len(weights))
        slope, slope_m = slope / chains - DECAY * weights, (gold_moves - moved) / chains - DECAY * moves
        power_w += slope**2
        power_m += slope_m**2
        weights += RATE * slope / np.sqrt(power_w)
        moves += RATE * slope_m / np.sqrt(power_m)
    return Field(np.round(weights, 3).astype(np.float32), np.round(moves, 3).astype(np.float32))


def made_up(rng: random.Random, words: list[str]) -> tuple[str, list[tuple[int, int]]]:
    """A window of text and the places of the secrets in it."""
    pick = lambda letters, a, b: "".join(rng.choice(letters) for _ in range(rng.randint(a, b)))
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    shapes = (
        lambda: pick(num + "abcdef", 32, 64), lambda: pick(num + "ABCDEF", 32, 64), lambda: pick(low + up + num, 20, 48),
        lambda: pick(low + up + num + "+/", 32, 64), lambda: "AKIA" + pick(up + num, 16, 16), lambda: "ghp_" + pick(low + up + num, 36, 36),
        lambda: "sk_live_" + pick(low + up + num, 24, 32), lambda: ".".join("eyJ" + pick(low + up + num, 20, 40) for _ in range(3)),
    )
    short = lambda: pick(low + up, 4, 8) + pick(num, 2, 4) + pick(low + up + num, 2, 6)
    alike = (
        lambda: pick(num, 3, 12), lambda: f"20{pick(num, 2, 2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", lambda: pick(low, 18, 40),
        lambda: f"/{pick(low, 3, 9)}/{pick(num, 2, 6)}/index.html", lambda: f"{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}",
        lambda: f"{pick(low, 4, 9)}@{pick(low, 4, 9)}.example.com", lambda: f"{rng.choice(KEYWORDS)} {rng.choice(words)}",
        lambda: f"+{pick(num, 2, 2)}-{pick(num, 3, 3)}-{pick(num, 4, 7)}", lambda: f"{rng.choice(words)}={pick(num, 1, 4)}",
        lambda: f"{rng.choice(words)}: {rng.choice(words)}", lambda: f"http://{pick(low, 5, 9)}.example.org/{pick(low + num, 4, 9)}",
    )
    text, spans = "", []
    for _ in range(rng.randint(6, 20)):
        kind = rng.random()
        if kind < 0.12:
            key = rng.choice(KEYWORDS[:-1])
            key = key.upper() if rng.random() < 0.2 else key
            head, tail = rng.choice(((f"{key}=", ""), (f"{key}: ", ""), (f'{key} = "', '"'), (f"{key}='", "'"), ("Authorization: Bearer ", ""), ("", "")))
            secret = rng.choice(shapes)() if not head or rng.random() < 0.7 else short()
            text += head
            spans.append((len(text), len(text) + len(secret)))
            text += secret + tail
        elif kind < 0.3:
            text += rng.choice(alike)()
        else:
            text += rng.choice(words)
        text += rng.choice((" ", " ", " ", " ", "\n", ". "))
    return text, spans


def training_windows(texts: list[str], count: int = TRAIN_WINDOWS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and sizes of padded chains made from the sample's words."""
    rng = random.Random(seed)
    words = [w for t in texts for w in t.split()[:200] if len(w) < 40 and not re.search(r"[0-9A-F]{6}|[=:]", w)] or ["the", "and", "word", "of"]
    made = [made_up(rng, words) for _ in range(count)]
    data, offsets = text_buffer(pa.array([t for t, _ in made]))
    tokens = featured(data, offsets)
    features = np.zeros((count, WINDOW_TOKENS, tokens.features.shape[1]), np.int16)
    labels, sizes = np.zeros((count, WINDOW_TOKENS), int), np.zeros(count, int)
    at = np.searchsorted(tokens.doc, np.arange(count + 1))
    for i, (text, spans) in enumerate(made):
        inside = np.zeros(len(text.encode()) + 1, np.int64)
        for a, b in spans:
            inside[len(text[:a].encode()) : len(text[:b].encode())] = a + 1
        size = sizes[i] = min(at[i + 1] - at[i], WINDOW_TOKENS)
        features[i, :size] = tokens.features[at[i] : at[i] + size]
        owner = inside[tokens.start[at[i] : at[i] + size] - offsets[i]]
        labels[i, :size] = np.where(owner == 0, 0, np.where(np.concatenate([[True], owner[1:] != owner[:-1]]), 1, 2))
    return features, labels, sizes


def trained(docs: DataFrame) -> Field:
    """The field fitted on windows of the sampled documents: those with the smallest hashes of their ids.

    The hashes alone are ranked first, so only the sample's texts leave their tasks.
    """
    hashed = docs.withColumn("h", F.xxhash64(F.col("doc_id").cast("string")))
    least = hashed.select("h").orderBy("h").limit(TRAIN_DOCS).agg(F.max("h")).first()[0]
    sample = hashed.filter((F.col("h") <= least) & F.col("text").isNotNull())
    rows = sample.select("h", F.substring(F.col("text").cast("string"), 1, 4000).alias("t")).orderBy("h", "t").limit(TRAIN_DOCS)
    texts = [r.t for r in rows.collect()]
    features, labels, sizes = training_windows(texts)
    return fit(features, labels, sizes)


def base_spans(text: str, assign: bool = True, access: bool = True, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if assign else []
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16] if access else []
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32] if hexes else []
    return sorted(out)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, "text", CHUNK):
            column = pc.fill_null(batch.column(1), "")
            data, offsets = text_buffer(column)
            tokens = featured(data, offsets)
            tag = field.tags(field.scores(tokens.features), tokens.doc)
            opens = np.flatnonzero((tag == 1) | ((tag == 2) & (np.concatenate([[0], tag[:-1]]) == 0)))
            may = [
                pc.match_substring_regex(column, "(?i)password|passwd|secret|token|api_?key").to_numpy(zero_copy_only=False),
                pc.match_substring(column, "AKIA").to_numpy(zero_copy_only=False),
                pc.match_substring_regex(column, "[0-9a-f]{32}").to_numpy(zero_copy_only=False),
            ]
            found: dict[int, list[tuple[int, int, int]]] = {}
            for i in np.flatnonzero(may[0] | may[1] | may[2]).tolist():
                found[i] = base_spans(column[i].as_py(), *(bool(m[i]) for m in may))
            base = [found.get(i, []) for i in range(batch.num_rows)]
            spans = [list(b) for b in base]
            points: dict[int, np.ndarray] = {}
            for t in opens.tolist():
                doc, to = int(tokens.doc[t]), t
                while to + 1 < len(tag) and tag[to + 1] == 2 and tokens.doc[to + 1] == doc:
                    to += 1
                if doc not in points:
                    points = {doc: np.concatenate([[0], np.cumsum((data[offsets[doc] : offsets[doc + 1]] & 0xC0) != 0x80)])}
                a, b = (int(points[doc][x - offsets[doc]]) for x in (tokens.start[t], tokens.end[to]))
                if not any(x < b and a < y for x, _, y in base[doc]):
                    spans[doc].append((a, 3, b))
            count = lambda kind: pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64())  # noqa: B023, E731
            digest = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), count(0), count(1), count(2), pa.array(digest), pa.array([_joined(sorted(s)) for s in spans])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def secrets_of(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(_scan(field or trained(rows)), schema)
