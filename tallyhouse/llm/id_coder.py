"""Adaptive range coder for token ids below 65,536, in independent checksummed blocks.

A segment (the blocks coded side by side) opens with a prior: frequencies of the ids, and of
those pairs of neighbours that save more than they take to store. Within a block every id is
predicted by its order-2 and order-1 contexts (the id that last followed the previous two, or
the previous one). Three adaptive experts (confidence of the order-2 prediction and whether
both agree, confidence of the order-1 prediction, recent outcomes) estimate whether the id is
the order-2 prediction, the order-1 prediction or neither; their estimates are mixed with
weights that follow how well each has predicted. An id that neither context predicts is coded
by the prior's frequencies after the previous id or, where it is not among them, by order 0:
adaptive frequencies of its high byte, which start at the prior's, then the prior's frequencies
of low bytes given the high one. Frequencies drive a range coder with 48-bit state and carry.

All models start anew from the prior in every block, so a block decodes with its segment's
header alone. Blocks of a segment are coded side by side, one array lane each; only elementwise
arithmetic is used, so that encoder and decoder agree bit by bit on any machine.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
#: Blocks coded side by side: many, as each step costs the same few hundred array operations.
LANES = 2048
SLOTS = 512
MAGIC = b"IDC2"
STEP = 8
#: Steps after which the order-0 sums are taken anew: ever farther apart.
REFRESH = frozenset({16, 48, 128, 256, 512, 768, 1024, 1536})
#: Total that a block's high-byte frequencies start with.
HIGH_TOTAL = 4096
#: Bits that a stored pair of neighbours takes.
PAIR_BITS = 18
TOP, MASK32, MASK48 = 1 << 32, (1 << 32) - 1, (1 << 48) - 1


class _Encoder:
    """State of 48 bits in 64-bit integers: lows, ranges, and 16-bit words written so far."""

    def __init__(self, lanes: int, block: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, MASK48, np.int64)
        self.width = block * 3 + 8
        self.words = np.zeros(lanes * self.width, np.int32)
        self.at = np.arange(lanes) * self.width + 1

    def code(self, lanes, start, size, total) -> None:
        unit = self.range.take(lanes, mode="clip") // total
        low = self.low.take(lanes, mode="clip") + start * unit
        span = unit * size
        if (over := low > MASK48).any():
            over = np.flatnonzero(over)
            self.words[self.at[lanes[over]] - 1] += 1
            low &= MASK48
        small = np.flatnonzero(span < TOP)
        if len(small):
            part = low.take(small)
            mine = lanes.take(small)
            at = self.at.take(mine)
            self.words[at] = part >> 32
            low[small] = (part & MASK32) << 16
            span[small] <<= 16
            self.at[mine] = at + 1
        self.low[lanes], self.range[lanes] = low, span

    def finish(self) -> list[bytes]:
        """The words of each lane; the first one holds a last carry and is dropped."""
        for _ in range(3):
            self.words[self.at] = self.low >> 32
            self.low = (self.low & MASK32) << 16
            self.at += 1
        table = self.words.reshape(-1, self.width)
        ends = self.at - np.arange(len(self.at)) * self.width
        for i in range(int(ends.max(initial=1)) - 1, 0, -1):
            carry = table[:, i] >> 16
            if carry.any():
                table[:, i - 1] += carry
                table[:, i] &= 0xFFFF
        return [table[k, 1:e].astype(">u2").tobytes() for k, e in enumerate(ends)]


class _Decoder:
    def __init__(self, blocks: list[bytes]):
        sizes = np.array([len(b) // 2 for b in blocks], np.int64)
        self.words = np.zeros(int(sizes.sum()) + 4, np.int64)
        self.words[: int(sizes.sum())] = np.frombuffer(b"".join(blocks), ">u2")
        self.at = np.cumsum(sizes) - sizes
        self.range = np.full(len(blocks), MASK48, np.int64)
        self.value = np.zeros(len(blocks), np.int64)
        for _ in range(3):
            self.value = (self.value << 16) | self.words[self.at]
            self.at += 1

    def target(self, lanes, total):
        self.unit = self.range.take(lanes, mode="clip") // total
        self.held = self.value.take(lanes, mode="clip")
        return np.minimum(self.held // self.unit, total - 1)

    def code(self, lanes, start, size) -> None:
        """Right after target() of the same lanes."""
        value = self.held - start * self.unit
        span = self.unit * size
        small = np.flatnonzero(span < TOP)
        if len(small):
            mine = lanes.take(small)
            at = self.at.take(mine)
            value[small] = (value.take(small) << 16) | self.words.take(at, mode="clip")
            span[small] <<= 16
            self.at[mine] = at + 1
        self.value[lanes], self.range[lanes] = value, span


def _rounded(counts: np.ndarray) -> np.ndarray:
    """Codes of one byte for counts below 2^30: four leading bits and an exponent, rounded down."""
    shift = np.maximum(np.frexp(counts.astype(np.float64))[1] - 4, 0)
    return np.where(shift > 0, (shift << 3) + (counts >> shift), counts).astype(np.uint8)


def _counts(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.int64)
    shift = np.maximum((codes >> 3) - 1, 0)
    return np.where(shift > 0, (codes - (shift << 3)) << shift, codes)


class _Prior:
    """What all blocks of a segment start from: frequencies of ids, and of followers of an id."""

    def __init__(self, size: int, zeroth: np.ndarray, escapes: np.ndarray, followers: np.ndarray, keys: np.ndarray, pairs: np.ndarray):
        """Coded frequencies of ids and of unlisted followers, how many pairs each id starts, the pairs and theirs."""
        self.parts = size, zeroth, escapes, followers, keys, pairs
        order0 = np.zeros(1 << 16, np.int64)
        order0[:size] = _counts(zeroth)
        table = order0.reshape(256, 256)
        self.low = np.zeros((256, 257), np.int64)
        np.cumsum(table, axis=1, out=self.low[:, 1:])
        self.low = self.low.reshape(-1)
        high = table.sum(axis=1)
        self.high = np.where(high > 0, 1 + high * HIGH_TOTAL // max(int(high.sum()), 1), 0)
        self.high[0] = max(int(self.high[0]), 1)
        self.keys = keys
        self.escapes = np.zeros(1 << 16, np.int64)
        self.escapes[:size] = _counts(escapes)
        self.sums = np.concatenate([[0], np.cumsum(_counts(pairs))])
        ends = np.zeros((1 << 16) + 1, np.int64)
        ends[1 : size + 1] = np.cumsum(followers)
        ends[size + 1 :] = len(keys)
        self.base = self.sums[ends[:-1]]
        self.listed = self.sums[ends[1:]] - self.base

    @classmethod
    def of(cls, table: np.ndarray, lengths: np.ndarray) -> _Prior:
        size = int(table.max(initial=0)) + 1
        keys = table.astype(np.uint32)
        keys[:, 1:] |= table[:, :-1].astype(np.uint32) << 16
        keys, counts = np.unique(keys[np.arange(table.shape[1]) < lengths[:, None]], return_counts=True)
        last, ids = (keys >> 16).astype(np.int64), (keys & 0xFFFF).astype(np.int64)
        before = np.bincount(last, counts, size).astype(np.int64)
        after = np.bincount(ids, counts, size).astype(np.int64)
        saved = counts * np.log2(counts / before[last] * (max(int(counts.sum()), 1) / after[ids]))
        kept = saved > PAIR_BITS
        rest = ~kept
        zeroth = np.bincount(ids[rest], counts[rest], size).astype(np.int64)
        escapes = np.bincount(last[rest], counts[rest], size).astype(np.int64)
        return cls(size, _rounded(zeroth), _rounded(escapes), np.bincount(last[kept], minlength=size), keys[kept], _rounded(counts[kept]))

    def to_bytes(self) -> bytes:
        size, zeroth, escapes, followers, keys, pairs = self.parts
        ids = (keys & 0xFFFF).astype("<u2")
        steps = np.diff(ids, prepend=ids[:1])
        # low and high bytes of the steps apart, as they compress better
        body = b"".join(part.tobytes() for part in (zeroth, escapes, followers.astype("<u4"), steps.view(np.uint8).reshape(-1, 2).T, ids[:1], pairs))
        return struct.pack("<II", size, len(keys)) + zlib.compress(body, 6)

    @classmethod
    def from_bytes(cls, data: bytes) -> _Prior:
        size, n = struct.unpack("<II", data[:8])
        body = zlib.decompress(data[8:])
        zeroth, escapes = (np.frombuffer(body, np.uint8, size, k * size) for k in range(2))
        followers = np.frombuffer(body, "<u4", size, 2 * size).astype(np.int64)
        steps = np.ascontiguousarray(np.frombuffer(body, np.uint8, 2 * n, 6 * size).reshape(2, n).T).view("<u2").reshape(-1)
        first = np.frombuffer(body, "<u2", min(n, 1), 6 * size + 2 * n)
        ids = (np.cumsum(steps, dtype=np.uint16) + first.sum(dtype=np.uint16)).astype(np.uint32)
        pairs = np.frombuffer(body, np.uint8, n, 6 * size + 2 * n + 2 * len(first))
        return cls(size, zeroth, escapes, followers, np.repeat(np.arange(size, dtype=np.uint32) << 16, followers) | ids, pairs)

    def encode(self, coder: _Encoder, lanes, last, ids):
        """Codes listed followers and escapes; returns which of the lanes escaped."""
        key = last.astype(np.uint32) << 16 | ids.astype(np.uint32)
        at = np.searchsorted(self.keys, key)
        found = self.keys.take(at, mode="clip") == key if len(self.keys) else np.zeros(len(key), bool)
        open_ = np.flatnonzero(self.listed[last])
        if len(open_):
            context, at, hit = last[open_], at[open_], found[open_]
            escape = self.escapes[context]
            start = np.where(hit, escape + self.sums.take(at, mode="clip") - self.base[context], 0)
            size = np.where(hit, self.sums.take(at + 1, mode="clip") - self.sums.take(at, mode="clip"), escape)
            coder.code(lanes[open_], start, size, escape + self.listed[context])
        return np.flatnonzero(~found)

    def decode(self, coder: _Decoder, lanes, last, ids):
        """Sets the ids of listed followers; returns which of the lanes escaped."""
        left = np.ones(len(lanes), bool)
        open_ = np.flatnonzero(self.listed[last])
        if len(open_):
            context, mine = last[open_], lanes[open_]
            escape = self.escapes[context]
            target = coder.target(mine, escape + self.listed[context])
            hit = target >= escape
            place = target - escape + self.base[context]
            at = np.where(hit, np.searchsorted(self.sums, place, "right") - 1, 0)
            start = np.where(hit, escape + self.sums[at] - self.base[context], 0)
            coder.code(mine, start, np.where(hit, self.sums[at + 1] - self.sums[at], escape))
            ids[mine[hit]] = self.keys[at[hit]] & 0xFFFF
            left[open_[hit]] = False
        return np.flatnonzero(left)


def _byte_at(sums: np.ndarray, row, target):
    """The byte whose range holds the target, in rows of 257 sums."""
    base = row * 257
    place = base.copy()
    for step in (128, 64, 32, 16, 8, 4, 2, 1):
        place += step
        place -= step * (sums.take(place, mode="clip") > target)
    return place - base


def _range_of(sums: np.ndarray, row, byte):
    place = row * 257
    total = sums.take(place + 256, mode="clip")
    place += byte
    start = sums.take(place, mode="clip")
    return start, sums.take(place + 1, mode="clip") - start, total


class _Frequencies:
    """Adaptive byte frequencies of each lane, with sums that are refreshed now and then."""

    def __init__(self, first: np.ndarray, lanes: int):
        self.counts = np.tile(first.astype(np.int32), lanes)
        self.sums = np.zeros(lanes * 257, np.int32)
        self.refresh()

    def refresh(self) -> None:
        np.cumsum(self.counts.reshape(-1, 256), axis=1, out=self.sums.reshape(-1, 257)[:, 1:])

    def add(self, lane, byte) -> None:
        self.counts[lane * 256 + byte] += STEP


class _Model:
    def __init__(self, lanes: int, prior: _Prior):
        self.lanes = np.arange(lanes)
        self.one = np.full(lanes * SLOTS, -8, np.int32)
        self.two = np.full(lanes * SLOTS, -8, np.int32)
        # for each expert, how often each of the three outcomes followed each of its contexts
        self.outcomes = [[np.full(lanes * n, 0.4) for _ in range(3)] for n in (16, 8, 9)]
        self.weights = [np.full(lanes, 1 / 3) for _ in range(3)]
        self.last, self.before, self.recent = (np.zeros(lanes, np.int64) for _ in range(3))
        self.high = _Frequencies(prior.high, lanes)

    def predict(self, m: int):
        """Slots, both predictions and the frequencies of the three outcomes for the first m lanes."""
        last, before, lanes = self.last[:m], self.before[:m], self.lanes[:m]
        home = lanes * SLOTS
        self.slot1 = home + ((last * 40503 >> 4) & (SLOTS - 1))
        self.slot2 = home + (((last * 51749 + before * 38183) >> 5) & (SLOTS - 1))
        one, two = self.one.take(self.slot1, mode="clip"), self.two.take(self.slot2, mode="clip")
        self.id1, self.id2, self.sure1, self.sure2 = one >> 3, two >> 3, one & 7, two & 7
        self.contexts = (lanes * 16 + self.sure2 * 2 + (self.id1 == self.id2), lanes * 8 + self.sure1, lanes * 9 + self.recent[:m])
        self.estimates = []
        for table, context in zip(self.outcomes, self.contexts):
            a, b, c = (side.take(context, mode="clip") for side in table)
            whole = a + b + c
            self.estimates.append((a / whole, b / whole, c / whole))
        (w0, w1, w2), (x, y, z) = (w[:m] for w in self.weights), self.estimates
        return [((x[k] * w0 + y[k] * w1 + z[k] * w2) * 16000).astype(np.int64) + 1 for k in range(3)]

    def update(self, m: int, ids, outcome) -> None:
        is0, is1 = outcome == 0, outcome == 1
        weights = [w[:m] for w in self.weights]
        for weight, table, context, (a, b, c) in zip(weights, self.outcomes, self.contexts, self.estimates):
            for side, hit in zip(table, (is0, is1, ~(is0 | is1))):
                side[context[hit]] += 1
            weight *= np.where(is0, a, np.where(is1, b, c))
        whole = 0.94 / (weights[0] + weights[1] + weights[2])
        for weight in weights:
            weight *= whole
            weight += 0.02
        for table, slot, guess, sure in ((self.one, self.slot1, self.id1, self.sure1), (self.two, self.slot2, self.id2, self.sure2)):
            hit = guess == ids
            kept = hit | (sure > 2)
            table[slot] = np.where(kept, guess, ids) * 8 + np.where(hit, np.minimum(sure + 1, 7), np.where(kept, sure >> 1, 1))
        self.before[:m] = self.last[:m]
        self.last[:m] = ids
        self.recent[:m] = self.recent[:m] % 3 * 3 + outcome

    def refresh(self, step: int) -> None:
        if step in REFRESH:
            self.high.refresh()


def encode_blocks(table: np.ndarray, lengths: np.ndarray, prior: _Prior) -> list[bytes]:
    """Payloads of the rows of `table`; lengths do not grow from row to row."""
    model, coder = _Model(len(lengths), prior), _Encoder(len(lengths), table.shape[1])
    for step in range(int(lengths[0]) if len(lengths) else 0):
        model.refresh(step)
        m = int(np.searchsorted(-lengths, -step, "left"))
        lanes, ids = model.lanes[:m], table[:m, step].astype(np.int64)
        chances = model.predict(m)
        outcome = np.where(ids == model.id2, 0, np.where(ids == model.id1, 1, 2))
        first, second = chances[0], chances[0] + chances[1]
        start = np.where(outcome == 0, 0, np.where(outcome == 1, first, second))
        size = np.where(outcome == 0, first, np.where(outcome == 1, chances[1], chances[2]))
        coder.code(lanes, start, size, second + chances[2])
        rest = np.flatnonzero(outcome == 2)
        if len(rest):
            rest = rest[prior.encode(coder, rest, model.last[rest], ids[rest])]
        if len(rest):
            high = ids[rest] >> 8
            coder.code(rest, *_range_of(model.high.sums, rest, high))
            coder.code(rest, *_range_of(prior.low, high, ids[rest] & 255))
            model.high.add(rest, high)
        model.update(m, ids, outcome)
    return coder.finish()


def decode_blocks(blocks: list[bytes], lengths: np.ndarray, prior: _Prior) -> np.ndarray:
    """The table of ids, zero beyond each row's length."""
    table = np.zeros((len(lengths), int(lengths[0]) if len(lengths) else 0), np.uint16)
    model, coder = _Model(len(lengths), prior), _Decoder(blocks)
    for step in range(table.shape[1]):
        model.refresh(step)
        m = int(np.searchsorted(-lengths, -step, "left"))
        lanes, chances = model.lanes[:m], model.predict(m)
        first, second = chances[0], chances[0] + chances[1]
        target = coder.target(lanes, second + chances[2])
        outcome = (target >= first).astype(np.int64) + (target >= second)
        start = np.where(outcome == 0, 0, np.where(outcome == 1, first, second))
        coder.code(lanes, start, np.where(outcome == 0, first, np.where(outcome == 1, chances[1], chances[2])))
        ids = np.where(outcome == 0, model.id2, model.id1).astype(np.int64)
        rest = np.flatnonzero(outcome == 2)
        if len(rest):
            rest = rest[prior.decode(coder, rest, model.last[rest], ids)]
        if len(rest):
            high = _byte_at(model.high.sums, rest, coder.target(rest, model.high.sums.take(rest * 257 + 256)))
            coder.code(rest, *_range_of(model.high.sums, rest, high)[:2])
            low = _byte_at(prior.low, high, coder.target(rest, prior.low.take(high * 257 + 256)))
            coder.code(rest, *_range_of(prior.low, high, low)[:2])
            model.high.add(rest, high)
            ids[rest] = high << 8 | low
        model.update(m, ids, outcome)
        table[:m, step] = ids
    return table


def pack(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment: header, one entry (ids, bytes, crc32 of the ids as 32-bit integers) a block, prior, payloads."""
    if len(ids) and int(ids.max()) >> 16:
        raise ValueError("ids must be below 65536")
    count = -(-len(ids) // block)
    lengths = np.full(count, block)
    if count:
        lengths[-1] = len(ids) - block * (count - 1)
    table = np.zeros((count, block), np.uint16)
    table.reshape(-1)[: len(ids)] = ids
    prior = _Prior.of(table, lengths)
    payloads = encode_blocks(table, lengths, prior)
    entries = b"".join(
        struct.pack("<III", int(n), len(p), zlib.crc32(table[k, :n].astype("<u4").tobytes())) for k, (n, p) in enumerate(zip(lengths, payloads))
    )
    shared, body = prior.to_bytes(), b"".join(payloads)
    return MAGIC + struct.pack("<IIQI", count, len(shared), len(body), zlib.crc32(entries + shared)) + entries + shared + body


def read_segment(stream) -> np.ndarray | None:
    """The ids of the next segment, checked block by block; None at the end."""
    head = stream.read(24)
    if not head:
        return None
    count, n_shared, size, check = struct.unpack("<IIQI", head[4:])
    if head[:4] != MAGIC:
        raise ValueError("not a token segment")
    entries, shared = stream.read(12 * count), stream.read(n_shared)
    if zlib.crc32(entries + shared) != check:
        raise ValueError("damaged block table or prior")
    body = stream.read(size)
    told = np.frombuffer(entries, "<u4").reshape(-1, 3)
    ends = np.cumsum(told[:, 1].astype(np.int64))
    blocks = [body[e - n : e] for e, n in zip(ends, told[:, 1])]
    table = decode_blocks(blocks, told[:, 0].astype(np.int64), _Prior.from_bytes(shared))
    for k, (n, _, crc) in enumerate(told.tolist()):
        if zlib.crc32(table[k, :n].astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
    return np.concatenate([table[k, :n] for k, n in enumerate(told[:, 0])]) if count else np.zeros(0, np.uint16)
