"""Ids of a word BPE (white space dropped, case folded, words coded alone), word by word.

The pre-tokenizer splits a text into runs of letters, single digits, runs of other signs and a few
apostrophe endings, and every such part is coded alone. So a text may be cut, without any change of its
ids, at white space, behind a run of (ASCII or Latin-1) letters before another ASCII sign, behind an ASCII
digit, and between an ASCII sign other than the apostrophe and a letter or digit. Cuts within a special
token are left out. Equal pieces, A-Z folded, are encoded once a task by the tokenizers library; many
short ones of a plain kind are one call, told apart by the word-end mark of their last ids.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import pandas as pd

from tallyhouse.llm.textscan import PIECE, _powers, mix

#: Fixed value: the pre-tokenizer's pattern for which the cuts hold.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Distinct pieces a task remembers (16 MB or so) before it starts anew.
MEMORY = 1_000_000
JOINED = 512

_ALPHA, _DIGIT, _SIGN, _WHITE = 1, 2, 4, 8
_CLASS = np.zeros(256, np.uint8)
for _b in range(0x21, 0x7F):
    _CLASS[_b] = _ALPHA if chr(_b).isalpha() else _DIGIT if chr(_b).isdigit() else _SIGN
_CLASS[[0x20, 0x09, 0x0A, 0x0D]] = _WHITE
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
#: Pieces that are one part for the pre-tokenizer.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def word_pieces(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces, white space between them left out, and the folded bytes."""
    n = len(data)
    folded = _FOLD[data]
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), folded
    kind = _CLASS[data]
    lead = np.zeros(n, bool)
    lead[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter = kind == _ALPHA
    opens = letter | lead
    letter |= lead
    letter[1:] |= lead[:-1]
    white = kind == _WHITE
    digit, sign = kind == _DIGIT, kind == _SIGN
    cut = np.zeros(n, bool)
    right = digit | sign
    cut[1:] = white[:-1] | (letter[:-1] & right[1:]) | (digit[:-1] & (right | opens)[1:])
    cut[1:] |= sign[:-1] & (data[:-1] != 0x27) & (opens | digit)[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    cut[edges] = True
    raw = data.tobytes() if special else b""
    for token in special:
        at = raw.find(token)
        while at >= 0:
            if not np.searchsorted(edges, at + len(token), "left") - np.searchsorted(edges, at, "right"):
                cut[at + 1 : at + len(token)] = False
                cut[at] = True
                if at + len(token) < n:
                    cut[at + len(token)] = True
                # no byte of a text: what is folded to the same letters stays another piece
                folded[at] = 0xFF
            at = raw.find(token, at + 1)
    starts = np.flatnonzero(cut & ~white)
    stop = cut | white
    stops = np.append(np.flatnonzero(stop), n)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return starts, ends, folded


class WordIds:
    """Encodes texts and remembers pieces: sorted keys, and where their ids lie."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        told = json.loads(tokenizer)
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.by_word = told["model"].get("end_of_word_suffix") == WORD_END and PATTERN in json.dumps(told["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\")
        self.special = [t["content"].encode() for t in told["added_tokens"]]
        vocab = told["model"]["vocab"]
        self.closes = np.zeros(max(max(vocab.values()), *(t["id"] for t in told["added_tokens"]), 0) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the number of ids of each text."""
        if not self.by_word:
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(offsets.tolist())]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            counts = np.fromiter(map(len, got), np.int64, len(got))
            return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(counts.sum())), counts
        starts, ends, folded = word_pieces(data, offsets, self.special)
        ids, sizes, at = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        while at < len(starts):
            to = max(int(np.searchsorted(ends, starts[at] + PIECE, "right")), at + 1)
            part, size = self._window(data, folded, starts[at:to], ends[at:to])
            ids.append(part)
            sizes.append(size)
            at = to
        doc = np.searchsorted(offsets, starts, "right") - 1
        counts = np.bincount(doc, weights=np.concatenate(sizes), minlength=len(offsets) - 1).astype(np.int64)
        return np.concatenate(ids), counts

    def _window(self, data, folded, starts, ends):
        a, b = int(starts[0]), int(ends[-1])
        power, inverse = _powers(b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((folded[a:b] + np.uint64(1)) * power[: b - a], out=sums[1:])
        s, e = starts - a, ends - a
        codes, distinct = pd.factorize(mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)))
        if len(self.keys) > MEMORY:
            self.forget()
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            raw = data[a:b].tobytes()
            texts = [raw[x:y].decode("utf-8", "replace") for x, y in zip(s[first[new]].tolist(), e[first[new]].tolist())]
            self._learn(distinct[new], texts)
            place = np.searchsorted(self.keys, distinct)
        each = self.size[place][codes]
        begins = self.at[place][codes]
        total = np.cumsum(each, dtype=np.int64)
        pick = np.repeat(begins - (total - each), each) + np.arange(int(total[-1]))
        return self.flat[pick], each

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        plain = np.fromiter((_PLAIN.fullmatch(t) is not None for t in texts), bool, len(texts))
        sizes = np.zeros(len(texts), np.int32)
        simple, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        joined = [" ".join(texts[i] for i in simple[k : k + JOINED].tolist()) for k in range(0, len(simple), JOINED)]
        got = [e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(itertools.chain.from_iterable(got), np.uint32)
        ends = np.flatnonzero(self.closes[ids])
        if len(ends) == len(simple) and (not len(ids) or ends[-1] == len(ids) - 1):
            sizes[simple] = np.diff(ends, prepend=-1)
        else:  # a word without its end mark: each alone
            simple, rest, ids = simple[:0], np.arange(len(texts)), ids[:0]
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in rest.tolist()], add_special_tokens=False)]
        sizes[rest] = np.fromiter(map(len, alone), np.int32, len(alone))
        order = np.concatenate([simple, rest])
        at = np.empty(len(texts), np.int64)
        at[order] = len(self.flat) + np.cumsum(sizes[order]) - sizes[order]
        self.flat = np.concatenate([self.flat, ids, np.fromiter(itertools.chain.from_iterable(alone), np.uint32)])
        rank = np.argsort(keys, kind="stable")
        into = np.searchsorted(self.keys, keys[rank])
        self.keys = np.insert(self.keys, into, keys[rank])
        self.at = np.insert(self.at, into, at[rank])
        self.size = np.insert(self.size, into, sizes[rank])
