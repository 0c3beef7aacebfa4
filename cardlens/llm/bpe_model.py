"""Byte-level BPE tables shared by the encoder and the token counter.

A word's BPE result is the only token sequence whose adjacent pairs are all
*compatible*: encoding the two tokens' joined bytes gives the two tokens
back. Merges run in rank order, so the last token left of a boundary is, at
"time" r, the youngest token on the left token's right spine whose rank is
below r (likewise on the other side). A pair is incompatible exactly when some
merge across the boundary has its rank inside the life of both spine tokens.
"""

from __future__ import annotations

import heapq
import json
from functools import cached_property

import numpy as np

NEVER = np.int64(2**31 - 2)  # limit of a token that is never consumed
NO_MERGE = np.int64(2**31 - 1)

# White space as the library's pre-tokenizer pattern sees it (Unicode White_Space).
SPACE_CLASS = (
    r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)

# fixed value: the byte-level pre-tokenizer pattern, white space spelled out
# because Java's \s is ASCII only
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE_CLASS}\p{{L}}\p{{N}}]+|[{SPACE_CLASS}]+(?![^{SPACE_CLASS}])|[{SPACE_CLASS}]+"
)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others follow from U+0100 on in byte order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """The parts of a ``tokenizer.json`` that the operators need (driver side;
    its size is bounded by the vocabulary, so it may be broadcast)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    pre = spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        raise ValueError(f"{path}: not a byte-level BPE tokenizer without prefix space")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = [(t["content"], t["id"]) for t in spec.get("added_tokens", [])]
    return {"vocab": model["vocab"], "merges": merges, "special": special}


class BpeModel:
    """Lookup tables built once per Python worker from :func:`read_vocabulary`."""

    def __init__(self, spec: dict):
        alphabet = byte_alphabet()
        raw = {tok: bytes(alphabet[c] for c in tok) for tok in spec["vocab"]}
        self.id_of = {raw[tok]: i for tok, i in spec["vocab"].items()}
        self.special = dict(spec["special"])
        size = max([*spec["vocab"].values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for b, i in self.id_of.items():
            self.bytes_of[i] = b
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.rank = np.full(size, -1, np.int64)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.merge = {}
        for r, (a, b) in enumerate(spec["merges"]):
            ia, ib = spec["vocab"][a], spec["vocab"][b]
            out = spec["vocab"][a + b]
            if self.rank[out] >= 0 or max(self.rank[ia], self.rank[ib]) >= r:
                raise ValueError("pair checks need one merge per token, parts first")
            self.rank[out], self.left[out], self.right[out] = r, ia, ib
            self.merge[ia << 32 | ib] = (r, out)
        self.rank_of_pair = {k: r for k, (r, _) in self.merge.items()}
        self.made_by_rank = [out for _, out in self.merge.values()]
        keys = np.fromiter(self.merge, np.int64, len(self.merge))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter((v[0] for v in self.merge.values()), np.int64)[order]
        self.made = np.asarray(self.made_by_rank, np.int64)
        self.byte_id = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        self.size_of = np.asarray([len(b) for b in self.bytes_of])
        self.inner, self.child, self.token_at = self._trie(backward=False)
        self.longest = max(map(len, self.id_of))
        # plain lists: quicker than arrays one value at a time
        self._rank, self._left, self._right = (
            a.tolist() for a in (self.rank, self.left, self.right)
        )

    # -- speculation -------------------------------------------------------
    def _trie(self, backward: bool):
        """Trie of the vocabulary, or of its reversed tokens: ``child[inner[node],
        byte]`` is the next node (-1: none), ``token[node]`` the token that ends
        there; only nodes with children have a row of ``child``."""
        node_of, parent, last = {b"": 0}, [-1], [0]
        ends = {tok[::-1] if backward else tok: i for tok, i in self.id_of.items()}
        for tok in ends:
            at = len(tok)
            while tok[:at] not in node_of:
                at -= 1
            for k in range(at + 1, len(tok) + 1):
                parent.append(node_of[tok[: k - 1]])
                last.append(tok[k - 1])
                node_of[tok[:k]] = len(parent) - 1
        up, byte = np.asarray(parent[1:]), np.asarray(last[1:])
        inner = np.full(len(parent), -1, np.int64)
        rows = np.unique(up)
        inner[rows] = np.arange(len(rows))
        child = np.full((len(rows), 256), -1, np.int32)
        child[inner[up], byte] = np.arange(1, len(parent))
        token = np.full(len(parent), -1, np.int64)
        for tok, i in ends.items():
            token[node_of[tok]] = i
        return inner, child, token

    def greedy(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Longest vocabulary match from the left, again and again, for all
        words ``data[start:end]`` in step: (word index, token) of each match,
        in order within a word."""
        word = np.flatnonzero(end > start)
        at, stop = start[word].astype(np.int64), end[word].astype(np.int64)
        node, best, best_at = np.zeros_like(at), np.full(len(at), -1), at.copy()
        owners, tokens = [], []
        while len(word):
            row = self.inner[node]
            more = (at < stop) & (row >= 0)
            step = np.where(more, self.child[row, data[np.minimum(at, len(data) - 1)]], -1)
            on = step >= 0
            node, at = np.where(on, step, 0), at + on
            tok = np.where(on, self.token_at[node], -1)
            hit = tok >= 0
            best, best_at = np.where(hit, tok, best), np.where(hit, at, best_at)
            off = ~on
            owners.append(word[off])
            tokens.append(best[off])
            at = np.where(off, best_at, at)
            go = on | (at < stop)
            if not go.all():
                word, at, stop, node = word[go], at[go], stop[go], node[go]
                best, best_at = best[go], best_at[go]
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return owner[order], token[order]

    # -- verification ------------------------------------------------------
    @cached_property
    def suffixes(self):
        """Backward trie, and for each token the longest other token that it
        ends in."""
        shorter = np.full(len(self.bytes_of), -1, np.int64)
        for tok, i in self.id_of.items():
            for k in range(1, len(tok)):
                if (j := self.id_of.get(tok[k:])) is not None:
                    shorter[i] = j
                    break
        return *self._trie(backward=True), shorter

    def longest_suffixes(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each place in ``data``, the longest token that ends there and
        starts no earlier than ``first`` of that place."""
        inner, child, token, _ = self.suffixes
        at = np.arange(len(data))
        cur, node, best = at.copy(), np.zeros(len(data), np.int64), np.full(len(data), -1)
        while len(at):
            row = inner[node]
            step = np.where(row >= 0, child[row, data[cur]], -1)
            on = step >= 0
            at, cur, node = at[on], cur[on], step[on].astype(np.int64)
            tok = token[node]
            hit = tok >= 0
            best[at[hit]] = tok[hit]
            go = cur > first[at]
            at, cur, node = at[go], cur[go] - 1, node[go]
        return best

    def pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair (NO_MERGE: there is none)."""
        key = x << 32 | y
        pos = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[pos] == key, self.pair_ranks[pos], NO_MERGE)

    def pairs_compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each adjacent token pair: does it survive BPE unchanged?"""
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        lim_x, lim_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(at):
            m = self.pair_rank(x, y)
            bad = (m < lim_x) & (m <= lim_y)
            ok[at[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            at, x, y, lim_x, lim_y = at[go], x[go], y[go], lim_x[go], lim_y[go]
            rx, ry = rx[go], ry[go]
            split_x = rx >= ry
            lim_x, lim_y = np.where(split_x, rx, lim_x), np.where(split_x, lim_y, ry)
            x, y = np.where(split_x, self.right[x], x), np.where(split_x, y, self.left[y])
        return ok

    def pair_compatible(self, x: int, y: int) -> bool:
        """:meth:`pairs_compatible` for one pair."""
        merge, rank = self.merge, self._rank
        lim_x = lim_y = int(NEVER)
        while True:
            hit = merge.get(x << 32 | y)
            if hit is not None and hit[0] < lim_x and hit[0] <= lim_y:
                return False
            rx, ry = rank[x], rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx >= ry:
                lim_x, x = rx, self._right[x]
            else:
                lim_y, y = ry, self._left[y]

    # -- exact merging -----------------------------------------------------
    def exact_short(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Merge many short words in step, one merge a word and round, by rank
        and leftmost first: (word index, token) in order within a word."""
        size = end - start
        cols = np.arange(int(size.max(initial=1)))
        inside = cols < size[:, None]
        at = np.minimum(start[:, None] + cols, len(data) - 1)
        toks = np.where(inside, self.byte_id[data[at]], -1)
        ranks = np.full((len(size), len(cols)), NO_MERGE)
        pair = inside[:, 1:]
        ranks[:, :-1][pair] = self.pair_rank(toks[:, :-1][pair], toks[:, 1:][pair])
        word, owners, tokens = np.arange(len(size)), [], []
        while len(word):
            i = ranks.argmin(axis=1)
            rows = np.arange(len(word))
            r = ranks[rows, i]
            done = r == NO_MERGE
            if done.any():
                left = toks[done]
                owners.append(np.repeat(word[done], (left >= 0).sum(axis=1)))
                tokens.append(left[left >= 0])
                word, toks, ranks, i, r = (v[~done] for v in (word, toks, ranks, i, r))
                rows = rows[: len(word)]
                if not len(word):
                    break
            toks[rows, i] = self.made[r]
            later = cols + (cols > i[:, None])  # close the gap behind i
            padded = np.concatenate([toks, np.full((len(word), 1), -1)], axis=1)
            toks = np.take_along_axis(padded, later, axis=1)
            later = cols + (cols >= i[:, None])
            padded = np.concatenate([ranks, np.full((len(word), 1), NO_MERGE)], axis=1)
            ranks = np.take_along_axis(padded, later, axis=1)
            for k in (i, i - 1):
                has = (k >= 0) & (k + 1 < len(cols))
                x, y = toks[rows[has], k[has]], toks[rows[has], k[has] + 1]
                ranks[rows[has], k[has]] = np.where(y >= 0, self.pair_rank(x, y), NO_MERGE)
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(owners), np.concatenate(tokens)

    def exact(self, word: bytes) -> list[int]:
        """Merge one word with a heap over a linked list: n log n, so a very long
        word is no problem."""
        merge = self.merge
        toks = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        n = len(toks)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (hit := merge.get(toks[i] << 32 | toks[i + 1])) is not None:
                heap.append((hit[0], i, toks[i], toks[i + 1], hit[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, out = heapq.heappop(heap)
            j = nxt[i] if toks[i] == a else n
            if j >= n or toks[j] != b:
                continue  # one of the two is gone
            toks[i], toks[j] = out, -1
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                if (hit := merge.get(out << 32 | toks[k])) is not None:
                    heapq.heappush(heap, (hit[0], i, out, toks[k], hit[1]))
            if (h := prv[i]) >= 0 and (hit := merge.get(toks[h] << 32 | out)) is not None:
                heapq.heappush(heap, (hit[0], h, toks[h], out, hit[1]))
        return [t for t in toks if t >= 0]


_MODELS: dict[str, BpeModel] = {}


def worker_model(key: str, spec: dict) -> BpeModel:
    """One set of tables per Python worker and vocabulary."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = BpeModel(spec)
    return _MODELS[key]
