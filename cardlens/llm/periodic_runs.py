"""Runs of repeated words: Lyndon arrays by Baier's grouping, roots extended by LCE.

A run is a stretch of words of smallest period q, at least ``EXPONENT`` times as long
as q and at least ``SHORTEST`` words, that cannot be extended. Each run holds a Lyndon
word of length q, under one of the two orders of the alphabet (ascending and
descending word numbers), that is the longest one at its start. So:

1. ``lyndon_array``: the first phase of Baier's suffix sorter puts positions into
   groups, which it takes in descending order; the length of a group's context is
   the longest Lyndon word at each of its positions. Once under each order.
2. ``runs_of``: every position and its Lyndon length is a root; the longest common
   extensions of it and the position one root later, to the right and to the left,
   give the run's ends. Extensions come from prefix hashes under two moduli by
   bisection, and every run found is compared word by word before it counts.

Before that, positions that no run can reach are left out: all four-word sequences inside a
run occur at least twice in it (a run of period 1 has 6 words, of period q 4q), so a run
lies within a stretch of four-word sequences that repeat in the text.

Each text is judged alone, in Arrow batches, without a shuffle.

Defined cases: a null text, or one without words, has no run, no word and the hash of the
empty string; equal best runs go to the smallest start, then period; a repeated row gives a
repeated result; a null id is hashed like the empty string by ``planted``; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SHORTEST, EXPONENT = 6, 4
GRAM = 4  # words of a sequence that a run must repeat
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)


def planted(doc_id, n: int) -> np.ndarray | None:
    """Source word of each of ``n`` words where the contract makes a text
    periodic (by the CRC-32 of its id), else None."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


def lyndon_array(s: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position of ``s`` (numbers from 0).

    Groups form a list from low to high; the highest unfinished one is taken, and its
    context is appended to the context of the nearest earlier position of a lower
    group, which moves to a new group just above its own, the higher the more often."""
    n = len(s)
    order = sorted(set(s))
    group_of = {c: g for g, c in enumerate(order)}
    group = [group_of[c] for c in s]
    below = list(range(-1, len(order) - 1))
    above = list(range(1, len(order) + 1))
    if above:
        above[-1] = -1  # the groups are a list by links
    context = [1] * len(order)
    members: list[list[int]] = [[] for _ in order]
    for i, g in enumerate(group):
        members[g].append(i)
    done = bytearray(n)
    back = [-1] * n  # nearest earlier position of a lower group, once the own group is done
    out = [0] * n
    top = len(order) - 1
    while top >= 0:
        size = context[top]
        mine = [i for i in members[top] if group[i] == top]
        if mine:
            mine.sort()
            found: list[int] = []
            for i in mine:
                out[i] = size
                done[i] = 1
                p = i - 1
                while p >= 0 and done[p]:
                    p = back[p]
                back[i] = p
                if p >= 0:
                    found.append(p)
            if found:
                times = Counter(found) if len(found) > 1 else {found[0]: 1}
                moves: dict[tuple[int, int], list[int]] = {}
                for p, k in times.items():
                    moves.setdefault((k, group[p]), []).append(p)
                for k, old in sorted(moves, key=lambda m: -m[0]):
                    new = len(context)
                    context.append(context[old] + k * size)
                    over = above[old]
                    below.append(old)
                    above.append(over)
                    above[old] = new
                    if over >= 0:
                        below[over] = new
                    moved = moves[k, old]
                    members.append(moved)
                    for p in moved:
                        group[p] = new
        members[top] = []
        top = below[top]
    return out


class Extensions:
    """Longest common extensions of positions of a number sequence."""

    def __init__(self, s: np.ndarray):
        n = len(s)
        self.n, self.parts = n, []
        for m, b in zip(MODULI, BASES, strict=True):
            power = np.ones(n + 1, np.int64)
            have = 1
            while have <= n:  # powers by doubling
                step = int(power[have - 1]) * b % m
                more = min(have, n + 1 - have)
                power[have : have + more] = power[:more] * step % m
                have += more
            total = np.zeros(n + 1, np.int64)
            # blocks keep the sums below 2^63
            np.cumsum((s + 1) % m * power[:n] % m, out=total[1:])
            self.parts.append((m, power, total % m))

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` numbers from ``i`` and from ``j`` (``i <= j``) hash alike."""
        ok = np.ones(len(i), bool)
        for m, power, total in self.parts:
            a = (total[i + length] - total[i]) % m * power[j - i] % m
            ok &= a == (total[j + length] - total[j]) % m
        return ok

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Numbers that agree from ``i`` and ``j`` on (``i < j``)."""
        return self._most(np.zeros_like(i), self.n - j, lambda k: self.same(i, j, k))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Numbers that agree before ``i`` and ``j`` (``i < j``)."""
        return self._most(np.zeros_like(i), i.copy(), lambda k: self.same(i - k, j - k, k))

    @staticmethod
    def _most(low: np.ndarray, high: np.ndarray, holds: Callable) -> np.ndarray:
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = holds(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _is_run(s: np.ndarray, start: int, length: int, q: int) -> bool:
    end = start + length
    return (
        np.array_equal(s[start : end - q], s[start + q : end])
        and (start == 0 or s[start - 1] != s[start + q - 1])
        and (end == len(s) or s[end] != s[end - q])
    )


def _scan(s: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """``start, length`` of the stretch of period ``q`` around ``i``, by comparing."""
    a = i
    while a > 0 and s[a - 1] == s[a - 1 + q]:
        a -= 1
    b = i + q
    while b < len(s) and s[b] == s[b - q]:
        b += 1
    return a, b - a


def runs_of(s: np.ndarray, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs of a number sequence, by start, then period."""
    n = len(s)
    if n < shortest:
        return []
    numbers = np.unique(s, return_inverse=True)[1].astype(np.int64)
    lce = Extensions(numbers)
    found: dict[tuple[int, int, int], list[int]] = {}
    for one in (numbers, numbers.max() - numbers):
        q = np.array(lyndon_array(one.tolist()), np.int64)
        i = np.arange(n)
        fits = i + q < n
        i, q = i[fits], q[fits]
        # the root of a run occurs there once more, at the first of its places at least
        again = lce.same(i, i + q, np.minimum(q, n - i - q))
        i, q = i[again], q[again]
        before = lce.left(i, i + q)
        start, length = i - before, before + q + lce.right(i, i + q)
        long = length >= np.maximum(shortest, exponent * q)
        for root, *run in zip(*(x[long].tolist() for x in (i, start, length, q)), strict=True):
            found.setdefault(tuple(run), []).append(root)
    out = set()
    for run, roots in found.items():
        if _is_run(numbers, *run):
            out.add(run)
            continue
        for i in roots:  # a hash that two stretches share: compare word by word
            start, length = _scan(numbers, i, run[2])
            if length >= max(shortest, exponent * run[2]):
                out.add((start, length, run[2]))
    return sorted(out)


def repeated_stretches(codes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """``begin, end`` of the stretches of word codes (of texts ``owner``, in order) whose
    sequences of GRAM words all occur twice in their text or share a hash with one that does."""
    n = len(codes) - GRAM + 1
    if n <= 0:
        return []
    mixed = owner[:n].astype(np.uint64)
    for k in range(GRAM):
        mixed = (mixed ^ codes[k : n + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    inside = owner[:n] == owner[GRAM - 1 :]
    order = np.argsort(mixed, kind="stable")
    ranked = mixed[order]
    twin = ranked[1:] == ranked[:-1]
    good = np.zeros(n, bool)
    good[order[1:]] |= twin
    good[order[:-1]] |= twin
    good &= inside
    edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + GRAM - 1
    # stretches of two texts never touch: sequences across texts are not inside
    wide = ends - begins >= SHORTEST
    return list(zip(begins[wide].tolist(), ends[wide].tolist(), strict=True))


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length over period, compared exactly."""
    best = None
    for r in runs:  # by start, then period: the first of equals stays
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words without those of a run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


RESULT = pa.schema(
    [
        pa.field("n_words", pa.int64()),
        pa.field("n_runs", pa.int64()),
        pa.field("start", pa.int64()),
        pa.field("length", pa.int64()),
        pa.field("period", pa.int64()),
        pa.field("exponent_milli", pa.int64()),
        pa.field("runs", pa.list_(pa.list_(pa.int64()))),
        pa.field("runs_sha256", pa.string()),
        pa.field("collapsed_sha256", pa.string()),
    ]
)
RESULT_DDL = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<array<long>>, runs_sha256 string, collapsed_sha256 string"
)
TEXTS_BYTES = 16 << 20  # bytes of texts judged at once: bounds a worker's memory whatever the batch


def judge_texts(ids: list, texts: list[str | None], source: Callable | None) -> pa.Table:
    """One row of ``RESULT`` per text. ``source(id, n)`` may give each word's place in
    the text that is judged instead."""
    numbers: dict[bytes, int] = {}
    all_words, codes, ends = [], [], []
    for key, text in zip(ids, texts, strict=True):
        # bytes split at exactly [\x20\x09-\x0D]
        words = (text or "").encode().split()
        at = source(key, len(words)) if source else None
        if at is not None:
            words = [words[i] for i in at.tolist()]
        all_words.append(words)
        codes.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        ends.append(len(words))
    sizes = np.array(ends, np.int64)
    starts = np.cumsum(sizes) - sizes
    joined = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    runs: list[list] = [[] for _ in ends]
    for begin, end in repeated_stretches(joined, owner):
        d = int(owner[begin])
        shift = begin - int(starts[d])
        runs[d] += [(s + shift, length, q) for s, length, q in runs_of(joined[begin:end])]
    rows = []
    for words, found in zip(all_words, runs, strict=True):
        found.sort()
        best = best_run(found)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        rows.append(
            {
                "n_words": len(words),
                "n_runs": len(found),
                "start": best and best[0],
                "length": best and best[1],
                "period": best and best[2],
                "exponent_milli": best and 1000 * best[1] // best[2],
                "runs": [list(r) for r in found],
                "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                "collapsed_sha256": hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
            }
        )
    return pa.Table.from_pylist(rows, RESULT)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source: Callable | None = None
) -> DataFrame:
    """``id_col`` and the columns of ``RESULT`` of every row of ``docs``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_of = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)], np.int64)
            before = np.cumsum(bytes_of) - bytes_of
            at = 0
            while at < batch.num_rows:  # whole texts, one at least
                to = max(at + 1, int(np.searchsorted(before, before[at] + TEXTS_BYTES)))
                part = batch.slice(at, to - at)
                table = judge_texts(part.column(0).to_pylist(), part.column(1).to_pylist(), source)
                table = table.add_column(0, "_id", part.column(0))
                yield from table.combine_chunks().to_batches()
                at = to

    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return rows.mapInArrow(judged, f"_id {id_type}, {RESULT_DDL}").withColumnRenamed("_id", id_col)
