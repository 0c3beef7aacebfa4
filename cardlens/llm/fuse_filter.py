"""Binary fuse filters (Graf and Lemire, 2022): three slots a key, eight-bit prints.

A filter is static: it is built once from all keys of an immutable set and
answers "maybe" for each of them and for about 0.4 % of other keys.
"""

from __future__ import annotations

import math

import numpy as np

_TRIES = 100


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key + seed."""
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Segment length and number of segments in which a key's first slot lies."""
    if n <= 1:
        return 4, 1
    length = min(1 << 18, 1 << int(math.log(n) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
    return length, max(1, math.ceil(n * factor / length) - 2)


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    first = (h >> np.uint64(32)) * np.uint64(segments * length) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _print(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build(keys: np.ndarray) -> dict:
    """Filter of distinct or repeated uint64 ``keys``: ``seed, length, segments,
    slots`` (bytes)."""
    keys = np.unique(keys.astype(np.uint64))
    length, segments = _shape(len(keys))
    size = (segments + 2) * length
    for seed in range(1, _TRIES + 1):
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 % 2**64)
        slots = _slots(h, length, segments)
        count = np.bincount(slots.ravel(), minlength=size)
        names = np.zeros(size, np.int64)  # xor of the keys in a slot
        for s in slots:
            np.bitwise_xor.at(names, s, np.arange(len(keys)))
        left, rounds = len(keys), []
        alone = np.flatnonzero(count == 1)
        while len(alone):
            key, where = np.unique(names[alone], return_index=True)
            rounds.append((key, alone[where]))
            left -= len(key)
            touched = slots[:, key]
            for s in touched:
                np.subtract.at(count, s, 1)
                np.bitwise_xor.at(names, s, key)
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if left:
            continue  # a cycle: next seed
        out = np.zeros(size, np.uint8)
        prints = _print(h)
        for key, slot in reversed(rounds):
            a, b, c = slots[:, key]
            out[slot] = 0
            out[slot] = prints[key] ^ out[a] ^ out[b] ^ out[c]
        return {"seed": seed, "length": length, "segments": segments, "slots": out.tobytes()}
    raise RuntimeError(f"no seed of {_TRIES} gives a filter of {len(keys)} keys")


def maybe(keys: np.ndarray, seed: int, length: int, segments: int, slots: bytes) -> np.ndarray:
    """For each key: may it be in the set? (False is certain.)"""
    h = _mix(keys.astype(np.uint64), seed * 0x9E3779B97F4A7C15 % 2**64)
    table = np.frombuffer(slots, np.uint8)
    a, b, c = _slots(h, length, segments)
    return (table[a] ^ table[b] ^ table[c]) == _print(h)
