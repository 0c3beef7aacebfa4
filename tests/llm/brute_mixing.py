"""Mixing by a plain reading of the module's text, in plain Python and numpy."""

import hashlib
import re

import numpy as np

MARKS = (
    ("licence", re.compile(r"(?i)licen[sc]e|rights reserved")),
    ("contact", re.compile(r"@[a-z0-9-]+\.[a-z]")),
    ("noisy", re.compile(r"[#*$%&|<>!]{2}")),
)


def topic(text):
    words = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for name, mark in MARKS:
        n = len(mark.findall(text or ""))
        if n and (name != "noisy" or n >= 0.08 * words):
            return name
    return "prose"


def rake(table, wants, rounds=20_000, tolerance=1e-13):
    """Weights of a cell table (an array of any dimension) raked to ``wants``, one list per axis."""
    w = table / table.sum()
    for _ in range(rounds):
        before = w
        for axis, want in enumerate(wants):
            others = tuple(a for a in range(w.ndim) if a != axis)
            now = w.sum(axis=others)
            factor = np.divide(want, now, out=np.zeros_like(now), where=now > 0)
            w = w * factor.reshape([-1 if a == axis else 1 for a in range(w.ndim)])
        if np.abs(w - before).max() < tolerance:
            break
    return w


def mix(rows, temper=0.9, ceiling=0.01, budget=0.7):
    """``row, probability, kept`` of every row (dicts with doc_id, text, lang, source)."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    keys = [(r["source"], r["lang"], topic(r["text"])) for r in rows]
    places = [{v: i for i, v in enumerate(dict.fromkeys(k[a] for k in keys))} for a in range(3)]
    table = np.zeros([len(p) for p in places])
    for k, n in zip(keys, sizes, strict=True):
        table[tuple(p[v] for p, v in zip(places, k, strict=True))] += n
    if not table.sum():
        return [(r, 1.0, True) for r in rows]
    wants = []
    for axis in range(3):
        share = table.sum(axis=tuple(a for a in range(3) if a != axis)) / table.sum()
        if axis < 2:
            want = np.where(share > 0, share**temper, 0)
        else:
            want = np.array([min(s, ceiling) if v == "noisy" else s for v, s in zip(places[2], share, strict=True)])
        wants.append(want / want.sum())
    raked = rake(table, wants)
    lift = np.divide(raked, table, out=np.zeros_like(raked), where=table > 0)
    low, high = 0.0, lift.max()
    kept_at = lambda s: (np.minimum(1, lift / s) * table).sum()
    scale = high
    if kept_at(high) < budget * table.sum():
        low = high * 1e-12
        for _ in range(200):  # kept tokens fall as the scale rises
            scale = (low + high) / 2
            low, high = (scale, high) if kept_at(scale) > budget * table.sum() else (low, scale)
    out = []
    for r, k in zip(rows, keys, strict=True):
        at = tuple(p[v] for p, v in zip(places, k, strict=True))
        chance = min(1.0, lift[at] / scale) if table[at] else 1.0
        name = "" if r["doc_id"] is None else str(r["doc_id"])
        draw = int(hashlib.md5(("mix" + name).encode()).hexdigest()[:13], 16) / 2**52
        out.append((r, chance, draw < chance))
    return out
