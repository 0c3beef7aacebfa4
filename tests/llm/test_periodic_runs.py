"""Runs of words against brute force: Lyndon arrays by definition, runs by trying
every period, and the registered query's digests by a plain reading of its contract."""

import hashlib
import random
import re
import zlib

import numpy as np

from cardlens.llm import periodic_runs
from cardlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def longest_lyndon(s):
    n = len(s)
    return [
        max(m for m in range(1, n - i + 1) if all(s[i : i + m] < s[i + k : i + m] for k in range(1, m)))
        for i in range(n)
    ]


def all_runs(s):
    """Every maximal stretch of each period, if no smaller one fits it."""
    out, n = [], len(s)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                w = s[i : i + length]
                if not any(w[r:] == w[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def contract(doc_id, text):
    """The digest columns by a plain reading of the contract."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = all_runs(w)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def made(rnd, size):
    parts = []
    while len(parts) < size:
        w = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 5))]
        parts += (w * rnd.randint(1, 8))[: rnd.randint(1, 30)]
    return parts


def test_lyndon_array():
    rnd = random.Random(3)
    for _ in range(800):
        s = [rnd.randint(0, rnd.choice([0, 1, 2, 3])) for _ in range(rnd.randint(0, 13))]
        assert periodic_runs.lyndon_array(s) == longest_lyndon(s), s


def test_runs_of():
    rnd = random.Random(4)
    for _ in range(500):
        s = made(rnd, 45)
        assert periodic_runs.runs_of(np.array(s)) == all_runs(s), s
    assert periodic_runs.runs_of(np.array([], np.int64)) == []
    assert periodic_runs.runs_of(np.array([5] * 6)) == [(0, 6, 1)]
    assert periodic_runs.runs_of(np.array([5] * 5)) == []
    assert periodic_runs.runs_of(np.array([1, 2] * 4)) == [(0, 8, 2)]
    assert periodic_runs.runs_of(np.array([1, 2] * 3 + [1])) == []


def test_shared_hashes_are_told_apart(monkeypatch):
    """With moduli so small that hashes collide, every run is still right."""
    monkeypatch.setattr(periodic_runs, "MODULI", (3, 2))
    rnd = random.Random(5)
    for _ in range(200):
        s = made(rnd, 30)
        assert periodic_runs.runs_of(np.array(s)) == all_runs(s), s


def test_extensions():
    rnd = random.Random(6)
    s = np.array([rnd.randint(0, 1) for _ in range(300)])
    lce = periodic_runs.Extensions(s)
    i = np.array([rnd.randint(0, 250) for _ in range(200)])
    j = i + np.array([rnd.randint(1, 40) for _ in range(200)])

    def right(a, b):
        k = 0
        while b + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        return k

    def left(a, b):
        k = 0
        while a - k > 0 and s[a - k - 1] == s[b - k - 1]:
            k += 1
        return k

    assert lce.right(i, j).tolist() == [right(a, b) for a, b in zip(i, j, strict=True)]
    assert lce.left(i, j).tolist() == [left(a, b) for a, b in zip(i, j, strict=True)]


def test_awkward_rows(spark):
    rnd = random.Random(7)
    texts = [None, "", " \n\t", "x", "a a a a a", "a a a a a a", "a\x0ba\x0ca\ra\ta\na", "é\x85 é\x85 é\x85 é\x85 é\x85 é\x85"]
    texts += [" ".join(f"w{x}" for x in made(rnd, rnd.randint(1, 90))) for _ in range(120)]
    texts += ["k l m " * 40_000, " ".join(str(rnd.randint(0, 9)) for _ in range(3000))]
    rows = [(i, t, "n", "s") for i, t in enumerate(texts)] + [(None, "b " * 9, "n", "s"), (9, texts[9], "n", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, start string").repartition(3)
    got = periodic_runs.periodic_runs(docs, source=periodic_runs.planted).collect()
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted(((str(i), *map(str, contract(i, t))) for i, t, *_ in rows if t is None or len(t) < 50_000))
    long_ids = {str(i) for i, t in enumerate(texts) if t is not None and len(t) >= 50_000}
    have = sorted((str(r.doc_id), *(str(r[c]) for c in names)) for r in got if str(r.doc_id) not in long_ids)
    assert have == want
    long = [r for r in got if str(r.doc_id) in long_ids]
    assert [(r.n_runs, r.start, r.length, r.period) for r in long] == [(1, 0, 120_000, 3)]
    assert len(got) == len(rows)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_other_key_types_and_no_planting(spark):
    docs = spark.createDataFrame([("a", "q r " * 5)], "key string, body string")
    row = periodic_runs.periodic_runs(docs, "key", "body").first()
    assert (row.key, row.n_words, row.runs) == ("a", 10, [[0, 10, 2]])


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op13_periodic_runs"](spark, SMALL)
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = {r.doc_id: contract(r.doc_id, r.text) for r in docs if len(r.text or "") < 30_000}
    got = {r.doc_id: tuple(r[c] for c in names) for r in out.collect()}
    assert len(got) == len(docs)
    assert {k: got[k] for k in short} == short
