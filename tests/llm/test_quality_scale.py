"""Quality verdicts: the whole result by brute force, and labelled documents at two scales."""

import math
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from cardlens.llm import quality


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def hash_of(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True), seed=seed).intdigest()
    return signed(seed)


def brute(docs, labels, bits):
    """``doc_id, base_failed, score, kept`` of every row, by a plain reading of the module's text."""

    def grams(text):
        words = [hash_of(w) for w in (text or "").split()]
        return [h % 2**bits for h in words + [hash_of(a, b) for a, b in zip(words, words[1:], strict=False)]]

    def held(i):
        return i is not None and hash_of(i, "held") % quality.FOLDS == 0

    good, bad = set(), set()
    for i, q, toxic in labels:
        if i is not None and (q == 0 or not toxic):
            (good if q == 1 else bad).add(i)
    raw, target = Counter(), Counter()
    for i, text in docs:
        found = grams(text)
        raw.update(found)
        if i in good and not held(i):
            target.update(found)
    scale = sum(raw.values()) / sum(target.values())
    rows = []
    for i, text in docs:
        words, found = (text or "").split(), grams(text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        times = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(8)}
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        ratios = [math.log(target[g] * scale + 1) - math.log(raw[g] + 1) for g in found]
        rows.append((i, failed, sum(ratios) / len(ratios) if ratios else None))
    fold = {}
    for i, failed, score in rows:
        if held(i) and not failed and (i in good) != (i in bad):
            fold.setdefault((i, i in good), []).append(score)
    scored = sorted((sum(v) / len(v), g) for (_, g), v in fold.items())
    n_good, n_bad = sum(g for _, g in scored), sum(not g for _, g in scored)
    assert n_good and n_bad
    gains = {}
    for cut in [scored[0][0] - 1e-6] + [(a + b) / 2 for (a, _), (b, _) in zip(scored, scored[1:], strict=False) if b > a]:
        gains[cut] = sum(not g for s, g in scored if s < cut) / n_bad - sum(g for s, g in scored if s < cut) / n_good
    threshold = min(gains, key=lambda c: (-round(gains[c], 9), c))
    return [(i, failed, score, not failed and (score is None or score >= threshold)) for i, failed, score in rows]


def test_whole_result_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "LEAST_BITS", 9)
    rnd = random.Random(8)
    clean = [f"w{k}" for k in range(60)]
    docs, labels = [], []
    for i in range(160):
        noisy = i % 4 == 0
        words = [rnd.choice(["$$", "%%%", "&&", "zz", *clean[:9]] if noisy else clean) for _ in range(rnd.randint(15, 60))]
        if i % 11 == 0:
            words += words[:9] * 3
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(not noisy), int(i % 29 == 0)))
    docs += [(None, "w1 w2"), (5, docs[5][1]), (900, None), (901, ""), (902, " \n")]
    labels += [(None, 1, 0), labels[0], (labels[1][0], 1 - labels[1][1], 0)]
    frame = spark.createDataFrame([(*r, "h", "p") for r in docs], "doc_id long, text string, hashes string, pairs string")
    out = quality.judge_by_labels(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = sorted(((r.doc_id, r.base_failed, r.score, r.kept) for r in out), key=repr)
    want = sorted(brute(docs, labels, 9), key=repr)
    assert [(i, f, k) for i, f, _, k in sorted(got, key=lambda r: (str(r[0]), str(r[2])[:6]))] == [
        (i, f, k) for i, f, _, k in sorted(want, key=lambda r: (str(r[0]), str(r[2])[:6]))
    ]
    by_id = {i: s for i, _, s, _ in want}
    assert all((s is None) == (by_id[i] is None) and (s is None or s == pytest.approx(by_id[i], abs=1e-9)) for i, _, s, _ in got)
    assert {k for *_, k in got} == {True, False}


def test_characters_are_counted_without_a_lookup_of_each(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a\x1cb\x85 c\u3000d", "##*$%&|<>^-]\\ \U0001f600x\u0301 [#", "<a>\r\n<b>\x00 é&", "|" * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = quality.base_counts(frame, "doc_id", "text")
    got = {r.doc_id: (r.word_chars, r.n_symbols) for r in out.collect()}
    want = {i: (sum(c not in " \t\n\x0b\x0c\r" for c in t or ""), sum(c in "#*$%&|<>" for c in t or "")) for i, t in enumerate(texts)}
    assert got == want
    assert "translate(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_grow_with_the_corpus():
    assert [quality.bucket_bits(n) for n in (0, 1, 2**18, 2**18 + 1, 10**6, 10**9)] == [18, 18, 18, 19, 20, 20]


def test_threshold_of_held_out_labels(spark):
    scored = spark.createDataFrame(
        [(1, -3.0, False), (2, -2.0, False), (3, -0.5, False), (4, 0.5, False), (5, -9.0, True), (6, None, False)],
        "doc_id long, score double, base_failed boolean",
    )
    held = spark.createDataFrame([(1, False), (2, False), (3, True), (4, True), (5, True), (6, True)], "held_id long, good boolean")
    assert quality.fit_threshold(scored, held) == pytest.approx(-1.25)
    assert quality.fit_threshold(scored, held.filter("good")) == quality.THRESHOLD


def test_every_label_is_used(spark):
    ids = spark.range(120_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    assert quality.trusted_ids(ids.unionByName(ids.limit(9))).count() == 60_000
    held = quality.held_ids(ids)
    by_class = {r.good: r["count"] for r in held.groupBy("good").count().collect()}
    in_fold = ids.filter(quality.held_out(F.col("doc_id")))
    assert by_class == {bool(r.quality): r["count"] for r in in_fold.groupBy("quality").count().collect()}
    assert min(by_class.values()) > 10_000
    # four scores: most bad ids, a quarter of the good, a quarter of the bad, the other good ones
    last = F.xxhash64("held_id") > 2**62
    score = F.when(F.col("good"), F.when(last, 1.0).otherwise(3.0)).otherwise(F.when(last, 2.0).otherwise(0.0))
    scored = held.select(F.col("held_id").alias("doc_id"), score.alias("score"), F.lit(False).alias("base_failed"))
    # the gain is about 3/4 above 0 and above 2, less above 1
    n = {(r.good, r.last): r["count"] for r in held.groupBy("good", last.alias("last")).count().collect()}
    above_0 = n[False, False] / by_class[False]
    above_2 = 1 - n[True, True] / by_class[True]
    assert quality.fit_threshold(scored, held) == (0.5 if above_0 >= above_2 else 2.5)


def test_trusted_texts_are_exact_whatever_the_filter_holds(spark, monkeypatch):
    rows = [(None if i % 97 == 0 else i // 2, f"t{i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.range(0, 1500, 3).select(F.col("id").alias("trusted_id"))
    want = sorted((t, int(i is not None and i % 3 == 0)) for i, t in rows)
    bits = quality.id_bits(trusted, "trusted_id").first().bits
    assert len(bits) == 64 and 400 < sum(bin(b & (2**64 - 1)).count("1") for b in bits) <= 500
    for words, ids in ((1 << 18, trusted), (1, trusted), (1 << 18, trusted.select(F.col("trusted_id").cast("int")))):
        monkeypatch.setattr(quality, "FILTER_WORDS", words)
        assert sorted(map(tuple, quality.trusted_texts(docs, ids, "doc_id", "text").collect())) == want
    none = quality.trusted_texts(docs, trusted.limit(0), "doc_id", "text")
    assert none.agg(F.count("*"), F.sum("target")).first() == (3000, 0)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_noise_goes_and_good_stays_at_both_scales(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.judge_by_labels(docs, labels).join(labels, "doc_id").filter("not base_failed")
    # the held-out fold fitted the threshold
    bad = F.col("quality") == 0
    rows = out.filter(~bad | ~quality.held_out(F.col("doc_id"))).groupBy(bad.alias("bad"))
    share = {r.bad: r.kept for r in rows.agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[True] <= 0.05 and share[False] >= 0.99
