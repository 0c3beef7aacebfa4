"""Each operator against a brute-force version, on rows that are awkward on
purpose: nulls, empty and very long texts, ties, repeated rows, columns whose
names clash with the operator's own, and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardlens.llm import (
    bpe_codec,
    exact_dedup,
    fuse_filter,
    langid,
    mixing,
    quality,
    secret_scan,
    simhash,
    token_counts,
    url_filter,
    warc,
)
from cardlens.llm.components import components
from cardlens.llm.queries import ABUSE, URL_RULES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_tokens string, kept string, id string, words string, digest string"
)


def awkward_texts() -> list[str | None]:
    rnd = random.Random(7)
    parts = [
        "a", "the", " quick", "  ", "\n", "'s", "n't", "12", "!!", "é", "中文", "😀", "\x85", "　", "<|endoftext|>", "-",
    ]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    edge = [None, "", " ", "\t\n", "x", "<|endoftext|>", "a<|endoftext|>  <|endof", "a" * 5000, " " * 500 + "y"]
    edge += ["word " * 3000, "line\nline\n\nline", "A\tb  c", "A b c", "a b c"]
    return edge + made + edge[:6]


@pytest.fixture(scope="module")
def docs(spark):
    texts = awkward_texts()
    langs = ["en", "de", None]
    rows = [
        (i, t, langs[i % 3], None if i % 5 == 0 else f"s{i % 2}", len(t or ""), "n", "k", "i", "w", "d")
        for i, t in enumerate(texts)
    ]
    rows += [(None, "no id", "en", "s0", 5, *"nkiwd"), rows[10], rows[10]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def pairs(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# -- BPE ---------------------------------------------------------------------
def test_codec_is_the_library(docs, none, library):
    def truth(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        joined = ",".join(map(str, ids))
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    want = sorted(((r.doc_id, *truth(r.text)) for r in docs.collect()), key=repr)
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert pairs(bpe_codec.round_trip(docs, PATH), *names) == want
    assert bpe_codec.round_trip(none, PATH).collect() == []


def test_decode_of_any_ids(spark, library):
    rnd = random.Random(3)
    rows = [(i, [rnd.randrange(50257) for _ in range(rnd.randint(0, 30))]) for i in range(60)] + [(99, None)]
    got = dict(pairs(bpe_codec.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH), "doc_id", "text"))
    for i, ids in rows:
        assert got[i] == library.decode(ids or [], skip_special_tokens=False)


def test_codec_on_every_letter_class(spark, library):
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c <= 0xDFFF]
    rows = [(i, f"a{c}b {c}{c} 1{c}") for i, c in enumerate(points)]
    got = dict(pairs(bpe_codec.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH), "doc_id", "ids"))
    for (i, text), e in zip(rows, library.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        assert got[i] == e.ids, text


def test_counts_prefixes_and_cuts(docs, none, library):
    out = {r.doc_id: r for r in token_counts.count_tokens(docs, PATH, 5).collect()}
    curves = {r.doc_id: r.counts for r in token_counts.prefix_counts(docs, PATH).collect()}
    for r in docs.collect():
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        got = out[r.doc_id]
        assert (got.n_bytes, got.n_tokens, got.over_limit) == (len(text.encode()), n, n > 5)
        if len(text) < 200 and "<|" not in text:
            truth = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
            assert curves[r.doc_id] == truth
            assert got.cut_chars == max(k for k, c in enumerate(truth) if c <= 5)
    assert token_counts.count_tokens(none, PATH, 5).collect() == []


# -- WARC --------------------------------------------------------------------
PAGES = "page_id long, url string, html string, payload string, size int, digest string"


def page_rows():
    big, small = "<p>" + "ä" * 80, "<p>tiny"
    texts = [big, big, small, small, None, "", "x" * 100, "x" * 100, "x" * 99, "x" * 99, "\r\n\r\n" * 60, "y" * 300_000]
    return [(i, f"https://h/{i}?a b" if i % 3 else None, t, "p", 1, "d") for i, t in enumerate(texts)] + [
        (5, "", "", "p", 1, "d"), (None, "u", big, "p", 1, "d"), (0, "again", big, "p", 1, "d"),
    ]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(page_rows(), PAGES).repartition(3)
    manifest = warc.write_archives(pages, warc.archive_folder(pages))
    got = warc.read_archives(manifest)
    want = []
    first = {}
    for i, _, t, *_ in page_rows():
        if i is not None and len((t or "").encode()) >= 100:
            first[t] = min(first.get(t, i), i)
    for i, _, t, *_ in page_rows():
        raw = (t or "").encode()
        again = t in first and first[t] != i
        want.append(
            (None if i is None else str(i), len(raw), hashlib.sha256(raw).hexdigest(),
             "revisit" if again else "response", str(first[t]) if again else None,
             None if again else raw)
        )
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert pairs(got, *names) == sorted((w[:5] for w in want), key=repr)
    payloads = sorted((bytes(r.payload) for r in got.collect() if r.payload is not None))
    assert payloads == sorted(w[5] for w in want if w[5] is not None)
    empty = spark.createDataFrame([], PAGES)
    assert warc.read_archives(warc.write_archives(empty, warc.archive_folder(empty))).collect() == []


def test_warc_reader_frames_and_checks():
    digest = hashlib.sha256(b"hello").hexdigest()
    one = warc.record("1", "http://a", b"hello", digest, 5, None)
    two = warc.record("2", None, None, digest, 5, "1")

    def source(data, step=7):
        at = [0]

        def read(_):
            part = data[at[0] : at[0] + step]
            at[0] += step
            return part

        return read

    found = list(warc.records(source(one + two)))
    assert [f["warc-type"] for f, _, _ in found] == ["response", "revisit"]
    assert found[0][2] == b"hello" and found[1][2] == b""
    with pytest.raises(ValueError, match="gzip member"):
        list(warc.records(source(one[:-9])))
    plain = zlib.decompress(one, 31)
    with pytest.raises(ValueError, match="digest"):
        list(warc.records(source(gz(plain.replace(b"hello", b"jello")))))
    with pytest.raises(ValueError):
        list(warc.records(source(gz(plain.replace(b"Content-Length: ", b"Content-Length: 9")))))


def gz(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# -- exact dedup ----------------------------------------------------------------
def test_fuse_filter():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 100, 5000):
        keys = rnd.integers(0, 2**63, n).astype(np.uint64)
        f = fuse_filter.build(np.concatenate([keys, keys]))
        assert fuse_filter.maybe(keys, **f).all()
        other = rnd.integers(0, 2**63, 20000).astype(np.uint64)
        assert fuse_filter.maybe(other, **f).mean() < 0.02


def test_exact_duplicates(docs, none):
    def norm(t):
        return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")

    groups = {}
    for r in docs.collect():
        groups.setdefault(norm(r.text), []).append(r.doc_id)
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        seen = False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            want.append((i, keep, len(ids), i == keep and not seen, sha))
            seen = seen or i == keep
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert pairs(exact_dedup.exact_duplicates(docs), *names) == sorted(want, key=repr)
    assert exact_dedup.exact_duplicates(none).collect() == []


def test_screen_has_no_false_negative_and_bytes_decide(spark):
    old = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    new = spark.range(2000, 4000).select((F.col("id") + 10_000).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    snapshot = exact_dedup.group(exact_dedup.fingerprint_rows(old))
    batch = exact_dedup.group(exact_dedup.fingerprint_rows(new))
    filters = exact_dedup.build_filters(snapshot, 4)
    hits = {r.digest for r in exact_dedup.screen(batch, filters, 4).collect()}
    both = {r.digest for r in batch.join(snapshot, "digest", "left_semi").collect()}
    assert both <= hits and len(hits) < 1000 + 50
    out = exact_dedup.merge_batch(old.union(new), snapshot, filters, batch, 4).collect()
    assert len(out) == 4000 and sum(r.n for r in out) == 5000
    assert all(r.keep.id < 10_000 for r in out if r.n == 2)
    # one digest claimed by two texts: the claim fails the byte check
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    sha = hashlib.sha256(b"a b").hexdigest()
    good = spark.createDataFrame([(sha, 1, 2)], "digest string, a long, b long")
    assert exact_dedup.same_bytes(docs, good).count() == 1


# -- language -------------------------------------------------------------------
def test_suffix_automaton_parses_by_longest_match():
    text = "abracadabra cadabra"
    m = langid.SuffixAutomaton(text)

    def brute(w):
        n = i = 0
        while i < len(w):
            j = i + 1
            while j < len(w) and w[i : j + 1] in text:
                j += 1
            i, n = j, n + 1
        return n

    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdrx ") for _ in range(rnd.randint(1, 15))) for _ in range(300)]
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    assert m.phrases(codes, start, end).tolist() == [brute(w) for w in words]


def test_language_edges(spark, docs, none):
    out = {r.doc_id: r for r in langid.identify(docs).collect()}
    for r in docs.collect():
        got = out[r.doc_id]
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert got.held_out == held and 0 <= got.score <= 1
        letter = any(c.isalpha() for c in r.text or "")
        assert (got.lang_pred == "und") == (not letter)
    assert langid.identify(none).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = scored.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    shuffled = docs.withColumn("lang", F.when(langid.fold(F.col("doc_id")) == 0, "xx").otherwise(F.col("lang")))
    same = langid.identify(shuffled).exceptAll(langid.identify(docs))
    assert same.count() == 0  # held-out labels play no part


# -- SimHash ----------------------------------------------------------------------
def brute_fingerprint(t, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, most):
    """value -> representative, links at <= most bits."""
    values = sorted(set(values))
    a = np.array(values, np.uint64)
    parent = list(range(len(a)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= most):
            parent[find(i)] = find(i + 1 + int(j))
    return {v: find(i) for i, v in enumerate(values)}


def test_near_duplicates(docs, none):
    rows = docs.collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    root = brute_components(prints.values(), 2)
    best = {}
    for r in rows:
        k = root[prints[r.doc_id]]
        if r.doc_id is not None:
            best[k] = min(best.get(k, r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, f"{prints[r.doc_id]:016x}", best.get(root[prints[r.doc_id]])) for r in rows), key=repr)
    got = simhash.near_duplicates(docs)
    assert pairs(got, "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(none).collect() == []


@pytest.mark.parametrize("most", [1, 2])
def test_links_of_crowded_and_thin_blocks(spark, most):
    rnd = random.Random(5)
    values = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        centre = rnd.getrandbits(64)
        for _ in range(250):
            x = centre
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            values.add(x)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    nodes = spark.createDataFrame([(x,) for x in signed.values()], "fp long")
    root = {r.node: r.root for r in components(simhash.links(nodes, most)).collect()}
    want = brute_components(values, most)
    mine = {}
    for v, x in signed.items():
        mine.setdefault(root.get(x, x), set()).add(v)
    truth = {}
    for v, k in want.items():
        truth.setdefault(k, set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, truth.values()))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


# -- mixing -----------------------------------------------------------------------
def test_raking_meets_the_targets(spark):
    rnd = random.Random(4)
    cells = [(a, b, rnd.randint(1, 1000)) for a in "xyz" for b in ("p", "q", None)]
    df = spark.createDataFrame(cells, "a string, b string, _mix_tokens long")
    targets = {"a": {"x": 0.2, "y": 0.5, "z": 0.3}}
    rows = mixing.rake(df, ["a", "b"], targets, rounds=40).collect()
    kept = {(r.a, r.b): r["_mix_tokens"] * r["_mix_probability"] for r in rows}
    total = sum(kept.values())
    for v, t in targets["a"].items():
        assert sum(w for (a, _), w in kept.items() if a == v) / total == pytest.approx(t, abs=1e-6)
    assert max(r["_mix_probability"] for r in rows) == 1


def test_calibrate_edges(docs, none):
    rows = mixing.calibrate(docs, mixing.margins_of(docs))
    out = rows.collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 < r["_mix_probability"] <= 1 and 0 <= r["_mix_draw"] < 1
        assert r["_mix_tokens"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert mixing.calibrate(none, mixing.margins_of(none)).collect() == []
    silent = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r["_mix_probability"] for r in mixing.calibrate(silent, mixing.margins_of(silent)).collect()} == {1.0}


# -- secrets ------------------------------------------------------------------------
SECRETS = [
    'password = "hunter22" and TOKEN:abcdef',
    "token=token\"=abcdefg secret: ab api_key='x.y/z+1='",
    "AKIA" + "A1" * 8 + " AKIASHORT xAKIA" + "Z" * 20,
    "deadbeef" * 3 + " " + "0" * 23 + "g" + "f" * 30,
    "é中 secret=😀 secret=abcdef😀 apikey:\x20\x20'abcdefgh'",
    "-----BEGIN RSA PRIVATE KEY-----",
    None,
    "",
    "plain",
    "passwd: " + "a" * 70_000,
]


def brute_spans(t, rule):
    out = []
    for m in re.finditer(rule.pattern, t or ""):
        if len(m[rule.value]) >= rule.least:
            out.append((m.start(), m.end()))
    return out


def test_secret_spans_and_incremental_ledger(spark):
    rows = [(i, t, "b", "s") for i, t in enumerate(SECRETS * 2)] + [(None, SECRETS[0], "b", "s"), (0, SECRETS[0], "b", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, blob string, spans string").repartition(4)
    base, more = secret_scan.BASE_RULES, secret_scan.MORE_RULES
    ledger = secret_scan.scan(docs, base)
    assert ledger.count() == len({t or "" for t in SECRETS}) * len(base)
    found = secret_scan.findings(docs, ledger, base).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, t, *_ in rows:
        for rule in base:
            got = [(s.start, s.stop) for s in by_id[i][rule.kind]]
            assert got == brute_spans(t, rule), (t, rule.kind)
    # nothing new: no pair left; a new rule: every blob once, for that rule only
    assert secret_scan.scan(docs, base, ledger).count() == 0
    again = secret_scan.scan(docs, base + more[:1], ledger)
    assert {r.rule for r in again.select("rule").distinct().collect()} == {"pem:1"}
    # a new version of one path: one new blob
    changed = docs.union(spark.createDataFrame([(3, "secret=changed1", "b", "s")], docs.schema))
    assert secret_scan.scan(changed, base, ledger).select("blob").distinct().count() == 1
    empty = docs.filter("false")
    assert secret_scan.findings(empty, secret_scan.scan(empty, base), base).collect() == []


# -- quality -------------------------------------------------------------------------
def brute_counts(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(t.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_score(spark, docs, none):
    rows = [(1000 + i, f"good words here number {i} " * 3 + "# *|\nx\nx") for i in range(30)]
    rows += [(2000 + i, f"zz{i} qq | " * 12) for i in range(5)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more).withColumn("hashes", F.lit("clash"))
    labels = spark.createDataFrame([(1000 + i, 1, 0) for i in range(20)] + [(None, 1, 0), (1003, 1, 0)], "doc_id long, quality int, toxic int")
    trusted = quality.trusted_ids(labels)
    model = quality.ratios(both, trusted, buckets=512)
    out = quality.judge(both, model).collect()
    texts = {}
    for r in both.collect():
        texts.setdefault(r.doc_id, r.text)

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    def feats(t):
        hashes = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        two = [
            signed(xxhash.xxh64(b.to_bytes(8, "little", signed=True), seed=signed_seed(
                xxhash.xxh64(a.to_bytes(8, "little", signed=True), seed=42).intdigest())).intdigest())
            for a, b in zip(hashes, hashes[1:], strict=False)
        ]
        return [h % 512 for h in hashes + two]

    raw, target = np.zeros(512), np.zeros(512)
    good = {r.trusted_id for r in trusted.collect()}
    for r in both.collect():
        for f in feats(r.text):
            raw[f] += 1
            target[f] += r.doc_id in good
    ratio = np.log(target * raw.sum() / target.sum() + 1) - np.log(raw + 1)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(texts[r.doc_id])
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        f = feats(texts[r.doc_id])
        assert (r.score is None) == (not f)
        if f:
            assert r.score == pytest.approx(ratio[f].mean(), abs=1e-9)
        assert r.kept == (not failed and (r.score is None or r.score >= quality.THRESHOLD))
    empty = quality.judge(none, quality.ratios(none, trusted))
    assert empty.collect() == []


def signed_seed(x):
    return x


# -- URLs ----------------------------------------------------------------------------
def test_url_parts_rules_and_filter(spark):
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block")]
    cases = {
        None: ("", "", None),
        "": ("", "", None),
        "no scheme": ("", "", None),
        "http://Example.COM/en/x?q#f": ("example.com", "/en/x", "example.com/en/"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "https://a.www.example.com/en/y": ("a.www.example.com", "/en/y", "www.example.com/en/"),
        "http://example.com": ("example.com", "", None),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/"),
        "x://h.net/es/a": ("h.net", "/es/a", "net/es/"),
        "x://net/es/": ("net", "/es/", "net/es/"),
        "http://h.org?a=://b": ("h.org", "", None),
        "http://É.org/Ä#?": ("É.org", "/Ä", None),
        "http://bad.org/p/?utm_source=a&b=1": ("bad.org", "/p/", None),
        "https://www.bad.org:8080/p?b=1&ref=2#x": ("www.bad.org:8080", "/p", None),
    }
    rows = [(i, u, "h", "p") for i, u in enumerate([*cases, *cases])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    listed = spark.createDataFrame([("bad.org/p?b=1",), (None,)], "url_key string")
    out = url_filter.judge(pages, rules, listed).collect()
    assert len(out) == len(rows)
    for r in out:
        url = rows[r.page_id][1]
        assert (r.host, r.path, r.rule) == cases[url]
        want = dict(rules).get(r.rule) or ("block" if url and "bad.org" in url else "allow")
        assert r.verdict == want
    nothing = spark.createDataFrame([], "url_key string")
    assert {r.verdict for r in url_filter.judge(pages, [], nothing).collect()} == {"allow"}
    assert url_filter.judge(pages.filter("false"), rules, listed).collect() == []


def test_bloom_lets_every_listed_url_through(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("url_key"))
    urls = spark.range(20000).select("id", F.concat(F.lit("h/"), "id").alias("url_key"))
    urls = urls.withColumn("url_hash", url_filter.url_hash(F.col("url_key")))
    blocks = url_filter.block_count(5000)
    words = url_filter.bloom(listed, blocks).first()[0]
    assert len(words) == blocks * url_filter.WORDS
    maybe = urls.filter(url_filter.may_hold(F.lit(np.array(words)), blocks, F.col("url_hash")))
    ids = {r.id for r in maybe.collect()}
    assert set(range(5000)) <= ids and len(ids) < 5000 + 0.05 * 15000
    hit, free = url_filter.listed_among(urls, listed)
    assert hit.count() == 5000 and free.count() == 15000


def test_pages_without_a_host_and_equal_rules(spark):
    rows = [(1, "http://"), (2, None), (3, "no scheme"), (4, "http://#x"), (5, "http://a.b/x"), (6, "http:///p")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = pages.select(url_filter.canonical(F.col("url")).alias("url_key"))
    out = {r.page_id: r.verdict for r in url_filter.judge(pages, [], listed).collect()}
    assert out == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "block", 6: "allow"}
    rules = [("a.b/", "allow"), ("a.b/", "block"), ("b/xy", "block"), ("b/x/", "allow")]
    out = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules, listed).collect()}
    assert out[5] == ("a.b/", "allow")  # equal length: the first given


def test_url_sql_agrees_on_pages_without_a_host(spark):
    import duckdb
    import pandas as pd

    rows = [(1, "http://", "scum"), (2, None, "loser"), (3, "no scheme", "idiot"), (4, "http://h/", "moron"), (5, "http://www.h", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    bad = pages.filter(F.rlike("html", F.lit(ABUSE)) & F.contains("url", F.lit("://")))
    listed = bad.select(url_filter.canonical(F.col("url")).alias("url_key"))
    got = sorted((r.page_id, r.verdict) for r in url_filter.judge(pages, URL_RULES, listed).collect())
    db = duckdb.connect()
    db.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    sql = url_filter.duckdb_sql("pages", URL_RULES, ABUSE)
    assert got == sorted(db.sql(f"SELECT page_id, verdict FROM ({sql})").fetchall())
    assert dict(got) == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block"}


def test_many_matches_in_one_text(spark):
    """Spans of 200,000 matches: arrays do not grow match by match."""
    import time

    text = "AKIA" + "A" * 16 + " " + ("0123456789abcdef01234567 " * 200_000)
    rule = next(r for r in secret_scan.BASE_RULES if r.kind == "hex")
    df = spark.createDataFrame([(text,)], "t string")
    began = time.time()
    found = df.select(secret_scan.spans(F.col("t"), rule).alias("s")).select(
        F.size("s").alias("n"), F.expr("s[0].start").alias("a"), F.expr("s[199999].stop").alias("z"), F.expr("s[128].start").alias("m")
    )
    assert tuple(found.first()) == (200_000, 21, 21 + 25 * 200_000 - 1, 21 + 25 * 128)
    assert time.time() - began < 60


def test_later_versions_scan_unseen_blobs_only(spark):
    rows = [(i, f"token = abcdef{i % 7}") for i in range(40)] + [(41, None), (42, ""), (43, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rules = secret_scan.BASE_RULES
    old, new = secret_scan.scan_versions([docs.filter("doc_id < 20"), docs.filter("doc_id >= 20")], rules)
    assert old.count() == 7 * 3 and new.count() == 3  # the empty blob alone is new
    found = secret_scan.findings(docs, old.unionByName(new), rules)
    assert sorted((r.doc_id, len(r.assign)) for r in found.collect()) == [(i, int(i < 40)) for i, _ in rows]
