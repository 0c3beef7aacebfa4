"""Exact token counts at every prefix, by dynamic programming over prefixes.

Within a pre-token, the encoding of the first ``i`` bytes ends in exactly one
token: the suffix token that is compatible with the last token of what stands
before it. So ``count[i] = count[i - len(token)] + 1``, and one left-to-right
sweep gives the token count at every byte prefix without encoding any of them.
Counts of a text add up over its pre-tokens; the single place where a cut
changes earlier pre-tokens (one white-space character split off a longer run)
is handled as a pre-token of its own.

``count_tokens`` keeps totals and budget answers per document;
``prefix_counts`` keeps the whole curve, so that later questions about any
cut (:func:`tokens_at`, :func:`longest_within`) are look-ups.

Defined cases: a null or empty text has 0 tokens and cut 0; repeated rows each
give a row; other columns of the input are ignored. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.bpe_model import BpeModel, read_vocabulary, worker_model
from cardlens.llm.words import chunks, list_parts, per_row, pre_tokens

SHORT_BYTES = 40  # longer pre-tokens are swept one at a time


def byte_counts(model: BpeModel, word: bytes) -> list[int]:
    """Token count at every byte prefix of a pre-token (index 0: 0)."""
    id_of, longest = model.id_of, model.longest
    n = len(word)
    count, last = [0] * (n + 1), [-1] * (n + 1)
    for i in range(1, n + 1):
        for j in range(max(0, i - longest), i):
            tok = id_of.get(word[j:i])
            if tok is not None and (not j or model.pair_compatible(last[j], tok)):
                last[i], count[i] = tok, count[j] + 1
                break
    return count


def sweep(model: BpeModel, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """:func:`byte_counts` of the words ``data[start:end]``, which follow one
    another, all words in step: the token count up to each place of ``data``."""
    size = end - start
    first = np.repeat(start, size)
    tail = model.longest_suffixes(data, first)
    shorter = model.suffixes[-1]
    last, count = np.full(len(data), -1), np.zeros(len(data), np.int64)
    by_size = start[np.argsort(-size, kind="stable")]
    words_over = np.searchsorted(np.sort(-size), -np.arange(int(size.max(initial=0))), "left")
    for k, n in enumerate(words_over.tolist()):
        at = by_size[:n] + k
        tok = tail[at]
        while len(at):
            before = at - model.size_of[tok]
            ok = before < first[at]  # the token is the whole prefix
            count[at[ok]] = 1
            rest = np.flatnonzero(~ok)
            prev = last[before[rest]]
            pairs, back = np.unique(prev << 32 | tok[rest], return_inverse=True)
            fits = model.pairs_compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]
            good = rest[fits]
            count[at[good]] = count[before[good]] + 1
            ok[good] = True
            last[at[ok]] = tok[ok]
            at, tok = at[~ok], shorter[tok[~ok]]
    return count


def totals(model: BpeModel, words: pa.Array) -> np.ndarray:
    """Tokens of each whole pre-token."""
    raw = words.cast(pa.binary())
    sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(raw), np.int64)
    short = np.flatnonzero(sizes <= SHORT_BYTES)
    data = np.frombuffer(b"".join(raw.take(pa.array(short)).to_pylist()), np.uint8)
    end = np.cumsum(sizes[short])
    if len(short):
        out[short] = sweep(model, data, end - sizes[short], end)[end - 1]
    for k in np.flatnonzero(sizes > SHORT_BYTES).tolist():
        out[k] = byte_counts(model, raw[k].as_py())[-1]
    for text in model.special:
        if (at := pc.index(words, pa.scalar(text, words.type)).as_py()) >= 0:
            out[at] = 1
    return out


def char_counts(model: BpeModel, word: str) -> list[int]:
    """:func:`byte_counts` at character prefixes; a special string is one
    token once it is whole, and ordinary text before."""
    raw = word.encode()
    count = byte_counts(model, raw)
    ends, at = [0], 0
    for c in word:
        at += len(c.encode())
        ends.append(at)
    out = [count[e] for e in ends]
    if word in model.special:
        out[-1] = 1
    return out


def total(model: BpeModel, word: str) -> int:
    """Tokens of one whole pre-token."""
    return char_counts(model, word)[-1]


def curve(model: BpeModel, words: list[str]) -> np.ndarray:
    """Token count of every character prefix of a text, given its pre-tokens.

    A prefix that ends one white-space character into a pre-token that follows
    a white-space run joins that run. A prefix that ends inside a special
    string is plain text, whose pre-tokens may join those before it; these few
    cuts are not part of the curve and get the count at the next whole one."""
    parts, base, before = [np.zeros(1, np.int64)], 0, ""
    for w in words:
        c = np.asarray(char_counts(model, w)[1:], np.int64)
        if w in model.special:
            c[:] = 1
        c += base
        if before.isspace() and before not in model.special and w[0].isspace():
            c[0] = base - total(model, before) + total(model, before + w[0])
        parts.append(c)
        base += total(model, w)
        before = w
    return np.concatenate(parts)


def longest_within(model: BpeModel, words: list[str], totals: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of whole or part pre-tokens that has
    at most ``budget`` tokens."""
    ends = np.cumsum(totals)
    k = int(np.searchsorted(ends, budget, "right"))  # pre-tokens wholly within
    done = sum(map(len, words[:k]))
    if k == len(words):
        return done
    lead = max(0, k - 1)  # the run before may join the cut
    spent = int(ends[lead - 1]) if lead else 0
    tail = curve(model, words[lead : k + 1])
    inside = int(np.flatnonzero(tail <= budget - spent)[-1])
    return done - sum(map(len, words[lead:k])) + inside


def tokens_at(counts: Column, cut: Column) -> Column:
    """Tokens of the first ``cut`` characters, from a stored curve."""
    return F.get(counts, F.least(cut, F.size(counts) - 1))


def _prepare(docs: DataFrame, path: str, id_col: str, text_col: str):
    spec = read_vocabulary(path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        pre_tokens(text, [s for s, _ in spec["special"]]).alias("words"),
    )
    return words, docs.sparkSession.sparkContext.broadcast(spec)


def count_tokens(
    docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit, cut_chars``: ``cut_chars`` is
    the length of the longest prefix with at most ``limit`` tokens."""
    words, spec = _prepare(docs, path, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path, spec.value)
        for batch in batches:
            for part in chunks(batch, "words"):
                flat, offsets = list_parts(part.column("words"))
                coded = flat.dictionary_encode()
                each = totals(model, coded.dictionary)
                at = coded.indices.to_numpy()
                sizes = each[at]
                n = per_row(sizes, offsets)
                chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)
                lengths = chars.astype(np.int64)[at]
                cut = per_row(lengths, offsets)
                for k in np.flatnonzero(n > limit).tolist():
                    a, b = int(offsets[k]), int(offsets[k + 1])
                    # a pre-token has one token at least: later ones can't be within
                    b = min(b, a + limit + 1)
                    cut[k] = longest_within(model, flat[a:b].to_pylist(), sizes[a:b], limit)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("n_bytes"), pa.array(n), pa.array(n > limit), pa.array(cut)],
                    ["id", "n_bytes", "n_tokens", "over_limit", "cut_chars"],
                )

    out = words.mapInArrow(
        run, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    )
    return out.withColumnRenamed("id", id_col)


def prefix_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, counts array<int>``: tokens at every character prefix."""
    words, spec = _prepare(docs, path, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path, spec.value)
        for batch in batches:
            for part in chunks(batch, "words", 100_000):
                curves = [curve(model, w) for w in part.column("words").to_pylist()]
                rows = pa.array([c.astype(np.int32) for c in curves], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("id"), rows], ["id", "counts"])

    out = words.mapInArrow(run, f"id {id_type}, counts array<int>")
    return out.withColumnRenamed("id", id_col)
