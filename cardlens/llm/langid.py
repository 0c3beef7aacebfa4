"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton of the distinct words of a bounded sample of
labelled texts accepts exactly the substrings of that text. A document's words
(with their boundaries) are cut into phrases, each the longest match from
where the last one ended; a phrase costs ``log2`` of the automaton's text
length, and the language that needs the fewest such bits per character wins.

Words come from the JVM; a worker parses the distinct words of a chunk in step,
once per language, and adds up per document. No shuffle but for the sample.

Sample (documented bound): at most ``TRAIN_DOCS`` texts per language, of any length, those
with the smallest hash of their id; of each the first ``TRAIN_CHARS`` code points from its
first letter on (and the rest of the last word) are learned. Every
document is predicted from its whole text.

Defined cases: a null text or one without a letter is ``und`` with score 0;
so is every text if nothing is labelled; ties go to the first language in
alphabetical order; a null id is never learned from and never held out;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cardlens.llm.words import chunks, list_parts

FOLDS = 5  # fold 0 is held out
TRAIN_DOCS = 100
TRAIN_CHARS = 4000
LETTER = r"\p{L}"
WORD = r"\p{L}{1,32}"  # a longer run of letters counts as several words
UNKNOWN = "und"
EDGE = " "  # stands at both ends of a word


def letters_of(text: Column) -> Column:
    """The words of a whole text, in lower case (null: none)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


class SuffixAutomaton:
    """All substrings of a text, as a dense table of steps (state 0: start)."""

    def __init__(self, text: str):
        step, link, size = [{}], [-1], [0]
        last = 0
        for c in text:
            cur = len(step)
            step.append({})
            link.append(0)
            size.append(size[last] + 1)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if size[p] + 1 == size[q]:
                    link[cur] = q
                else:
                    twin = len(step)
                    step.append(dict(step[q]))
                    link.append(link[q])
                    size.append(size[p] + 1)
                    link[q] = link[cur] = twin
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = twin
                        p = link[p]
            last = cur
        alphabet = sorted(set(text))
        self.chars = np.array([ord(c) for c in alphabet], np.uint32)
        column = {c: i for i, c in enumerate(alphabet)}
        # one more column: characters that the text has not
        self.table = np.full((len(step), len(alphabet) + 1), -1, np.int32)
        for state, steps in enumerate(step):
            for c, to in steps.items():
                self.table[state, column[c]] = to
        self.bits = np.log2(max(2, len(text)))

    def columns(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.chars):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        return np.where(self.chars[at] == codes, at, len(self.chars))

    def phrases(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Longest-match phrases that each ``codes[start:end]`` needs, all in step."""
        column = self.columns(codes)
        out = np.zeros(len(start), np.int64)
        word = np.flatnonzero(end > start)
        at, stop, state = start[word].copy(), end[word], np.zeros(len(word), np.int64)
        while len(word):
            to = self.table[state, column[at]]
            on = to >= 0
            cut = ~on  # a phrase ends before this character, or is this unknown one
            out[word[cut]] += 1
            at = at + (on | (state == 0))
            state = np.where(on, to, 0)
            over = at >= stop
            out[word[over & (state > 0)]] += 1
            go = ~over
            word, at, stop, state = word[go], at[go], stop[go], state[go]
        return out


def bits_per_word(models: list[SuffixAutomaton], words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Parsing cost of each word under each model (rows: words), and the
    characters of each word, boundaries included."""
    texts = [EDGE + w + EDGE for w in words.to_pylist()]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    end = np.cumsum(size)
    costs = [m.phrases(codes, end - size, end) * m.bits for m in models]
    return np.stack(costs, axis=1) if costs else np.zeros((len(texts), 0)), size


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, str]:
    """Sample text of each language: its distinct words in order. Brought to the
    driver within the bound of the module's docstring."""
    usable = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).filter((fold(F.col("id")) != 0) & F.col("lang").isNotNull())
    usable = usable.filter(F.rlike("text", F.lit(LETTER)))
    learned = rf"(?s){LETTER}.{{0,{TRAIN_CHARS - 1}}}{LETTER}{{0,32}}"
    usable = usable.withColumn("text", F.regexp_extract("text", learned, 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")
    sample = usable.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= TRAIN_DOCS)
    words: dict[str, dict[str, None]] = {}
    for row in sample.select("lang", "k", letters_of(F.col("text")).alias("words")).sort("lang", "k").collect():
        words.setdefault(row.lang, {}).update(dict.fromkeys(row.words))
    return {lang: EDGE + EDGE.join(w) + EDGE for lang, w in sorted(words.items())}


_MODELS: dict[int, list[SuffixAutomaton]] = {}


def _worker_models(samples: dict[str, str]) -> list[SuffixAutomaton]:
    key = hash(tuple(samples.items()))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = [SuffixAutomaton(text) for text in samples.values()]
    return _MODELS[key]


def label_rows(rows: DataFrame, samples: dict[str, str]) -> DataFrame:
    """``rows`` (with their words in ``_lid_words``) with that column replaced by
    ``_lid_lang`` and ``_lid_score``; all other columns pass through. The score is 1 -
    best / second best cost (0: undecided, towards 1: clear; 1 if there is one language)."""
    shared = rows.sparkSession.sparkContext.broadcast(samples)
    kept = [c for c in rows.columns if c != "_lid_words"]
    fields = [f for f in rows.schema.fields if f.name != "_lid_words"]
    schema = StructType([*fields, StructField("_lid_lang", StringType()), StructField("_lid_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _worker_models(shared.value)
        names = np.array([*shared.value, UNKNOWN], object)
        for batch in batches:
            for part in chunks(batch, "_lid_words"):
                best, score = _decide(models, part.column("_lid_words"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(names[best], pa.string()), pa.array(score)],
                    [*kept, "_lid_lang", "_lid_score"],
                )

    return rows.mapInArrow(run, schema)


def _decide(models: list[SuffixAutomaton], lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the winning model (behind the last: none) and score of each row."""
    flat, offsets = list_parts(lists)
    coded = flat.dictionary_encode()
    costs, _ = bits_per_word(models, coded.dictionary)
    at = coded.indices.to_numpy(zero_copy_only=False)
    total = np.zeros((len(lists), len(models)))
    for k in range(len(models)):
        sums = np.concatenate([[0.0], np.cumsum(costs[at, k])])
        total[:, k] = sums[offsets[1:]] - sums[offsets[:-1]]
    known = (offsets[1:] > offsets[:-1]) & bool(models)
    best = np.where(known, total.argmin(axis=1) if models else -1, len(models))
    score = known.astype(float)
    if len(models) > 1:
        low = np.partition(total, 1, axis=1)[:, :2]
        score = np.where(known, 1 - low[:, 0] / np.maximum(low[:, 1], 1e-9), 0.0)
    return best, np.clip(score, 0, 1)


def predict(
    docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, lang_pred, score`` of every row."""
    rows = docs.select(F.col(id_col), letters_of(F.col(text_col)).alias("_lid_words"))
    return label_rows(rows, samples).toDF(id_col, "lang_pred", "score")


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from the labelled folds, predict every document:
    ``id_col, held_out, lang_pred, score``."""
    out = predict(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col)
    held = F.coalesce(fold(F.col(id_col)) == 0, F.lit(False))
    return out.select(id_col, held.alias("held_out"), "lang_pred", "score")
