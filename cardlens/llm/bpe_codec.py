"""BPE encoding and decoding: speculate, verify, repair.

Pre-tokens come from the JVM (``regexp_extract_all``). A worker takes the
distinct pre-tokens of a chunk as flat arrays and

1. proposes tokens by greedy longest match, all words in step,
2. tests every adjacent pair of all proposals at once (``pairs_compatible``),
3. merges exactly only the words with a failing pair.

No shuffle and no state between chunks: a lost executor costs its tasks only.

Defined cases: a null or empty text has no ids and decodes to ``""``; repeated
rows each give a row; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.bpe_model import BpeModel, read_vocabulary, worker_model
from cardlens.llm.words import chunks, list_parts, pre_tokens

SHORT_BYTES = 40  # longer words are merged one at a time


def encode_words(model: BpeModel, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat token ids of all pre-tokens, and the number of ids of each."""
    words = words.cast(pa.binary())
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    start, end = ends[:-1].astype(np.int64), ends[1:].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
    if not len(words) or start[0] == end[-1]:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)

    owner, token = model.greedy(data, start, end)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    pairs, back = np.unique(token[inside] << 32 | token[inside + 1], return_inverse=True)
    ok = model.pairs_compatible(pairs >> 32, pairs & 0xFFFFFFFF)
    redo = np.zeros(len(words), bool)
    redo[owner[inside[~ok[back]]]] = True
    size = end - start
    parts = []
    for text, i in model.special.items():
        at = pc.index(words, pa.scalar(text.encode(), pa.binary())).as_py()
        if at >= 0:
            size[at] = 0  # no word to merge
            redo[at] = True
            parts.append((np.array([at]), np.array([i])))
    for low, high in ((0, 8), (8, 14), (14, SHORT_BYTES)):
        some = np.flatnonzero(redo & (size > low) & (size <= high))
        own, tok = model.exact_short(data, start[some], end[some])
        parts.append((some[own], tok))
    for k in np.flatnonzero(redo & (size > SHORT_BYTES)).tolist():
        tok = model.exact(data[start[k] : end[k]].tobytes())
        parts.append((np.full(len(tok), k), np.asarray(tok, np.int64)))
    keep = ~redo[owner]
    owner = np.concatenate([owner[keep], *(p[0] for p in parts)])
    token = np.concatenate([token[keep], *(p[1] for p in parts)])
    flat = token[np.argsort(owner, kind="stable")].astype(np.int32)
    return flat, np.bincount(owner, minlength=len(words))


def encode_lists(model: BpeModel, col: pa.ListArray) -> pa.ListArray:
    """Lists of pre-tokens -> lists of ids."""
    words, offsets = list_parts(col)
    coded = words.dictionary_encode()
    flat, sizes = encode_words(model, coded.dictionary)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    taken = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)).take(coded.indices)
    starts = taken.offsets.to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(starts[offsets] - starts[0], pa.int32()), taken.flatten())


def join_ids(ids: pa.ListArray, names: pa.Array, sep: str | bytes) -> pa.Array:
    """Per row, the names of its ids joined by ``sep``."""
    flat, offsets = list_parts(ids)
    named = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(flat))
    return pc.binary_join(named, pa.scalar(sep, names.type))


def decode_lists(model: BpeModel, ids: pa.ListArray) -> list[str]:
    """Lists of ids -> texts; bytes that are no UTF-8 become U+FFFD."""
    joined = join_ids(ids, pa.array(model.bytes_of, pa.binary()), b"")
    return [b.decode("utf-8", "replace") for b in joined.to_pylist()]


def _model_of(df: DataFrame, path: str):
    spec = read_vocabulary(path)
    return path, df.sparkSession.sparkContext.broadcast(spec), [s for s, _ in spec["special"]]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>`` of every whole text."""
    key, spec, special = _model_of(docs, path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(key, spec.value)
        for batch in batches:
            for part in chunks(batch, "words"):
                ids = encode_lists(model, part.column("words"))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], ["id", "ids"])

    words = docs.select(
        F.col(id_col).alias("id"), pre_tokens(F.col(text_col), special).alias("words")
    )
    out = words.mapInArrow(run, f"id {id_type}, ids array<int>")
    return out.select(F.col("id").alias(id_col), "ids")


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` of every list of ids (null: empty text)."""
    key, spec, _ = _model_of(coded, path)
    id_type = coded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(key, spec.value)
        for batch in batches:
            for part in chunks(batch, "ids"):
                text = pa.array(decode_lists(model, part.column("ids")), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("id"), text], ["id", "text"])

    ids = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))
    out = coded.select(F.col(id_col).alias("id"), ids.alias("ids"))
    out = out.mapInArrow(run, f"id {id_type}, text string")
    return out.select(F.col("id").alias(id_col), "text")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids, and digest both: ``id_col, n_tokens long,
    ids_sha256, decoded_sha256`` (one Python pass; the ids stay in the worker)."""
    key, spec, special = _model_of(docs, path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def digest(values) -> pa.Array:
        return pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(key, spec.value)
        decimals = pa.array([str(i).encode() for i in range(len(model.bytes_of))], pa.binary())
        for batch in batches:
            for part in chunks(batch, "words"):
                ids = encode_lists(model, part.column("words"))
                texts = decode_lists(model, ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pc.list_value_length(ids).cast(pa.int64()),
                        digest(join_ids(ids, decimals, b",").to_pylist()),
                        digest(t.encode() for t in texts),
                    ],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    words = docs.select(
        F.col(id_col).alias("id"), pre_tokens(F.col(text_col), special).alias("words")
    )
    out = words.mapInArrow(
        run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return out.withColumnRenamed("id", id_col)
