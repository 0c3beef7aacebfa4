"""Whole texts -> pre-token lists in the JVM, and Arrow helpers over such lists."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlens.llm.bpe_model import WORD_PATTERN

# Pre-tokens handled at once by a worker: bounds its memory whatever the batch.
CHUNK_WORDS = 500_000


def pre_tokens(text: Column, special: list[str]) -> Column:
    """Array of pre-tokens of a whole text (null: none). Special strings are
    cut out first and stand alone, as the library does; no pre-token can
    equal one by accident because pre-tokens never mix letters and signs."""

    def pieces(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(WORD_PATTERN), 0)

    text = F.coalesce(text, F.lit(""))
    if not special:
        return pieces(text)
    either = "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
    marks = F.regexp_extract_all(text, F.lit(f"({either})"), 1)

    def with_mark(part: Column, i: Column) -> Column:
        return F.when(i > 0, F.concat(F.array(F.get(marks, i - 1)), pieces(part))).otherwise(
            pieces(part)
        )

    parts = F.transform(F.split(text, either, -1), with_mark)
    return F.when(F.rlike(text, F.lit(either)), F.flatten(parts)).otherwise(pieces(text))


def chunks(batch: pa.RecordBatch, list_col: str, size: int = CHUNK_WORDS) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` list items each."""
    col = batch.column(list_col)
    ends = col.offsets.to_numpy(zero_copy_only=False)[1:] - col.offsets[0].as_py()
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def list_parts(col: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """Items of a list column and row offsets that start at 0."""
    offsets = col.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return col.flatten(), offsets - offsets[0]


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the items of each row."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]
