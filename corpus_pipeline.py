"""Corpus pipeline: five operators of ``cardlens.llm`` over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``; all but the last return the columns
of documents. Every stage works on all that its predecessor kept:

1. ``language_id``    documents without a known language (``und``: no text, no letter) go
2. ``exact_dedup``    one document of each group of equal texts stays
3. ``simhash_dedup``  one document of each near-duplicate component stays
4. ``mixing``         a sample by calibrated probabilities of source, language and topic
5. ``bpe``            token ids' and decoded text's digests of what is left

Rows with the same id and equal text count as one document from stage 2 on;
rows with the same id and different texts stand or fall together in stage 3.
Null ids are an id like any other. Column names that start with ``_lid_``, ``_mix_`` or
``_key`` are reserved: a table that has one is an error.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import bpe_codec, exact_dedup, langid, mixing, simhash
from cardlens.llm.queries import MAX_BITS, SHINGLE_WORDS, TOKENIZER
from cardlens.session import ensure_checkpoint_dir


# rows pass through the language stage whole: Arrow batches are kept small
BATCH_BYTES = 16 << 20


def unreserved(docs: DataFrame) -> DataFrame:
    taken = [c for c in docs.columns if c.lower().startswith(("_lid_", "_mix_", "_key"))]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")
    return docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what no language can be told of; without labelled texts to learn from, only
    texts without a letter. Rows pass through the prediction
    whole, so nothing is shuffled but the training sample."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    samples = langid.learn(unreserved(docs))
    if not samples:
        return docs.filter(F.rlike("text", F.lit(langid.LETTER)))
    rows = docs.withColumn("_lid_words", langid.letters_of(F.col("text")))
    named = langid.label_rows(rows, samples)
    return named.filter(F.col("_lid_lang") != langid.UNKNOWN).select(docs.columns)


def exact_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row that stays of each group of equal texts. The kept keys grow with
    the data and are never broadcast; a repeated row of the one that stays goes
    on the same partitioning, without another shuffle."""

    def key(sha) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha)

    found = exact_dedup.exact_duplicates(unreserved(docs)).filter("kept")
    stay = found.select(key(F.col("text_sha256")).alias("_key"))
    rows = docs.withColumn("_key", key(exact_dedup.digest(F.col("text"))))
    kept = rows.join(stay.hint("merge"), "_key", "left_semi")
    return kept.dropDuplicates(["_key"]).select(docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component."""
    found = simhash.near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = stay.select(F.col("doc_id").alias("kept_id")).hint("merge")
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["kept_id"]), "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents drawn by their cell's probability."""
    rows = mixing.calibrate(docs, mixing.margins_of(docs), ceilings=mixing.TARGETS)
    return rows.filter(mixing.sampled()).select(docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of what is left: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return bpe_codec.round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dups),
    ("simhash_dedup", near_dups),
    ("mixing", mix),
    ("bpe", bpe),
]

# cross-parsing, XXH64 fingerprints and BPE are beyond SQL: tests hold the pipeline
# against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
