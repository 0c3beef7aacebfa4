"""One registered query per operator, with its production parameters.

Every query reads its whole table and returns one row per row of it; the
operators themselves have more general interfaces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import (
    bpe_codec,
    conversation_repair,
    exact_dedup,
    langid,
    mixing,
    nearest,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    token_counts,
    url_filter,
    warc,
)
from cardlens.llm.secret_scan import BASE_RULES, MORE_RULES

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
MIN_PAYLOAD = 100
SHINGLE_WORDS, MAX_BITS = 3, 2
QUERY_EVERY, NEIGHBOURS = 20, 20
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
# fixed values: the abuse words of the toxic labelled documents
ABUSE = r"(?i)\b(scum|worthless|disgusting|trash|pathetic|idiot|stupid|clown|loser|moron)\b"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of the ids and of the text."""
    docs = read(spark, sf_dir, "documents")
    return bpe_codec.round_trip(docs, public_tokenizers.path(TOKENIZER))


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, read the archives back."""
    pages = read(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, warc.archive_folder(pages), MIN_PAYLOAD)
    id_type = pages.schema["page_id"].dataType
    return warc.read_archives(manifest).select(
        F.col("page_id").cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents: snapshot, static filters, byte checks."""
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by cross-parsing."""
    return langid.identify(read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components of all documents."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the longest prefix within the limit."""
    docs = read(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability of every document after raking to tempered margins."""
    docs = read(spark, sf_dir, "documents")
    out = mixing.calibrate(docs, mixing.margins_of(docs), ceilings=mixing.TARGETS)
    return out.select(
        "doc_id",
        F.col("_mix_topic").alias("topic"),
        F.col("_mix_tokens").alias("n_tokens"),
        F.round("_mix_probability", 6).alias("probability"),
        mixing.sampled().alias("kept"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through the blob ledger, in two versions: even ids, then all others,
    of which only blobs that the first version had not are scanned (``n_skipped``: pairs left out)."""
    docs = read(spark, sf_dir, "documents")
    rules = BASE_RULES + MORE_RULES
    even = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    first, rest = docs.filter(even), docs.filter(~even)
    old, new = secret_scan.scan_versions([first, rest], rules)
    ledger = old.unionByName(new)
    # a pair of the second version was skipped where its blob is in the first one's ledger
    kinds = {secret_scan.version_key(r) for r in rules}
    known = old.filter(F.col("rule").isin(kinds)).groupBy("blob").agg(F.count("*").alias("n_known"))
    found = secret_scan.findings(docs, ledger, rules, known=known)
    base = [r.kind for r in BASE_RULES]
    return found.select(
        "doc_id",
        F.when(even, 0).otherwise(F.coalesce("n_known", F.lit(0))).cast("long").alias("n_skipped"),
        *(F.size(k).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text([r.kind for r in rules]).alias("spans"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the likelihood-ratio verdict of every document."""
    out = quality.judge_by_labels(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.withColumn("score", F.round("score", 6))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; listed are the canonical URLs of pages with abuse."""
    pages = read(spark, sf_dir, "pages")
    bad = pages.filter(F.rlike("html", F.lit(ABUSE)) & F.contains("url", F.lit("://")))
    listed = bad.select(url_filter.canonical(F.col("url")).alias("url_key"))
    return url_filter.judge(pages, URL_RULES, listed)


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, F.col("id") % QUERY_EVERY == 0, NEIGHBOURS)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least-cost repair of every conversation after the contract's damage."""
    rows = conversation_repair.damage(read(spark, sf_dir, "conversations"))
    found = conversation_repair.repair(rows, gone_col="_gone")
    at_hand = F.col("repaired").isNotNull()
    whole = found.conversations.filter(at_hand).withColumn("repaired_sha256", F.sha2("repaired", 256))
    of_pieces = conversation_repair.text_digests(found.pieces).withColumnsRenamed(
        {"conv_id": "_conv", "sha256": "repaired_sha256"}
    )
    long = found.conversations.filter(~at_hand)
    long = long.join(of_pieces.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return whole.unionByName(long).drop("repaired")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, with the contract's planted periods."""
    docs = read(spark, sf_dir, "documents")
    return periodic_runs.periodic_runs(docs, source=periodic_runs.planted).drop("runs")


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_simhash": op5_simhash,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_nearest": op11_nearest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

# DuckDB SQL where SQL can express the whole result
ORACLE = {
    "op2_warc_round_trip": f"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= {MIN_PAYLOAD}
                           THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM f
    """,
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
}


def _sql_secrets() -> str:
    """Spans from the pieces between matches, as the operator does, in DuckDB SQL."""
    rules = BASE_RULES + MORE_RULES
    found, spans = [], []
    for r in rules:
        pattern = r.pattern.replace("'", "''")
        found.append(
            f"regexp_extract_all(t, '{pattern}', 0) AS h_{r.kind}, "
            f"regexp_extract_all(t, '{pattern}', {r.value}) AS v_{r.kind}, "
            f"string_split_regex(t, '{pattern}') AS g_{r.kind}"
        )
        gaps = f"list_sum(list_transform(g_{r.kind}[1:i], lambda g: length(g)))"
        hits = f"coalesce(list_sum(list_transform(h_{r.kind}[1:i - 1], lambda h: length(h))), 0)"
        one = (
            f"{{'s': ({gaps} + {hits})::BIGINT, 'n': length(h_{r.kind}[i]), "
            f"'v': length(v_{r.kind}[i])}}"
        )
        every = f"list_transform(range(1, len(h_{r.kind}) + 1), lambda i: {one})"
        spans.append(f"list_filter({every}, lambda x: x.v >= {r.least}) AS k_{r.kind}")

    def text(some) -> str:
        parts = ", ".join(
            f"list_transform(k_{r.kind}, lambda x: {{'s': x.s, 'o': {i}, "
            f"'t': '{r.kind}:' || x.s || ':' || (x.s + x.n)}})"
            for i, r in enumerate(some)
        )
        joined = f"list_transform(list_sort(flatten([{parts}])), lambda x: x.t)"
        return f"coalesce(array_to_string({joined}, ','), '')"

    counts = ", ".join(f"len(k_{r.kind})::BIGINT AS n_{r.kind}" for r in BASE_RULES)
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        f AS (SELECT doc_id, t, {", ".join(found)} FROM d),
        s AS (SELECT doc_id, t, {", ".join(spans)} FROM f)
        SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 0
                   WHEN EXISTS (SELECT 1 FROM documents e WHERE e.doc_id % 2 = 0 AND coalesce(e.text, '') = s.t)
                   THEN {len(rules)} ELSE 0 END::BIGINT AS n_skipped,
               {counts}, sha256({text(BASE_RULES)}) AS base_sha256, {text(rules)} AS spans FROM s
    """


ORACLE["op8_secrets"] = _sql_secrets()
ORACLE["op7_mixing"] = mixing.duckdb_sql("documents", mixing.TARGETS) + """
    SELECT doc_id, topic, n_tokens, round(probability, 6) AS probability, kept FROM mixed
"""
ORACLE["op10_url_filter"] = url_filter.duckdb_sql("pages", URL_RULES, ABUSE)
