"""URL verdicts: host and path rules, then a listed-URL check behind a Bloom filter.

The listed canonical URLs fill a *blocked* Bloom filter: a URL's hash picks one block
of eight 32-bit words and one bit in each word, so a probe touches one block.
The filter is an array literal of bounded size (``MAX_BLOCKS``): a longer list
only lets more URLs through to the exact hash join, which removes every false
positive. URLs that the filter turns away skip the join.

All of it is DataFrame expressions inside code generation.

Defined cases: a URL that is null or has no ``://`` has an empty host and path
and no rule fits it; empty keys are never listed and a URL without a host is never blocked by the list;
of rules of equal length that fit, the one given first wins; an empty list blocks nothing; repeated rows each give
a row; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut

WORDS, WORD_BITS = 8, 32
BITS_PER_URL = 12
MAX_BLOCKS = 1 << 15  # 2 MB as an array of 64-bit words
SALT = 0x47B6137B  # odd multipliers, one per word, follow from it

TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)=[^&#]*"


# -- parts of a URL --------------------------------------------------------------
def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(_ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``/``m.`` and port, path without a closing slash, query
    without tracking parameters; scheme and fragment go."""
    where = F.regexp_replace(F.regexp_replace(host(url), r"^(www|m)\.", ""), r":\d+$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), r"&{2,}", "&")
    query = F.regexp_replace(query, r"^&|&$", "")
    query = F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))
    return F.concat(where, F.regexp_replace(path(url), r"/+$", ""), query)


# -- rules -----------------------------------------------------------------------
def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (``host/path``) that fits, the first given of equals, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(reversed(rules), key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        same = (host_ == name) | F.endswith(host_, F.lit(f".{name}"))
        out = F.when(same & F.startswith(path_, F.lit(f"/{rest}")), rule).otherwise(out)
    return out


# -- Bloom filter ------------------------------------------------------------------
def url_hash(key: Column) -> Column:
    return F.xxhash64(key)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(key, 32), F.lit(blocks)).cast("int")


def _bit(key: Column, word: int) -> Column:
    """The bit (0 to 31) of a key in a word: the high bits of a product."""
    factor = (SALT * (2 * word + 1) ** 5) % 2**31 | 1
    low = key.bitwiseAND(F.lit(0x7FFFFFFF))
    return F.shiftright((low * F.lit(factor)).bitwiseAND(F.lit(0x7FFFFFFF)), 26).cast("int")


def block_count(listed: int) -> int:
    need = max(1, listed * BITS_PER_URL // (WORDS * WORD_BITS))
    return min(MAX_BLOCKS, 1 << (need - 1).bit_length())


def bloom(listed: DataFrame, blocks: int, key: str = "url_key") -> DataFrame:
    """One row, ``words``: the filter of the hashes in ``key``, block after block."""
    key_ = url_hash(F.col(key))
    bits = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key_, w))).alias(f"w{w}") for w in range(WORDS)]
    filled = listed.groupBy(_block(key_, blocks).alias("block")).agg(*bits)
    every = listed.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    words = F.array(*(F.coalesce(F.col(f"w{w}"), F.lit(0)) for w in range(WORDS)))
    rows = every.join(filled, "block", "left").select(F.struct("block", words.alias("words")).alias("row"))
    return rows.agg(F.flatten(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["words"])).alias("words"))


def may_hold(words: Column, blocks: int, hashed: Column) -> Column:
    """False is certain. ``hashed``: :func:`url_hash` of the URL, as a stored column."""
    at = _block(hashed, blocks) * WORDS
    hits = (
        F.call_function("shiftright", F.get(words, at + w), _bit(hashed, w)).bitwiseAND(F.lit(1)) == 1
        for w in range(WORDS)
    )
    return reduce(lambda a, b: a & b, hits)


def listed_among(urls: DataFrame, listed: DataFrame, key: str = "url_key") -> tuple[DataFrame, DataFrame]:
    """``urls`` (with ``url_hash``) split into (listed, not listed) by the keys of ``listed``."""
    listed = cut(listed.select(key).distinct(), "listed")
    n = listed.count()
    if not n:
        return urls.limit(0), urls
    blocks = block_count(n)
    words = cut(bloom(listed, blocks, key), "bloom")
    maybe = urls.withColumn("_maybe", may_hold(words.scalar(), blocks, F.col("url_hash")))
    hit = maybe.filter("_maybe").drop("_maybe")
    return (
        hit.join(listed, key, "left_semi"),
        maybe.filter("not _maybe").drop("_maybe").unionByName(hit.join(listed, key, "left_anti")),
    )


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row. ``listed`` has canonical
    URLs in ``url_key``; where no rule fits, they are blocked and others allowed."""
    rows = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    rows = rows.select(id_col, host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"), canonical(F.col("_url")).alias("url_key"))
    rows = rows.withColumns({"rule": rule_of(F.col("host"), F.col("path"), rules), "url_hash": url_hash(F.col("url_key"))})
    rows = cut(rows, "urls")  # narrow; the parts of a URL are worked out once
    verdict = F.lit(None).cast("string")
    for rule, what in reversed(rules):
        verdict = F.when(F.col("rule") == rule, what).otherwise(verdict)
    ruled = rows.filter("rule is not null").withColumn("verdict", verdict)
    open_ = rows.filter("rule is null")
    blocked, free = listed_among(open_.filter("host <> ''"), listed.filter("url_key <> ''"))
    free = free.unionByName(open_.filter("host = ''"))
    free = free.withColumn("verdict", F.lit("allow"))
    out = ruled.unionByName(blocked.withColumn("verdict", F.lit("block"))).unionByName(free)
    return out.select(id_col, "host", "path", "rule", "verdict")


def duckdb_sql(table: str, rules: list[tuple[str, str]], abuse: str) -> str:
    """The same verdicts as DuckDB SQL (the filter leaves no trace in them)."""
    fits = " ".join(
        f"WHEN (host = '{name}' OR host LIKE '%.{name}') AND starts_with(path, '/{rest}') THEN '{rule}'"
        for rule, (name, _, rest) in (
            (r, r.partition("/")) for r, _ in sorted(rules, key=lambda r: -len(r[0]))
        )
    )
    verdicts = " ".join(f"WHEN rule = '{rule}' THEN '{verdict}'" for rule, verdict in rules)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH u AS (
        SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {table}
    ), h AS (
        SELECT *, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
               regexp_replace(regexp_replace(regexp_replace(
                   regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '{TRACKING}', '', 'g'),
                   '&{{2,}}', '&', 'g'), '^&|&$', '', 'g') AS q
        FROM u
    ), c AS (
        SELECT *, regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':\\d+$', '')
               || regexp_replace(path, '/+$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END AS key,
               CASE {fits} END AS rule
        FROM h
    ), listed AS (SELECT DISTINCT key FROM c WHERE key <> '' AND regexp_matches(coalesce(html, ''), '{abuse}'))
    SELECT page_id, host, path, rule,
           CASE {verdicts} WHEN host <> '' AND key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
    FROM c
    """
