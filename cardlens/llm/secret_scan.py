"""Secret scans over an incremental ledger of content-addressed blobs.

* Every version of every path is addressed by the SHA-256 of its content; one
  row of each *blob* represents all its copies.
* The *ledger* holds (blob, rule version) pairs that were scanned, with what was
  found. A scan takes only pairs that the ledger has not: a blob seen under
  another path or in an earlier run is not read again, a changed rule reads all
  blobs for that rule only.
* *Findings* join back to all paths of their blob.

Native throughout: a rule is a Java regular expression; spans come from the
lengths of what lies between matches (``split``) and of the matches
(``regexp_extract_all``), which the same pattern cuts alike.

Defined cases: a null text is the empty blob, which has no findings; repeated
rows and copies each get their blob's findings; a null id is a path like any
other; other columns are ignored; an empty table gives an empty result and an
empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut

SPANS = "array<struct<start:int,stop:int>>"
BLOCK_MATCHES = 128


@dataclass(frozen=True)
class Rule:
    """``pattern`` without capturing groups but the one in ``value`` (0: the whole
    match), which must have ``least`` characters; ``hint`` is a cheap test that holds for
    every text with a match."""

    kind: str
    version: int
    pattern: str
    value: int
    least: int
    hint: str


# fixed values: the three base kinds, in their order
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
        r"[:=]",
    ),
    # the least length stands in the pattern where a too short run can't hold a longer one
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20, r"AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
)
# what the ledger adds to the base kinds
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, r"-----BEGIN "),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, r"gh[pousr]_"),
)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches of a rule in code points, end exclusive;
    matches whose value is too short are consumed but not reported."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), 0)
    value = F.regexp_extract_all(text, F.lit(rule.pattern), rule.value) if rule.value else found
    gaps = F.split(text, rule.pattern, -1)
    sizes = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"), value.alias("value")),
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["value"]).alias("value")
        ),
    )
    every = _bound(sizes, lambda found: _placed(found, rule.least))
    return F.when(F.rlike(text, F.lit(rule.hint)), every).otherwise(F.array().cast(SPANS))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(sizes: Column, least: int) -> Column:
    """Spans from the lengths of gaps and matches. Arrays grow by copying, so matches are taken in
    blocks: lengths of blocks first, then the spans of each block from where it begins."""
    last = F.floor((F.size(sizes) - 1) / BLOCK_MATCHES).cast("int")
    starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: F.slice(sizes, b * BLOCK_MATCHES + 1, BLOCK_MATCHES))

    def length(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda acc, x: acc + x["gap"] + x["hit"])

    def begins(found: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))

        def step(acc: Column, block: Column) -> Column:
            grown = F.concat(acc["all"], F.array(acc["at"]))
            return F.struct((acc["at"] + length(block)).alias("at"), grown.alias("all"))

        return F.aggregate(found, zero, step, lambda acc: acc["all"])

    def spans_of(block: Column, begin: Column) -> Column:
        zero = F.struct(begin.alias("at"), F.array().cast(SPANS).alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            one = F.array(F.struct(start.alias("start"), (start + x["hit"]).alias("stop")))
            grown = F.when(x["value"] >= least, F.concat(acc["spans"], one)).otherwise(acc["spans"])
            return F.struct((start + x["hit"]).alias("at"), grown.alias("spans"))

        return F.aggregate(block, zero, step, lambda acc: acc["spans"])

    return _bound(blocks, lambda found: F.flatten(F.zip_with(found, begins(found), spans_of)))


def version_key(rule: Rule) -> str:
    return f"{rule.kind}:{rule.version}"


def scan(
    docs: DataFrame,
    rules: tuple[Rule, ...],
    ledger: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """New ledger rows ``blob, rule, spans``, written, for the (blob, rule version)
    pairs of ``docs`` that ``ledger`` has not; one row even where nothing is found.
    Copies collapse in the partial aggregation before anything is shuffled; of each
    unseen blob one text is read."""
    wanted = F.array(*(F.lit(version_key(r)) for r in rules))
    paths = docs.select(F.col(id_col).alias("id"), blob_of(F.col(text_col)).alias("blob"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id"))
    todo = paths.groupBy("blob").agg(first.alias("first")).withColumn("due", wanted)
    if ledger is not None:
        known = ledger.groupBy("blob").agg(F.collect_set("rule").alias("known"))  # a few per blob
        due = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
        todo = todo.join(known, "blob", "left").withColumn("due", due).filter(F.size("due") > 0)
    todo = todo.select(F.col("blob").alias("todo_blob"), F.col("first.id").alias("todo_id"), "due")

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        blob_of(F.col(text_col)).alias("blob"),
    )
    one = rows.join(todo, (F.col("blob") == F.col("todo_blob")) & F.col("id").eqNullSafe(F.col("todo_id")))
    done = [
        F.when(
            F.array_contains("due", version_key(r)),
            F.struct(F.lit(version_key(r)).alias("rule"), spans(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ]
    found = one.select("blob", F.explode(F.array_compact(F.array(*done))).alias("row"))
    # an id that is repeated with the same text gives its rows twice
    return cut(found.select("blob", "row.rule", "row.spans").dropDuplicates(["blob", "rule"]), "ledger")


def findings(
    docs: DataFrame,
    ledger: DataFrame,
    rules: tuple[Rule, ...],
    id_col: str = "doc_id",
    text_col: str = "text",
    known: DataFrame | None = None,
) -> DataFrame:
    """Every path with its blob's findings: ``id_col, blob`` and one array of
    ``start, stop`` per rule, named after its kind. Paths carry no text. ``known``
    may bring more columns per blob."""
    kinds = {version_key(r): r.kind for r in rules}
    some = ledger.filter(F.col("rule").isin(list(kinds)) & (F.size("spans") > 0))
    none = F.array().cast(SPANS)
    by_blob = some.groupBy("blob").agg(
        *(F.coalesce(F.max(F.when(F.col("rule") == key, F.col("spans"))), none).alias(kind) for key, kind in kinds.items())
    )
    if known is not None:
        by_blob = by_blob.join(known, "blob", "full")
    paths = docs.select(F.col(id_col), blob_of(F.col(text_col)).alias("blob"))
    empty = F.col("blob") == F.sha2(F.lit(""), 256)
    found = paths.filter(~empty).join(by_blob, "blob", "left")
    # of the empty blob, which any number of paths may hold, there is one row at most
    others = [c for c in by_blob.columns if c != "blob"]
    of_empty = by_blob.filter(empty).agg(F.max(F.struct(*others)).alias("row")).scalar()
    found = found.unionByName(paths.filter(empty).withColumn("_row", of_empty).select("*", "_row.*").drop("_row"))
    more = [c for c in by_blob.columns if c != "blob" and c not in kinds.values()]
    return found.select(id_col, "blob", *more, *(F.coalesce(F.col(k), none).alias(k) for k in kinds.values()))


def scan_versions(
    versions: list[DataFrame], rules: tuple[Rule, ...], id_col: str = "doc_id", text_col: str = "text"
) -> list[DataFrame]:
    """Ledger rows of each version in turn: a version is scanned for the pairs that no earlier one had."""
    ledgers: list[DataFrame] = []
    for docs in versions:
        known = None
        for one in ledgers:
            known = one if known is None else known.unionByName(one)
        ledgers.append(scan(docs, rules, known, id_col, text_col))
    return ledgers


def _named(kind: str, order: int) -> Column:
    def one(s: Column) -> Column:
        text = F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string"))
        return F.struct(s["start"].alias("start"), F.lit(order).alias("order"), text.alias("text"))

    return F.transform(F.col(kind), one)


def span_text(kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans of some kinds, by start, then kind as listed."""
    named = [_named(kind, order) for order, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*named)), lambda s: s["text"]), ",")
