"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed per cell (one per combination of the margins'
values); each round rakes the cell weights to one margin's target shares after
the other, ``w * target / current``, as window sums over the cell table. A
document is then kept with its cell's calibrated probability: raked weight /
token weight, scaled so that the largest is 1 (so nothing is clipped and the
expected token shares of the sample are exactly the raked ones). If that keeps less than
the token budget (``BUDGET``, a share of all tokens), the scale is solved for the
budget and probabilities end at 1: a tiny cell lowers the rate of no other below it.

Rounds go on until every margin is met to ``TOLERANCE`` or the largest error stands still over
``LOOKS`` looks (:func:`finished`); margins that cannot be met are reported as a warning, and
the shares reached are returned beside the result (``report``).

Everything is DataFrame expressions. Documents are shuffled once, as partial
sums per cell; the cell table is written and broadcast to the documents if its measured size is
under Spark's threshold, else joined on a salted key, so that no cell's documents meet in one task.

Targets default to tempered shares, ``share ** temper`` renormalised, which lift
rare values. Given targets are renormalised over the values that occur;
a value without a target keeps its observed share. A ceiling is a target that never lifts: a
value below it keeps its observed share.

Defined cases: null margin values are a value of their own; a document of no tokens
counts in no sum but is kept or dropped by its cell's probability (1 if the cell
has no tokens at all); the draw hashes the id (null: the empty string), so
repeated rows share a draw, and the same document is drawn alike in every
run; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut
from cardlens.operators.joins import checked_broadcast

ROUNDS = 8  # between two looks at the margins
LOOKS = 5
MOST_ROUNDS = 1000
SALTS = 64
TOLERANCE = 1e-5  # of all tokens
BUDGET = 0.7  # of the tokens are kept at least
TEMPER = 0.9
DRAW_BITS = 52
SALT = "mix"

# topics of the query: the first that fits a text
TOPICS = (
    ("licence", r"(?i)licen[sc]e|rights reserved"),
    ("contact", r"@[a-z0-9-]+\.[a-z]"),
    ("noisy", r"[#*$%&|<>!]{2}"),
)
OTHER_TOPIC = "prose"
# a text is noisy by its pairs of symbols per word, not by a single one
LEAST_DENSITY = {"noisy": 0.08}
# ceilings of the query: less noise; sources and languages are tempered
TARGETS = {"topic": {"noisy": 0.01}}


def tokens(text: Column) -> Column:
    """Token weight of a text: its white-space separated words."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return words.cast("long")


def topic(text: Column) -> Column:
    pick = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        fits = F.rlike(text, F.lit(pattern))
        if name in LEAST_DENSITY:
            fits &= F.regexp_count(text, F.lit(pattern)) >= F.lit(LEAST_DENSITY[name]) * tokens(text)
        pick = F.when(F.coalesce(fits, F.lit(False)), name).otherwise(pick)
    return pick


def draw(doc_id: Column) -> Column:
    """Uniform in [0, 1), from the id alone."""
    hexed = F.md5(F.concat(F.lit(SALT), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(hexed, 1, DRAW_BITS // 4), 16, 10).cast("double") / F.lit(float(2**DRAW_BITS))


def rake(
    cells: DataFrame,
    margins: list[str],
    targets: dict[str, dict[str, float]] | None = None,
    rounds: int = ROUNDS,
    temper: float = TEMPER,
    ceilings: dict[str, dict[str, float]] | None = None,
    budget: float = 0.0,
    report: list[DataFrame] | None = None,
) -> DataFrame:
    """Cells (``margins``, ``_mix_tokens``) with ``_mix_probability``. Only sums over
    the whole cell table come to the driver. A margin has targets or ceilings. ``report`` receives a
    DataFrame ``margin, value, target, raked`` of the shares aimed at and reached."""
    size = F.col("_mix_tokens")
    used = cells.filter(size > 0)
    total = used.agg(F.sum(size)).first()[0]
    if not total:
        return cells.withColumn("_mix_probability", F.lit(1.0))
    for m in margins:
        of_value = F.sum(size).over(Window.partitionBy(m))
        share = of_value / F.lit(float(total))
        given = (targets or {}).get(m)
        want = F.pow(share, F.lit(float(temper)))
        most = (ceilings or {}).get(m)
        if given or most:
            table = F.create_map(*(F.lit(x) for kv in (given or most).items() for x in kv))
            want = F.try_element_at(table, F.col(m))
            want = F.coalesce(want if given else F.least(want, share), share)
        used = used.withColumn(f"_want_{m}", want).withColumn(f"_part_{m}", size / of_value)
    # a value's target counts once, spread over its cells by their tokens
    norm = used.agg(*(F.sum(F.col(f"_want_{m}") * F.col(f"_part_{m}")).alias(m) for m in margins)).first()
    weight = F.col("_mix_weight")
    used = used.withColumn("_mix_weight", size / F.lit(float(total)))
    done, errors = 0, []
    while True:
        for _ in range(rounds):
            for m in margins:
                now = F.sum(weight).over(Window.partitionBy(m))
                used = used.withColumn("_mix_weight", weight * F.col(f"_want_{m}") / F.lit(norm[m]) / now)
        used, done = cut(used, "raked"), done + rounds
        error = _margin_errors(used, margins, norm)
        errors.append(max(error.values()))
        if finished(errors) or done >= MOST_ROUNDS:
            break
    if report is not None:
        report.append(_reached(used, margins, norm))
    if errors[-1] > TOLERANCE:
        missed = ", ".join(f"{m.removeprefix('_mix_')} by {e:.2g}" for m, e in error.items() if e > TOLERANCE)
        warnings.warn(f"margins not met after {done} rounds: {missed}", RuntimeWarning, stacklevel=2)
    raked = used.select(*margins, size.alias("_mix_size"), weight.alias("_mix_raked"), (weight / size).alias("_mix_lift"))
    scale = _scale(raked, float(total), budget)
    fits = reduce(lambda a, b: a & b, (cells[m].eqNullSafe(raked[m]) for m in margins))
    lift = F.coalesce(F.least(F.lit(1.0), F.col("_mix_lift") / F.lit(scale)), F.lit(1.0))
    return cells.join(raked, fits, "left").select(*(cells[m] for m in margins), size, F.round(lift, 9).alias("_mix_probability"))


def finished(errors: list[float]) -> bool:
    """Whether raking ends after looks with these largest errors: met, or standing still. Errors may rise
    for a while on the way down; only margins that cannot be met make them stay as they are."""
    last = errors[-LOOKS:]
    return errors[-1] <= TOLERANCE or (len(last) == LOOKS and max(last) - min(last) <= 1e-3 * max(last))


def _reached(used: DataFrame, margins: list[str], norm) -> DataFrame:
    rows = [
        used.groupBy(F.col(m).cast("string").alias("value")).agg(
            (F.first(f"_want_{m}") / F.lit(norm[m])).alias("target"), F.sum("_mix_weight").alias("raked")
        ).select(F.lit(m.removeprefix("_mix_")).alias("margin"), "value", "target", "raked")
        for m in margins
    ]
    return reduce(DataFrame.unionByName, rows)


def _margin_errors(used: DataFrame, margins: list[str], norm) -> dict[str, float]:
    """Largest difference of a value's share from its target, of each margin."""
    now = {m: F.sum("_mix_weight").over(Window.partitionBy(m)) for m in margins}
    rows = used.select(*(F.abs(now[m] - F.col(f"_want_{m}") / F.lit(norm[m])).alias(m) for m in margins))
    return rows.agg(*(F.max(m).alias(m) for m in margins)).first().asDict()


def _scale(raked: DataFrame, total: float, budget: float) -> float:
    """The lift that stands for probability 1: the largest, or the one below it that
    keeps ``budget`` of the tokens. Cells reach probability 1 one after the other, so the
    scale only falls until the set of them stands."""
    lift = F.col("_mix_lift")
    scale = raked.agg(F.max(lift)).first()[0]
    if 1 / scale >= budget * total:
        return scale
    full = lift >= F.lit(scale)
    while True:
        size, weight = raked.agg(
            F.sum(F.when(full, F.col("_mix_size")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("_mix_raked")))
        ).first()
        rest = budget * total - float(size)
        if rest <= 0 or not weight or weight / rest >= scale * (1 - 1e-12):
            return scale
        scale = weight / rest
        full = lift >= F.lit(scale)


def calibrate(
    docs: DataFrame,
    margins: dict[str, Column],
    targets: dict[str, dict[str, float]] | None = None,
    rounds: int = ROUNDS,
    temper: float = TEMPER,
    id_col: str = "doc_id",
    text_col: str = "text",
    ceilings: dict[str, dict[str, float]] | None = None,
    budget: float = BUDGET,
    report: list[DataFrame] | None = None,
) -> DataFrame:
    """``docs`` with ``_mix_tokens``, ``_mix_probability`` and ``_mix_draw``;
    a document is in the sample where the draw is below the probability. Column names
    that start with ``_mix_`` are reserved: they raise."""
    taken = [c for c in docs.columns if c.lower().startswith("_mix_")]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")
    names = [f"_mix_{m}" for m in margins]
    rows = docs.withColumns(
        dict(zip(names, margins.values(), strict=True))
        | {"_mix_tokens": tokens(F.col(text_col)), "_mix_draw": draw(F.col(id_col))}
    )
    sums = rows.groupBy(*names).agg(F.sum("_mix_tokens").alias("_mix_tokens"))
    by_name, most = ({f"_mix_{m}": t for m, t in (x or {}).items()} for x in (targets, ceilings))
    chances = rake(cut(sums, "cells"), names, by_name, rounds, temper, most, budget, report)
    chances = chances.select(*(F.col(n).alias(f"{n}_cell") for n in names), "_mix_probability")
    fits = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"{n}_cell")) for n in names))
    side, small = checked_broadcast(chances)
    if small:
        return rows.join(side, fits).drop(*(f"{n}_cell" for n in names))
    salted = rows.withColumn("_mix_salt", F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(SALTS)).cast("int"))
    side = side.withColumn("_mix_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = salted.join(side, fits & (F.col("_mix_salt") == F.col("_mix_copy")))
    return found.drop("_mix_salt", "_mix_copy", *(f"{n}_cell" for n in names))


def margins_of(docs: DataFrame) -> dict[str, Column]:
    """The margins of the documents table: source, language and topic."""
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}


def sampled() -> Column:
    return F.col("_mix_draw") < F.col("_mix_probability")


def duckdb_sql(
    table: str,
    targets: dict[str, dict[str, float]] | None = None,
    rounds: int = ROUNDS,
    temper: float = TEMPER,
) -> str:
    """The same raking as DuckDB SQL, with ``targets`` as ceilings: common table expressions that end in
    ``mixed`` (all columns of ``table`` and topic, n_tokens, probability, kept). It makes ``rounds`` rounds and
    scales to the largest lift: the operator's result where they meet the margins and keep the budget."""
    words = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"

    def fits(name: str, pattern: str) -> str:
        found = f"regexp_matches(coalesce(text, ''), '{pattern}')"
        if name in LEAST_DENSITY:
            pairs = f"len(regexp_extract_all(coalesce(text, ''), '{pattern}'))"
            found += f" AND {pairs} >= CAST({LEAST_DENSITY[name]} AS DOUBLE) * {words}"
        return found

    pick = " ".join(f"WHEN {fits(name, pattern)} THEN '{name}'" for name, pattern in TOPICS)
    margins = ("source", "lang", "topic")
    steps, last = [], "w0"
    for r in range(rounds):
        for m in margins:
            name = f"w{r}_{m}"
            steps.append(
                f"{name} AS (SELECT * REPLACE (w * want_{m} / (SELECT norm_{m} FROM norms)"
                f" / sum(w) OVER (PARTITION BY {m}) AS w) FROM {last})"
            )
            last = name
    def want(m: str) -> str:
        share = f"sum(tokens) OVER (PARTITION BY {m}) / (SELECT sum(tokens) FROM cells)"
        given = (targets or {}).get(m)
        if not given:
            return f"pow({share}, {temper})"
        return f"CASE {m} " + " ".join(f"WHEN '{v}' THEN least({t}, {share})" for v, t in given.items()) + f" ELSE {share} END"

    wants = ", ".join(
        f"{want(m)} AS want_{m}, tokens / sum(tokens) OVER (PARTITION BY {m}) AS part_{m}" for m in margins
    )
    norms = ", ".join(f"sum(want_{m} * part_{m}) AS norm_{m}" for m in margins)
    same = " AND ".join(f"d.{m} IS NOT DISTINCT FROM p.{m}" for m in margins)
    digits = DRAW_BITS // 4
    return f"""
    WITH docs AS (
        SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
               CASE {pick} ELSE '{OTHER_TOPIC}' END AS topic,
               ('0x' || substr(md5('{SALT}' || coalesce(doc_id::VARCHAR, '')), 1, {digits}))::BIGINT
                   / {float(2**DRAW_BITS)} AS draw
        FROM {table}
    ), cells AS (
        SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0
    ), wants AS (SELECT *, {wants} FROM cells), norms AS (SELECT {norms} FROM wants),
    w0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS w FROM wants),
    {", ".join(steps)},
    p AS (SELECT source, lang, topic, round((w / tokens) / max(w / tokens) OVER (), 9) AS probability FROM {last}),
    mixed AS (
        SELECT d.*, coalesce(p.probability, 1) AS probability, d.draw < coalesce(p.probability, 1) AS kept
        FROM docs d LEFT JOIN p ON {same}
    )"""
