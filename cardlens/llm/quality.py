"""Quality rules: hashed n-gram log-likelihood ratio of trusted text to the corpus.

Features are the words and word pairs, by their 64-bit hash, in a power of two of buckets that
grows with the number of documents (:func:`bucket_bits`). Two multinomials over the buckets
are counted: of all documents (raw corpus) and of trusted documents (target). A document's
score is the mean over its features of ``log(target share / raw share)``, so it is normalised by
length. Smoothing adds one to a raw count and as much to a target count as the corpora's sizes
make of one, so that what neither holds has ratio 0. A document is kept if its score is at least the threshold.

The raw counts cover every document, the target counts every trusted one: all ids labelled good
outside the held-out fold. A bit set of their hashed ids (``FILTER_WORDS``, 2 MB at most) tells most
other documents, whose texts are not moved; a shuffle join by id decides the rest exactly. The counts
shuffle at most one row per bucket and task; the ratios are one array (at most ``2 ** MOST_BITS``
numbers, 8 MB), a literal of the scoring pass, which shuffles nothing.

The threshold is fitted on all labelled documents that are never trusted (one fold of the ids):
the one that best keeps good and drops bad ones, by running sums over the ranges of the scores.

Defined cases: a null or empty text has no words, all counts 0, score null and
fails the base rules; without trusted documents or with an empty corpus all
ratios are 0 and nothing fails by score; without held-out labels of both classes the
threshold is ``THRESHOLD``; a null id is never trusted;
repeated rows each count and each give a row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut
from cardlens.operators.ranking import ordered_cumulative

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_SHARE = 20, 30  # base rules: words, per cent of words

THRESHOLD = -0.1  # where no threshold can be fitted
FOLDS = 5  # fold 0 is held out
LEAST_BITS, MOST_BITS = 18, 20
FILTER_WORDS = 1 << 18  # of 64 bits; eight bits an id or more below that


# -- base counts ------------------------------------------------------------------
def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^{SPACE}]+"), 0)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(rf"[^{SPACE}]")))
    return F.size(lines) - F.size(F.array_distinct(lines))


def _shifted_pairs(hashes: Column, by: int) -> Column:
    """Hash of each entry with the one ``by`` places later."""
    left = F.greatest(F.size(hashes) - by, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, left), F.slice(hashes, by + 1, left), lambda a, b: F.xxhash64(a, b))


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(pairs: Column) -> Column:
    """One hash per run of WINDOW words (none: too few words), by doubling those of word pairs."""
    return bound(bound(pairs, lambda two: _shifted_pairs(two, 2)), lambda four: _shifted_pairs(four, 4))


def covered_words(windows: Column) -> Column:
    """Words inside windows that occur at least twice. Where a window repeats at all, windows are
    sorted with their places, those equal to a neighbour are taken in order of place, and each
    adds the words that the one before has not covered."""
    return bound(windows, lambda w: F.when(F.size(w) == F.size(F.array_distinct(w)), 0).otherwise(_covered(w)))


def _covered(windows: Column) -> Column:
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(x: Column) -> Column:
        n = F.size(x)
        before = F.zip_with(
            F.slice(x, 2, n), F.slice(x, 1, n - 1), lambda b, a: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
        )
        return F.sort_array(F.array_distinct(F.flatten(F.array_compact(before))))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    return F.aggregate(
        bound(placed, places),
        start,
        lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["sum"] + i + WINDOW - F.greatest(acc["end"], i)).alias("sum")
        ),
        lambda acc: acc["sum"],
    )


def base_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col, hashes`` (of the words), ``pairs`` (of adjacent words) and the base counts of every row."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", words_of(F.col("_text")))
    rows = rows.withColumn("hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("pairs", _shifted_pairs(F.col("hashes"), 1))
    text = F.col("_text")
    return rows.select(
        id_col,
        "hashes",
        "pairs",
        F.size("hashes").cast("long").alias("n_words"),
        # by words and matches: translate makes a string of every character
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"),
        covered_words(window_hashes(F.col("pairs"))).cast("long").alias("n_repeat_words"),
    )


# -- likelihood ratio ----------------------------------------------------------------
def bucket_bits(documents: int) -> int:
    """One bucket a document at least, a power of two between the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, (max(1, documents) - 1).bit_length()))


def features(hashes: Column) -> Column:
    """Hashes of all words, then of all pairs of adjacent words."""
    return bound(hashes, lambda h: F.concat(h, _shifted_pairs(h, 1)))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(id_col, F.lit("held")), F.lit(FOLDS)) == 0, F.lit(False))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every id labelled good and not toxic."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    good = good.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("trusted_id"))
    return good.distinct()


def held_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``held_id, good``: every held-out id of each class (good as in ``trusted_ids``, or
    quality 0); ids of both classes go."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    rows = labels.filter(held_out(F.col(id_col)) & F.col(id_col).isNotNull() & (good | (F.col("quality") == 0)))
    rows = rows.groupBy(F.col(id_col).alias("held_id")).agg(F.min(good).alias("good"), F.max(good).alias("any"))
    return rows.filter(F.col("good") == F.col("any")).drop("any")


def id_bits(ids: DataFrame, id_col: str) -> DataFrame:
    """One row, ``bits``: 64-bit words in which every id has set the bit of its hash."""
    words = min(FILTER_WORDS, 1 << (ids.count() // 8).bit_length())
    place = F.pmod(F.xxhash64(id_col), F.lit(64 * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    filled = ids.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = ids.sparkSession.range(words).select(F.col("id").cast("int").alias("word"))
    full = every.join(filled, "word", "left").fillna(0)
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda r: r["bits"]).alias("bits"))


def may_hold(bits: Column, id_col: Column) -> Column:
    """False is certain."""
    place = F.pmod(F.xxhash64(id_col), 64 * F.size(bits))
    word = F.get(bits, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def trusted_texts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text, target`` of every row: 1 if its id is trusted, else 0."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    maybe = F.lit(True)
    if rows.schema["id"].dataType == trusted.schema["trusted_id"].dataType:  # equal ids have equal hashes
        maybe = may_hold(cut(id_bits(trusted, "trusted_id"), "bits").scalar(), F.col("id"))
    rows = rows.withColumn("_maybe", maybe)
    hits = rows.filter("_maybe").join(trusted.hint("merge"), F.col("id") == F.col("trusted_id"), "left")
    hits = hits.select("text", F.col("trusted_id").isNotNull().cast("long").alias("target"))
    return hits.unionByName(rows.filter("not _maybe").select("text", F.lit(0).cast("long").alias("target")))


def ratios(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """One row, ``ratios``: those of the buckets in order. ``trusted`` holds each ``trusted_id``
    once. ``buckets`` is set by the number of documents if not given."""
    buckets = buckets or 1 << bucket_bits(docs.count())
    rows = trusted_texts(docs, trusted, id_col, text_col)
    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    each = rows.select(F.explode(features(hashes)).alias("hash"), "target")
    counts = each.groupBy(_bucket(F.col("hash"), buckets).alias("bucket"))
    counts = cut(counts.agg(F.count("*").alias("raw"), F.sum("target").alias("target")), "buckets")
    raw_total, target_total = (x or 0 for x in counts.agg(F.sum("raw"), F.sum("target")).first())
    # pseudo-counts in proportion to the totals: log of (t + T/R) / (T + B T/R) over (r + 1) / (R + B)
    scale = float(raw_total) / target_total if target_total else 0.0
    share = F.log((F.col("target") * scale + 1) / (F.col("raw") + 1))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").fillna(0)
    ratio = share if target_total else F.lit(0.0)
    listed = F.array_sort(F.collect_list(F.struct("bucket", ratio.alias("ratio"))))  # one entry per bucket
    return cut(full.agg(F.transform(listed, lambda r: r["ratio"]).alias("ratios")), "ratios")


def mean_ratio(hashes: Column, pairs: Column, values: Column) -> Column:
    """Mean ratio of the features (null: none)."""

    def total(found: Column) -> Column:
        return F.aggregate(found, F.lit(0.0), lambda acc, h: acc + F.get(values, F.pmod(h, F.size(values)).cast("int")))

    return (total(hashes) + total(pairs)) / F.nullif(F.size(hashes) + F.size(pairs), F.lit(0))


def score(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``score`` and ``base_failed`` of every row."""
    rows = base_counts(docs, id_col, text_col).withColumn("_ratios", model.scalar())
    rows = rows.withColumn("score", mean_ratio(F.col("hashes"), F.col("pairs"), F.col("_ratios")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop("hashes", "pairs", "_ratios")


def fit_threshold(scored: DataFrame, held: DataFrame, id_col: str = "doc_id") -> float:
    """The threshold with the largest share of good kept + share of bad dropped (ties: the
    lowest), among the held-out documents that pass the base rules. Halfway between two scores."""
    rows = scored.filter(~F.col("base_failed") & F.col("score").isNotNull()).select(id_col, "score")
    rows = rows.join(held, F.col(id_col) == F.col("held_id"))
    rows = cut(rows.groupBy("held_id", "good").agg(F.avg("score").alias("score")).select("score", "good"), "held")
    n_good, n_bad = rows.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not n_good or not n_bad:
        return THRESHOLD
    # gain of a threshold above a score, times n_good * n_bad: whole numbers that end at 0
    step = F.count_if(~F.col("good")) * n_good - F.count_if("good") * n_bad
    gains = ordered_cumulative(rows.groupBy("score").agg(step.alias("step")), [], "score", "step")
    best = F.max(F.struct("_cum", (-F.col("score")).alias("minus"))).alias("best")
    least, best = gains.agg(F.min("score").alias("least"), best).first()
    if best["_cum"] <= 0:
        return least - 1e-6
    below = -best["minus"]
    return (below + rows.filter(F.col("score") > below).agg(F.min("score")).first()[0]) / 2


def verdicts(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(True))
    return scored.withColumn("kept", kept)


def judge(
    docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Base counts, ``score``, ``base_failed`` and ``kept`` of every row."""
    return verdicts(score(docs, model, id_col, text_col), threshold)


def judge_by_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``judge`` by a model of the trusted ids and a threshold fitted on the held-out ones."""
    held = held_out(F.col(id_col))
    trusted = cut(trusted_ids(labels.filter(~held), id_col), "trusted")
    model = ratios(docs, trusted, id_col, text_col)
    scored = cut(score(docs, model, id_col, text_col), "scored")
    return verdicts(scored, fit_threshold(scored, held_ids(labels, id_col), id_col))
