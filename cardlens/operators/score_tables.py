"""Scores from model tables: fitted classifiers as rows, applied with joins and column expressions.

* A linear model is a table ``feature, coefficient``; the row whose feature is null holds the intercept.
* A forest is a table ``tree, node, feature, threshold, left, right, probability``: inner nodes name a
  feature and their children, leaves hold the probability of class 1. Node 0 is the root.

:func:`linear_table` and :func:`forest_table` make them from fitted or saved Spark ML models; a table made
elsewhere scores the same way, without Spark ML. Cards are never shuffled for a table that is small enough
to broadcast (checked); larger node tables are joined by shuffles, where AQE splits the hot root nodes.

Defined cases: a value goes left when it is at most the threshold; null and NaN go right. A linear score
is null where a feature of the table is null. An unknown feature, node or a forest deeper than ``depth`` is an error.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.operators.joins import checked_broadcast

NODE_SCHEMA = "tree int, node int, feature string, threshold double, left int, right int, probability double"
LINEAR_SCHEMA = "feature string, coefficient double"


def linear_table(spark: SparkSession, model: LogisticRegressionModel, cols: list[str]) -> DataFrame:
    """The fitted coefficients (as many as features) as a table."""
    rows = [(c, float(b)) for c, b in zip(cols, model.coefficients.toArray(), strict=True)]
    return spark.createDataFrame([*rows, (None, float(model.intercept))], LINEAR_SCHEMA)


def forest_table(spark: SparkSession, model_path: str, cols: list[str]) -> DataFrame:
    """The nodes of a forest saved at ``model_path`` (:class:`RandomForestClassificationModel`), read as a table."""
    nodes = spark.read.parquet(f"{model_path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    stats = F.col("impurityStats")
    weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    share = F.when(F.size(stats) > 1, F.try_divide(F.get(stats, F.lit(1)), weight)).otherwise(F.lit(0.0))
    names = F.array(*map(F.lit, cols))
    return nodes.select(
        F.col("tree").cast("int").alias("tree"),
        F.col("id").cast("int").alias("node"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).cast("int").alias("left"),
        F.when(inner, F.col("rightChild")).cast("int").alias("right"),
        F.when(~inner, share).alias("probability"),
    )


def forest_depth(model: RandomForestClassificationModel) -> int:
    return max((t.depth for t in model.trees), default=0)


def score_linear(cards: DataFrame, table: DataFrame, cols: list[str], out: str = "y_proba") -> DataFrame:
    """``cards`` with the logistic score of a linear table whose features are among ``cols``."""
    entry = F.struct(F.coalesce("feature", F.lit("")).alias("feature"), "coefficient")
    # one row with an entry per feature
    weights = table.agg(F.map_from_entries(F.collect_list(entry)).alias("w")).scalar()
    scored = cards.withColumn("_w", weights)
    unknown = F.array_except(F.map_keys("_w"), F.array(F.lit(""), *map(F.lit, cols)))
    total = F.coalesce(F.try_element_at("_w", F.lit("")), F.lit(0.0))
    for c in cols:
        weight = F.try_element_at("_w", F.lit(c))
        total = total + F.when(weight.isNull(), 0.0).otherwise(weight * F.col(c).cast("double"))
    score = F.when(F.size(unknown) == 0, 1.0 / (1.0 + F.exp(-total))).otherwise(
        F.raise_error(F.concat(F.lit("linear table: unknown features "), F.array_join(unknown, ", ")))
    )
    return scored.withColumn(out, score).drop("_w")


def _node_side(nodes: DataFrame, cols: list[str]) -> DataFrame:
    """The node table for joins, features as places in ``cols``; broadcast when measured small."""
    place = F.create_map(*(x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))))
    known = F.try_element_at(place, F.col("feature"))
    side = nodes.select(
        F.col("tree").alias("_t"),
        F.col("node").alias("_n"),
        F.when(F.col("feature").isNull() | known.isNotNull(), known)
        .otherwise(F.raise_error(F.concat(F.lit("node table: unknown feature "), F.col("feature"))).cast("int"))
        .alias("_f"),
        F.col("threshold").alias("_c"),
        F.col("left").alias("_l"),
        F.col("right").alias("_r"),
        F.col("probability").alias("_p"),
    )
    return checked_broadcast(side)[0]


def _here() -> list[Column]:
    return [F.col("_tree") == F.col("_t"), F.col("_node") == F.col("_n")]


def _leaves(cards: DataFrame, side: DataFrame, keep: list[Column], cols: list[str], depth: int) -> DataFrame:
    """``keep`` and ``_tree, _node, _p`` of the leaf that each card reaches in each tree."""
    trees = side.filter("_n = 0").agg(F.collect_set("_t").alias("t")).scalar()
    values = F.array(*(F.col(c).cast("double") for c in cols))
    at = cards.select(*keep, values.alias("_x"), F.explode(trees).alias("_tree")).withColumn("_node", F.lit(0))
    kept = [c for c in at.columns if c != "_node"]
    for _ in range(depth):
        value = F.get("_x", F.col("_f"))
        to_left = F.coalesce(value <= F.col("_c"), F.lit(False))
        after = F.when(F.col("_f").isNull(), F.col("_node")).when(to_left, F.col("_l")).otherwise(F.col("_r"))
        at = at.join(side, _here(), "left").select(*kept, after.alias("_node"))
    lost = F.raise_error(F.concat_ws(" ", F.lit("no leaf reached: tree"), "_tree", F.lit("node"), "_node")).cast("double")
    return at.join(side, _here(), "left").select(*kept, "_node", F.coalesce("_p", lost).alias("_p")).drop("_x")


def score_forest(
    cards: DataFrame, nodes: DataFrame, key: str, cols: list[str], depth: int, out: str = "y_proba"
) -> DataFrame:
    """``key, out``: mean probability of the leaves that a card (one row each) reaches in all trees.

    One row per card and tree walks down ``depth`` times by joining the node table; the rows of a card
    stay together, so their mean is a partial aggregate before it is shuffled."""
    leaf = _leaves(cards, _node_side(nodes, cols), [F.col(key)], cols, depth)
    return leaf.groupBy(key).agg(F.avg("_p").alias(out))


def _paths(side: DataFrame, depth: int) -> DataFrame:
    """``_tree, _node, _path``: every leaf with the nodes from the root to it. Walks the node table alone."""
    at = side.filter("_n = 0").select(F.col("_t").alias("_tree"), F.lit(0).alias("_node"), F.array(F.lit(0)).alias("_path"))
    for _ in range(depth):
        down = F.array("_l", "_r")
        grown = F.transform(down, lambda n: F.struct(n.alias("_node"), F.array_append("_path", n).alias("_path")))
        stays = F.array(F.struct("_node", "_path"))
        at = at.join(side, _here()).select("_tree", F.inline(F.when(F.col("_f").isNull(), stays).otherwise(grown)))
    return at


def forest_importance(
    cards: DataFrame, nodes: DataFrame, target: str, cols: list[str], depth: int, weight: str | None = None
) -> DataFrame:
    """``feature, importance`` for all of ``cols``: mean decrease in Gini impurity of a node table on ``cards``
    (classes 0 and 1 in ``target``, optional row weights), as shares that add up to 1.

    On the rows a forest was trained on these are the model's own importances; on other rows they tell
    which features separate those. Each tree counts the same, one that separates nothing counts nothing,
    and without any separation all are 0. Rows whose class or weight is null count nothing.

    Cards are counted at their leaves by a partial aggregate; everything after it is as large as the
    node table: leaves add their counts to the nodes on their way."""
    side = _node_side(nodes, cols)
    times = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    labelled = [F.col(target).cast("int").alias("_y"), times.alias("_w")]
    at_leaf = _leaves(cards, side, labelled, cols, depth).groupBy("_tree", "_node").agg(
        *(F.sum(F.when(F.col("_y") == y, F.col("_w")).otherwise(0.0)).alias(f"_w{y}") for y in (0, 1))
    )
    on_way = at_leaf.join(_paths(side, depth), ["_tree", "_node"]).select("_tree", F.explode("_path").alias("_node"), "_w0", "_w1")
    sums = on_way.groupBy("_tree", "_node").agg(F.sum("_w0").alias("_w0"), F.sum("_w1").alias("_w1"))
    total = F.col("_w0") + F.col("_w1")
    gini = total - F.try_divide(F.col("_w0") * F.col("_w0") + F.col("_w1") * F.col("_w1"), total)
    impurity = sums.select("_tree", "_node", F.coalesce(gini, F.lit(0.0)).alias("_i"))
    # a node's decrease: its own impurity less that of its children
    inner = side.filter(F.col("_f").isNotNull())
    parts = F.array(*(F.struct(F.col(n).alias("_at"), F.lit(s).alias("_s")) for n, s in (("_n", 1.0), ("_l", -1.0), ("_r", -1.0))))
    signed = inner.select(F.col("_t").alias("_tree"), F.col("_f"), F.inline(parts)).withColumnRenamed("_at", "_node")
    by_tree = signed.join(impurity, ["_tree", "_node"]).groupBy("_tree", "_f").agg(F.sum(F.col("_s") * F.col("_i")).alias("_d"))
    of_tree = F.sum("_d").over(Window.partitionBy("_tree"))  # at most one row per feature
    shares = by_tree.withColumn("_d", F.when(of_tree > 0, F.col("_d") / of_tree).otherwise(0.0))
    shares = shares.groupBy("_f").agg(F.sum("_d").alias("_d"))
    names = F.array(*(F.struct(F.lit(c).alias("feature"), F.lit(i).alias("_f")) for i, c in enumerate(cols)))
    every = cards.sparkSession.range(1).select(F.inline(names)).join(F.broadcast(shares), "_f", "left")  # one row per feature
    d = F.coalesce("_d", F.lit(0.0))
    return every.select("feature", F.coalesce(F.try_divide(d, F.sum(d).over(Window.partitionBy())), F.lit(0.0)).alias("importance"))
