"""Random forest whose class weights are those of each bootstrap sample.

A forest is fitted in groups of trees. Every group has a bootstrap sample of its own: a card is drawn
a Poisson(1) number of times, told by a hash of card and group, so the sample needs no shuffle and is the same
however the rows are partitioned or recomputed. The class weights of a group balance the draws of that very
sample (:func:`bootstrap_weights`), its trees differ by the features tried at each node, and the trees of all
groups make one Spark ML forest.

Spark ML has every partition send a histogram of every node, however few cards it holds there, so the work is nodes times
partitions. A fit therefore reads the matrix in partitions of many cards (:func:`packed`), a bounded number each; the
groups keep the cores busy.

Only the weights (two rows per group) and the fitted trees reach the driver. Groups are fitted as concurrent jobs
that share one written feature matrix.

Trees grow with the cards, and Spark ML fits, saves and scores them in the driver. A forest that may have more nodes than
the driver should hold (:func:`fit_plan`) is therefore fitted a few trees of a group at a time; every fit is saved and let go
(:func:`save_part`), and :class:`ForestParts` scores with one part after the other. A single tree is not divided.

Defined cases: a null card is drawn like an empty name; rows of one card are drawn together; a class
that a sample lacks has probability 0 in that group's trees; a group without any draw has no
trees; a sample of one class has weight 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.config import (
    CARD_ID_COLUMN,
    FIT_THREADS,
    RANDOM_STATE,
    RF_DRIVER_NODES,
    RF_PART_THREADS,
    RF_PARTITION_CARDS,
    TARGET_COLUMN,
)
from cardlens.operators.materialize import materialize, scratch_path

HASH_DIGITS = 8  # hexadecimal digits of the hash that decide the draws
MOST_DRAWS = 12  # more draws are less likely than one hash value
T = TypeVar("T")


def draw_cuts() -> list[int]:
    """The k-th number: the least hash value that stands for more than k draws (Poisson with mean 1)."""
    below, share = 0.0, math.exp(-1.0)
    cuts = []
    for k in range(MOST_DRAWS):
        below += share
        cuts.append(round(below * 16**HASH_DIGITS))
        share /= k + 1
    return cuts


def draws(card: Column, group: Column, seed: int = RANDOM_STATE) -> Column:
    """How many times a card is in the bootstrap sample of a group."""
    name = F.concat_ws(":", F.coalesce(card.cast("string"), F.lit("")), F.lit(seed).cast("string"), group.cast("string"))
    place = F.conv(F.substring(F.md5(name), 1, HASH_DIGITS), 16, 10).cast("long")
    return sum(((place >= cut).cast("int") for cut in draw_cuts()), F.lit(0))


def bootstrap_weights(
    train: DataFrame, groups: int, target: str = TARGET_COLUMN, seed: int = RANDOM_STATE
) -> DataFrame:
    """``tree_group, label, n_cards, n_draws, class_weight`` per group and class drawn: balanced weights
    n / (k * n_c) over the draws of the group's sample. One pass of two columns, partial sums per task."""
    each = train.select(CARD_ID_COLUMN, target, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("tree_group"))
    drawn = each.withColumn("_draws", draws(F.col(CARD_ID_COLUMN), F.col("tree_group"), seed)).filter("_draws > 0")
    counts = drawn.groupBy("tree_group", target).agg(
        F.count(F.lit(1)).alias("n_cards"), F.sum("_draws").cast("long").alias("n_draws")
    )
    group = Window.partitionBy("tree_group")  # one row per class
    balanced = F.sum("n_draws").over(group).cast("double") / (F.count(F.lit(1)).over(group) * F.col("n_draws"))
    return counts.withColumn("class_weight", balanced)


def concurrently(spark: SparkSession, tasks: list[Callable[[], T]], threads: int = FIT_THREADS) -> list[T]:
    """Results of the tasks in their order; at most ``threads`` submit Spark jobs at a time. The first
    error is raised once the running tasks are through, tasks not yet begun are left out."""
    with ThreadPoolExecutor(max(1, min(threads, len(tasks)))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        try:
            return [r.result() for r in running]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def packed(matrix: DataFrame, cards: int = RF_PARTITION_CARDS) -> DataFrame:
    """All rows of a written table in partitions of about ``cards``, without a shuffle; never more partitions than before."""
    return matrix.coalesce(max(1, -(-matrix.count() // cards)))


def fit_plan(
    cards: int, trees: int, groups: int, least: int = 1, depth: int = 30, nodes: int | None = None, threads: int | None = None
) -> tuple[int | None, int]:
    """Trees of one fit at the most, and fits at once, so that their trees have at most ``nodes`` nodes together. No limit of
    trees (None) where the whole forest has at most half as many. A tree with its share of drawn cards, ``least`` in a leaf,
    is counted with the most nodes it can have; one tree at a time is the least that is fitted."""
    nodes, threads = nodes or RF_DRIVER_NODES, threads or RF_PART_THREADS
    leaves = min(max(1, math.ceil(cards * (1 - math.exp(-1)) / max(1, least))), 2**depth)
    if trees * (2 * leaves - 1) <= nodes // 2:
        return None, FIT_THREADS
    at_once = max(1, nodes // (2 * leaves - 1))
    most = max(1, min(at_once // threads, -(-trees // min(groups, trees))))
    return most, min(threads, at_once // most)


def group_fits(
    matrix: DataFrame,
    trees: int,
    groups: int,
    target: str = TARGET_COLUMN,
    seed: int = RANDOM_STATE,
    most_trees: int | None = None,
    **settings,
) -> list[Callable[[], RandomForestClassificationModel]]:
    """One fit per group over ``matrix`` (card, label, ``features``; a written table), to be run in any order, or several
    of at most ``most_trees`` trees each. The trees are dealt to the groups as evenly as possible; ``settings`` go to the classifier."""
    groups = min(groups, trees)
    few = packed(matrix)
    rows = bootstrap_weights(matrix, groups, target, seed).collect()  # at most two per group
    weight_of = {(r["tree_group"], r[target]): r["class_weight"] for r in rows}
    drawn = sorted({g for g, _ in weight_of})
    if not drawn:
        raise ValueError("no training rows: a forest cannot be fitted")
    classes = 1 + int(max(label for _, label in weight_of))
    nominal = {"ml_attr": {"type": "nominal", "num_vals": classes}}

    def fit(group: int, share: int, part: int) -> RandomForestClassificationModel:
        weight = F.lit(0.0)
        for (g, label), w in weight_of.items():
            if g == group:
                weight = F.when(F.col(target) == label, F.lit(w)).otherwise(weight)
        times = draws(F.col(CARD_ID_COLUMN), F.lit(group), seed)
        sample = few.select("features", F.col(target).alias(target, metadata=nominal), (times * weight).alias("_weight"))
        classifier = RandomForestClassifier(
            featuresCol="features",
            labelCol=target,
            weightCol="_weight",
            numTrees=share,
            bootstrap=False,  # the weights hold the draws
            seed=seed + group + part * groups,
            cacheNodeIds=most_trees is not None,  # else every pass sends the trees grown so far
            **settings,
        )
        return classifier.fit(sample.filter("_weight > 0"))

    fits = []
    for place, group in enumerate(drawn):
        share = trees // len(drawn) + (place < trees % len(drawn))
        most = most_trees or share
        for part, done in enumerate(range(0, share, most)):
            fits.append(lambda group=group, some=min(most, share - done), part=part: fit(group, some, part))
    return fits


def one_forest(spark: SparkSession, parts: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The trees of all parts (fitted on the same features and classes) as one forest."""
    sc = spark.sparkContext
    of = sc._jvm.org.apache.spark.ml.classification
    trees = [tree._java_obj for part in parts for tree in part.trees]
    array = sc._gateway.new_array(of.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    first = parts[0]
    merged = of.RandomForestClassificationModel(first.uid, array, first.numFeatures, first.numClasses)
    model = RandomForestClassificationModel._from_java(merged)
    first._copyValues(model, {first.numTrees: len(trees)})
    model._transfer_params_to_java()
    return model


def save_part(spark: SparkSession, fit: Callable[[], RandomForestClassificationModel]) -> dict:
    """Runs a fit and writes its trees; only their path, number and summed importances stay in the driver."""
    model = fit()
    path = scratch_path(spark, "forest-part")
    model.save(path)
    importances = sum(tree.featureImportances.toArray() for tree in model.trees)
    return {"path": path, "trees": model.getNumTrees, "importances": importances.tolist()}


class ForestParts(Transformer, MLReadable["ForestParts"], MLWritable):
    """A forest of saved parts, with the columns and the importances of a Spark ML forest of all their trees.

    Rows are numbered and written once; every part adds its votes to a table of its own, ``threads`` parts at a time, and
    the votes of a row are added up in the order of the parts. So :meth:`transform` runs its jobs at once."""

    def __init__(self, parts: list[dict] | None = None, threads: int = RF_PART_THREADS):
        super().__init__()
        self.parts, self.threads = parts or [], threads

    @property
    def getNumTrees(self) -> int:  # named as in Spark ML
        return sum(part["trees"] for part in self.parts)

    @property
    def featureImportances(self) -> np.ndarray:
        total = np.sum([part["importances"] for part in self.parts], axis=0)
        return total / total.sum() if total.sum() else total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        rows = materialize(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")

        def votes(place: int, path: str) -> str:
            scored = RandomForestClassificationModel.load(path).transform(rows.select("_row", "features"))
            voted = scored.select("_row", F.lit(place).alias("_part"), vector_to_array("rawPrediction").alias("_votes"))
            to = scratch_path(spark, "forest-votes")
            voted.write.parquet(to)
            return to

        tasks = [lambda i=i, p=part["path"]: votes(i, p) for i, part in enumerate(self.parts)]
        each = spark.read.parquet(*concurrently(spark, tasks, self.threads))
        in_order = F.array_sort(F.collect_list(F.struct("_part", "_votes")))  # one entry per part
        total = F.aggregate(
            F.slice("_each", 2, F.size("_each")),
            F.get("_each", F.lit(0))["_votes"],
            lambda total, part: F.zip_with(total, part["_votes"], lambda a, b: a + b),
        )
        sums = each.groupBy("_row").agg(in_order.alias("_each")).select("_row", total.alias("_raw"))
        weight = F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x)
        share = F.when(weight > 0, F.transform("_raw", lambda x: x / weight)).otherwise(F.col("_raw"))
        scored = rows.join(sums, "_row", "left").withColumns({
            "rawPrediction": array_to_vector("_raw"),
            "probability": array_to_vector(share),
            "prediction": (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double"),
        })
        return scored.drop("_row", "_raw")

    def write(self) -> MLWriter:
        return _PartsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PartsReader()


class _PartsWriter(MLWriter):
    """Metadata and a copy of every part."""

    def __init__(self, forest: ForestParts):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        spark, parts = self.sparkSession, []
        conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
        for i, part in enumerate(self.forest.parts):
            old, new = hadoop.Path(part["path"]), hadoop.Path(f"{path}/part-{i:05d}")
            hadoop.FileUtil.copy(old.getFileSystem(conf), old, new.getFileSystem(conf), new, False, conf)
            parts.append(part | {"path": f"part-{i:05d}"})
        DefaultParamsWriter.saveMetadata(self.forest, path, spark, {"parts": parts, "threads": self.forest.threads})


class _PartsReader(MLReader):
    def load(self, path: str) -> ForestParts:
        kept = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        forest = ForestParts([part | {"path": f"{path}/{part['path']}"} for part in kept["parts"]], kept["threads"])
        return forest._resetUid(kept["uid"])
