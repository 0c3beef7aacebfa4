"""Model preparation, candidates, training, selection and scoring (Spark ML).

Features arrive as card rows; the ML boundary is a ``VectorAssembler``
column. Everything is fitted by distributed Spark ML estimators; only
coefficients, importances and metric rows reach the driver.
"""

from __future__ import annotations

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.config import (
    CARD_ID_COLUMN,
    FIT_THREADS,
    LR_MAX_ITER,
    RANDOM_STATE,
    RF_GROUPS,
    RF_MAX_BINS,
    RF_MAX_DEPTH,
    RF_MIN_INSTANCES_PER_NODE,
    RF_NUM_TREES,
    TARGET_COLUMN,
)
from cardlens.operators.forest import ForestParts, concurrently, fit_plan, group_fits, one_forest, save_part
from cardlens.operators.materialize import materialize
from cardlens.operators.quantiles import group_median_exact

LR_TOLERANCE = 1e-9
MODEL_NAMES = ("logistic_regression", "random_forest")


def class_weight_table(train: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Balanced class weights n / (k * n_c), one row per class present."""
    counts = train.groupBy(target).agg(F.count(F.lit(1)).alias("n_cards"))
    everything = Window.partitionBy()  # at most one row per class
    return counts.select(
        target,
        "n_cards",
        (
            F.sum("n_cards").over(everything).cast("double")
            / (F.count(F.lit(1)).over(everything) * F.col("n_cards"))
        ).alias("class_weight"),
    )


def with_class_weights(train: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Attach ``class_weight`` (a <=2-row table, so broadcast is safe)."""
    w = class_weight_table(train, target).select(target, "class_weight")
    return train.join(F.broadcast(w), target, "left")


def fit_standardizer(fitted_on: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column: one aggregate, 2 x len(cols)
    scalars to the driver (the fitted model, as a scaler's fit produces)."""
    row = fitted_on.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in cols],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, fitted_on: DataFrame, cols: list[str]) -> DataFrame:
    """z = (x - mean) / population std, statistics fitted on ``fitted_on``; a
    zero (or undefined) std leaves the centred value (scale 1)."""
    stats = fit_standardizer(fitted_on, cols)

    def z(c: str):
        mean, std = stats[c]
        scale = 1.0 if not std else float(std)
        return (F.col(c) - F.lit(mean).cast("double")) / F.lit(scale)

    return df.withColumns({c: z(c) for c in cols})


def _missing(c: str) -> str:
    return f"(`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)))"


def fit_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact median of each column that has a missing value (null or NaN); 0 where
    nothing is known. The medians come from range-partitioned running counts; complete
    columns cost one count and no shuffle of their values."""
    gaps = df.agg(*[F.count_if(F.expr(_missing(c))).alias(c) for c in cols]).first()
    need = [c for c in cols if gaps[c]]
    if not need:
        return {}
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in need]
    known = df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL AND NOT isnan(value)")
    found = group_median_exact(known, "feature", "value", "median").collect()  # one row per column
    return dict.fromkeys(need, 0.0) | {r["feature"]: r["median"] for r in found}


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def impute_stage(cols: list[str], medians: dict[str, float]) -> SQLTransformer:
    """``_imp_<c>``: the value, or the fitted median where it is missing."""
    filled = [
        f"CASE WHEN {_missing(c)} THEN {_number(medians[c])} ELSE CAST(`{c}` AS DOUBLE) END"
        if c in medians
        else f"CAST(`{c}` AS DOUBLE)"
        for c in cols
    ]
    names = (f"{e} AS `_imp_{c}`" for e, c in zip(filled, cols, strict=True))
    return SQLTransformer(statement=f"SELECT *, {', '.join(names)} FROM __THIS__")


def scale_stage(cols: list[str], stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    """``_std_<c>``: :func:`standardize` of the filled columns (population std)."""
    scaled = (
        f"(`_imp_{c}` - {_number(stats[f'_imp_{c}'][0] or 0.0)}) / {_number(stats[f'_imp_{c}'][1] or 1.0)} AS `_std_{c}`"
        for c in cols
    )
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def train_models(
    train: DataFrame, cols: list[str], seed: int = RANDOM_STATE, names: tuple[str, ...] = MODEL_NAMES
) -> dict[str, PipelineModel]:
    """Fit candidates on one feature matrix, which is written once, as concurrent jobs:
    logistic regression (median impute, standardize, L2, balanced) and a random
    forest (median impute, 300 trees, leaf >= 3, Spark's largest depth) in groups that are balanced over
    their own bootstrap samples (:mod:`cardlens.operators.forest`); one too large for the driver is a
    :class:`~cardlens.operators.forest.ForestParts`."""
    spark = train.sparkSession
    labelled = train.withColumn(TARGET_COLUMN, F.col(TARGET_COLUMN).cast("double"))
    data = materialize(with_class_weights(labelled), "train")
    impute = impute_stage(cols, fit_medians(data, cols))
    stages: dict[str, list] = {}
    if "logistic_regression" in names:
        stats = fit_standardizer(impute.transform(data), [f"_imp_{c}" for c in cols])
        scaled = VectorAssembler(inputCols=[f"_std_{c}" for c in cols], outputCol="scaled_features")
        stages["logistic_regression"] = [impute, scale_stage(cols, stats), scaled]
    if "random_forest" in names:
        stages["random_forest"] = [impute, VectorAssembler(inputCols=[f"_imp_{c}" for c in cols], outputCol="features")]
    matrix = materialize(_feature_matrix(data, stages), "matrix")

    fits, most_trees, threads = [], None, FIT_THREADS
    if "logistic_regression" in names:
        regression = LogisticRegression(
            featuresCol="scaled_features",
            labelCol=TARGET_COLUMN,
            weightCol="class_weight",
            maxIter=LR_MAX_ITER,
            tol=LR_TOLERANCE,
            regParam=1.0 / max(matrix.count(), 1),
            elasticNetParam=0.0,
            standardization=False,
        )
        fits.append(lambda: regression.fit(matrix))
    if "random_forest" in names:
        most_trees, threads = fit_plan(matrix.count(), RF_NUM_TREES, RF_GROUPS, RF_MIN_INSTANCES_PER_NODE, RF_MAX_DEPTH)
        trees = group_fits(
            matrix,
            RF_NUM_TREES,
            RF_GROUPS,
            seed=seed,
            most_trees=most_trees,
            minInstancesPerNode=RF_MIN_INSTANCES_PER_NODE,
            maxDepth=RF_MAX_DEPTH,
            maxBins=RF_MAX_BINS,
            featureSubsetStrategy="sqrt",
        )
        fits += [partial(save_part, spark, fit) for fit in trees] if most_trees else trees
    fitted = concurrently(spark, fits, threads)
    models = {}
    if "logistic_regression" in names:
        models["logistic_regression"] = PipelineModel([*stages["logistic_regression"], fitted.pop(0)])
    if "random_forest" in names:
        forest = ForestParts(fitted, threads) if most_trees else one_forest(spark, fitted)
        models["random_forest"] = PipelineModel([*stages["random_forest"], forest])
    return models


def _feature_matrix(data: DataFrame, stages: dict[str, list]) -> DataFrame:
    """Card, label, weight and the feature vector of each candidate."""
    out, done = data, set()
    for stage in (s for each in stages.values() for s in each):
        if stage.uid not in done:
            done.add(stage.uid)
            out = stage.transform(out)
    vectors = [s[-1].getOutputCol() for s in stages.values()]
    return out.select(CARD_ID_COLUMN, TARGET_COLUMN, "class_weight", *vectors)


def logistic_gradient(model: PipelineModel, train: DataFrame, cols: list[str]) -> DataFrame:
    """``feature, gradient``: slope of the weighted, regularised loss at the fitted
    coefficients (0 at the optimum), from one aggregate over the training rows."""
    lr = model.stages[-1]
    labelled = train.withColumn(TARGET_COLUMN, F.col(TARGET_COLUMN).cast("double"))
    scored = positive_class_probability(model, with_class_weights(labelled))
    miss = F.col("class_weight") * (F.col("y_proba") - F.col(TARGET_COLUMN))
    sums = scored.agg(
        F.sum("class_weight").alias("_w"), *[F.sum(miss * F.col(f"_std_{c}")).alias(c) for c in cols]
    )
    penalty = lr.getRegParam()
    slopes = [
        F.struct(F.lit(c).alias("feature"), (F.col(c) / F.col("_w") + F.lit(penalty * float(b))).alias("gradient"))
        for c, b in zip(cols, lr.coefficients.toArray(), strict=True)
    ]
    return sums.select(F.inline(F.array(*slopes)))


def positive_class_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Score: ``y_proba`` = P(label = 1); the last column if class 1 was unseen."""
    scored = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    proba = F.when(F.size(probs) > 1, probs[1]).otherwise(F.element_at(probs, -1))
    return scored.withColumn("y_proba", proba.cast("double"))


def score_cards(model: PipelineModel, df: DataFrame) -> DataFrame:
    s = positive_class_probability(model, df)
    return s.select(
        CARD_ID_COLUMN,
        F.col(TARGET_COLUMN).cast("int").alias("y_true"),
        "y_proba",
    )


def mark_best(metrics: DataFrame) -> DataFrame:
    """Adds ``is_best`` to ``position, roc_auc, f1, ...`` (one row per candidate):
    the highest AUC, F1 where there is no AUC, nothing last; ties go to the
    candidate that comes first."""
    nothing = F.lit(None).cast("double")
    score = F.coalesce(F.nanvl("roc_auc", nothing), F.nanvl("f1", nothing), F.lit(float("-inf")))
    best_first = Window.orderBy(score.desc(), "position")  # a handful of candidates
    return metrics.withColumn("is_best", F.row_number().over(best_first) == 1)


def feature_importance(model: PipelineModel, cols: list[str]) -> tuple[list[float], str]:
    """Importances of the fitted classifier, by its kind."""
    fitted = model.stages[-1]
    if isinstance(fitted, RandomForestClassificationModel):
        return fitted.featureImportances.toArray().tolist(), "feature_importance"
    if isinstance(fitted, ForestParts):
        return fitted.featureImportances.tolist(), "feature_importance"
    if isinstance(fitted, LogisticRegressionModel):
        return abs(fitted.coefficients.toArray()).tolist(), "absolute_coefficient"
    return [0.0 for _ in cols], "not_available"
