"""Fitting, scoring and comparing models on distributed tables with MLlib."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import QuantileDiscretizer, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.calendar import is_night
from punctual.functions.scores import mae, r2
from punctual.operators.evaluation import confusion_report, regression_report
from punctual.operators.history import History, fit_history
from punctual.operators.sampling import (
    convenience,
    shuffled_split,
    simple_random,
    stratified,
    with_class_weight,
)
from punctual.operators.slices import order_slices, slice_report
from punctual.operators.split import time_split
from punctual.operators.thresholds import average_precision, recall_at_precision, sweep
from punctual.session import settle

# What the scoring side can assemble, which of it is categorical, the restricted set.
SERVING_FEATURES = [
    "distance_km", "prep_min_estimate", "courier_rating", "n_items", "hour", "dow", "city", "weather",
]
CATEGORICAL = ["city", "weather"]
FEATURE_SETS = {
    "base": [
        "distance_km", "n_items", "courier_rating", "restaurant_prep_min_estimate", "hour", "dow", "city", "weather",
    ],
    "slim": ["distance_km", "restaurant_prep_min_estimate", "hour", "city"],
}

# Bins of a tree column. A column with more categories keeps the most frequent ones; the rest is one more.
MAX_BINS = 256
MOST_CATEGORIES = MAX_BINS - 2
REST = "(other)"
# Fits that run at the same time.
SIDE_BY_SIDE = 8
# Rows that one task of a fit takes. A fit on more takes rows with equal features together, or spreads them.
ROWS_PER_TASK = 250_000


def serving_frame(labelled: DataFrame) -> DataFrame:
    """The serving features under the names the feature table uses."""
    renamed = {"prep_min_estimate": "restaurant_prep_min_estimate"}
    return labelled.withColumns({n: F.col(c) for n, c in renamed.items()})


def _folded(train: DataFrame, columns: list[str], most: int) -> dict[str, list[str]]:
    """The ``most`` most frequent categories (the smaller first on a tie) of each column that has more."""
    kept = {}
    for column in columns:
        counts = train.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("c")).count()
        top = counts.orderBy(F.desc("count"), "c").limit(most + 1).collect()
        if len(top) > most:
            kept[column] = [r["c"] for r in top[:most]]
    return kept


def spread(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` settled, and its number of rows. Parts with far more than ``ROWS_PER_TASK`` rows are divided.

    Parts come from the files: a table in a few large ones, or in few row groups, would leave most cores idle.
    """
    settled = settle(df)
    sizes = settled.groupBy(F.spark_partition_id().alias("part")).count()
    total, most = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    if most > 2 * ROWS_PER_TASK:
        settled = settle(settled.repartition(-(-total // ROWS_PER_TASK)))
    return settled, total


def _wide(train: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns with more values than a tree has bins."""
    if not columns:
        return []
    counts = train.agg(*[F.approx_count_distinct(F.col(c), 0.02).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] >= MAX_BINS]


def prepared(train: DataFrame, features: list[str], categorical: list[str], most: int, binned: bool = False) -> list:
    """Index categories, fold rare ones, assemble. A category that train never had counts as a missing one.

    With ``binned`` a column with more values than a tree has bins is cut at its quantiles, as each tree would do.
    """
    used = [c for c in categorical if c in features]
    stages, inputs = [], {c: c for c in features}
    kept = _folded(train, used, most)
    if kept:
        def quoted(value: str) -> str:
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

        cases = [
            f"CASE WHEN `{c}` IS NULL THEN NULL WHEN CAST(`{c}` AS STRING) IN ({', '.join(map(quoted, values))})"
            f" THEN CAST(`{c}` AS STRING) ELSE '{REST}' END AS `_{c}_kept`"
            for c, values in kept.items()
        ]
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(cases)} FROM __THIS__"))
    if used:
        outputs = [f"_{c}_index" for c in used]
        sources = [f"_{c}_kept" if c in kept else c for c in used]
        stages.append(StringIndexer(inputCols=sources, outputCols=outputs, handleInvalid="keep"))
        inputs |= dict(zip(used, outputs))
    wide = _wide(train, [c for c in features if c not in used]) if binned else []
    if wide:
        outputs = [f"_{c}_bin" for c in wide]
        # one bin less, as a missing value has its own
        stages.append(QuantileDiscretizer(inputCols=wide, outputCols=outputs, numBuckets=MAX_BINS - 1, handleInvalid="keep"))
        inputs |= dict(zip(wide, outputs))
    stages.append(VectorAssembler(inputCols=[inputs[c] for c in features], outputCol="_features", handleInvalid="keep"))
    return stages


def side_by_side(calls: list[Callable]) -> list:
    """The results of independent calls, whose jobs share the cluster instead of waiting for each other.

    A fit is a chain of many small jobs; on its own it leaves most of the executors idle.
    """
    with ThreadPool(max(1, min(len(calls), SIDE_BY_SIDE))) as pool:
        inherited = inheritable_thread_target(SparkSession.getActiveSession())
        return pool.map(lambda call: call(), [inherited(call) for call in calls])


def _fit(
    learner, train: DataFrame, columns: list, features: list[str], categorical: list[str], most: int, weight: str | None = None
) -> PipelineModel:
    """Fit on the columns in use, written once: each tree level reads that table and not what lies below it."""
    narrow, rows = spread(train.select(*columns))
    shape = Pipeline(stages=prepared(narrow, features, categorical, most, rows > ROWS_PER_TASK)).fit(narrow)
    return PipelineModel([*shape.stages, fit_rows(learner, shape.transform(narrow), rows, weight)])


def fit_rows(learner, table: DataFrame, rows: int, weight: str | None = None):
    """The learner's model of ``table``, which has ``rows`` rows and their ``_features``.

    To a regression many rows with the same features are one with their mean target and their number as weight. So
    in a table of more than ``ROWS_PER_TASK`` rows such rows are taken together, unless hardly any two are
    alike. A classifier gets all rows.
    """
    if rows <= ROWS_PER_TASK or isinstance(learner, GBTClassifier) or weight:
        return learner.fit(table)
    target = learner.getLabelCol()
    flat = table.select(vector_to_array("_features").alias("_values"), target)
    cells = flat.agg(F.approx_count_distinct(F.xxhash64("_values"), 0.02)).first()[0]
    if cells * 1.5 > rows:
        return learner.fit(table)
    count = F.count(F.lit(1))
    # a missing target stays one, and so an error
    mean = F.when(F.count(target) == count, F.avg(target)).alias("_mean")
    together = flat.groupBy("_values").agg(count.cast("double").alias("_weight"), mean)
    together, _ = spread(together.select(array_to_vector("_values").alias("_features"), F.col("_mean").alias(target), "_weight"))
    return learner.copy().setWeightCol("_weight").fit(together)


def fit_regressor(
    train: DataFrame,
    features: list[str],
    target: str,
    *,
    categorical: list[str] = CATEGORICAL,
    trees: int = 20,
    depth: int = 5,
    step: float = 0.1,
    seed: int = 2026,
    most_categories: int = MOST_CATEGORIES,
) -> PipelineModel:
    """Gradient-boosted trees on the given columns. Statistics are aggregated on the executors.

    Of a categorical column the ``most_categories`` most frequent values count, all others as one.
    """
    learner = _regressor(target, trees, depth, step, seed)
    columns = [*features, F.col(target).cast("double").alias(target)]
    return _fit(learner, train, columns, features, categorical, most_categories)


def _regressor(target: str, trees: int = 20, depth: int = 5, step: float = 0.1, seed: int = 2026) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="_features", labelCol=target, predictionCol="pred", maxIter=trees, maxDepth=depth,
        stepSize=step, maxBins=MAX_BINS, seed=seed, checkpointInterval=10,
    )


def fit_tree(
    train: DataFrame, features: list[str], target: str, *, categorical: list[str] = CATEGORICAL, depth: int = 5,
    seed: int = 2026, most_categories: int = MOST_CATEGORIES,
) -> PipelineModel:
    """One regression tree: the mean target of the train rows in each leaf."""
    learner = DecisionTreeRegressor(
        featuresCol="_features", labelCol=target, predictionCol="pred", maxDepth=depth, maxBins=MAX_BINS, seed=seed
    )
    columns = [*features, F.col(target).cast("double").alias(target)]
    return _fit(learner, train, columns, features, categorical, most_categories)


def fit_classifier(
    train: DataFrame,
    features: list[str],
    target: str,
    *,
    weight: str | None = None,
    categorical: list[str] = CATEGORICAL,
    trees: int = 20,
    depth: int = 5,
    seed: int = 2026,
    most_categories: int = MOST_CATEGORIES,
) -> PipelineModel:
    learner = GBTClassifier(
        featuresCol="_features", labelCol=target, predictionCol="_class", maxIter=trees, maxDepth=depth,
        maxBins=MAX_BINS, seed=seed, checkpointInterval=10,
    )
    learner = learner.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    columns = [*features, F.col(target).cast("double").alias(target)]
    if weight:
        learner = learner.setWeightCol(weight)
        columns.append(weight)
    return _fit(learner, train, columns, features, categorical, most_categories, weight)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``pred``; helper columns of the pipeline are dropped."""
    return model.transform(rows).select(*rows.columns, "pred")


def score_class(model: PipelineModel, rows: DataFrame, name: str = "proba") -> DataFrame:
    scored = model.transform(rows)
    return scored.select(*rows.columns, vector_to_array("_probability")[1].alias(name))


def evaluation_bundle(scored_test: DataFrame, train: DataFrame, target: str, promise: str) -> DataFrame:
    """Model MAE and R2, MAE of the promise and of predicting the train mean, row counts: one row."""
    learned = train.agg(F.struct(F.avg(target).alias("mean"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    rows = scored_test.withColumn("_mean", learned["mean"])
    return rows.agg(
        mae("pred", target).alias("model_mae"),
        r2("pred", target).alias("model_r2"),
        mae(promise, target).alias("promised_mae"),
        mae("_mean", target).alias("predict_the_mean_mae"),
        F.count(F.lit(1)).alias("n_test"),
    ).withColumn("n_train", learned["n"])


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def feature_bakeoff(
    train: DataFrame,
    test: DataFrame,
    target: str,
    sets: dict[str, list[str]],
    *,
    categorical: list[str] = CATEGORICAL,
    most_categories: int = MOST_CATEGORIES,
    **model,
) -> DataFrame:
    """The same learner on several column lists; one row each with MAE, R2 and the gain over the first.

    The categories of all columns are indexed once and all columns go into one vector, written once to the shared
    folder. A model takes its slice of it. Models are fitted side by side, and all are
    measured in one pass over the test rows.
    """
    used = list(dict.fromkeys(c for features in sets.values() for c in features))
    label = F.col(target).cast("double").alias(target)
    (train, rows), test = spread(train.select(*used, label)), test.select(*used, label)
    stages = prepared(train, used, categorical, most_categories, rows > ROWS_PER_TASK)
    stages[-1].setOutputCol("_matrix")
    indexed = Pipeline(stages=stages).fit(train)
    train, test = (settle(indexed.transform(side).select("_matrix", target)) for side in (train, test))

    def one(features: list[str]) -> PipelineModel:
        slicer = VectorSlicer(inputCol="_matrix", outputCol="_features", indices=[used.index(c) for c in features])
        return PipelineModel([slicer, fit_rows(_regressor(target, **model), slicer.transform(train), rows)])

    fitted = side_by_side([partial(one, features) for features in sets.values()])
    scored = test
    for i, m in enumerate(fitted):
        scored = m.transform(scored).withColumnRenamed("pred", f"_pred{i}").drop("_features")
    lines = [
        F.struct(F.lit(name).alias("features"), mae(f"_pred{i}", target).alias("mae"), r2(f"_pred{i}", target).alias("r2"))
        for i, name in enumerate(sets)
    ]
    table = settle(scored.agg(*[line.alias(f"_m{i}") for i, line in enumerate(lines)]).select(F.inline(F.array(*[f"_m{i}" for i in range(len(lines))]))))
    base = table.filter(F.col("features") == next(iter(sets))).agg(F.max("mae")).scalar()
    return table.withColumn("gain", base - F.col("mae"))


def sampling_bakeoff(
    pool: DataFrame,
    test: DataFrame,
    n: int,
    *,
    ts: str,
    row_id: str,
    strata: list[str],
    features: list[str],
    target: str,
    categorical: list[str] = CATEGORICAL,
    **model,
) -> DataFrame:
    """Three samples of the same size, the same learner, the same full test set; overall and at night."""
    samples = {
        "convenience": convenience(pool, n, ts, row_id),
        "simple random": simple_random(pool, n, row_id),
        "stratified": stratified(pool, n, row_id, strata),
    }
    test = settle(test.select(*dict.fromkeys([*features, target, "hour"])))
    error = F.abs(F.col("pred") - F.col(target))

    def one(name: str, sample: DataFrame) -> DataFrame:
        sample = settle(sample)
        fitted = fit_regressor(sample, features, target, categorical=categorical, **model)
        size = sample.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(is_night()).alias("night"))).scalar()
        report = score(fitted, test).agg(
            F.avg(error).alias("mae_overall"), F.avg(F.when(is_night(), error)).alias("mae_night")
        )
        return settle(
            report.select(
                F.lit(name).alias("sample"),
                size["n"].alias("train_rows"),
                size["night"].alias("night_rows_in_train"),
                "mae_overall",
                "mae_night",
            )
        )

    return _stack(side_by_side([partial(one, name, sample) for name, sample in samples.items()]))


def imbalance_bakeoff(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    target: str,
    *,
    min_precision: float = 0.10,
    categorical: list[str] = CATEGORICAL,
    **model,
) -> DataFrame:
    """Plain against class-weighted, both at 0.5, and the weighted one at its best threshold for the precision.

    Where no threshold is precise enough, the third row has no counts.
    """
    used = list(dict.fromkeys([*features, target]))
    train, test = settle(train.select(*used)), settle(test.select(*used))
    weighted = with_class_weight(train, target)
    fit = partial(fit_classifier, features=features, target=target, categorical=categorical, **model)
    plain_model, weighted_model = side_by_side([partial(fit, train), partial(fit, weighted, weight="weight")])
    scored = score_class(plain_model, test, "p_plain")
    scored = settle(score_class(weighted_model, scored, "p_weighted").select(target, "p_plain", "p_weighted"))
    positive = F.col(target).cast("boolean")
    swept = {c: sweep(scored, c, positive) for c in ("p_plain", "p_weighted")}
    best = recall_at_precision(swept["p_weighted"], min_precision).first()
    best_row = "weighted at best threshold"
    known = best["threshold"] is not None
    decisions = {
        "plain": F.col("p_plain") >= 0.5,
        "weighted": F.col("p_weighted") >= 0.5,
        best_row: F.col("p_weighted") >= best["threshold"] if known else F.lit(False),
    }
    ap = {c: average_precision(s).scalar() for c, s in swept.items()}
    report = confusion_report(scored, decisions, positive)
    if not known:
        report = report.select("model", *[F.when(F.col("model") != best_row, F.col(c)).alias(c) for c in report.columns[1:]])
    plain = F.col("model") == "plain"
    return report.withColumn("avg_precision", F.when(plain, ap["p_plain"]).otherwise(ap["p_weighted"]))


def leak_ladder(
    raw_label: Callable[[bool], DataFrame],
    *,
    features: list[str],
    answer: str,
    from_answer: str,
    history_keys: list[str],
    target: str,
    ts: str,
    row_id: str,
    holdout_days: int = 45,
    categorical: list[str] = CATEGORICAL,
    **model,
) -> DataFrame:
    """R2 and MAE after each of five fixes, from a leaky set-up to an honest one.

    ``raw_label(drop_duplicates)`` gives the labelled rows. The leaky start uses a column that
    is the answer, one computed from it, a history over all rows, twins on both sides and a
    shuffled split; the fixes remove them in that order.
    """
    name = "history_mean"

    def shuffled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = settle(shuffled_split(rows, row_id))
        return (marked.filter("in_train").drop("in_train"), marked.filter(~F.col("in_train")).drop("in_train"))

    def with_history(source: DataFrame, sides: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        history: History = fit_history(source, history_keys, target, name)
        return settle(history.apply(sides[0])), settle(history.apply(sides[1]))

    needed = list(dict.fromkeys([*features, answer, from_answer, *history_keys, target, ts, row_id]))
    # labelling is the longest step and every set of rows below begins with it
    with_twins = settle(raw_label(False).select(*needed))
    twin_sides = shuffled(with_twins)
    all_rows = with_history(with_twins, twin_sides)
    train_only = with_history(twin_sides[0], twin_sides)
    single = settle(raw_label(True).select(*needed))
    single_sides = shuffled(single)
    no_twins = with_history(single_sides[0], single_sides)
    by_time = time_split(single, ts, holdout_days)
    honest = with_history(by_time[0], by_time)

    base = [*features, name]
    steps = [
        ("0 as found", all_rows, [*base, answer, from_answer]),
        ("1 without the answer", all_rows, [*base, from_answer]),
        ("2 without its derivative", all_rows, base),
        ("3 history from train only", train_only, base),
        ("4 without twins", no_twins, base),
        ("5 split by time", honest, base),
    ]

    def one(step: str, sides: tuple[DataFrame, DataFrame], columns: list[str]) -> DataFrame:
        fitted = fit_regressor(sides[0], columns, target, categorical=categorical, **model)
        report = regression_report(score(fitted, sides[1]), "pred", target)
        return settle(report.select(F.lit(step).alias("step"), "r2", "mae", "n"))

    return _stack(side_by_side([partial(one, *step) for step in steps]))


def feature_importances(model: PipelineModel, features: list[str], categorical: list[str] = CATEGORICAL):
    """Feature name -> importance of the fitted trees."""
    return dict(zip(features, [float(x) for x in model.stages[-1].featureImportances.toArray()]))


def can_overfit(train: DataFrame, features: list[str], target: str, *, order: list[str], rows: int = 100, **model):
    """MAE on the same ``rows`` rows the learner was fitted on; far from 0 means a broken label or input."""
    few = settle(train.orderBy(*order).limit(rows))
    fitted = fit_regressor(few, features, target, **{"trees": 40, "depth": 8, **model})
    return score(fitted, few).agg(F.count(F.lit(1)).alias("rows"), mae("pred", target).alias("mae"))


def label_beside_prediction(scored: DataFrame, target: str, order: list[str], rows: int = 5) -> DataFrame:
    return scored.orderBy(*order).limit(rows).select(*order, target, "pred")


def save_model(model: PipelineModel, path: str, metrics: DataFrame, models_table: str, features: list[str]) -> None:
    """Save the pipeline and record where it is, what it was fed and how it did."""
    model.write().overwrite().save(path)
    metrics.select(
        F.lit(path).alias("path"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.to_json(F.struct("*")).alias("metrics"),
        F.current_timestamp().alias("saved_at"),
    ).write.mode("append").parquet(models_table)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def order_reports(train: DataFrame, test: DataFrame, target: str = "actual_minutes", **model) -> dict[str, DataFrame]:
    """The honest model of the order data with its evaluation and slice reports."""
    train, test = serving_frame(train), serving_frame(test)
    fitted = fit_regressor(train, SERVING_FEATURES, target, **model)
    scored = score(fitted, test)
    return {
        "evaluation": evaluation_bundle(scored, train, target, "promised_eta_min"),
        "slices": slice_report(scored, order_slices(), "pred", target),
    }
