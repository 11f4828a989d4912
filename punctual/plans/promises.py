"""Promises at chosen quantiles, learned from the features: trees find the segments, exact quantiles fill their leaves.

The rows that shape the model and the rows that fill the leaves are not the same ones, so that a promise at
alpha is kept by about alpha of the rows that nobody has seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.scores import idle_per_thousand, mae, promises_broken
from punctual.operators.evaluation import ALPHAS
from punctual.operators.lookup import attach
from punctual.operators.quantiles import column_medians, group_quantiles
from punctual.operators.sampling import shuffled_split
from punctual.plans.training import CATEGORICAL, MAX_BINS, MOST_CATEGORIES, fit_regressor, prepared, score
from punctual.session import settle


@dataclass
class PromiseModel:
    """``base`` predicts the middle (None: 0), ``tree`` the leaf of a row, ``leaves`` holds a leaf's quantiles of
    what is left, one column ``_q0``, ``_q1``, ... per alpha, and ``overall`` those of all rows."""

    base: PipelineModel | None
    tree: PipelineModel
    leaves: DataFrame
    overall: dict[str, float | None]
    alphas: tuple[float, ...]

    def promise(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``promises``, an array of the promises in the order of ``alphas``.

        Promises never fall as alpha rises. A leaf without a filling row takes the quantiles of all rows.
        """
        middle = score(self.base, rows).withColumnRenamed("pred", "_base") if self.base else rows.withColumn("_base", F.lit(0.0))
        placed = self.tree.transform(middle).select(*rows.columns, "_base", F.col("_leaf").cast("int").alias("_leaf"))
        known = attach(placed, self.leaves, "_leaf")
        each = [F.col("_base") + F.coalesce(F.col(n), F.lit(v).cast("double")) for n, v in self.overall.items()]
        return known.select(*rows.columns, F.array(*each).alias("promises"))


def fit_promises(
    train: DataFrame,
    features: list[str],
    target: str,
    row_id: str,
    *,
    alphas: tuple[float, ...] = ALPHAS,
    categorical: list[str] = CATEGORICAL,
    with_base: bool = True,
    depth: int = 4,
    least_rows: int = 200,
    fraction: float = 0.5,
    seed: int = 2026,
    most_categories: int = MOST_CATEGORIES,
    **model,
) -> PromiseModel:
    """Learn promises for all ``alphas`` at once.

    One share of the rows, chosen by hash, fits the base model and a tree over how far off it is
    (over the target itself without a base). The other share passes through both, and each leaf of the tree gets its
    exact residual quantiles, all alphas in one reading. Leaves hold ``least_rows`` fitting rows at least.
    """
    used = list(dict.fromkeys([*features, target, row_id]))
    known = train.select(*used).filter(F.col(target).isNotNull())
    marked = settle(shuffled_split(known, row_id, fraction=fraction, seed=seed))
    shape, fill = (marked.filter(f).drop("in_train") for f in (F.col("in_train"), ~F.col("in_train")))
    base = fit_regressor(shape, features, target, categorical=categorical, seed=seed, **model) if with_base else None

    def off(rows: DataFrame) -> DataFrame:
        scored = score(base, rows) if base else rows.withColumn("pred", F.lit(0.0))
        return scored.withColumn("_residual", F.col(target).cast("double") - F.col("pred")).drop("pred")

    spread = F.abs("_residual") if base else F.col("_residual")
    narrow = settle(off(shape).withColumn("_spread", spread).drop("_residual"))
    learner = DecisionTreeRegressor(
        featuresCol="_features", labelCol="_spread", predictionCol="_expected", leafCol="_leaf", maxDepth=depth,
        maxBins=MAX_BINS, minInstancesPerNode=least_rows, seed=seed,
    )
    tree = Pipeline(stages=[*prepared(narrow, features, categorical, most_categories), learner]).fit(narrow)
    names = {f"_q{i}": a for i, a in enumerate(alphas)}
    placed = settle(tree.transform(off(fill)).select(F.col("_leaf").cast("int").alias("_leaf"), "_residual"))
    leaves = settle(group_quantiles(placed, ["_leaf"], "_residual", names))
    overall = group_quantiles(placed, [], "_residual", names).first()
    return PromiseModel(base, tree, leaves, {n: overall[n] if overall else None for n in names}, tuple(alphas))


def promise_sweep(promised: DataFrame, actual: str, alphas: tuple[float, ...] = ALPHAS) -> DataFrame:
    """One row per alpha: rows, broken promises, idle minutes per 1,000 rows, MAE and median promise.

    All counters of all alphas come from one pass over the rows as they are; only the medians take a value per alpha.
    ``never_falls`` says if no row's promise is lower than at the alpha before.
    """
    names = [f"_p{i}" for i in range(len(alphas))]
    wide = promised.select(F.col(actual).alias("_y"), *[F.col("promises")[i].alias(n) for i, n in enumerate(names)])
    measures: list[Column] = []
    for i, n in enumerate(names):
        rises = F.lit(True) if not i else F.bool_and(F.col(n) >= F.col(names[i - 1]))
        measures.append(
            F.struct(
                F.lit(float(alphas[i])).alias("alpha"), F.count("_y").alias("rows"), promises_broken(n, "_y").alias("promises_broken"),
                idle_per_thousand(n, "_y").alias("idle_per_1k"), mae(n, "_y").alias("mae"), rises.alias("never_falls"),
            ).alias(f"_m{i}")
        )
    counted = wide.agg(*measures).select(F.inline(F.array(*[f"_m{i}" for i in range(len(names))])))
    medians = column_medians(wide, [], dict(zip(names, names, strict=True))).first()
    middle = F.create_map(*[x for a, n in zip(alphas, names, strict=True) for x in (F.lit(float(a)), F.lit(medians[n] if medians else None).cast("double"))])
    return counted.withColumn("median_promise", F.element_at(middle, F.col("alpha")))
