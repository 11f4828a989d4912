"""Reports over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.scores import (
    bias,
    confusion_columns,
    confusion_rates,
    idle_minutes,
    idle_per_thousand,
    mae,
    promises_broken,
    r2,
    regression_columns,
)
from punctual.operators.lookup import attach
from punctual.operators.quantiles import group_quantiles
from punctual.session import settle

# The quantiles that a promise is swept over.
ALPHAS = (0.5, 0.6, 0.7, 0.8, 0.9)


def regression_report(scored: DataFrame, pred: str, actual: str, by: list[str] = ()) -> DataFrame:
    """n, mae, bias and r2, over all rows or per group."""
    measures = [c.alias(n) for n, c in regression_columns(pred, actual).items()]
    return scored.groupBy(*by).agg(*measures) if by else scored.agg(*measures)


def baseline_table(test: DataFrame, actual: str, baselines: dict[str, Column]) -> DataFrame:
    """MAE, bias and r2 of several predictions of the same rows, best first, in one pass."""
    named = test.select(F.col(actual).alias("_y"), *[c.alias(f"_p{i}") for i, c in enumerate(baselines.values())])
    measures = []
    for i in range(len(baselines)):
        measures += [f(f"_p{i}", "_y").alias(f"{k}{i}") for k, f in (("mae", mae), ("bias", bias), ("r2", r2))]
    lines = [
        F.struct(F.lit(name).alias("baseline"), *[F.col(f"{k}{i}").alias(k) for k in ("mae", "bias", "r2")])
        for i, name in enumerate(baselines)
    ]
    return named.agg(*measures).select(F.inline(F.array(*lines))).orderBy("mae", "baseline")


def confusion_report(scored: DataFrame, decisions: dict[str, Column], positive: Column) -> DataFrame:
    """Counts and rates of several yes/no decisions about the same rows, in one pass."""
    counts, lines = [], []
    for i, (name, hit) in enumerate(decisions.items()):
        columns = confusion_columns(hit, positive)
        counts += [c.alias(f"{n}{i}") for n, c in columns.items()]
        lines.append(F.struct(F.lit(name).alias("model"), *[F.col(f"{n}{i}").alias(n) for n in columns]))
    table = scored.agg(*counts).select(F.inline(F.array(*lines)))
    return table.withColumns(confusion_rates())


def promise_counters(scored: DataFrame, pred: str, actual: str, by: list[str] = ()) -> DataFrame:
    """The two business counters that move against each other, and the error."""
    measures = [
        promises_broken(pred, actual).alias("promises_broken"),
        idle_minutes(pred, actual).alias("idle_minutes"),
        idle_per_thousand(pred, actual).alias("idle_per_1k"),
        mae(pred, actual).alias("mae"),
    ]
    return scored.groupBy(*by).agg(*measures) if by else scored.agg(*measures)


def quantile_promises(
    train: DataFrame, test: DataFrame, pred: str, actual: str, segment: str, alphas: tuple[float, ...] = ALPHAS
) -> DataFrame:
    """Test rows once per alpha with a promise: the prediction plus the alpha-quantile of the
    train residuals of the row's segment. A segment unseen in train uses all residuals."""
    residuals = train.select(segment, (F.col(actual) - F.col(pred)).alias("_residual"))
    names = {f"_q{i}": a for i, a in enumerate(alphas)}
    per_segment = group_quantiles(residuals, [segment], "_residual", names)
    per_segment = settle(per_segment)
    unseen_segments = test.select(segment).distinct().join(per_segment, segment, "left_anti").limit(1).count()
    overall = group_quantiles(residuals, [], "_residual", names).first() if unseen_segments else dict.fromkeys(names)
    joined = attach(test, per_segment, segment)
    lines = [
        F.struct(
            F.lit(float(a)).alias("alpha"),
            (F.col(pred) + F.coalesce(F.col(name), F.lit(overall[name]).cast("double"))).alias("promise"),
        )
        for name, a in names.items()
    ]
    return joined.select(*test.columns, F.inline(F.array(*lines)))


def alpha_report(promised: DataFrame, actual: str) -> DataFrame:
    """One row per alpha: broken promises, idle minutes per 1,000 rows, MAE and median promise."""
    counters = promise_counters(promised, "promise", actual, ["alpha"]).drop("idle_minutes")
    medians = group_quantiles(promised, ["alpha"], "promise", {"median_promise": 0.5})
    return counters.join(medians, "alpha")


def silent_fallbacks(scored: DataFrame, default_flag: str, filled: str) -> DataFrame:
    """How often scoring fell back without saying so: unknown keys and filled values."""
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(default_flag).cast("double")).alias("default_rate"),
        F.avg((F.col(filled) > 0).cast("double")).alias("filled_rate"),
    )


def skew_between(train: DataFrame, served: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each feature where the model learned it and where it is served."""
    def means(df: DataFrame) -> Column:
        return df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()

    a, b = means(train), means(served)
    lines = [
        F.struct(F.lit(c).alias("feature"), a[c].alias("train_mean"), b[c].alias("served_mean")) for c in columns
    ]
    return train.sparkSession.range(1).select(F.inline(F.array(*lines)))
