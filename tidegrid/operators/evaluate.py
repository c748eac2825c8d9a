"""Forecast errors, backtests and model comparison."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.operators.baseline import seasonal_naive
from tidegrid.operators.select import training_part, validation_part
from tidegrid.operators.windows import seasonal_lags
from tidegrid.spec import Spec

# Compared metrics and their labels in reports, in report order.
METRIC_LABELS = {"mape": "MAPE", "mse": "MSE", "wmape": "wMAPE"}


def error_aggregates(y: Column, yhat: Column) -> dict[str, Column]:
    """Error measures of pairs; pairs with a missing side do not count.

    ``mape_nonzero`` leaves out rows with a zero actual. ``mape`` is undefined (NULL)
    as soon as one actual is zero. Without any pair all measures are NULL.
    """
    usable = y.isNotNull() & yhat.isNotNull()
    error = F.when(usable, y - yhat)
    relative = F.abs(F.try_divide(error, y))
    return {
        "n": F.count_if(usable),
        "mape": F.when(F.count_if(usable & (y == 0)) == 0, F.avg(relative) * 100),
        "mape_nonzero": F.avg(relative) * 100,
        "mse": F.avg(error * error),
        "rmse": F.sqrt(F.avg(error * error)),
        "wmape": F.try_divide(F.sum(F.abs(error)), F.sum(F.when(usable, F.abs(y)))) * 100,
    }


def metrics(actual: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Errors per series and model; a model without common stamps gets NULL errors."""
    y = actual.select("series_id", "ts", F.col("value").alias("y"))
    scored = forecasts.select("series_id", "model", "ts", "yhat").join(y, ["series_id", "ts"], "left")
    aggs = error_aggregates(F.col("y"), F.col("yhat"))
    return scored.groupBy("series_id", "model").agg(*[c.alias(name) for name, c in aggs.items()])


def backtest_seasonal(regular: DataFrame, spec: Spec) -> DataFrame:
    """Errors of the seasonal lag predictors over the last validation days.

    Series with less history than the validation days plus one are left out.
    """
    lags = seasonal_lags(regular.where(F.col("n") >= spec.min_backtest), spec)
    pairs = lags.unpivot(["series_id", "value"], ["lag_value", "lag_mean"], "model", "yhat")
    aggs = error_aggregates(F.col("value"), F.col("yhat"))
    named = F.when(F.col("model") == "lag_value", "seasonal_naive").otherwise("slot_average")
    wanted = ("n", "mape_nonzero", "rmse")
    return pairs.withColumn("model", named).groupBy("series_id", "model").agg(
        *[aggs[name].alias(name) for name in wanted]
    )


Forecaster = Callable[[DataFrame, Spec, int], DataFrame]


def baseline_models(spec: Spec) -> dict[str, Forecaster]:
    """The two seasonal baselines, in report order."""
    return {
        "seasonal_naive": lambda df, s, steps: seasonal_naive(df, s, steps, 0, "seasonal_naive"),
        "kday_average": lambda df, s, steps: seasonal_naive(df, s, steps, spec.k_days, "kday_average"),
    }


def baseline_tail(spec: Spec) -> int:
    """Newest rows the baselines and their hold-out scores read."""
    return spec.validation_steps + max(spec.k_days, 1) * spec.period


def forecasts_of(regular: DataFrame, models: Mapping[str, Forecaster], spec: Spec, steps: int) -> DataFrame:
    """Forecasts of all models in one table; what only some of them have is NULL elsewhere."""
    out = None
    for name, make in models.items():
        part = make(regular, spec, steps).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no models")
    return out


def holdout_forecasts(regular: DataFrame, models: Mapping[str, Forecaster], spec: Spec) -> DataFrame:
    """Forecasts of the validation days from the rows before them, all series and models."""
    return forecasts_of(training_part(regular, spec), models, spec, spec.validation_steps)


def backtest_holdout(regular: DataFrame, models: Mapping[str, Forecaster], spec: Spec) -> DataFrame:
    """Errors of every model on the validation days."""
    return metrics(validation_part(regular, spec), holdout_forecasts(regular, models, spec))


def _long(scores: DataFrame) -> DataFrame:
    return scores.unpivot(["series_id", "model"], list(METRIC_LABELS), "metric", "score")


def compare_models(scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """Per series and metric: the score of each model and the best one.

    The lowest score wins, the model listed first on a tie, ``N/A`` if none has one.
    """
    rank = F.lit(None).cast("int")
    for i, m in reversed(list(enumerate(models))):
        rank = F.when(F.col("model") == m, F.lit(i)).otherwise(rank)
    ranked = F.when(F.col("score").isNotNull() & rank.isNotNull(), F.struct("score", rank.alias("rank")))
    columns = [F.max(F.when(F.col("model") == m, F.col("score"))).alias(m) for m in models]
    best = F.coalesce(F.min_by("model", ranked), F.lit("N/A")).alias("best_model")
    return _long(scores).groupBy("series_id", "metric").agg(*columns, best)


def improvement(scores: DataFrame, baseline: str) -> DataFrame:
    """Relative gain of every model over the baseline in percent.

    NULL where the baseline score is zero or missing. A window holds one row per model.
    """
    base = F.max(F.when(F.col("model") == baseline, F.col("score"))).over(W.partitionBy("series_id", "metric"))
    gains = _long(scores).withColumn("base_score", base).where(F.col("model") != baseline)
    return gains.withColumn(
        "improvement", F.try_divide(F.col("base_score") - F.col("score"), F.col("base_score")) * 100
    )


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Range and mean of each forecast, and the mean interval bounds where there are any."""
    bounds = [F.avg(c).alias(f"mean_{c}") for c in ("lower", "upper") if c in forecasts.columns]
    return forecasts.groupBy("series_id", "model").agg(
        F.count(F.lit(1)).alias("steps"),
        F.min("yhat").alias("min_yhat"),
        F.max("yhat").alias("max_yhat"),
        F.avg("yhat").alias("mean_yhat"),
        *bounds,
    )


def interval_coverage(actual: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Share of actuals inside the interval ``lower..upper`` per series and model."""
    y = actual.select("series_id", "ts", F.col("value").alias("y"))
    inside = F.col("y").between(F.col("lower"), F.col("upper")).cast("double")
    return (
        forecasts.join(y, ["series_id", "ts"])
        .groupBy("series_id", "model")
        .agg(F.count("y").alias("n"), F.avg(inside).alias("coverage"))
    )
