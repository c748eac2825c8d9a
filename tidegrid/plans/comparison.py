"""The whole job: regularise, report gaps, backtest, forecast, compare."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidegrid.operators import analogue, arma, basis, boosted, features, regression, stacked
from tidegrid.operators.evaluate import Forecaster, backtest_holdout, baseline_models, compare_models, forecasts_of
from tidegrid.operators.gaps import top_missing_blocks
from tidegrid.operators.regularise import regularise
from tidegrid.session import saved
from tidegrid.sources.sinks import forecast_table, report_lines
from tidegrid.spec import Spec


@dataclass(frozen=True)
class Comparison:
    """Results over one saved regular table; the rest runs when it is used."""

    regular: DataFrame
    gaps: DataFrame
    scores: DataFrame
    best: DataFrame
    forecasts: DataFrame
    table: DataFrame
    report: DataFrame


def run_comparison(
    raw: DataFrame, spec: Spec, models: dict[str, Forecaster] | None = None
) -> Comparison:
    """Every series and model of ``raw`` (``series_id, ts, value``) in one set of plans.

    The regular table is written down once (see ``session.saved``); every result reads that copy.
    """
    models = models or baseline_models(spec)
    regular = saved(regularise(raw, spec))
    scores = backtest_holdout(regular, models, spec)
    best = compare_models(scores, list(models))
    forecasts = forecasts_of(regular, models, spec, spec.horizon)
    return Comparison(
        regular=regular,
        gaps=top_missing_blocks(raw, spec),
        scores=scores,
        best=best,
        forecasts=forecasts,
        table=forecast_table(regular, forecasts, list(models)),
        report=report_lines(best, list(models)),
    )


def all_models(spec: Spec, weather: DataFrame | None = None, max_p: int = 2) -> dict[str, Forecaster]:
    """Every forecaster under one form, the baselines first.

    With ``weather`` the order search and the direct model also come with weekend and temperature:
    known stamps of the past from the weather, future ones from the calendar and from a year or a
    week before. Every model answers for every series; ``model_used`` names a substitute.
    """
    cols = ["is_weekend", "temperature_2m"]

    def with_covariates(make):
        def run(df: DataFrame, s: Spec, steps: int) -> DataFrame:
            table = features.exog_matrix(df, weather, s)
            ahead = features.future_covariates(table, s, steps)
            return make(table.withColumnRenamed("demand", "value"), s, steps, exog_cols=cols, future=ahead)

        return run

    models = baseline_models(spec) | {
        "ar1": regression.ar1,
        "ar_p": lambda df, s, steps: regression.ar_forecast(df, s, steps, max_p=max_p),
        "lag_recursive": lambda df, s, steps: regression.lag_recursive(df, weather, s, steps),
        "direct_horizon": regression.direct_horizon,
    }
    if weather is not None:
        models["ar_exog"] = with_covariates(
            lambda df, s, steps, **known: regression.ar_forecast(df, s, steps, max_p=max_p, model="ar_exog", **known)
        )
        models["direct_exog"] = with_covariates(
            lambda df, s, steps, **known: regression.direct_horizon(df, s, steps, model="direct_exog", **known)
        )
    return models


def fitted_models() -> dict[str, Forecaster]:
    """Forecasters whose fit runs while the plan is built: shocks, stacked blocks, trees, basis functions, past windows."""
    return {
        "arma": arma.arma_forecast,
        "stacked_horizon": stacked.stacked_horizon,
        "boosted_recursive": lambda df, s, steps: boosted.boosted_recursive(df, s, steps, trees=10),
        "basis": basis.basis_forecast,
        "analogue": analogue.analogue_forecast,
    }
