"""Regular tables that carry their stretches: the same rows and forecasts, and no grid row is shuffled."""

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.helpers import series, stamp
from tests.test_properties import READINGS, RELAXED, frame
from tidegrid.operators import regression, regularise, stretched
from tidegrid.plans.catalog import QUERIES
from tidegrid.plans.comparison import all_models
from tidegrid.spec import Spec

ORDER = ["series_id", "pos"]


def both(raw, spec, reach):
    return regularise.regularise(raw, spec), stretched.saved_rows(regularise.regularise(raw, spec, reach=reach), spec)


def waves(spark):
    """A long series with gaps, one without a full week, one shorter than a season, one of one row."""
    rng = np.random.default_rng(5)
    at = {"long": sorted({0, 699, *rng.integers(0, 699, 150).tolist()}), "week": [0, 9, 27], "brief": [0, 2], "one": [3]}
    return series(spark, [(s, 30 * i, float(np.sin(i / 3) * 5 + i % 4 + 20)) for s, slots in at.items() for i in slots])


@RELAXED
@given(rows=READINGS, chunk=st.sampled_from([1, 7, 4096]), reach=st.sampled_from([1, 5]))
def test_rows_are_those_of_the_regular_table(spark, rows, chunk, reach):
    _, df = frame(spark, rows)
    plain, carried = both(df, Spec(chunk=chunk), reach)
    a, b = (t.select(*plain.columns).toPandas().sort_values(ORDER).reset_index(drop=True) for t in (plain, carried))
    assert a.equals(b)
    beside = {(r["series_id"], r["pos"]): r["b"] for r in carried.select(*ORDER, stretched.back(reach).alias("b")).collect()}
    known = {(r.series_id, r.pos): r.value for r in a.itertuples()}
    assert all(v == known.get((s, p - reach)) for (s, p), v in beside.items())


def test_models_say_the_same(spark):
    spec = Spec(period=4, horizon=6, chunk=50)
    plain, carried = both(waves(spark), spec, 7 * spec.period)
    makes = dict(all_models(spec))
    for exog in ("calendar", "asof"):
        makes[exog] = lambda df, s, h, e=exog: regression.lag_recursive(df, None, s, h, exog_future=e, share=0.8, scaler_share=0.7, cap=300)
    makes["share"] = lambda df, s, h: regression.direct_horizon(df, s, h, share=0.8, scaler_share=0.7)
    makes["seasons"] = lambda df, s, h: regression.ar1(df, s, h, train_seasons=20)
    makes["deep"] = lambda df, s, h: regression.direct_horizon(df, s, h, lookback=40)
    for name, make in makes.items():
        a, b = (make(t, spec, 6).toPandas().sort_values(["series_id", "h"]).reset_index(drop=True) for t in (plain, carried))
        assert list(a.columns) == list(b.columns) and len(a) == 4 * 6, name
        for c in a.columns:
            if c in ("yhat", "lower", "upper"):
                np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=1e-8, atol=1e-8, err_msg=name)
            else:
                assert a[c].equals(b[c]), (name, c)


def test_tails_are_refused_as_before(spark):
    spec = Spec(period=4, horizon=6)
    _, carried = both(waves(spark), spec, 7 * spec.period)
    for name in ("ar1", "ar_p", "lag_recursive", "direct_horizon"):
        with pytest.raises(Exception, match="needs whole series"):
            all_models(spec)[name](carried.where("pos >= 100"), spec, 4).collect()
    with pytest.raises(ValueError):
        regularise.regularise(waves(spark), spec, tail=3, reach=4)


def written(plan):
    """Rows that the exchanges of an executed plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return written(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return written(plan.plan())
    metric = "shuffleRecordsWritten"
    own = plan.metrics().apply(metric).value() if plan.metrics().contains(metric) else 0
    below = [x for found in (plan.children(), plan.subqueries()) for x in (found.apply(i) for i in range(found.size()))]
    return own + sum(written(x) for x in below)


def test_models_used_shuffles_no_grid_rows(spark, tmp_path):
    """Nine readings in 1,300 hours: what is shuffled follows the series, not the hours between."""
    rows = [(k, stamp(60 * h), user, "view", float(k), "{}") for user in (1, 2) for k, h in enumerate([0, 5, 30, 200, 201, 600, 900, 901, 1300])]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    df = QUERIES["models_used"](spark, str(tmp_path))
    found = df.collect()
    used = {(r["model"], r["model_used"], r["steps"]) for r in found if r["series_id"] == "1/all"}
    assert used == {(m, m, 48) for m in ("seasonal_naive", "kday_average", "ar1", "ar_p", "lag_recursive", "direct_horizon")}
    names = len({r["series_id"] for r in found})
    assert len(found) == 6 * names
    assert written(df._jdf.queryExecution().executedPlan()) < 40 * names < 1301
