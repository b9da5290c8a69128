"""Checks of stored models: what is right passes, what was altered is caught; forecasts against a plain loop."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hebdo.operators import forecast as FC
from hebdo.operators import model_checks as MC
from tests.test_forecast import _frame, _sim


@pytest.fixture(scope="module")
def fitted(spark):
    df = _frame(spark, {"a": _sim(1), "b": _sim(2, n=300)}).cache()
    fits, preds, _ = FC.sarima_grid(df, grid=[(1, 1, 1, 0), (1, 2, 0, 1)])
    return df, fits, preds


def test_fits_are_minima_and_altered_ones_are_not(spark, fitted):
    df, fits, preds = fitted
    assert all(r.sse_matches and r.is_minimum for r in MC.css_optimality(fits, df).collect())
    moved = fits.withColumn("coef", F.transform("coef", lambda c, i: F.when(i == 0, c + 0.05).otherwise(c)))
    got = MC.css_optimality(moved, df).collect()
    assert len(got) == 4 and not any(r.sse_matches or r.is_minimum for r in got)
    noisy = fits.withColumn("sigma2", F.col("sigma2") * 1.001)
    assert not any(r.sse_matches for r in MC.css_optimality(noisy, df).collect())


def test_altered_predictions_are_caught(spark, fitted):
    df, fits, preds = fitted
    ok = MC.recomputed_forecasts(fits, preds, df).collect()
    assert len(ok) == 4 and all(r.yhat_matches and r.lo95_matches and r.hi95_matches and r.n_steps == 78 for r in ok)
    bad = preds.withColumn("hi95", F.col("hi95") + F.when(F.col("step") == 40, 0.01 * F.abs("hi95")).otherwise(0.0))
    got = MC.recomputed_forecasts(fits, bad, df).collect()
    assert all(r.yhat_matches and r.lo95_matches and not r.hi95_matches for r in got)
    lost = MC.recomputed_forecasts(fits, preds.filter("step <> 3"), df).collect()
    assert not any(r.yhat_matches for r in lost)


def plain_forecast(y, terms, sigma2, steps):
    w = [y[t] - y[t - 1] - y[t - 52] + y[t - 53] for t in range(53, len(y))]
    e, y, n = [], list(y), len(w)
    for t in range(n + steps):
        fit = sum(c * (w if k[0] == "w" else e)[t - int(k[1:])] for k, c in terms if t >= int(k[1:]))
        if t < n:
            e.append(w[t] - fit)
        else:
            w.append(fit)
            e.append(0.0)
            y.append(fit + y[-1] + y[-52] - y[-53])
    shock, sw, se = [], [], []
    for t in range(steps):
        se.append(float(t == 0))
        sw.append(sum(c * (sw if k[0] == "w" else se)[t - int(k[1:])] for k, c in terms if t >= int(k[1:])) + se[t])
        back = lambda k: shock[t - k] if t >= k else 0.0
        shock.append(sw[t] + back(1) + back(52) - back(53))
    return y[-steps:], 1.96 * np.sqrt(sigma2 * np.cumsum(np.square(shock)))


def test_stored_parameters_give_the_forecast_of_a_plain_loop(spark):
    series = {"a": _sim(3), "b": _sim(4, n=160)}
    terms = [("w1", 0.4), ("w2", -0.1), ("e1", -0.5), ("w52", -0.2), ("e52", 0.3), ("e53", 0.05)]
    table = spark.createDataFrame([(s, k, c, 2.25) for s in series for k, c in terms], "series_id string, term string, coef double, sigma2 double")
    got = MC.forecast_from_params(_frame(spark, series), MC.stored_params(table), horizon=60).collect()
    for name, ys in series.items():
        path, half = plain_forecast(ys, terms, 2.25, 60)
        rows = sorted((r for r in got if r.series_id == name), key=lambda r: r.step)
        assert [r.step for r in rows] == list(range(1, 61))
        assert rows[0].week_date == dt.date(2010, 1, 4) + dt.timedelta(days=7 * len(ys))
        assert np.allclose([r.yhat for r in rows], path) and np.allclose([r.hi95 - r.yhat for r in rows], half)
        assert np.allclose([r.yhat - r.lo95 for r in rows], half)


def test_refit_takes_all_weeks_and_keeps_the_order(spark, fitted):
    df, fits, preds = fitted
    best = spark.createDataFrame([("a", 0), ("b", 1)], "series_id string, candidate_id int")
    full, ahead = FC.refit_full(df, best)
    grid = {r.series_id: (r.candidate_id, r.n_train, r.p, r.q) for r in full.collect()}
    assert grid["a"][:2] == (0, 420) and grid["b"][:2] == (1, 300)
    first = {r.series_id: r.d for r in ahead.groupBy("series_id").agg(F.min("week_date").alias("d")).collect()}
    assert first["a"] == dt.date(2010, 1, 4) + dt.timedelta(days=7 * 420)
    assert ahead.filter("candidate_id <> -1 and is_future").count() == 52 and ahead.filter("not is_future").count() == 0


def test_harmonic_residuals_and_ranking(spark):
    rng = np.random.default_rng(5)
    df = _frame(spark, {"a": 50 + 10 * np.sin(np.arange(300) / 8) + rng.normal(0, 1, 300)})
    assert [(r.n_terms, r.orthogonal) for r in MC.harmonic_normal_equations(df).collect()] == [(22, True)]
    board = spark.createDataFrame([("s", "SARIMAX", 1, 3.0, 9.0, 2), ("s", "SARIMAX", 2, 2.0, 9.5, 3), ("s", "Naive52", None, None, 5.0, 1),
                                   ("s", "SARIMAX", 3, None, None, 4)], "series_id string, model string, candidate_id int, aic double, rmse double, rank int")
    best = lambda c: spark.createDataFrame([("s", c, False)], "series_id string, candidate_id int, is_default boolean")
    assert tuple(MC.ranking(board, best(1)).collect()[0]) == ("s", 4, True, True)
    assert tuple(MC.ranking(board, best(2)).collect()[0]) == ("s", 4, True, False)
    wrong = board.withColumn("rank", F.when(F.col("rank") > 2, 7 - F.col("rank")).otherwise(F.col("rank")))
    assert tuple(MC.ranking(wrong, best(1)).collect()[0]) == ("s", 4, False, True)
