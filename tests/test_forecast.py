"""Model grid: coefficient recovery, error rows, intervals, metamorphic checks."""

import datetime as dt

import numpy as np
import pytest

from hebdo.operators import forecast as FC


def _integrate(w, y0):
    y = list(y0)
    for wt in w:
        y.append(wt + y[-1] + y[-52] - y[-53])
    return np.array(y)


def _sim(seed, n=420, phi=0.6):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n)
    w = np.zeros(n)
    for t in range(1, n):
        w[t] = phi * w[t - 1] + e[t]
    base = 100 + 10 * np.sin(2 * np.pi * np.arange(53) / 52)
    return _integrate(w, base)[: n]


def _frame(spark, series: dict):
    rows = [(k, dt.date(2010, 1, 4) + dt.timedelta(days=7 * i), float(v))
            for k, ys in series.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "series_id string, week_date date, cases double")


def test_recovers_ar_coefficient(spark):
    df = _frame(spark, {"a": _sim(1)})
    fits, preds, _ = FC.sarima_grid(df, grid=[(1, 1, 1, 0)])
    r = fits.collect()[0]
    assert r.error == ""
    coef = dict(zip(r.features, r.coef))
    assert abs(coef["w1"] - 0.6) < 0.2
    assert abs(coef["w52"]) < 0.25


def test_error_rows_do_not_fail_the_job(spark):
    pattern = 100 + 10 * np.sin(2 * np.pi * np.arange(52) / 52)
    flat = np.tile(pattern, 8).round(6)  # noise-free seasonal: double difference is exactly 0
    df = _frame(spark, {"flat": flat, "short": np.arange(30.0), "ok": _sim(2)})
    fits, preds, _ = FC.sarima_grid(df)
    errs = {(r.series_id, r.error) for r in fits.collect()}
    assert ("flat", "singular design") in errs
    assert ("short", "series too short") in errs
    assert {e for s, e in errs if s == "ok"} == {""}
    assert fits.count() == 3 * len(FC.GRID)
    fitted = preds.filter("candidate_id <> -1").select("series_id").distinct().collect()
    assert [r.series_id for r in fitted] == ["ok"]


def test_no_series_is_lost(spark):
    """Whatever its length, a series comes out with 26 future weeks, in order, by a stated method."""
    lengths = {f"n{n}": n for n in (1, 2, 10, 53, 60, 120, 200, 240, 400)}
    df = _frame(spark, {k: _sim(9)[:n] if n > 53 else 50 + np.arange(float(n)) for k, n in lengths.items()})
    fits, preds, actual = FC.sarima_grid(df)
    best = fits.filter("error = '' and candidate_id = 0")
    out = FC.with_fallback(preds, best).filter("is_future").toPandas()
    assert out.groupby("series_id").size().to_dict() == {k: 26 for k in lengths}
    assert np.isfinite(out.yhat).all()
    method = out.groupby("series_id").method.first()
    assert method["n10"] == "seasonal_naive" and all(method[f"n{n}"] == "sarima" for n in (200, 240, 400))


@pytest.mark.parametrize("exog", [None, "heat"])
def test_rule_a_without_training_weeks(spark, exog):
    """Rule A holds out at least 4 weeks: such series get their error rows and a null fallback, the others are fitted."""
    from pyspark.sql import functions as F
    lengths = {f"n{n}": n for n in (1, 2, 3, 4, 5, 300)}
    df = _frame(spark, {k: _sim(9)[:n] for k, n in lengths.items()}).withColumn("heat", F.dayofyear("week_date").cast("double"))
    fits, preds, _ = FC.sarima_grid(df, grid=[FC.DEFAULT_ORDER], rule="A", exog=exog)
    errs = {r.series_id: (r.error, r.n_train) for r in fits.collect()}
    assert errs == {k: ("series too short", max(0, n - 4)) if n < 300 else ("", 248) for k, n in lengths.items()}
    out = FC.with_fallback(preds, fits.filter("error = ''")).toPandas()
    for k, n in lengths.items():
        mine = out[out.series_id == k].sort_values("step")
        assert mine.is_future.sum() == 26 and mine.yhat.isna().all() == (n <= 4) and mine.yhat.notna().all() == (n > 4)
        assert mine.week_date.iloc[0] == dt.date(2010, 1, 4) + dt.timedelta(7 * (max(0, n - 4) if n < 300 else 248))


def _sim_ma(seed, n, theta=-0.4, seasonal=-0.7):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 53)
    w = e[53:] + theta * e[52:-1] + seasonal * e[1:-52] + theta * seasonal * e[:-53]
    return w


@pytest.mark.parametrize("n,most", [(1500, 0.05), (420, 0.12)])
def test_recovers_moving_average_terms(n, most):
    w = np.stack([_sim_ma(s, n) for s in range(8)], axis=1)
    feats = FC.candidate_features(1, 1, 0, 1, False)
    beta, e, fine = FC.fit_css(w, None, feats)
    coef = dict(zip(feats, beta.T))
    # (1 - phi B) is free here and near 0: compare the implied short-lag weights
    assert fine.all()
    for name, true in (("e52", -0.7),):
        assert abs(coef[name].mean() - true) < most
    assert abs((coef["w1"] + coef["e1"]).mean() + 0.4) < most
    assert abs(e[60:].std() - 1) < 0.1


def test_gradient_is_zero_at_the_fit():
    """Normal equations: the derivative of every residual recursion is orthogonal to the residuals."""
    w = np.stack([_sim_ma(s, 400) for s in range(3)], axis=1)
    feats = FC.candidate_features(1, 2, 1, 0, False)
    beta, e, _ = FC.fit_css(w, None, feats)
    for i in range(len(feats)):
        step = np.zeros_like(beta)
        step[:, i] = 1e-4
        up, down = FC._residuals(w, None, feats, beta + step), FC._residuals(w, None, feats, beta - step)
        slope = ((up ** 2).sum(0) - (down ** 2).sum(0)) / 2e-4
        assert np.all(np.abs(slope) < 1e-3 * (e ** 2).sum(0))


def test_intervals_widen_and_future_count(spark):
    df = _frame(spark, {"a": _sim(3)})
    fits, preds, _ = FC.sarima_grid(df, grid=[(1, 1, 0, 1)])
    p = preds.filter("candidate_id <> -1").orderBy("step").toPandas()
    width = (p.hi95 - p.lo95).to_numpy()
    assert np.all(np.diff(width) >= -1e-9)
    assert int(p.is_future.sum()) == FC.HORIZON
    assert (~p.is_future).sum() == 52


def test_alone_equals_among_many(spark):
    a = _sim(4)
    alone = FC.sarima_grid(_frame(spark, {"a": a}))[0]
    many = FC.sarima_grid(_frame(spark, {"a": a, "b": _sim(5), "c": _sim(6)}).repartition(7))[0]
    x = {(r.candidate_id): r.coef for r in alone.collect()}
    y = {(r.candidate_id): r.coef for r in many.filter("series_id = 'a'").collect()}
    for k in x:
        assert np.allclose(x[k], y[k], rtol=1e-9, atol=1e-12)


def test_weeks_stacked_at_once_stay_bounded_however_many_series_come(spark, monkeypatch):
    """A batch of many series, one of them far longer than the rest, is fitted in runs, each row as it is alone."""
    import pyarrow as pa
    sizes = {f"s{i}": 110 + 7 * (i % 9) for i in range(40)} | {"long": 600}
    df = _frame(spark, {k: _sim(i, n) for i, (k, n) in enumerate(sizes.items())})
    caught, real = {}, type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, *a: caught.update(run=run, rows=self) or real(self, run, *a))
    fits = FC.sarima_grid(df, grid=[(1, 1, 0, 1)])[0].collect()
    monkeypatch.setattr(FC, "CELLS", 1000)
    stacks, fit = [], FC.fit_css
    monkeypatch.setattr(FC, "fit_css", lambda w, x, feats: stacks.append(w.shape) or fit(w, x, feats))
    batch = pa.Table.from_batches(caught["rows"].toArrow().to_batches()).combine_chunks().to_batches()[0]
    out = [r for part in caught["run"]([batch]) for r in part.to_pylist() if r["candidate_id"] != FC.FALLBACK]
    assert batch.num_rows == len(sizes) and max(n for _, n in stacks) > 1
    assert all(n == 1 or weeks * n <= 1000 for weeks, n in stacks)
    assert sorted((r["series_id"], r["error"]) for r in out) == sorted((r["series_id"], r["error"]) for r in fits)
    alone = {r["series_id"]: r["coef"] for r in fits}
    for r in out:
        assert r["error"] or np.allclose(r["coef"], alone[r["series_id"]], rtol=1e-9, atol=1e-12)


def test_harmonic_fits_pure_seasonal(spark):
    t = np.arange(300)
    y = 50 + 5 * np.sin(2 * np.pi * 7 * t / 365.25) + 0.1 * t
    df = _frame(spark, {"h": y})
    out = FC.harmonic_candidate(df).toPandas()
    assert len(out) == 52
    assert np.max(np.abs(out.y - out.yhat)) < 1e-6


@pytest.mark.parametrize("order", FC.GRID)
def test_candidate_feature_sets(order):
    f = FC.candidate_features(*order, exog=False)
    p, q, P, Q = order
    assert len(f) == p + q + P * (1 + p) + Q * (1 + q)
