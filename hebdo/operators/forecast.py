"""Seasonal ARIMA candidate grid, harmonic regression and forecasts for many series.

Model: regression with SARIMA(p,1,q)(P,1,Q,52) errors. The source fits it by
exact state-space maximum likelihood; here it is estimated by conditional
least squares: values and residuals before the first differenced week are 0,
and the sum of squared one-step residuals is minimised by Gauss-Newton steps
with halving. A long autoregression gives the first residuals.

1. ``w = (1-B)(1-B^52) y`` comes from window functions partitioned by series
   (one sort per series, weekly grain); each series' weeks are packed into
   one row by a grouped aggregate (bounded by the calendar, not the data).
2. ``mapInArrow`` fits all candidates and runs the forecast recursion for many series at
   once, in runs of at most ``CELLS`` weeks of an Arrow batch (one series at least), so a task's memory does not grow
   with the series it gets: series are stacked right-aligned, padded in front with
   zeros (which the zero start values make exact), and every recursion is a loop over weeks on
   (series, coefficient) arrays.
3. Every series gets a forecast: where no candidate has more weeks than
   coefficients, or all designs are singular, the row says so in ``error`` and
   the fallback (candidate -1, seasonal naive: the week a year before, or the last
   value in the first year) stands in.

Documented differences from the source: the AIC is m*ln(sigma^2) + 2k on the
common sample (comparable within one leaderboard, not to a likelihood AIC);
seasonal cross terms are free coefficients (not forced to phi*Phi); no
stationarity/invertibility constraints (as in the source).
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators.series import holdout_split

SEASON = 52
HORIZON = 26
FALLBACK = -1

# The candidate orders (p, q, P, Q); d = D = 1, s = 52.
GRID = (
    (1, 1, 1, 0),
    (1, 2, 1, 0),
    (2, 1, 1, 0),
    (1, 1, 0, 1),
    (1, 2, 0, 1),
    (2, 1, 0, 1),
    (1, 1, 1, 1),
)
DEFAULT_ORDER = (1, 1, 1, 0)          # (1,1,1)(1,1,0,52): the single default fit

#: Lags of the long autoregression that gives the first residuals.
START_LAGS = (1, 2, 3, 4, 5, 6, 52, 53, 104)
STEPS = 25
#: Weeks stacked at once, padding included.
CELLS = 100_000


def candidate_features(p: int, q: int, P: int, Q: int, exog: bool) -> list[str]:
    ar = [f"w{i}" for i in range(1, p + 1)]
    ma = [f"e{i}" for i in range(1, q + 1)]
    if P:
        ar += ["w52"] + [f"w{52 + i}" for i in range(1, p + 1)]
    if Q:
        ma += ["e52"] + [f"e{52 + i}" for i in range(1, q + 1)]
    return ar + ma + (["xw"] if exog else [])


def _gram_aggs(feats: list[str], target: str) -> list:
    aggs = [F.count(F.lit(1)).alias("m"), F.sum(F.col(target) * F.col(target)).alias("yty")]
    for i, a in enumerate(feats):
        aggs.append(F.sum(F.col(a) * F.col(target)).alias(f"xy__{a}"))
        for b in feats[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"g__{a}__{b}"))
    return aggs


def _gram_stack(pdf: pd.DataFrame, feats: list[str]):
    """(n, k, k) Gram matrices and (n, k) cross products from a batch of Gram rows."""
    n, k = len(pdf), len(feats)
    G = np.empty((n, k, k))
    for i, a in enumerate(feats):
        for j in range(i, k):
            col = pdf[f"g__{a}__{feats[j]}"].to_numpy(dtype=float)
            G[:, i, j] = col
            G[:, j, i] = col
    xy = np.stack([pdf[f"xy__{a}"].to_numpy(dtype=float) for a in feats], axis=1)
    return G, xy


def _solve_batch(G: np.ndarray, xy: np.ndarray) -> list:
    """Solve a stack of small systems at once; singular or non-finite ones give None."""
    n, k = xy.shape
    out: list = [None] * n
    idx = np.flatnonzero(np.isfinite(G).all(axis=(1, 2)) & np.isfinite(xy).all(axis=1))
    if len(idx):
        good = idx[np.linalg.matrix_rank(G[idx]) == k]
        if len(good):
            sol = np.linalg.solve(G[good], xy[good][..., None])[..., 0]
            for r, beta in zip(good, sol):
                out[r] = beta
    return out


def _packed(series: DataFrame, key: str, value: str, exog: str | None, rule: str | None) -> DataFrame:
    """One row per series: arrays of its weeks in order, with the double difference of the training weeks (all, without a rule)."""
    s = series.select(key, "week_date", F.col(value).cast("double").alias("y"), *([F.col(exog).cast("double").alias("x")] if exog else []))
    s = holdout_split(s, key, rule) if rule else s.withColumn("is_test", F.lit(False))
    w = Window.partitionBy(key).orderBy("week_date")
    dd = lambda c: F.col(c) - F.lag(c, 1).over(w) - F.lag(c, SEASON).over(w) + F.lag(c, SEASON + 1).over(w)
    cols = ["week_date", "y", "is_test", F.when(~F.col("is_test"), dd("y")).alias("w")] + ([dd("x").alias("xw")] if exog else [])
    s = s.select(key, *cols)
    names = [c for c in s.columns if c != key]
    return (s.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("_t"))
            .select(key, *[F.col(f"_t.{c}").alias(c) for c in names]))


# ---- conditional least squares on stacks of series: arrays are (week, series[, coefficient]) ----

def _shift(a: np.ndarray, lag: int) -> np.ndarray:
    out = np.zeros_like(a)
    if lag < len(a):
        out[lag:] = a[:len(a) - lag]
    return out


def _terms(feats: list[str]) -> list[tuple[str, int]]:
    return [("x", 0) if f == "xw" else (f[0], int(f[1:])) for f in feats]


def _filtered(u: np.ndarray, ma: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """e_t = u_t - sum_j d_j e_(t - l_j), week by week for all series."""
    e = u.copy()
    for t in range(len(e)):
        for lag, d in ma:
            if lag <= t:
                e[t] -= d * e[t - lag]
    return e


def _residuals(w: np.ndarray, x: np.ndarray | None, feats: list[str], beta: np.ndarray) -> np.ndarray:
    u, ma = w.copy(), []
    for i, (kind, lag) in enumerate(_terms(feats)):
        if kind == "e":
            ma.append((lag, beta[:, i]))
        else:
            u -= beta[:, i] * (x if kind == "x" else _shift(w, lag))
    return _filtered(u, ma)


def _regressors(w, x, e, feats) -> np.ndarray:
    return np.stack([x if kind == "x" else _shift(w if kind == "w" else e, lag) for kind, lag in _terms(feats)], axis=-1)


def _least_squares(z: np.ndarray, y: np.ndarray, ridge: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Per series: coefficients of y on z, and whether the design has full rank (any design will do with a ridge)."""
    gram = np.einsum("tsk,tsl->skl", z, z)
    cross = np.einsum("tsk,ts->sk", z, y)
    k = gram.shape[1]
    fine = np.isfinite(gram).all((1, 2)) & np.isfinite(cross).all(1)
    if not ridge and fine.any():
        fine[fine] &= np.linalg.matrix_rank(gram[fine], hermitian=True) == k
    scale = ridge * np.trace(np.where(fine[:, None, None], gram, 0), axis1=1, axis2=2)[:, None, None] / k
    safe = np.where(fine[:, None, None], gram + np.where(scale > 0, scale, 0.0 if not ridge else 1.0) * np.eye(k), np.eye(k))
    return np.linalg.solve(safe, np.where(fine[:, None], cross, 0)[..., None])[..., 0], fine


def fit_css(w: np.ndarray, x: np.ndarray | None, feats: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, residuals, full rank) minimising the sum of squared residuals per series."""
    with np.errstate(all="ignore"):
        long = np.stack([_shift(w, lag) for lag in START_LAGS], axis=-1)
        first, _ = _least_squares(long + 0.0, w, 1e-6)
        e0 = w - np.einsum("tsk,sk->ts", long, first)
        beta, _ = _least_squares(_regressors(w, x, e0, feats), w, 1e-6)
        cost = lambda e: np.where(np.isfinite(s := np.einsum("ts,ts->s", e, e)), s, np.inf)
        e = _residuals(w, x, feats, beta)
        best = cost(e)
        for scale in (0.5, 0.0):
            trial = _residuals(w, x, feats, beta * scale)
            better = cost(trial) < best
            beta = np.where(better[:, None], beta * scale, beta)
            e, best = np.where(better, trial, e), np.minimum(best, cost(trial))
        # a series that has settled stays as it is, whatever else is in its batch
        fine, moving = np.zeros(w.shape[1], bool), np.ones(w.shape[1], bool)
        for _ in range(STEPS):
            ma = [(lag, beta[:, i, None]) for i, (kind, lag) in enumerate(_terms(feats)) if kind == "e"]
            g = _filtered(-_regressors(w, x, e, feats), ma)
            step, fine = _least_squares(g, -e)
            before = best
            for scale in (1.0, 0.5, 0.25, 0.1, 0.02):
                left = moving & (best >= before)
                if not left.any():
                    break
                trial_beta = beta + scale * step
                trial = _residuals(w, x, feats, trial_beta)
                better = left & (cost(trial) < before)
                beta = np.where(better[:, None], trial_beta, beta)
                e, best = np.where(better, trial, e), np.where(better, cost(trial), best)
            moving &= best < before * (1 - 1e-8)
            if not moving.any():
                break
    return beta, e, fine & np.isfinite(best)


def _ar_poly(coef: dict[str, float]) -> np.ndarray:
    """Coefficients of (1 - sum a_l B^l)(1 - B)(1 - B^52) as an array by power."""
    a = np.zeros(SEASON + 3)
    a[0] = 1.0
    for name, c in coef.items():
        if name.startswith("w"):
            a[int(name[1:])] -= c
    a = np.convolve(a, [1.0, -1.0])
    s = np.zeros(SEASON + 1)
    s[0], s[SEASON] = 1.0, -1.0
    return np.convolve(a, s)


def _psi(coef: dict[str, float], n: int) -> np.ndarray:
    """MA(infinity) weights of the full model (differences included), n terms."""
    ar = _ar_poly(coef)[1:]                       # coefficients of B^1.. of the AR side
    theta = np.zeros(n)
    for name, c in coef.items():
        if name.startswith("e") and int(name[1:]) < n:
            theta[int(name[1:])] = c
    psi = np.zeros(n)
    psi[0] = 1.0
    for j in range(1, n):
        m = min(j, len(ar))
        psi[j] = theta[j] - ar[:m] @ psi[j - 1::-1][:m]
    return psi


def _recursion(y: np.ndarray, w: np.ndarray, e: np.ndarray, xw: np.ndarray | None, feats: list[str],
               beta: np.ndarray, steps: int) -> np.ndarray:
    """(step, series) forecasts; future residuals and unknown regressors are 0."""
    out = []
    n = len(w)
    w, e = np.vstack([w, np.zeros((steps, w.shape[1]))]), np.vstack([e, np.zeros((steps, w.shape[1]))])
    tail = list(y)
    for k in range(steps):
        t = n + k
        for i, (kind, lag) in enumerate(_terms(feats)):
            past = xw[k] if kind == "x" else (w if kind == "w" else e)[t - lag] if lag <= t else 0.0
            w[t] += beta[:, i] * past
        tail.append(w[t] + tail[-1] + tail[-SEASON] - tail[-SEASON - 1])
        out.append(tail[-1])
    return np.array(out)


def _stack(rows: list[np.ndarray], size: int) -> np.ndarray:
    """(week, series), right-aligned, zeros in front."""
    out = np.zeros((size, len(rows)))
    for i, r in enumerate(rows):
        if len(r) and size:
            out[max(0, size - len(r)):, i] = r[-size:]
    return out


def _naive(y: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Seasonal naive path (null without a week) and standard errors (null where a year of differences is missing)."""
    n = len(y)
    if not n:
        return np.full(steps, np.nan), np.full(steps, np.nan)
    path = np.array([y[n - SEASON + k % SEASON] if n >= SEASON else y[-1] for k in range(steps)])
    diff = y[SEASON:] - y[:-SEASON] if n > SEASON + 1 else np.empty(0)
    se = np.std(diff) * np.sqrt(np.arange(steps) // SEASON + 1) if len(diff) else np.full(steps, np.nan)
    return path, se


def sarima_grid(series: DataFrame, key: str = "series_id", value: str = "cases", exog: str | None = None,
                grid=GRID, rule: str | None = "B", horizon: int = HORIZON, only: DataFrame | None = None):
    """Fit every candidate for every series; returns (fits, predictions, actual).

    fits: one row per (series, candidate) with coefficients, sigma^2, AIC and
    error text. predictions: holdout steps and ``horizon`` future steps of every
    fitted candidate, and of the fallback (candidate -1) for every series.
    ``only`` (key, candidate_id) restricts each series to one stored candidate. Without a ``rule`` all
    weeks are trained on, there is no holdout, and the steps start behind the last week (``refit_full``).
    """
    from hebdo.session import checkpoint_dir, ship_package
    checkpoint_dir(series.sparkSession)
    ship_package(series.sparkSession)
    packed = _packed(series, key, value, exog, rule)
    if only is not None:
        packed = packed.join(only.select(key, F.col("candidate_id").alias("_only")), key)
    grid = list(grid)
    schema = T.StructType([
        packed.schema[key], *[T.StructField(c, T.IntegerType()) for c in ("candidate_id", "p", "q", "sp", "sq")],
        T.StructField("features", T.ArrayType(T.StringType())), T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("sigma2", T.DoubleType()), T.StructField("aic", T.DoubleType()), T.StructField("m", T.LongType()),
        T.StructField("n_train", T.LongType()), T.StructField("error", T.StringType()), T.StructField("h", T.IntegerType()),
        T.StructField("last_week", T.DateType()),
        *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("yhat", "lo95", "hi95")]])

    def run(batches):
        import pyarrow as pa
        kinds = to_arrow_schema(schema)
        for batch in batches:
            for part in _runs(batch):
                columns = zip(*_fit_batch(part.to_pandas(integer_object_nulls=True), key, grid, exog is not None, horizon))
                yield pa.RecordBatch.from_arrays([pa.array(c, t, from_pandas=True) for c, t in zip(columns, kinds.types)], schema=kinds)

    # fits and predictions are each read by several consumers: materialised once
    # in the shared checkpoint folder (lineage cut)
    done = packed.mapInArrow(run, schema).checkpoint()
    fits = done.filter(F.col("candidate_id") != FALLBACK).drop("h", "last_week", "yhat", "lo95", "hi95")
    preds = (done.filter("error = ''").select(
        key, "candidate_id", "h", "last_week", F.posexplode(F.arrays_zip("yhat", "lo95", "hi95")).alias("k", "v"))
        .select(key, "candidate_id", (F.col("k") + 1).alias("step"), F.date_add("last_week", (F.col("k") + 1) * 7).alias("week_date"),
                (F.col("k") >= F.col("h")).alias("is_future"), "v.yhat", "v.lo95", "v.hi95"))
    actual = series.select(key, "week_date", F.col(value).cast("double").alias("y"))
    actual = holdout_split(actual, key, rule) if rule else actual.withColumn("is_test", F.lit(False))
    return fits, preds, actual.select(key, "week_date", "y", "is_test")


def refit_full(series: DataFrame, best: DataFrame, key: str = "series_id", value: str = "cases", horizon: int = HORIZON):
    """(fits, predictions) of each series' chosen candidate, fitted anew on all its weeks, holdout included.

    ``best`` (key, candidate_id) comes from the holdout comparison; only that candidate is fitted.
    """
    fits, preds, _ = sarima_grid(series, key, value, rule=None, horizon=horizon, only=best)
    return fits, preds


def _runs(batch):
    """Slices of an Arrow batch of packed series whose stack has at most ``CELLS`` weeks (one series at least)."""
    import pyarrow.compute as pc
    size = pc.list_value_length(batch.column("y")).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(size):
        # series so far times the longest of them
        cells = np.maximum.accumulate(size[at:at + CELLS]) * np.arange(1, min(len(size) - at, CELLS) + 1)
        n = max(1, int(np.searchsorted(cells, CELLS, "right")))
        yield batch.slice(at, n)
        at += n


def _fit_batch(pdf: pd.DataFrame, key: str, grid: list, exog: bool, horizon: int) -> list[tuple]:
    """Rows of one run of series: all series of it are fitted and forecast together, by holdout length."""
    out = []
    tests = [np.asarray(v, bool) for v in pdf["is_test"]]
    ys = [np.asarray(v, float)[~t] for v, t in zip(pdf["y"], tests)]
    ws = [a[np.isfinite(a)] for a in (np.asarray(v, float)[~t] for v, t in zip(pdf["w"], tests))]
    # without a training week the steps still start at the first week of the series
    last = [np.asarray(v)[~t][-1] if not t.all() else np.asarray(v)[0] - timedelta(7) for v, t in zip(pdf["week_date"], tests)]
    xs = [np.nan_to_num(np.asarray(v, float)) for v in pdf["xw"]] if exog else None
    hs, keys = np.array([int(t.sum()) for t in tests]), pdf[key].tolist()
    for i, y in enumerate(ys):
        path, se = _naive(y, hs[i] + horizon)
        none = np.isnan(se).any()
        out.append((keys[i], FALLBACK, None, None, None, None, None, None, None, None, len(ws[i]), len(y), "", hs[i], last[i], path.tolist() if len(y) else [None] * len(path),
                    [None] * len(path) if none else (path - 1.96 * se).tolist(),
                    [None] * len(path) if none else (path + 1.96 * se).tolist()))
    wanted = pdf["_only"].to_numpy() if "_only" in pdf else None
    for cid, (p, q, P, Q) in enumerate(grid):
        feats = candidate_features(p, q, P, Q, exog)
        k = len(feats)
        mine = [i for i in range(len(keys)) if wanted is None or wanted[i] == cid]
        long = [i for i in mine if len(ws[i]) > k]
        for i in set(mine) - set(long):
            out.append(_row(keys[i], cid, (p, q, P, Q), feats, len(ys[i]), "series too short", hs[i], last[i]))
        for h in sorted(set(hs[long].tolist())):
            at = [i for i in long if hs[i] == h]
            n = max(len(ws[i]) for i in at)
            w, steps = _stack([ws[i] for i in at], n), h + horizon
            x = future = None
            if exog:
                x = _stack([xs[i][:len(xs[i]) - h][-len(ws[i]):] for i in at], n)
                future = np.vstack([_stack([xs[i][len(xs[i]) - h:] for i in at], h), np.zeros((horizon, len(at)))])
            beta, e, fine = fit_css(w, x, feats)
            size = max(n, SEASON + 1) + SEASON + 1
            yhat = _recursion(_stack([ys[i] for i in at], size), w, e, future, feats, beta, steps)
            for c, i in enumerate(at):
                m = len(ws[i])
                s2 = float(e[:, c] @ e[:, c]) / m
                if not fine[c] or s2 <= 0 or not np.isfinite(yhat[:, c]).all():
                    out.append(_row(keys[i], cid, (p, q, P, Q), feats, len(ys[i]), "singular design", hs[i], last[i]))
                    continue
                se = np.sqrt(s2 * np.cumsum(_psi(dict(zip(feats, beta[c])), steps) ** 2))
                out.append((keys[i], cid, p, q, P, Q, feats, beta[c].tolist(), s2, float(m * np.log(s2) + 2 * k), m, len(ys[i]), "",
                            h, last[i], yhat[:, c].tolist(), (yhat[:, c] - 1.96 * se).tolist(), (yhat[:, c] + 1.96 * se).tolist()))
    return out


def _row(key, cid, order, feats, n_train, error, h, last) -> tuple:
    return (key, cid, *order, feats, None, None, None, None, n_train, error, h, last, None, None, None)


def holdout_scores(preds: DataFrame, actual: DataFrame, key: str = "series_id") -> DataFrame:
    """MAE / RMSE per (series, candidate) over the holdout, computed in Spark."""
    t = preds.filter(~F.col("is_future") & (F.col("candidate_id") != FALLBACK)).join(actual.filter("is_test").select(key, "week_date", "y"),
                                              [key, "week_date"])
    err = F.col("y") - F.col("yhat")
    return t.groupBy(key, "candidate_id").agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"))


def with_fallback(preds: DataFrame, chosen: DataFrame, key: str = "series_id") -> DataFrame:
    """Predictions of the chosen candidate of each series, else of the fallback; ``method`` says which."""
    own = preds.join(chosen.select(key, "candidate_id"), [key, "candidate_id"]).withColumn("method", F.lit("sarima"))
    rest = (preds.filter(F.col("candidate_id") == FALLBACK).join(own.select(key).distinct(), key, "left_anti")
            .withColumn("method", F.lit("seasonal_naive")))
    return own.unionByName(rest)


def order_text(p, q, P, Q):
    return (F.format_string("(%d,1,%d)", p, q), F.format_string("(%d,1,%d,52)", P, Q))


def candidates_table(fits: DataFrame, scores: DataFrame, key: str = "series_id", model: str = "SARIMAX") -> DataFrame:
    """Leaderboard rows for the fitted candidates (typed order columns + text)."""
    o, so = order_text(F.col("p"), F.col("q"), F.col("sp"), F.col("sq"))
    return (fits.join(scores, [key, "candidate_id"], "left")
            .select(key, F.lit(model).alias("model"), "candidate_id", "p", "q", "sp", "sq",
                    o.alias("order"), so.alias("seasonal"),
                    R(F.col("aic")).alias("aic"), R(F.col("mae")).alias("mae"), R(F.col("rmse")).alias("rmse"),
                    "error"))


# ------------------------------------------------------------------ harmonic regression

def harmonic_candidate(series: DataFrame, key: str = "series_id", value: str = "cases", K: int = 10,
                       rule: str = "B") -> DataFrame:
    """Trend + K yearly Fourier pairs (period 365.25 days), least squares on the
    training weeks; predictions for the holdout weeks. Gram in Spark, solve per series."""
    x, beta, feats = harmonic_fit(series, key, value, K, rule)
    return x.filter("is_test").join(beta, key).select(key, "week_date", "y", harmonic_value(feats).alias("yhat"), "error")


def harmonic_value(feats: list[str]):
    """Fitted value of a week from its regressors and ``beta``."""
    return reduce(lambda a, b: a + b, [F.col("beta")[i] * F.col(f) for i, f in enumerate(feats)])


def harmonic_fit(series: DataFrame, key: str = "series_id", value: str = "cases", K: int = 10, rule: str = "B"):
    """(weeks with their regressors, (key, beta, error), names of the regressors)."""
    from hebdo.session import ship_package
    ship_package(series.sparkSession)
    s = holdout_split(series.select(key, "week_date", F.col(value).cast("double").alias("y")), key, rule)
    t0 = F.min("week_date").over(Window.partitionBy(key))
    s = s.withColumn("t_days", F.datediff("week_date", t0).cast("double"))
    feats = ["one", "trend"] + [f"{f}{k}" for k in range(1, K + 1) for f in ("s", "c")]
    cols = [F.lit(1.0).alias("one"), (F.col("t_days") / 365.25).alias("trend")]
    for k in range(1, K + 1):
        ang = F.lit(2 * np.pi * k) * F.col("t_days") / F.lit(365.25)
        cols += [F.sin(ang).alias(f"s{k}"), F.cos(ang).alias(f"c{k}")]
    x = s.select(key, "week_date", "y", "is_test", *cols)
    gram = x.filter(~F.col("is_test")).groupBy(key).agg(*_gram_aggs(feats, "y"))
    schema = T.StructType([gram.schema[key], T.StructField("beta", T.ArrayType(T.DoubleType())),
                           T.StructField("error", T.StringType())])

    def solve(batches):
        for pdf in batches:
            G, xy = _gram_stack(pdf, feats)
            enough = pdf["m"].to_numpy(dtype=float) > len(feats)
            sols = [b if ok else None for b, ok in zip(_solve_batch(G, xy), enough)]
            yield pd.DataFrame({key: pdf[key].to_numpy(),
                                "beta": [None if b is None else b.tolist() for b in sols],
                                "error": ["" if b is not None else "singular or too short" for b in sols]})

    beta = gram.mapInPandas(solve, schema)
    return x, beta, feats
