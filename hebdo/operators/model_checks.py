"""Stored models applied and checked in SQL functions alone, without the code that fitted them.

``forecast_from_params`` forecasts from a stored parameter table: residuals of the known weeks by the model's
own recursion, then future weeks with residuals of 0, then 95 % bounds from the weights
of past shocks. The recursions are folds over the weeks of a series, packed
in one row (bounded by the calendar), so they run in the JVM for all series at once.

The checks use the same folds on fits of the grid:

* ``css_optimality``: the stored coefficients give the stored residual variance, and
  moving any of them either way does not lower the sum of squares.
* ``recomputed_forecasts``: stored predictions and bounds follow from the stored coefficients.
* ``harmonic_normal_equations``: the residuals are orthogonal to every regressor.
* ``ranking``: the leaderboard's ranks and the best model, by counting better rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.operators import forecast as FC

#: Step by which coefficients are moved, and the share of the sum of squares that a move may gain.
NUDGE, GAIN = 1e-3, 1e-5


def _term(feature: Column, coef: Column, w: Column, e: Column, x: Column, t: Column) -> Column:
    """A coefficient times its regressor at week ``t`` (from 0); what lies before the first week is 0."""
    lag = F.substr(feature, F.lit(2), F.lit(9)).try_cast("int")
    at = lambda a: F.when(lag <= t, F.get(a, t - lag)).otherwise(0.0)
    past = (F.when(feature == "xw", F.coalesce(F.get(x, t), F.lit(0.0)))
            .when(F.startswith(feature, F.lit("w")), at(w)).otherwise(at(e)))
    return coef * past


def _fold(features: Column, coef: Column, w: Column, x: Column, steps: Column | int, shock: bool = False) -> Column:
    """struct(w, e): differenced weeks and residuals, ``steps`` future weeks included.

    With ``shock`` the past is empty and the first future residual is 1: the response to a unit shock.
    """
    n = F.size(w)
    empty = F.array().cast("array<double>")
    terms = F.arrays_zip(features.alias("f"), coef.alias("c"))

    def step(s, t):
        fit = F.aggregate(terms, F.lit(0.0), lambda acc, fc: acc + _term(fc["f"], fc["c"], s["w"], s["e"], x, t))
        unit = F.when(t == 0, 1.0).otherwise(0.0) if shock else F.lit(0.0)
        value = F.when(t < n, F.get(w, t)).otherwise(fit + unit)
        left = F.when(t < n, F.get(w, t) - fit).otherwise(unit)
        return F.struct(F.concat(s["w"], F.array(value)).alias("w"), F.concat(s["e"], F.array(left)).alias("e"))

    return F.aggregate(F.sequence(F.lit(0), n + steps - 1), F.struct(empty.alias("w"), empty.alias("e")), step)


def _integrated(y: Column, w_future: Column) -> Column:
    """``y`` with the future weeks appended: each is its double difference plus the weeks 1 and 52 before less the week 53 before."""
    back = lambda a, k: F.coalesce(F.get(a, F.size(a) - k), F.lit(0.0))
    return F.aggregate(w_future, y, lambda a, v: F.concat(a, F.array(v + back(a, 1) + back(a, FC.SEASON) - back(a, FC.SEASON + 1))))


def _tail(a: Column, n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(a, F.size(a) - n + 1, n)


def _with_path(df: DataFrame, steps: Column) -> DataFrame:
    """``yhat``, ``lo95`` and ``hi95`` arrays from columns features, coef, sigma2, w, x, y (known weeks)."""
    zero = F.array().cast("array<double>")
    df = df.withColumn("_steps", steps)
    df = df.withColumn("_w", _tail(_fold(F.col("features"), F.col("coef"), F.col("w"), F.col("x"), F.col("_steps"))["w"], F.col("_steps")))
    df = df.withColumn("yhat", _tail(_integrated(F.col("y"), F.col("_w")), F.col("_steps")))
    shock = _fold(F.col("features"), F.col("coef"), zero, zero, F.col("_steps"), shock=True)["w"]
    df = df.withColumn("_psi", _integrated(zero, shock))
    squares = F.aggregate("_psi", zero, lambda a, p: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0.0)) + p * p)))
    df = df.withColumn("_se", F.transform(squares, lambda v: F.sqrt(F.col("sigma2") * v)))
    bound = lambda sign: F.zip_with("yhat", "_se", lambda v, s: v + F.lit(sign * 1.96) * s)
    return df.withColumn("lo95", bound(-1)).withColumn("hi95", bound(1)).drop("_steps", "_w", "_psi", "_se")


def _known(series: DataFrame, key: str, value: str, exog: str | None, rule: str | None) -> DataFrame:
    """(key, y, w, x, h, last_week): known weeks, their double differences, regressor from the first of these on."""
    packed = FC._packed(series, key, value, exog, rule)
    n_train = F.size(F.filter("is_test", lambda t: ~t))
    w = F.filter("w", lambda v: v.isNotNull())
    x = F.slice("xw", n_train - F.size(w) + 1, F.size("xw")) if exog else F.array().cast("array<double>")
    return packed.select(key, F.slice("y", F.lit(1), n_train).alias("y"), w.alias("w"), x.alias("x"),
                         (F.size("y") - n_train).alias("h"), F.element_at("week_date", n_train).alias("last_week"))


def forecast_from_params(series: DataFrame, params: DataFrame, key: str = "series_id", value: str = "cases",
                         horizon: int = FC.HORIZON) -> DataFrame:
    """(key, step, week_date, yhat, lo95, hi95): stored models applied to the whole of each series, nothing fitted.

    ``params`` has key, features array<string>, coef array<double> and sigma2, one row a series (``stored_params``).
    """
    df = _with_path(_known(series, key, value, None, None).join(params.select(key, "features", "coef", "sigma2"), key), F.lit(horizon))
    rows = df.select(key, "last_week", F.posexplode(F.arrays_zip("yhat", "lo95", "hi95")).alias("k", "v"))
    return rows.select(key, (F.col("k") + 1).alias("step"), F.date_add("last_week", (F.col("k") + 1) * 7).alias("week_date"), "v.*")


def stored_params(table: DataFrame, key: str = "series_id") -> DataFrame:
    """A parameter table of one row a term (``model_params_table``) as one row a series."""
    terms = F.sort_array(F.collect_list(F.struct("term", "coef")))
    return table.groupBy(key).agg(terms.alias("t"), F.min("sigma2").alias("sigma2")).select(
        key, F.col("t.term").alias("features"), F.col("t.coef").alias("coef"), "sigma2")


def _close(a: Column, b: Column, scale: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-6) * (F.lit(1.0) + F.abs(scale))


def css_optimality(fits: DataFrame, series: DataFrame, key: str = "series_id", value: str = "cases", exog: str | None = None,
                   rule: str = "B") -> DataFrame:
    """Per fit: n_terms, sse_matches, is_minimum, and the largest share of the sum of squares that a nudge gains."""
    df = fits.filter("error = ''").select(key, "candidate_id", "features", "coef", "sigma2", "m").join(
        _known(series, key, value, exog, rule), key)
    moves = F.flatten(F.transform(F.sequence(F.lit(1), F.size("coef")), lambda i: F.array(
        F.struct(i.alias("i"), F.lit(NUDGE).alias("by")), F.struct(i.alias("i"), F.lit(-NUDGE).alias("by")))))
    none = F.array(F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("by")))
    df = df.withColumn("move", F.explode(F.concat(none, moves)))
    coef = F.transform("coef", lambda c, i: F.when(i + 1 == F.col("move.i"), c + F.col("move.by")).otherwise(c))
    df = df.withColumn("nudged", coef)
    e = _fold(F.col("features"), F.col("nudged"), F.col("w"), F.col("x"), 0)["e"]
    df = df.withColumn("sse", F.aggregate(e, F.lit(0.0), lambda a, v: a + v * v))
    still = F.col("move.i") == 0
    out = df.groupBy(key, "candidate_id").agg(
        F.max(F.size("coef")).alias("n_terms"), F.max(F.when(still, F.col("sse"))).alias("at"),
        F.min(F.when(~still, F.col("sse"))).alias("least"), F.max(F.col("sigma2") * F.col("m")).alias("stored"))
    gain = F.greatest(F.lit(0.0), 1 - F.col("least") / F.col("at"))
    return out.select(key, "candidate_id", "n_terms", _close(F.col("at"), F.col("stored"), F.col("stored")).alias("sse_matches"),
                      (gain <= GAIN).alias("is_minimum"), gain.alias("gain"))


def recomputed_forecasts(fits: DataFrame, preds: DataFrame, series: DataFrame, key: str = "series_id", value: str = "cases",
                         exog: str | None = None, rule: str | None = "B", horizon: int = FC.HORIZON) -> DataFrame:
    """Per fit: n_steps, and whether the stored path and bounds equal those that its coefficients give."""
    df = fits.filter("error = ''").select(key, "candidate_id", "features", "coef", "sigma2").join(
        _known(series, key, value, exog, rule), key)
    df = _with_path(df, F.col("h") + horizon)
    mine = df.select(key, "candidate_id", F.posexplode(F.arrays_zip("yhat", "lo95", "hi95")).alias("k", "v")).select(
        key, "candidate_id", (F.col("k") + 1).alias("step"), *[F.col(f"v.{c}").alias(f"own_{c}") for c in ("yhat", "lo95", "hi95")])
    both = preds.filter(F.col("candidate_id") != FC.FALLBACK).join(mine, [key, "candidate_id", "step"], "full")
    same = lambda c: F.min(F.coalesce(_close(F.col(c), F.col(f"own_{c}"), F.col("own_yhat")), F.lit(False))).alias(f"{c}_matches")
    return both.groupBy(key, "candidate_id").agg(F.count(F.lit(1)).alias("n_steps"), same("yhat"), same("lo95"), same("hi95"))


def harmonic_normal_equations(series: DataFrame, key: str = "series_id", value: str = "cases", K: int = 10, rule: str = "B") -> DataFrame:
    """Per series: n_terms, and whether the training residuals are orthogonal to every regressor (cosine below 1e-6)."""
    x, beta, feats = FC.harmonic_fit(series, key, value, K, rule)
    train = x.filter(~F.col("is_test")).join(beta.filter("error = ''"), key)
    train = train.withColumn("r", F.col("y") - FC.harmonic_value(feats))
    cosine = lambda f: F.abs(F.sum(F.col("r") * F.col(f))) / F.sqrt(F.sum(F.col(f) * F.col(f)) * F.sum(F.col("r") * F.col("r")))
    g = train.groupBy(key).agg(*[cosine(f).alias(f) for f in feats])
    return g.select(key, F.lit(len(feats)).alias("n_terms"), reduce(lambda a, b: a & b, [F.col(f) < 1e-6 for f in feats]).alias("orthogonal"))


def ranking(board: DataFrame, best: DataFrame, key: str = "series_id", family: str = "SARIMAX") -> DataFrame:
    """Per series: n_rows, whether each rank is one more than the rows before it, and whether the best model is the first of its family."""
    order = F.struct(F.col("rmse").isNull().alias("a"), F.coalesce("rmse", F.lit(0.0)).alias("b"), F.col("aic").isNull().alias("c"),
                     F.coalesce("aic", F.lit(0.0)).alias("d"), F.col("model").alias("e"), F.col("candidate_id").isNull().alias("f"),
                     F.coalesce("candidate_id", F.lit(0)).alias("g"))
    rows = board.withColumn("_o", order)
    whole = Window.partitionBy(key)
    rows = rows.withColumn("_all", F.collect_list("_o").over(whole))  # a handful of candidates a series
    before = F.size(F.filter("_all", lambda o: o < F.col("_o")))
    ours = (F.col("model") == family) & F.col("rmse").isNotNull()
    rows = rows.withColumn("_right", F.col("rank") == before + 1)
    got = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.min("_right").alias("ranks_match"),
                                F.min(F.when(ours, F.struct("_o", "candidate_id"))).alias("first"))
    picked = best.select(key, F.when(~F.col("is_default"), F.col("candidate_id")).alias("picked"))
    return got.join(picked, key, "left").select(key, "n_rows", "ranks_match",
                                                F.col("first.candidate_id").eqNullSafe(F.col("picked")).alias("best_matches"))
