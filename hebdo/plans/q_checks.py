"""§2.7 value checks of the fitted models, forecasts from stored parameters, and the refit on all weeks.

The check tables recompute residuals, forecasts, bounds and ranks in SQL functions from what a model
stored (``operators/model_checks.py``); their oracles state what must come out for every series.
``forecast_from_params`` takes a parameter table that the oracle knows too, so DuckDB computes
every value by a recursion of its own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators import forecast as FC
from hebdo.operators import model_checks as MC
from hebdo.operators import reports as RP
from hebdo.plans import q_forecast as Q
from hebdo.plans.q_series import _METRICS, _NAIVE
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import r4, with_views
from hebdo.sources import files as FS

KEY = Q.KEY
# p + q, the seasonal term and its p or q cross terms, for the seven orders of the grid
_TERMS = "[4, 5, 6, 4, 6, 5, 6][candidate_id + 1]"
_FITS = {"fits": "SELECT DISTINCT series_id, candidate_id FROM case_series, (SELECT unnest(range(7)) AS candidate_id) g"}


@register("sarima_optimality", "2.7", with_views(f"""
SELECT series_id, CAST(candidate_id AS INTEGER) AS candidate_id, {_TERMS} AS n_terms, TRUE AS sse_matches, TRUE AS is_minimum
FROM fits""", "case_series", extra=_FITS))
def q_sarima_optimality(spark, d):
    """Every grid fit is a minimum of its sum of squares, and that sum is the stored one."""
    s = Q._series(spark, d)
    return MC.css_optimality(Q._grid(spark, d, series=s)[0], s).drop("gain")


@register("sarima_fixed_optimality", "2.7", with_views("""
SELECT DISTINCT series_id, m.model, m.n_terms, TRUE AS sse_matches, TRUE AS is_minimum
FROM case_series, (VALUES ('SARIMAX', 4), ('SARIMAX+Clima', 5)) m(model, n_terms)""", "case_series"))
def q_sarima_fixed_optimality(spark, d):
    """The same for the default order, alone and with the temperature regressor."""
    plain, climate = Q._series(spark, d), Q._series(spark, d, exog=True)
    base = MC.css_optimality(Q._grid(spark, d, [FC.DEFAULT_ORDER], "A", series=plain)[0], plain, rule="A")
    clim = MC.css_optimality(Q._grid(spark, d, [FC.DEFAULT_ORDER], "A", True, climate)[0], climate, exog="temperature", rule="A")
    return (base.withColumn("model", F.lit(RP.MODEL_BASE)).unionByName(clim.withColumn("model", F.lit(RP.MODEL_CLIMATE)))
            .select(KEY, "model", "n_terms", "sse_matches", "is_minimum"))


_STEPS = """(SELECT series_id, 26 + CASE WHEN COUNT(*) > 104 THEN 52 ELSE least(greatest(6, COUNT(*) // 4), COUNT(*) - 1) END AS n_steps
FROM case_series GROUP BY 1)"""


@register("forecast_recomputed", "2.7", with_views(f"""
SELECT f.series_id, CAST(f.candidate_id AS INTEGER) AS candidate_id, CAST(s.n_steps AS BIGINT) AS n_steps, TRUE AS yhat_matches,
       TRUE AS lo95_matches, TRUE AS hi95_matches FROM fits f JOIN {_STEPS} s ON f.series_id = s.series_id""", "case_series", extra=_FITS))
def q_forecast_recomputed(spark, d):
    """Holdout and future steps of every candidate, with their bounds, follow from the stored coefficients."""
    s = Q._series(spark, d)
    fits, preds, _ = Q._grid(spark, d, series=s)
    return MC.recomputed_forecasts(fits, preds, s)


@register("harmonic_normal_equations", "2.7", with_views(
    "SELECT DISTINCT series_id, 22 AS n_terms, TRUE AS orthogonal FROM case_series", "case_series"))
def q_harmonic_normal_equations(spark, d):
    return MC.harmonic_normal_equations(Q._series(spark, d))


@register("leaderboard_ranking", "2.7", with_views(f"""
SELECT series_id, 9 AS n_rows, TRUE AS ranks_match, TRUE AS best_matches, mae AS naive_mae, rmse AS naive_rmse FROM ({_METRICS}) m""",
                                                   "case_series", extra=_NAIVE))
def q_leaderboard_ranking(spark, d):
    """Ranks and best model by counting better rows; the naive row's metrics by value."""
    board, *_ = Q._leaderboard(spark, d)
    naive = board.filter("model = 'Naive52'").select(KEY, F.col("mae").alias("naive_mae"), F.col("rmse").alias("naive_rmse"))
    return MC.ranking(board, RP.best_model(board, KEY)).join(naive, KEY)


# ------------------------------------------------------------------ forecasts from stored parameters

#: Terms of the registered parameter table; each series' coefficients are scaled by its name's length.
_PARAMS = (("w1", 0.35), ("e1", -0.6), ("e2", 0.08), ("w52", -0.25), ("w53", 0.05), ("e52", -0.2))
_W = {n: f"({c} * length(series_id) / 10.0)::DOUBLE" for n, c in _PARAMS}
_RECURSION = {
    "dd": """
SELECT series_id, week_date, cases, cases - lag(cases, 1) OVER w - lag(cases, 52) OVER w + lag(cases, 53) OVER w AS v
FROM case_series WINDOW w AS (PARTITION BY series_id ORDER BY week_date)""",
    "known": """
SELECT series_id, list(v ORDER BY week_date) FILTER (WHERE v IS NOT NULL) AS w, list(cases ORDER BY week_date) AS y,
       MAX(week_date) AS last_week FROM dd GROUP BY 1""",
    # e and w run over the known weeks, then over 26 more; p is the response to a unit shock in the first of these
    "run": f"""
SELECT series_id, 0 AS t, len(w) AS n, w, y, [0.0::DOUBLE][1:0] AS e, [0.0::DOUBLE][1:0] AS pw, [0.0::DOUBLE][1:0] AS p, last_week FROM known
UNION ALL
SELECT series_id, t + 1, n, CASE WHEN t < n THEN w ELSE list_append(w, fit) END,
       CASE WHEN t < n THEN y ELSE list_append(y, fit + y[len(y)] + y[len(y) - 51] - y[len(y) - 52]) END,
       list_append(e, CASE WHEN t < n THEN w[t + 1] - fit ELSE 0.0 END),
       CASE WHEN t < n THEN pw ELSE list_append(pw, pfit) END,
       CASE WHEN t < n THEN p ELSE list_append(p, pfit + coalesce(p[len(p)], 0.0)) END, last_week
FROM (SELECT *, ({_W['w1']}) * coalesce(CASE WHEN t >= 1 THEN w[t] END, 0) + {_W['w52']} * coalesce(CASE WHEN t >= 52 THEN w[t - 51] END, 0)
             + {_W['w53']} * coalesce(CASE WHEN t >= 53 THEN w[t - 52] END, 0) + {_W['e1']} * coalesce(CASE WHEN t >= 1 THEN e[t] END, 0)
             + {_W['e2']} * coalesce(CASE WHEN t >= 2 THEN e[t - 1] END, 0) + {_W['e52']} * coalesce(CASE WHEN t >= 52 THEN e[t - 51] END, 0) AS fit,
             CASE t - n WHEN 0 THEN 1.0 WHEN 1 THEN ({_W['w1']}) * pw[1] + {_W['e1']} WHEN 2 THEN ({_W['w1']}) * pw[2] + {_W['e2']}
                        ELSE ({_W['w1']}) * coalesce(CASE WHEN t > n THEN pw[t - n] END, 0) END AS pfit
      FROM run WHERE t < n + 26) x"""}


@register("forecast_from_params", "2.7", "WITH RECURSIVE " + with_views(f"""
SELECT series_id, CAST(k AS INTEGER) AS step, CAST(last_week + to_days(CAST(7 * k AS INTEGER)) AS DATE) AS week_date,
       {r4('y[len(y) - 26 + k]')} AS yhat,
       {r4('y[len(y) - 26 + k] - 1.96 * 100.0 * length(series_id) * sqrt(list_sum(list_transform(p[1:k], lambda v: v * v)))')} AS lo95,
       {r4('y[len(y) - 26 + k] + 1.96 * 100.0 * length(series_id) * sqrt(list_sum(list_transform(p[1:k], lambda v: v * v)))')} AS hi95
FROM run, (SELECT unnest(range(1, 27)) AS k) s WHERE t = n + 26""", "case_series", extra=_RECURSION)[len("WITH "):])
def q_forecast_from_params(spark, d):
    """Forecasts and 95 % bounds of all series from a stored parameter table, by folds in the JVM."""
    s = Q._series(spark, d)
    names = s.select(KEY).distinct()
    terms = F.explode(F.array(*[F.struct(F.lit(n).alias("term"), (F.lit(c) * F.length(KEY) / 10.0).alias("coef")) for n, c in _PARAMS]))
    table = names.select(KEY, terms.alias("t"), F.pow(100.0 * F.length(KEY), F.lit(2.0)).alias("sigma2")).select(KEY, "t.*", "sigma2")
    path = FS.scratch_path(spark, "given_params")
    FS.write_table(table, path)
    out = MC.forecast_from_params(s, MC.stored_params(spark.read.parquet(path)))
    return out.select(KEY, "step", "week_date", *[R(F.col(c)).alias(c) for c in ("yhat", "lo95", "hi95")])


@register("model_params_forecast", "2.1", with_views(f"""
SELECT series_id, CAST(n_steps AS BIGINT) AS n_steps, TRUE AS matches
FROM (SELECT series_id, 26 AS n_steps FROM case_series GROUP BY 1) s""", "case_series"))
def q_model_params_forecast(spark, d):
    """The refitted best models, written as a parameter table and read back, give the forecasts that the refit gave."""
    s = Q._series(spark, d)
    fits, preds = _refit(spark, d, s)
    terms = fits.filter("error = ''").select(KEY, "sigma2", F.explode(F.arrays_zip("features", "coef")).alias("t")).select(
        KEY, F.col("t.features").alias("term"), F.col("t.coef").alias("coef"), "sigma2")
    path = FS.scratch_path(spark, "refit_params")
    FS.write_table(terms, path)
    again = MC.forecast_from_params(s, MC.stored_params(spark.read.parquet(path))).select(
        KEY, "week_date", *[F.col(c).alias(f"own_{c}") for c in ("yhat", "lo95", "hi95")])
    both = preds.filter(F.col("candidate_id") != FC.FALLBACK).join(again, [KEY, "week_date"], "full")
    same = [F.coalesce(MC._close(F.col(c), F.col(f"own_{c}"), F.col("own_yhat")), F.lit(False)) for c in ("yhat", "lo95", "hi95")]
    return both.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_steps"), F.min(same[0] & same[1] & same[2]).alias("matches"))


# ------------------------------------------------------------------ refit on all weeks

def _refit(spark, d, series):
    """(fits, predictions) of each series' best order on all its weeks."""
    cands = Q._table(spark, d, series=series)[0]
    best = RP.best_model(RP.leaderboard(cands, KEY), KEY)
    return FC.refit_full(series, best, KEY, "cases")


@register("forecast_26w_refit", "2.7")
def q_forecast_26w_refit(spark, d):
    """26 weeks behind the last known week, from the best order fitted anew on all weeks (else the fallback)."""
    s = Q._series(spark, d)
    fits, preds = _refit(spark, d, s)
    p = FC.with_fallback(preds, fits.filter("error = ''").select(KEY, "candidate_id"), KEY)
    return p.select(KEY, "step", "week_date", *[R(F.col(c)).alias(n) for c, n in (
        ("yhat", "yhat"), ("lo95", "yhat_lower"), ("hi95", "yhat_upper"))], "method")


@register("forecast_refit_weeks", "2.7", with_views("""
SELECT series_id, CAST(MAX(week_date) + to_days(7) AS DATE) AS first_week, CAST(MAX(week_date) + to_days(182) AS DATE) AS final_week,
       CAST(26 AS BIGINT) AS n_weeks, CAST(COUNT(*) AS BIGINT) AS n_train, TRUE AS sse_matches, TRUE AS is_minimum
FROM case_series GROUP BY 1""", "case_series"))
def q_forecast_refit_weeks(spark, d):
    """The refit trains on every week, is a minimum there, and its steps start behind the last week."""
    s = Q._series(spark, d)
    fits, preds = _refit(spark, d, s)
    own = preds.filter(F.col("candidate_id") != FC.FALLBACK).groupBy(KEY).agg(
        F.min("week_date").alias("first_week"), F.max("week_date").alias("final_week"), F.count(F.lit(1)).alias("n_weeks"))
    fine = MC.css_optimality(fits, s, rule=None).select(KEY, "sse_matches", "is_minimum")
    return own.join(fits.select(KEY, "n_train"), KEY).join(fine, KEY)
