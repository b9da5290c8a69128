"""§2.7 model grid, forecasts and refresh; §2.8 metric reports. Rows-only checks
(fitted models have no SQL equivalent); the holdout metrics of the seasonal
naive benchmark are value-checked separately (``mae``, ``rmse``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators import forecast as FC
from hebdo.operators import reports as RP
from hebdo.operators import series as S
from hebdo.operators import stats as ST
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import with_views
from hebdo.session import checkpoint_dir
from hebdo.sources import files as FS

KEY = "series_id"


def _series(spark, d, exog=False):
    """Weekly case series (with aligned climate when exog), checkpointed once in the
    shared checkpoint folder: every candidate family of one run reads it from there."""
    checkpoint_dir(spark)
    s = S.aligned_cases_climate(spark, d) if exog else S.region_case_series(spark, d)
    return s.checkpoint()


def _grid(spark, d, grid=FC.GRID, rule="B", exog=False, series=None):
    s = series if series is not None else _series(spark, d, exog)
    if exog:
        return FC.sarima_grid(s, KEY, "cases", exog="temperature", grid=grid, rule=rule)
    return FC.sarima_grid(s, KEY, "cases", grid=grid, rule=rule)


def _table(spark, d, grid=FC.GRID, rule="B", exog=False, model="SARIMAX", series=None):
    fits, preds, actual = _grid(spark, d, grid, rule, exog, series)
    return FC.candidates_table(fits, FC.holdout_scores(preds, actual), KEY, model), fits, preds


@register("sarima_candidates", "2.7")
def q_sarima_candidates(spark, d):
    return _table(spark, d)[0]


@register("sarima_fixed", "2.7")
def q_sarima_fixed(spark, d):
    return _table(spark, d, grid=[FC.DEFAULT_ORDER], rule="A")[0]


@register("sarimax_exog", "2.7")
def q_sarimax_exog(spark, d):
    return _table(spark, d, grid=[FC.DEFAULT_ORDER], rule="A", exog=True, model="SARIMAX+Clima")[0]


def _comparison(spark, d):
    base = _table(spark, d, grid=[FC.DEFAULT_ORDER], rule="A")[0]
    clim = _table(spark, d, grid=[FC.DEFAULT_ORDER], rule="A", exog=True, model="SARIMAX+Clima")[0]
    return RP.model_comparison(base, clim)


@register("model_comparison", "2.7")
def q_model_comparison(spark, d):
    return _comparison(spark, d)


@register("metrics_pair", "2.8")
def q_metrics_pair(spark, d):
    return RP.metrics_pair(_comparison(spark, d))


@register("model_report_metrics", "2.8")
def q_model_report_metrics(spark, d):
    return RP.model_report_metrics(RP.metrics_pair(_comparison(spark, d)))


def _harmonic_row(spark, d, series=None):
    pred = FC.harmonic_candidate(series if series is not None else S.region_case_series(spark, d))
    err = F.col("y") - F.col("yhat")
    return (pred.groupBy(KEY).agg(R(F.avg(F.abs(err))).alias("mae"), R(F.sqrt(F.avg(err * err))).alias("rmse"),
                                  F.max("error").alias("error"))
            .select(KEY, F.lit("Harmonic").alias("model"), F.lit(None).cast("int").alias("candidate_id"),
                    *[F.lit(None).cast("int").alias(c) for c in ("p", "q", "sp", "sq")],
                    F.lit("-").alias("order"), F.lit("yearly K=10").alias("seasonal"),
                    F.lit(None).cast("double").alias("aic"), "mae", "rmse", "error"))


@register("harmonic_candidate", "2.7")
def q_harmonic_candidate(spark, d):
    return _harmonic_row(spark, d)


def _naive_row(spark, d, series=None):
    m = ST.holdout_metrics(ST.seasonal_naive(series if series is not None else S.region_case_series(spark, d)))
    return m.select(KEY, F.lit("Naive52").alias("model"), F.lit(None).cast("int").alias("candidate_id"),
                    *[F.lit(None).cast("int").alias(c) for c in ("p", "q", "sp", "sq")],
                    F.lit("-").alias("order"), F.lit("-").alias("seasonal"),
                    F.lit(None).cast("double").alias("aic"), "mae", "rmse", F.lit("").alias("error"))


def _leaderboard(spark, d):
    series = _series(spark, d)
    cands, fits, preds = _table(spark, d, series=series)
    rows = _naive_row(spark, d, series).unionByName(cands).unionByName(_harmonic_row(spark, d, series))
    # read by several consumers (best model, forecasts, refresh log): materialise once
    return RP.leaderboard(rows, KEY).checkpoint(), fits, preds, series


@register("leaderboard", "2.7")
def q_leaderboard(spark, d):
    return _leaderboard(spark, d)[0]


@register("best_model", "2.7")
def q_best_model(spark, d):
    return RP.best_model(_leaderboard(spark, d)[0], KEY)


def _best_preds(spark, d):
    """Predictions of each series' best model; of the seasonal naive fallback where no candidate could be fitted."""
    lb, fits, preds, _ = _leaderboard(spark, d)
    best = RP.best_model(lb, KEY).select(KEY, "candidate_id", "is_default")
    return FC.with_fallback(preds, best, KEY), best.filter(~F.col("is_default")).drop("is_default"), fits


@register("forecast_26w", "2.7")
def q_forecast_26w(spark, d):
    p = _best_preds(spark, d)[0].filter("is_future")
    return p.select(KEY, "week_date", R(F.col("yhat")).alias("yhat"), R(F.col("lo95")).alias("yhat_lower"),
                    R(F.col("hi95")).alias("yhat_upper"), "method")


@register("forecast_coverage", "2.7", with_views("""
SELECT COUNT(*) AS series_in, COUNT(*) AS series_forecast, CAST(26 AS BIGINT) AS least_weeks, CAST(26 AS BIGINT) AS most_weeks
FROM (SELECT DISTINCT series_id FROM case_series) t""", "case_series"))
def q_forecast_coverage(spark, d):
    """Every series that goes in comes out with 26 weeks, fitted or by the fallback."""
    series = _series(spark, d)
    got = q_forecast_26w(spark, d).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return (series.select(KEY).distinct().join(got, KEY, "left")
            .agg(F.count(F.lit(1)).alias("series_in"), F.count("n").alias("series_forecast"),
                 F.min(F.coalesce("n", F.lit(0))).alias("least_weeks"), F.max(F.coalesce("n", F.lit(0))).alias("most_weeks")))


@register("forecast_interval_95", "2.7")
def q_forecast_interval_95(spark, d):
    p = _best_preds(spark, d)[0]
    return p.select(KEY, "step", "week_date", "is_future", R(F.col("yhat")).alias("yhat"),
                    R(F.col("lo95")).alias("lo95"), R(F.col("hi95")).alias("hi95"))


@register("model_params_table", "2.1")
def q_model_params_table(spark, d):
    """Best model per series as a typed parameter table (orders, terms, sigma^2), persisted."""
    _, best, fits = _best_preds(spark, d)
    params = (fits.join(best, [KEY, "candidate_id"])
              .select(KEY, "p", "q", "sp", "sq", "sigma2", "aic",
                      F.posexplode(F.arrays_zip("features", "coef")).alias("i", "t"))
              .select(KEY, "p", "q", "sp", "sq", F.col("t.features").alias("term"), F.col("t.coef").alias("coef"),
                      "sigma2", "aic"))
    path = FS.scratch_path(spark, "model_params")
    FS.write_table(params, path)
    return spark.read.parquet(path)


@register("monthly_refresh", "2.7", with_views("""
SELECT run, series_id, COUNT(*) AS n_points FROM case_series, (SELECT 1 AS run UNION ALL SELECT 2) r GROUP BY 1, 2""",
                                               "case_series"))
def q_monthly_refresh(spark, d):
    """Two monthly runs after one model selection: each reads the stored order of every series, refits
    that order only, overwrites the forecast and appends its rows to the one log."""
    lb, _, _, series = _leaderboard(spark, d)
    base = FS.scratch_path(spark, "refresh")
    FS.write_table(RP.best_model(lb, KEY), f"{base}/best_order")
    for run in (1, 2):
        refresh(spark, series, base, run)
    return spark.read.parquet(f"{base}/monitoring_log").select("run", KEY, "n_points")


def refresh(spark, series, base: str, run: int) -> None:
    best = spark.read.parquet(f"{base}/best_order")
    fits, preds, actual = FC.sarima_grid(series, KEY, "cases", only=best)
    out = FC.with_fallback(preds, fits.filter("error = ''").select(KEY, "candidate_id"), KEY).filter("is_future")
    FS.write_table(out.select(KEY, "week_date", "yhat", "lo95", "hi95", "method"), f"{base}/forecast")
    scores = FC.holdout_scores(preds, actual, KEY)
    n_points = series.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_points"))
    log = (best.select(KEY, "candidate_id", "order", "seasonal").join(n_points, KEY).join(scores, [KEY, "candidate_id"], "left")
           .select(F.lit(run).alias("run"), F.current_timestamp().alias("run_ts"), KEY, "order", "seasonal", "mae", "rmse", "n_points"))
    FS.append_log(log, f"{base}/monitoring_log")


@register("sarima_candidates_by_establishment", "2.7")
def q_sarima_candidates_by_establishment(spark, d):
    """The same candidate grid with one series per establishment (many-series scale-out)."""
    from hebdo.functions.calendar import iso_week_to_monday, week_bin_monday
    from hebdo.sources.tables import visit_sums
    checkpoint_dir(spark)
    v = visit_sums(spark, d, "year", "week").dropna(subset=["year", "week", "estab_code"])
    bins = (v.groupBy(F.col("estab_code").cast("string").alias(KEY),
                      week_bin_monday(iso_week_to_monday("year", "week")).alias("week_date"))
            .agg(F.sum("total").cast("double").alias("cases")))
    series = S.to_spine(bins, KEY, "cases", zero_fill=True).checkpoint()
    fits, preds, actual = FC.sarima_grid(series, KEY, "cases")
    return FC.candidates_table(fits, FC.holdout_scores(preds, actual), KEY)
