"""§2.6 window / time-series operators and §2.7 statistics as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions.calendar import iso_week, iso_week_to_monday, iso_year, label_stat_week, week_bin_monday
from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators import aggregates as A
from hebdo.operators import joins as J
from hebdo.operators import peaks as P
from hebdo.operators import series as S
from hebdo.operators import star as ST
from hebdo.operators import stats as T
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import (ffill_bfill_sql, interpolate_sql, iso_monday_sql, r4, spine_sql,
                                  week_bin_sql, with_views)
from hebdo.sources.tables import estab_labels, establishment_week_fact, readings, table, visit_sums


def V(spark, d):
    return visit_sums(spark, d, "year", "week")


def initcap_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda s: upper(s[1]) || lower(s[2:])), ' ')")


def pearson_sql(x: str, y: str) -> str:
    xc, yc = f"(CASE WHEN {y} IS NOT NULL THEN {x} END)", f"(CASE WHEN {x} IS NOT NULL THEN {y} END)"
    den = f"(stddev_pop({xc}) * stddev_pop({yc}))"
    return f"(CASE WHEN {den} = 0 THEN NULL ELSE covar_pop({xc}, {yc}) / {den} END)"


def _city_weeks(spark, d):
    return J.cases_left_climate(A.cases_by_city_week(visit_sums(spark, d, "year", "week")), A.climate_weekly_mean_exact(readings(spark, d)))


_CITY_WEEKS = {"cw": """
SELECT c.year, c.week, c.city, c.cases, m.temperature
FROM (SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
      FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3) c
LEFT JOIN climate m ON c.year = m.year AND c.week = m.week AND c.city = m.city"""}


def _pick_sql(kind: str, order: str, value: str, where: str = "TRUE") -> str:
    return f"""
SELECT {initcap_sql('city')} AS city, '{kind}' AS kind, year, week,
       printf('%d-W%02d', year, week) AS week_label, {r4(f'CAST({value} AS DOUBLE)')} AS value,
       {r4('temperature')} AS temp_at_week, cases AS cases_at_week
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY {order}, year, week) AS rn FROM cw WHERE {where}) t
WHERE rn = 1"""


_PEAK_CASES = _pick_sql("casos", "cases DESC", "cases")
_PEAK_COLD = _pick_sql("temperatura_min", "temperature", "temperature", "temperature IS NOT NULL")


# ------------------------------------------------------------------ §2.6

@register("iso_week_to_monday", "2.6", with_views(f"""
SELECT year, week, {iso_monday_sql('year', 'week')} AS week_monday
FROM (SELECT DISTINCT year, week FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL) t""", "visits_nc"))
def q_iso_week_to_monday(spark, d):
    yw = visit_sums(spark, d, "year", "week").select("year", "week").dropna().distinct()
    return yw.withColumn("week_monday", iso_week_to_monday("year", "week"))


@register("iso_year_week", "2.6", with_views("""
SELECT DISTINCT CAST(reading_ts AS DATE) AS reading_date, CAST(isoyear(reading_ts) AS INTEGER) AS iso_year,
       CAST(week(reading_ts) AS INTEGER) AS iso_week FROM readings WHERE reading_ts IS NOT NULL""", "readings"))
def q_iso_year_week(spark, d):
    r = readings(spark, d).dropna(subset=["reading_ts"])
    return r.select(F.to_date("reading_ts").alias("reading_date"), iso_year("reading_ts").alias("iso_year"),
                    iso_week("reading_ts").alias("iso_week")).distinct()


_EVENT_BINS = {"eb": f"""
SELECT event_type AS series_id, {week_bin_sql('ts')} AS week_date, CAST(SUM(value) AS DOUBLE) AS value
FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2"""}


@register("resample_week_sum", "2.6", with_views(f"""
SELECT sp.series_id, sp.week_date, {r4('COALESCE(b.value, 0)')} AS value
FROM ({spine_sql('eb')}) sp LEFT JOIN eb b ON sp.series_id = b.series_id AND sp.week_date = b.week_date""",
                                                 extra=_EVENT_BINS))
def q_resample_week_sum(spark, d):
    ev = table(spark, d, "events")
    return S.round_cols(S.resample_week_sum(ev.withColumnRenamed("event_type", "series_id"),
                                            "series_id", "ts", "value"), ["value"])


_READ_BINS = {"rb": f"""
SELECT lower(trim(city)) AS series_id, {week_bin_sql('reading_ts')} AS week_date, AVG(temperature) AS value
FROM readings WHERE city IS NOT NULL AND reading_ts IS NOT NULL GROUP BY 1, 2"""}


def _reading_bins_spine(spark, d):
    r = readings(spark, d).withColumn("series_id", F.lower(F.trim("city")))
    return S.resample_week_mean(r, "series_id", "reading_ts", "temperature")


@register("resample_week_mean", "2.6", with_views(f"""
SELECT sp.series_id, sp.week_date, {r4('b.value')} AS value
FROM ({spine_sql('rb')}) sp LEFT JOIN rb b ON sp.series_id = b.series_id AND sp.week_date = b.week_date""",
                                                  "readings", extra=_READ_BINS))
def q_resample_week_mean(spark, d):
    return S.round_cols(_reading_bins_spine(spark, d), ["value"])


@register("calendar_spine", "2.6", with_views(spine_sql("case_bins"), "case_bins"))
def q_calendar_spine(spark, d):
    by_week = (V(spark, d).dropna(subset=["year", "week", "region_label"])
               .groupBy(F.lower(F.trim("region_label")).alias("series_id"), "year", "week").agg(F.sum("total"))
               .select("series_id", week_bin_monday(iso_week_to_monday("year", "week")).alias("week_date")))
    return S.calendar_spine(by_week.distinct(), "series_id")


_RB_SPINE = dict(_READ_BINS)
_RB_SPINE["rbs"] = f"""
SELECT sp.series_id, sp.week_date, b.value
FROM ({spine_sql('rb')}) sp LEFT JOIN rb b ON sp.series_id = b.series_id AND sp.week_date = b.week_date"""


def _interp_query(direction):
    def build(spark, d):
        return S.round_cols(S.interpolate_linear(_reading_bins_spine(spark, d), "series_id", "value",
                                                 direction=direction), ["value"])
    return build


@register("interpolate_linear", "2.6", with_views(
    f"SELECT series_id, week_date, {r4('value')} AS value FROM ({interpolate_sql('rbs', 'value')}) q",
    "readings", extra=_RB_SPINE))
def q_interpolate_linear(spark, d):
    return _interp_query("forward")(spark, d)


@register("interpolate_both", "2.6", with_views(
    f"SELECT series_id, week_date, {r4('value')} AS value FROM ({interpolate_sql('rbs', 'value', both=True)}) q",
    "readings", extra=_RB_SPINE))
def q_interpolate_both(spark, d):
    return _interp_query("both")(spark, d)


@register("fill_forward_backward", "2.6", with_views(
    f"SELECT series_id, week_date, {r4('value')} AS value FROM ({ffill_bfill_sql('rbs', 'value')}) q",
    "readings", extra=_RB_SPINE))
def q_fill_forward_backward(spark, d):
    return S.round_cols(S.fill_forward_backward(_reading_bins_spine(spark, d), "series_id", "value"), ["value"])


@register("lag_shift", "2.6", with_views("""
SELECT series_id, week_date, cases,
       lag(cases, 1) OVER w AS cases_lag1, lag(cases, 52) OVER w AS cases_lag52
FROM case_series WINDOW w AS (PARTITION BY series_id ORDER BY week_date)""", "case_series"))
def q_lag_shift(spark, d):
    s = S.region_case_series(spark, d)
    return S.lag_shift(S.lag_shift(s, "series_id", "cases", 1, out="cases_lag1"),
                       "series_id", "cases", 52, out="cases_lag52")


_PROFILE = {"prof": """
SELECT series_id, CAST(week(week_date) AS INTEGER) AS week_of_year,
       AVG(cases) AS mean_cases, AVG(temperature) AS mean_temperature
FROM aligned GROUP BY 1, 2"""}


@register("zscore_profile", "2.6", with_views(f"""
SELECT series_id, week_of_year,
  {r4('(mean_cases - AVG(mean_cases) OVER p) / NULLIF(stddev_samp(mean_cases) OVER p, 0)')} AS z_cases,
  {r4('(mean_temperature - AVG(mean_temperature) OVER p) / NULLIF(stddev_samp(mean_temperature) OVER p, 0)')}
     AS z_temperature
FROM prof WINDOW p AS (PARTITION BY series_id)""", "aligned", extra=_PROFILE))
def q_zscore_profile(spark, d):
    a = S.aligned_cases_climate(spark, d)
    prof = (a.groupBy("series_id", iso_week("week_date").alias("week_of_year"))
            .agg(F.avg("cases").alias("mean_cases"), F.avg("temperature").alias("mean_temperature")))
    z = S.zscore(S.zscore(prof, "series_id", "mean_cases", "z_cases"), "series_id", "mean_temperature", "z_temperature")
    return z.select("series_id", "week_of_year", R(F.col("z_cases")).alias("z_cases"),
                    R(F.col("z_temperature")).alias("z_temperature"))


@register("peak_week_cases", "2.6", with_views(_PEAK_CASES, "visits_nc", "climate", extra=_CITY_WEEKS))
def q_peak_week_cases(spark, d):
    return P.peak_week_cases(_city_weeks(spark, d))


@register("coldest_week", "2.6", with_views(_PEAK_COLD, "visits_nc", "climate", extra=_CITY_WEEKS))
def q_coldest_week(spark, d):
    return P.coldest_week(_city_weeks(spark, d))


@register("peaks_table", "2.6", with_views(f"{_PEAK_CASES}\nUNION ALL\n{_PEAK_COLD}", "visits_nc", "climate",
                                           extra=_CITY_WEEKS))
def q_peaks_table(spark, d):
    return P.peaks_table(_city_weeks(spark, d))


@register("peak_flag", "2.6", with_views(f"""
SELECT f.time_id, f.estab_code, f.total, {r4('t.p90')} AS p90, CASE WHEN f.total > t.p90 THEN 1 ELSE 0 END AS is_peak
FROM fact_we f JOIN (SELECT estab_code, quantile_cont(total, 0.9) AS p90 FROM fact_we GROUP BY 1) t
  ON f.estab_code = t.estab_code""", "fact_we"))
def q_peak_flag(spark, d):
    f = A.with_peak_flag(establishment_week_fact(spark, d))
    return f.select("time_id", "estab_code", "total", R(F.col("p90")).alias("p90"), "is_peak")


@register("holdout_split", "2.6", with_views("""
SELECT series_id, week_date, cases, n_points, h, rdesc <= h AS is_test FROM (
  SELECT *, CAST(CASE WHEN n_points > 104 THEN 52 ELSE least(greatest(6, n_points // 4), n_points - 1) END AS INTEGER) AS h
  FROM (SELECT series_id, week_date, cases, COUNT(*) OVER (PARTITION BY series_id) AS n_points,
               row_number() OVER (PARTITION BY series_id ORDER BY week_date DESC) AS rdesc FROM case_series) a) b""",
                                             "case_series"))
def q_holdout_split(spark, d):
    return S.holdout_split(S.region_case_series(spark, d), "series_id").select(
        "series_id", "week_date", "cases", "n_points", "h", "is_test")


@register("surrogate_id", "2.6", with_views(f"""
SELECT CAST(row_number() OVER (ORDER BY year, week, city) AS BIGINT) AS surrogate_id, year, week, city,
       {r4('temperature')} AS temperature FROM climate""", "climate"))
def q_surrogate_id(spark, d):
    c = A.climate_weekly_mean_exact(readings(spark, d))
    out = ST.surrogate_id(c, ["year", "week"], ["city"], "surrogate_id")
    return out.select("surrogate_id", "year", "week", "city", R(F.col("temperature")).alias("temperature"))


@register("label_year_week", "2.6", with_views("""
SELECT year, week, printf('%d-S%02d', year, week) AS label, CAST(SUM(total) AS BIGINT) AS total
FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL GROUP BY year, week""", "visits_nc"))
def q_label_year_week(spark, d):
    return A.cases_by_year_week(V(spark, d)).select("year", "week", label_stat_week("year", "week").alias("label"),
                                                    "total")


# ------------------------------------------------------------------ §2.7 statistics

def _lag_sql(src: str, signed: bool) -> str:
    shifts = [f"lag(temperature, {k}) OVER w AS y{k}" for k in range(1, 9)]
    if signed:
        shifts += [f"lead(temperature, {k}) OVER w AS ym{k}" for k in range(1, 9)]
    cols = ["temperature AS y0"] + shifts
    ks = list(range(0, 9)) + ([-k for k in range(1, 9)] if signed else [])
    nm = {k: (f"y{k}" if k >= 0 else f"ym{-k}") for k in ks}
    aggs = ", ".join(f"{pearson_sql('x', nm[k])} AS c_{nm[k]}" for k in ks)
    sel = "\nUNION ALL\n".join(
        f"SELECT series_id, {lag} AS lag, {r4('c_' + nm[lag if signed else abs(lag)])} AS corr FROM g"
        for lag in range(-8, 9))
    return f"""
SELECT * FROM (
WITH b AS (SELECT series_id, cases AS x, {', '.join(cols)} FROM {src}
           WINDOW w AS (PARTITION BY series_id ORDER BY week_date)),
g AS (SELECT series_id, {aggs} FROM b GROUP BY series_id)
{sel}) q"""


@register("corr_lag0", "2.7", with_views(f"""
SELECT series_id, {r4(pearson_sql('cases', 'temperature'))} AS corr FROM inner_aligned GROUP BY 1""",
                                         "inner_aligned"))
def q_corr_lag0(spark, d):
    return T.corr_lag0(S.inner_aligned(spark, d))


@register("lag_correlation", "2.7", with_views(_lag_sql("inner_aligned", False), "inner_aligned"))
def q_lag_correlation(spark, d):
    return T.lag_correlation(S.inner_aligned(spark, d))


@register("lag_correlation_signed", "2.7", with_views(_lag_sql("inner_aligned", True), "inner_aligned"))
def q_lag_correlation_signed(spark, d):
    return T.lag_correlation(S.inner_aligned(spark, d), signed=True)


_BEST = f"""
SELECT series_id, lag AS best_lag, corr AS best_corr FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY abs(corr) DESC, lag) AS rn
  FROM ({_lag_sql('inner_aligned', False)}) lc WHERE corr IS NOT NULL) t WHERE rn = 1"""


@register("best_lag", "2.7", with_views(_BEST, "inner_aligned"))
def q_best_lag(spark, d):
    return T.best_lag(T.lag_correlation(S.inner_aligned(spark, d)))


_WEEKLY_BY_WOY = {"woy": """
SELECT lower(trim(region_label)) AS series_id, week, CAST(SUM(total) AS BIGINT) AS total
FROM visits_nc WHERE week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2"""}


@register("linear_trend", "2.7", with_views(f"""
SELECT series_id, week, total,
  {r4('regr_intercept(total, week) OVER p + regr_slope(total, week) OVER p * week')} AS fitted,
  {r4('regr_slope(total, week) OVER p')} AS slope, {r4('regr_intercept(total, week) OVER p')} AS intercept,
  {r4('regr_r2(total, week) OVER p')} AS r2
FROM woy WINDOW p AS (PARTITION BY series_id)""", "visits_nc", extra=_WEEKLY_BY_WOY))
def q_linear_trend(spark, d):
    w = (V(spark, d).dropna(subset=["week", "region_label"])
         .groupBy(F.lower(F.trim("region_label")).alias("series_id"), "week")
         .agg(F.sum("total").cast("bigint").alias("total")))
    return T.linear_trend(w, "series_id", "week", "total")


_NAIVE = {"nv": """
SELECT series_id, week_date, y, yhat FROM (
  SELECT *, rdesc <= CASE WHEN n > 104 THEN 52 ELSE least(greatest(6, n // 4), n - 1) END AS is_test FROM (
    SELECT series_id, week_date, cases AS y, lag(cases, 52) OVER (PARTITION BY series_id ORDER BY week_date) AS yhat,
           COUNT(*) OVER (PARTITION BY series_id) AS n,
           row_number() OVER (PARTITION BY series_id ORDER BY week_date DESC) AS rdesc
    FROM case_series) a) b WHERE is_test"""}


def _naive(spark, d):
    return T.seasonal_naive(S.region_case_series(spark, d))


@register("seasonal_naive", "2.7", with_views("SELECT * FROM nv", "case_series", extra=_NAIVE))
def q_seasonal_naive(spark, d):
    return _naive(spark, d)


_METRICS = f"""
SELECT series_id,
  {r4('CASE WHEN COUNT(*) = COUNT(yhat) THEN AVG(abs(y - yhat)) END')} AS mae,
  {r4('CASE WHEN COUNT(*) = COUNT(yhat) THEN sqrt(AVG((y - yhat) * (y - yhat))) END')} AS rmse,
  COUNT(*) AS n_test
FROM nv GROUP BY 1"""


@register("mae", "2.7", with_views(f"SELECT series_id, mae FROM ({_METRICS}) m", "case_series", extra=_NAIVE))
def q_mae(spark, d):
    return T.holdout_metrics(_naive(spark, d)).select("series_id", "mae")


@register("rmse", "2.7", with_views(f"SELECT series_id, rmse FROM ({_METRICS}) m", "case_series", extra=_NAIVE))
def q_rmse(spark, d):
    return T.holdout_metrics(_naive(spark, d)).select("series_id", "rmse")


@register("naive_metrics", "2.7", with_views(_METRICS, "case_series", extra=_NAIVE))
def q_naive_metrics(spark, d):
    return T.holdout_metrics(_naive(spark, d))


# ------------------------------------------------------------------ §2.8 reports (statistics-based)

@register("deviation_alerts", "2.8", with_views(f"""
SELECT series_id, week_date, y, yhat, {r4('abs(y - yhat) / NULLIF(abs(yhat), 0)')} AS rel_deviation
FROM nv WHERE yhat IS NOT NULL AND abs(y - yhat) > 0.2 * abs(yhat)""", "case_series", extra=_NAIVE))
def q_deviation_alerts(spark, d):
    return T.deviation_alerts(_naive(spark, d))


@register("correlation_summary", "2.8", with_views(f"""
SELECT c.series_id, {r4(pearson_sql('cases', 'temperature'))} AS corr_lag0,
       ANY_VALUE(b.best_lag) AS best_lag, ANY_VALUE(b.best_corr) AS best_corr
FROM inner_aligned c LEFT JOIN ({_BEST}) b ON c.series_id = b.series_id GROUP BY c.series_id""",
                                                   "inner_aligned"))
def q_correlation_summary(spark, d):
    return T.correlation_summary(T.lag_correlation(S.inner_aligned(spark, d)))


@register("peaks_report_rows", "2.8", with_views(f"""
SELECT city, kind, week_label, CAST(ROUND(CAST(value AS DECIMAL(38,10)), 1) AS DOUBLE) AS value,
       CAST(ROUND(CAST(temp_at_week AS DECIMAL(38,10)), 1) AS DOUBLE) AS temp_at_week, cases_at_week
FROM ({_PEAK_CASES}
UNION ALL
{_PEAK_COLD}) p ORDER BY city, kind""", "visits_nc", "climate", extra=_CITY_WEEKS))
def q_peaks_report_rows(spark, d):
    return P.peaks_report_rows(P.peaks_table(_city_weeks(spark, d)))


@register("peak_alert_report", "2.8", with_views("""
SELECT f.time_id, u.estab_label, f.total, f.is_peak
FROM fact_flag f LEFT JOIN (
  SELECT estab_code, estab_label FROM (
    SELECT estab_code, estab_label, row_number() OVER (PARTITION BY estab_code ORDER BY visit_id) AS rn
    FROM visits_nc) t WHERE rn = 1) u ON f.estab_code = u.estab_code
WHERE f.is_peak = 1""", "fact_flag", "visits_nc"))
def q_peak_alert_report(spark, d):
    from hebdo.operators import reports as RP
    return RP.peak_alert_report(A.with_peak_flag(establishment_week_fact(spark, d)), estab_labels(spark, d))


@register("climate_report", "2.8", with_views(f"""
SELECT year, week, city, {r4('temperature')} AS temperature, {r4('temperature - 5')} AS temp_min,
       {r4('temperature + 5')} AS temp_max, TRUE AS is_synthetic FROM climate""", "climate"))
def q_climate_report(spark, d):
    from hebdo.operators import reports as RP
    return RP.climate_report(A.climate_weekly_mean_exact(readings(spark, d)))


@register("append_log", "2.1", with_views(f"""
SELECT run, series_id, mae, rmse, n_test FROM ({_METRICS}) m, (SELECT 1 AS run UNION ALL SELECT 2) r""",
                                          "case_series", extra=_NAIVE))
def q_append_log(spark, d):
    """Two refresh runs append their metrics rows to one history table (created on first append)."""
    from hebdo.session import checkpoint_dir
    from hebdo.sources import files as FS
    checkpoint_dir(spark)
    path = FS.scratch_path(spark, "metrics_log")
    m = T.holdout_metrics(_naive(spark, d))
    for run in (1, 2):
        FS.append_log(m.select(F.lit(run).alias("run"), "*"), path)
    return spark.read.parquet(path)
