"""§2.4 star schema and §2.5 joins as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.functions.calendar import time_key
from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators import aggregates as A
from hebdo.operators import joins as J
from hebdo.operators import series as S
from hebdo.operators import star as ST
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import r4, with_views
from hebdo.session import checkpoint_dir
from hebdo.sources.tables import (cause_week_fact, estab_labels, establishment_week_fact, establishments, readings, table,
                                  visit_sums)


def _dim_time_sql(src: str) -> str:
    return f"""
SELECT year, week, CAST(year AS BIGINT) * 100 + week AS time_id,
       CAST(month(make_date(year, 1, 1) + to_days(CAST(greatest(week - 1, 0) * 7 AS INTEGER))) AS INTEGER) AS month,
       CAST((month(make_date(year, 1, 1) + to_days(CAST(greatest(week - 1, 0) * 7 AS INTEGER))) - 1) // 3 + 1 AS INTEGER) AS quarter,
       CAST(month(make_date(year, 1, 1) + to_days(CAST(greatest(week - 1, 0) * 7 AS INTEGER))) IN (6, 7, 8) AS INTEGER) AS is_winter
FROM (SELECT DISTINCT year, week FROM {src} WHERE year IS NOT NULL AND week IS NOT NULL) t"""


def _season_sql(m: str) -> str:
    return (f"CASE WHEN {m} IN (12, 1, 2) THEN 'Verano' WHEN {m} IN (3, 4, 5) THEN 'Otoño' "
            f"WHEN {m} IN (6, 7, 8) THEN 'Invierno' ELSE 'Primavera' END")


def _dim_time_season_sql(src: str) -> str:
    m = "CAST(month(make_date(year, 1, 1) + to_days(CAST(week * 7 AS INTEGER))) AS INTEGER)"
    return f"""
SELECT year, week, CAST(year AS BIGINT) * 100 + week AS time_id, {m} AS month, {_season_sql(m)} AS season
FROM (SELECT DISTINCT year, week FROM {src} WHERE year IS NOT NULL AND week IS NOT NULL) t"""


_ESTAB_UNIQUE_SQL = """
SELECT estab_code, estab_label, region_code, commune_code FROM (
  SELECT estab_code, estab_label, region_code, commune_code,
         row_number() OVER (PARTITION BY estab_code ORDER BY visit_id) AS rn FROM visits_nc) t WHERE rn = 1"""


# ------------------------------------------------------------------ §2.4 star

@register("dim_region", "2.4", with_views("""
SELECT DISTINCT region_code, region_label FROM visits_nc WHERE region_code IS NOT NULL""", "visits_nc"))
def q_dim_region(spark, d):
    return ST.dim_region(visit_sums(spark, d))


@register("dim_commune", "2.4", with_views("""
SELECT DISTINCT commune_code, commune_label, region_code FROM visits_nc WHERE commune_code IS NOT NULL""",
                                           "visits_nc"))
def q_dim_commune(spark, d):
    return ST.dim_commune(visit_sums(spark, d))


@register("dim_health_service", "2.4", with_views("""
SELECT DISTINCT service_code, service_label FROM visits_nc WHERE service_code IS NOT NULL""", "visits_nc"))
def q_dim_health_service(spark, d):
    return ST.dim_health_service(visit_sums(spark, d))


@register("dim_cause", "2.4", with_views("""
SELECT DISTINCT cause_code, cause FROM visits WHERE cause_code IS NOT NULL""", "visits"))
def q_dim_cause(spark, d):
    return ST.dim_cause(visit_sums(spark, d, with_cause=True))


@register("dim_time", "2.4", with_views(_dim_time_sql("visits_nc"), "visits_nc"))
def q_dim_time(spark, d):
    return ST.dim_time(visit_sums(spark, d, "year", "week"))


@register("dim_time_season", "2.4", with_views(_dim_time_season_sql("visits_nc"), "visits_nc"))
def q_dim_time_season(spark, d):
    return ST.dim_time_season(visit_sums(spark, d, "year", "week"))


@register("dim_establishment", "2.4", with_views("""
SELECT DISTINCT estab_code, estab_label, region_code, commune_code, service_code
FROM visits_nc WHERE estab_code IS NOT NULL""", "visits_nc"))
def q_dim_establishment(spark, d):
    return ST.dim_establishment(visit_sums(spark, d))


@register("dim_establishment_unique", "2.4", with_views(_ESTAB_UNIQUE_SQL, "visits_nc"))
def q_dim_establishment_unique(spark, d):
    return ST.dim_establishment_unique(visit_sums(spark, d))


@register("dim_temperature", "2.4", with_views(f"""
SELECT CAST(row_number() OVER (ORDER BY year, week, city) AS BIGINT) AS temperature_id,
       CAST(year AS BIGINT) * 100 + week AS time_id, year, week, city, {r4('temperature')} AS temperature
FROM climate c
WHERE CAST(year AS BIGINT) * 100 + week IN (SELECT time_id FROM dt)""", "visits_nc", "climate",
                                             extra={"dt": _dim_time_sql("visits_nc")}))
def q_dim_temperature(spark, d):
    return ST.dim_temperature(A.climate_weekly_mean_exact(readings(spark, d)), ST.dim_time(visit_sums(spark, d, "year", "week")))


@register("dim_temperature_by_code", "2.4", with_views(f"""
SELECT DISTINCT CAST(year AS BIGINT) * 100 + week AS time_id, city, {r4('temperature')} AS temperature
FROM climate""", "climate"))
def q_dim_temperature_by_code(spark, d):
    return ST.dim_temperature_by_code(A.climate_weekly_mean_exact(readings(spark, d)))


@register("time_key", "2.4", with_views("""
SELECT DISTINCT year, week, CAST(year AS BIGINT) * 100 + week AS time_id FROM visits_nc""", "visits_nc"))
def q_time_key(spark, d):
    return visit_sums(spark, d, "year", "week").select("year", "week", time_key("year", "week").alias("time_id")).distinct()


def _climate_time_dim(spark, d):
    c = A.climate_weekly_mean_exact(readings(spark, d))
    return ST.dim_time(c)


@register("fk_orphans_time", "2.4", with_views("""
SELECT * FROM fact_wec WHERE time_id NOT IN (
  SELECT DISTINCT CAST(year AS BIGINT) * 100 + week FROM climate)""", "fact_wec", "climate"))
def q_fk_orphans_time(spark, d):
    """Fact rows whose week is missing from a time register built on the climate calendar."""
    return ST.orphans(cause_week_fact(spark, d), _climate_time_dim(spark, d), "time_id")


@register("fk_orphans_establishment", "2.4", with_views("""
SELECT * FROM fact_wec WHERE estab_code NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
                                                        "fact_wec"))
def q_fk_orphans_establishment(spark, d):
    """Fact rows whose establishment is missing from a register of solvent suppliers."""
    register_ = table(spark, d, "supplier").filter(F.col("s_acctbal") >= 0)
    return ST.orphans(cause_week_fact(spark, d), register_, "estab_code", "s_suppkey")


@register("fk_orphans_cause", "2.4", with_views("""
SELECT * FROM fact_wec WHERE cause_code NOT IN (
  SELECT cause_code FROM causes WHERE cause NOT LIKE 'PROMO%')""", "fact_wec", "causes"))
def q_fk_orphans_cause(spark, d):
    """Fact rows whose cause is missing from a cause register that omits PROMO types."""
    from hebdo.sources.tables import cause_codes
    reg = cause_codes(spark, d).filter(~F.col("cause").startswith("PROMO"))
    return ST.orphans(cause_week_fact(spark, d), reg, "cause_code")


@register("time_without_temperature", "2.4", with_views("""
SELECT * FROM dtv WHERE time_id NOT IN (SELECT DISTINCT CAST(year AS BIGINT) * 100 + week FROM climate)""",
                                                        "visits_nc", "climate",
                                                        extra={"dtv": _dim_time_sql("visits_nc")}))
def q_time_without_temperature(spark, d):
    dt = ST.dim_time(visit_sums(spark, d, "year", "week"))
    temp = ST.dim_temperature_by_code(A.climate_weekly_mean_exact(readings(spark, d)))
    return dt.join(temp.select("time_id").distinct(), "time_id", "left_anti")


# ------------------------------------------------------------------ §2.5 joins

@register("cases_left_climate", "2.5", with_views(f"""
SELECT c.year, c.week, c.city, c.cases, {r4('m.temperature')} AS temperature
FROM (SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
      FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3) c
LEFT JOIN climate m ON c.year = m.year AND c.week = m.week AND c.city = m.city""", "visits_nc", "climate"))
def q_cases_left_climate(spark, d):
    out = J.cases_left_climate(A.cases_by_city_week(visit_sums(spark, d, "year", "week")), A.climate_weekly_mean_exact(readings(spark, d)))
    return out.withColumn("temperature", R(F.col("temperature")))


@register("peaks_left_names", "2.5", with_views(f"""
SELECT f.time_id, f.estab_code, u.estab_label, f.total, f.is_peak
FROM fact_flag f LEFT JOIN ({_ESTAB_UNIQUE_SQL}) u ON f.estab_code = u.estab_code
WHERE f.is_peak = 1""", "fact_flag", "visits_nc"))
def q_peaks_left_names(spark, d):
    return J.peaks_left_names(A.with_peak_flag(establishment_week_fact(spark, d)), estab_labels(spark, d))


@register("fact_left_season", "2.5", with_views(f"""
SELECT f.time_id, f.estab_code, f.total, f.is_peak, s.season
FROM fact_flag f LEFT JOIN ({_dim_time_season_sql('visits_nc')}) s ON f.time_id = s.time_id""",
                                                "fact_flag", "visits_nc"))
def q_fact_left_season(spark, d):
    checkpoint_dir(spark)
    fact = establishment_week_fact(spark, d).checkpoint()  # read by the flags and by the calendar: one scan of the lines
    return J.fact_left_season(A.with_peak_flag(fact), ST.dim_time_season(fact))


@register("climate_semi_time", "2.5", with_views(f"""
SELECT year, week, city, {r4('temperature')} AS temperature FROM climate
WHERE CAST(year AS BIGINT) * 100 + week IN (SELECT DISTINCT time_id FROM visits_nc)""", "climate", "visits_nc"))
def q_climate_semi_time(spark, d):
    c = A.climate_weekly_mean_exact(readings(spark, d))
    out = J.climate_semi_time(c, ST.dim_time(visit_sums(spark, d, "year", "week")))
    return out.select("year", "week", "city", R(F.col("temperature")).alias("temperature"))


@register("threshold_lookup", "2.5", with_views(f"""
SELECT f.time_id, f.estab_code, f.total, {r4('COALESCE(t.p90, 9999)')} AS threshold,
       CASE WHEN f.total > COALESCE(t.p90, 9999) THEN 1 ELSE 0 END AS is_peak
FROM fact_we f LEFT JOIN (SELECT estab_code, quantile_cont(total, 0.9) AS p90 FROM fact_we GROUP BY 1) t
  ON f.estab_code = t.estab_code""", "fact_we"))
def q_threshold_lookup(spark, d):
    fact = establishment_week_fact(spark, d)
    thr = fact.groupBy("estab_code").agg(F.percentile("total", 0.9).alias("p90"))
    return J.threshold_lookup(fact, thr)


@register("align_inner", "2.5", with_views(f"""
SELECT series_id, week_date, cases, {r4('temperature')} AS temperature FROM inner_aligned""", "inner_aligned"))
def q_align_inner(spark, d):
    return S.round_cols(S.inner_aligned(spark, d), ["temperature"])


@register("align_left_spine", "2.5", with_views(f"""
SELECT series_id, week_date, cases, {r4('temperature')} AS temperature FROM aligned""", "aligned"))
def q_align_left_spine(spark, d):
    return S.round_cols(S.aligned_cases_climate(spark, d), ["temperature"])


__all__ = ["establishments"]
