"""§2.3 aggregations as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hebdo.operators import aggregates as A
from hebdo.operators import series as S
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import r4, with_views
from hebdo.sources.tables import cause_week_fact, establishment_week_fact, readings, visit_sums, visits


def V(spark, d, cause=False):
    return visits(spark, d, with_cause=cause)


@register("season_report", "2.3", with_views(f"""
SELECT CASE WHEN m IN (12, 1, 2) THEN 'Verano' WHEN m IN (3, 4, 5) THEN 'Otoño'
            WHEN m IN (6, 7, 8) THEN 'Invierno' ELSE 'Primavera' END AS season,
       CAST(SUM(total) AS BIGINT) AS total_cases,
       {r4("AVG(total)")} AS mean_per_estab_week,
       CAST(SUM(is_peak) AS BIGINT) AS peak_count
FROM (SELECT *, month(make_date(year, 1, 1) + to_days(CAST(week * 7 AS INTEGER))) AS m FROM fact_flag) t
GROUP BY 1
""", "fact_flag"))
def q_season_report(spark, d):
    return A.season_report(A.with_peak_flag(establishment_week_fact(spark, d)))


@register("cases_by_date", "2.3", with_views("""
SELECT CAST(visit_ts AS DATE) AS visit_date, CAST(SUM(total) AS BIGINT) AS total
FROM visits_nc WHERE visit_ts IS NOT NULL GROUP BY 1
""", "visits_nc"))
def q_cases_by_date(spark, d):
    return A.cases_by_date(visit_sums(spark, d, "visit_ts"))


@register("cases_by_year_week", "2.3", with_views("""
SELECT year, week, CAST(SUM(total) AS BIGINT) AS total FROM visits_nc
WHERE year IS NOT NULL AND week IS NOT NULL GROUP BY year, week
""", "visits_nc"))
def q_cases_by_year_week(spark, d):
    return A.cases_by_year_week(visit_sums(spark, d, "year", "week"))


@register("cases_by_commune", "2.3", with_views("""
SELECT commune_label, CAST(SUM(total) AS BIGINT) AS total FROM visits_nc
WHERE commune_label IS NOT NULL GROUP BY 1
""", "visits_nc"))
def q_cases_by_commune(spark, d):
    return A.cases_by_commune(visit_sums(spark, d))


@register("cases_by_age_group", "2.3", with_views("""
SELECT age_group, CAST(SUM(total) AS BIGINT) AS total FROM visits_nc
WHERE age_group IS NOT NULL GROUP BY 1
""", "visits_nc"))
def q_cases_by_age_group(spark, d):
    return A.cases_by_age_group(visit_sums(spark, d, "age_group"))


@register("cases_by_establishment", "2.3", with_views("""
SELECT estab_label, CAST(SUM(total) AS BIGINT) AS total FROM visits_nc
WHERE estab_label IS NOT NULL GROUP BY 1
""", "visits_nc"))
def q_cases_by_establishment(spark, d):
    return A.cases_by_establishment(visit_sums(spark, d))


@register("cases_by_cause", "2.3", with_views("""
SELECT cause, CAST(SUM(total) AS BIGINT) AS total FROM visits
WHERE cause IS NOT NULL GROUP BY 1
""", "visits"))
def q_cases_by_cause(spark, d):
    return A.cases_by_cause(visit_sums(spark, d, with_cause=True))


@register("top_communes", "2.3", with_views("""
SELECT commune_label, CAST(SUM(total) AS BIGINT) AS total FROM visits_nc
WHERE commune_label IS NOT NULL GROUP BY 1 ORDER BY total DESC, commune_label LIMIT 20
""", "visits_nc"))
def q_top_communes(spark, d):
    return A.top_communes(visit_sums(spark, d), 20)


_heat_cols = ", ".join(
    f"CAST(COALESCE(SUM(CASE WHEN week = {w} THEN total END), 0) AS BIGINT) AS w{w:02d}" for w in range(1, 54))


@register("year_week_heatmap", "2.3", with_views(f"""
SELECT year, {_heat_cols} FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL GROUP BY year
""", "visits_nc"))
def q_year_week_heatmap(spark, d):
    return A.year_week_heatmap(visit_sums(spark, d, "year", "week"))


@register("cases_by_week_of_year", "2.3", with_views("""
SELECT week, CAST(SUM(total) AS BIGINT) AS total FROM visits_nc WHERE week IS NOT NULL GROUP BY week
""", "visits_nc"))
def q_cases_by_week_of_year(spark, d):
    return A.cases_by_week_of_year(visit_sums(spark, d, "week"))


@register("climate_weekly_mean", "2.3", with_views(f"""
SELECT city, CAST(isoyear(reading_ts) AS INTEGER) AS year, CAST(week(reading_ts) AS INTEGER) AS week,
       {r4("AVG(temperature)")} AS temperature, COUNT(*) AS n_readings
FROM readings WHERE reading_ts IS NOT NULL AND temperature IS NOT NULL AND city IS NOT NULL
GROUP BY 1, 2, 3
""", "readings"))
def q_climate_weekly_mean(spark, d):
    return A.climate_weekly_mean(readings(spark, d))


@register("cases_by_city_week", "2.3", with_views("""
SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3
""", "visits_nc"))
def q_cases_by_city_week(spark, d):
    return A.cases_by_city_week(visit_sums(spark, d, "year", "week"))


@register("fact_week_estab_cause", "2.3", with_views("SELECT * FROM fact_wec", "fact_wec"))
def q_fact_week_estab_cause(spark, d):
    return cause_week_fact(spark, d)


@register("fact_week_estab", "2.3", with_views("SELECT * FROM fact_we", "fact_we"))
def q_fact_week_estab(spark, d):
    return establishment_week_fact(spark, d)


@register("estab_p90_threshold", "2.3", with_views(f"""
SELECT estab_code, {r4("quantile_cont(total, 0.9)")} AS p90 FROM fact_we GROUP BY estab_code
""", "fact_we"))
def q_estab_p90_threshold(spark, d):
    return A.estab_p90_threshold(establishment_week_fact(spark, d))


@register("seasonal_profile", "2.3", with_views(f"""
SELECT series_id, CAST(week(week_date) AS INTEGER) AS week_of_year,
       {r4("AVG(cases)")} AS mean_cases, {r4("AVG(temperature)")} AS mean_temperature
FROM aligned GROUP BY 1, 2
""", "aligned"))
def q_seasonal_profile(spark, d):
    return A.seasonal_profile(S.aligned_cases_climate(spark, d))


@register("series_summary", "2.3", with_views("""
SELECT series_id, MIN(week_date) AS first_week, MAX(week_date) AS last_week, COUNT(*) AS n_weeks
FROM case_series GROUP BY 1
""", "case_series"))
def q_series_summary(spark, d):
    return A.series_summary(S.region_case_series(spark, d))


@register("city_list", "2.3", with_views("""
SELECT DISTINCT city FROM readings WHERE city IS NOT NULL
""", "readings"))
def q_city_list(spark, d):
    return A.city_list(readings(spark, d))


@register("series_validity", "2.3", with_views("""
SELECT estab_code, COUNT(visit_ts) AS n_dates, COUNT(DISTINCT visit_ts) AS n_distinct_dates,
       COUNT(visit_ts) > 10 AND COUNT(DISTINCT visit_ts) > 10 AS is_valid
FROM visits_nc GROUP BY 1
""", "visits_nc"))
def q_series_validity(spark, d):
    return A.series_validity(V(spark, d), "estab_code", "visit_ts")
