"""Per-city extreme weeks: maximum cases and minimum temperature.

"Row of the maximum, earliest week on ties" is ``min(struct(-value, year,
week, ...))`` per city: a decomposable aggregate (partial minima per map
task), so no per-city sort and no skew if one city dominates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.functions.calendar import label_iso_week
from hebdo.functions.cleaning import round_half_up as R

# Peak type tags.
KIND_CASES = "casos"
KIND_COLD = "temperatura_min"


def _pick(df: DataFrame, sort_key, kind: str, value) -> DataFrame:
    m = F.min(F.struct(sort_key.alias("_k"), F.col("year"), F.col("week"),
                       F.col("cases"), F.col("temperature"), value.alias("value"))).alias("_m")
    g = df.groupBy("city").agg(m)
    return g.select(F.initcap("city").alias("city"), F.lit(kind).alias("kind"),
                    F.col("_m.year").alias("year"), F.col("_m.week").alias("week"),
                    label_iso_week(F.col("_m.year"), F.col("_m.week")).alias("week_label"),
                    R(F.col("_m.value").cast("double")).alias("value"),
                    R(F.col("_m.temperature")).alias("temp_at_week"),
                    F.col("_m.cases").alias("cases_at_week"))


def peak_week_cases(city_weeks: DataFrame) -> DataFrame:
    """Per city: the week of maximum cases (earliest on ties) with its temperature."""
    return _pick(city_weeks, -F.col("cases"), KIND_CASES, F.col("cases"))


def coldest_week(city_weeks: DataFrame) -> DataFrame:
    """Per city with any temperature: the week of minimum temperature, with its cases."""
    t = city_weeks.filter(F.col("temperature").isNotNull())
    return _pick(t, F.col("temperature"), KIND_COLD, F.col("temperature"))


def peaks_table(city_weeks: DataFrame) -> DataFrame:
    return peak_week_cases(city_weeks).unionByName(coldest_week(city_weeks))


def peaks_report_rows(peaks: DataFrame) -> DataFrame:
    """One row per (city, kind), values at one decimal, cities sorted."""
    return (peaks.select("city", "kind", "week_label",
                         F.round(F.col("value").cast("decimal(38,10)"), 1).cast("double").alias("value"),
                         F.round(F.col("temp_at_week").cast("decimal(38,10)"), 1).cast("double").alias("temp_at_week"),
                         "cases_at_week")
            .orderBy("city", "kind"))
