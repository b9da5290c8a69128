"""Equi, semi and lookup joins of the analyses.

Sides that are bounded by the calendar (time dimensions: at most 53 rows per
year) are broadcast explicitly. Sides that grow with the data (establishment
labels, thresholds, climate) are left to the planner: AQE broadcasts them
when the measured size is under the threshold and shuffles otherwise.
Climate is always pre-aggregated to one row per (city, year, week) before it
is joined, so duplicate readings cannot multiply case rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cases_left_climate(cases_city_week: DataFrame, climate_weekly: DataFrame) -> DataFrame:
    """Left equi join on (year, week, city); climate keys normalised (lower/trim)."""
    c = climate_weekly.select(F.lower(F.trim("city")).alias("city"), "year", "week", "temperature")
    return cases_city_week.join(c, ["year", "week", "city"], "left") \
                          .select("year", "week", "city", "cases", "temperature")


def peaks_left_names(flagged_fact: DataFrame, estab_unique: DataFrame) -> DataFrame:
    """Peak rows with their establishment label (one label row per code)."""
    names = estab_unique.select("estab_code", "estab_label")
    return (flagged_fact.filter(F.col("is_peak") == 1)
            .join(names, "estab_code", "left")
            .select("time_id", "estab_code", "estab_label", "total", "is_peak"))


def fact_left_season(flagged_fact: DataFrame, dim_time_season: DataFrame) -> DataFrame:
    """Fact with its season; the time dimension is calendar-bounded -> broadcast."""
    t = F.broadcast(dim_time_season.select("time_id", "season"))
    return flagged_fact.join(t, "time_id", "left").select("time_id", "estab_code", "total", "is_peak", "season")


def climate_semi_time(climate_weekly: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Climate rows whose week exists in the time dimension (left semi)."""
    c = climate_weekly.withColumn("time_id", F.col("year").cast("bigint") * 100 + F.col("week"))
    return c.join(F.broadcast(dim_time.select("time_id")), "time_id", "left_semi").drop("time_id")


def threshold_lookup(fact: DataFrame, thresholds: DataFrame, default: float = 9999.0) -> DataFrame:
    """Per-row dictionary lookup of the establishment threshold, default 9999."""
    t = thresholds.select("estab_code", F.col("p90").alias("_thr"))
    thr = F.coalesce(F.col("_thr"), F.lit(default))
    return (fact.join(t, "estab_code", "left")
            .select("time_id", "estab_code", "total",
                    F.round(thr.cast("decimal(38,10)"), 4).cast("double").alias("threshold"),
                    F.when(F.col("total") > thr, 1).otherwise(0).cast("int").alias("is_peak")))
