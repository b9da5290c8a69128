"""Single-pass hash aggregations over the conformed visit / reading tables.

Every operator here is a ``groupBy().agg()``: Spark plans a partial
(map-side) aggregate before the shuffle, so a hot key (one establishment or
one commune holding a third of all rows) is collapsed to one partial row per
map task before anything moves. Null group keys are dropped first: pandas
drops them, Spark would keep a NULL group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.cleaning import round_half_up as R
from hebdo.functions.calendar import iso_week, iso_year, season_of_month, jan1_offset_date, time_key


def _sum_long(c: str, alias: str):
    # all-NULL group -> 0 (pandas semantics), counts stay BIGINT
    return F.coalesce(F.sum(F.col(c)), F.lit(0)).cast("bigint").alias(alias)


def sum_by(df: DataFrame, keys: list[str], value: str = "total", alias: str = "total",
           descending: bool = False) -> DataFrame:
    """sum(value) by keys, null keys dropped; optional ordering by the sum."""
    out = df.dropna(subset=keys).groupBy(*keys).agg(_sum_long(value, alias))
    if descending:
        out = out.orderBy(F.col(alias).desc(), *keys)
    return out


def cases_by_date(visits: DataFrame) -> DataFrame:
    return (visits.withColumn("visit_date", F.to_date("visit_ts"))
            .transform(lambda d: sum_by(d, ["visit_date"]))
            .orderBy("visit_date"))


def cases_by_year_week(visits: DataFrame) -> DataFrame:
    return sum_by(visits, ["year", "week"]).orderBy("year", "week")


def cases_by_commune(visits: DataFrame) -> DataFrame:
    return sum_by(visits, ["commune_label"], descending=True)


def cases_by_age_group(visits: DataFrame) -> DataFrame:
    return sum_by(visits, ["age_group"], descending=True)


def cases_by_establishment(visits: DataFrame) -> DataFrame:
    return sum_by(visits, ["estab_label"], descending=True)


def cases_by_cause(visits: DataFrame) -> DataFrame:
    return sum_by(visits, ["cause"], descending=True)


def top_communes(visits: DataFrame, n: int = 20) -> DataFrame:
    """Top-n communes by cases (ties broken by name): a TakeOrdered, no full sort."""
    return cases_by_commune(visits).limit(n)


def year_week_heatmap(visits: DataFrame) -> DataFrame:
    """year x week pivot of case sums, missing cell 0.

    The week list 1..53 is given explicitly so Spark does not run an extra
    distinct job to discover pivot values; output columns are w01..w53.
    """
    weeks = list(range(1, 54))
    p = (visits.dropna(subset=["year", "week"]).groupBy("year")
         .pivot("week", weeks).agg(F.sum("total")))
    return p.select("year", *[F.coalesce(F.col(str(w)), F.lit(0)).cast("bigint").alias(f"w{w:02d}")
                              for w in weeks]).orderBy("year")


def cases_by_week_of_year(visits: DataFrame) -> DataFrame:
    return sum_by(visits, ["week"]).orderBy("week")


def climate_weekly_mean(readings: DataFrame, ndigits: int = 4) -> DataFrame:
    """mean temperature by city x ISO year x ISO week (null readings dropped)."""
    r = readings.dropna(subset=["reading_ts", "temperature", "city"])
    return (r.groupBy(F.col("city"), iso_year("reading_ts").alias("year"), iso_week("reading_ts").alias("week"))
            .agg(R(F.avg("temperature"), ndigits).alias("temperature"),
                 F.count(F.lit(1)).alias("n_readings")))


def climate_weekly_mean_exact(readings: DataFrame) -> DataFrame:
    """Unrounded weekly mean, for downstream arithmetic."""
    r = readings.dropna(subset=["reading_ts", "temperature", "city"])
    return (r.groupBy(F.lower(F.trim("city")).alias("city"), iso_year("reading_ts").alias("year"),
                      iso_week("reading_ts").alias("week"))
            .agg(F.avg("temperature").alias("temperature")))


def cases_by_city_week(visits: DataFrame, city_col: str = "region_label") -> DataFrame:
    """sum by (year, week, city); the city key is normalised *before* grouping."""
    v = visits.withColumn("city", F.lower(F.trim(F.col(city_col))))
    return sum_by(v, ["year", "week", "city"], alias="cases")


#: Metrics of the fact as ``conform_table`` emits them, and as the visit analogue has them.
RAW_METRICS = ("total", "band_under1", "band_1_4", "band_5_14", "band_15_64", "band_65_plus")
VISIT_METRICS = ("total", "band_a", "band_n", "band_r")


def fact_week_estab_cause(visits: DataFrame, metrics=None) -> DataFrame:
    """Fact table at week x establishment x cause: sums of all metrics.

    The metrics are those of the input's layout: all six of a conformed raw table, or
    the analogue's; a table that has neither set whole is an error.
    """
    if metrics is None:
        metrics = next((m for m in (RAW_METRICS, VISIT_METRICS) if set(m) <= set(visits.columns)), None)
        if metrics is None:
            raise ValueError(f"no whole set of metrics among the columns {', '.join(visits.columns)}")
    v = visits.dropna(subset=["year", "week", "estab_code", "cause_code"])
    return (v.groupBy(time_key("year", "week").alias("time_id"), "estab_code", "cause_code")
            .agg(*[_sum_long(m, m) for m in metrics]))


def fact_week_estab(visits: DataFrame) -> DataFrame:
    """Narrow fact at week x establishment: sum(total)."""
    v = visits.dropna(subset=["year", "week", "estab_code"])
    return (v.groupBy("year", "week", "estab_code").agg(_sum_long("total", "total"))
            .withColumn("time_id", time_key("year", "week")))


def estab_p90_threshold(fact: DataFrame, q: float = 0.9) -> DataFrame:
    """Exact linear-interpolated percentile of weekly totals per establishment.

    ``percentile`` buffers the values of a group; at weekly grain a group
    holds at most one value per calendar week, so its size is bounded by the
    calendar, not by the raw row count.
    """
    return fact.groupBy("estab_code").agg(R(F.percentile("total", q), 4).alias("p90"))


def with_peak_flag(fact: DataFrame, q: float = 0.9) -> DataFrame:
    """peak = 1 when the week's total is strictly above the establishment p90.

    The threshold is a window aggregate over the establishment partition: no
    lookup table and no join.
    """
    thr = F.percentile("total", q).over(Window.partitionBy("estab_code"))
    return (fact.withColumn("p90", thr)
            .withColumn("is_peak", F.when(F.col("total") > F.col("p90"), 1).otherwise(0).cast("int")))


def season_report(fact_flagged: DataFrame) -> DataFrame:
    """By southern-hemisphere season: sum, mean per establishment-week, peaks.

    The season is a pure function of (year, week) (Jan 1 + 7*week), so it
    is computed inline instead of joining a time dimension back in.
    """
    month = F.month(jan1_offset_date("year", "week", offset_weeks=0, clip_at_zero=False))
    return (fact_flagged.withColumn("season", season_of_month(month))
            .groupBy("season")
            .agg(_sum_long("total", "total_cases"),
                 R(F.avg("total"), 4).alias("mean_per_estab_week"),
                 F.sum("is_peak").cast("bigint").alias("peak_count")))


def seasonal_profile(series: DataFrame, key: str = "series_id", ndigits: int = 4) -> DataFrame:
    """mean cases and mean temperature by ISO week of year, per series."""
    return (series.groupBy(key, iso_week("week_date").alias("week_of_year"))
            .agg(R(F.avg("cases"), ndigits).alias("mean_cases"),
                 R(F.avg("temperature"), ndigits).alias("mean_temperature")))


def series_summary(series: DataFrame, key: str = "series_id") -> DataFrame:
    return series.groupBy(key).agg(F.min("week_date").alias("first_week"),
                                   F.max("week_date").alias("last_week"),
                                   F.count(F.lit(1)).alias("n_weeks"))


def city_list(df: DataFrame, col: str = "city") -> DataFrame:
    return df.select(F.col(col).alias("city")).dropna().distinct()


def series_validity(df: DataFrame, key: str, date_col: str, min_points: int = 10) -> DataFrame:
    """Usable when a series has > min_points non-null and distinct dates."""
    return (df.groupBy(key)
            .agg(F.count(date_col).alias("n_dates"), F.count_distinct(date_col).alias("n_distinct_dates"))
            .withColumn("is_valid", (F.col("n_dates") > min_points) & (F.col("n_distinct_dates") > min_points)))
