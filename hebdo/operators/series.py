"""Weekly time-series operators for many series at once.

Every window here is partitioned by the series key and ordered by the week
date, so each series is processed inside one task while different series
spread over the cluster. Series are at weekly grain (one row per series per
week), so a window partition holds at most one row per calendar week no
matter how many raw rows fed it: hot keys are collapsed by the partial
aggregate before the shuffle.

All windows of a series share one specification (partition by key, order by
week date), so Spark sorts each series once and evaluates every lag, fill
and count in the same pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hebdo.functions.calendar import iso_week, iso_week_to_monday, iso_year, week_bin_monday
from hebdo.functions.cleaning import clamp_nonnegative, round_half_up
from hebdo.sources.tables import readings, visit_sums


def _w(key: str, order: str = "week_date") -> Window:
    return Window.partitionBy(key).orderBy(order)


def _whole(key: str, order: str = "week_date") -> Window:
    """Whole-partition frame with the shared ordering (no extra sort)."""
    return _w(key, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def resample_week(df: DataFrame, key: str, ts_col: str, value_col: str, how: str = "sum",
                  out: str = "value") -> DataFrame:
    """Bin timestamps into (Tue..Mon] weeks labelled by the Monday; sum or mean."""
    agg = F.sum(value_col) if how == "sum" else F.avg(value_col)
    return (df.withColumn("week_date", week_bin_monday(F.col(ts_col)))
            .dropna(subset=[key, "week_date"])
            .groupBy(key, "week_date").agg(agg.cast("double").alias(out)))


def to_spine(binned: DataFrame, key: str, value: str = "value", zero_fill: bool = True) -> DataFrame:
    """Gap-free weekly rows from each series' first to last bin.

    Each bin emits itself plus the empty weeks up to the next bin (``lead``
    over the series, then ``explode``): one sort per series, no min/max
    aggregate and no join back. Empty weeks get 0 (sums) or NULL (means).
    """
    nxt = F.col("_next")
    gaps = F.when(nxt.isNotNull() & (F.datediff(nxt, F.col("week_date")) > 7),
                  F.sequence(F.date_add("week_date", 7), F.date_sub(nxt, 7), F.expr("INTERVAL 7 DAYS")))
    filler = F.lit(0.0) if zero_fill else F.lit(None).cast("double")
    rows = F.concat(F.array(F.struct(F.col("week_date").alias("week_date"), F.col(value).cast("double").alias(value))),
                    F.coalesce(F.transform(gaps, lambda g: F.struct(g.alias("week_date"), filler.alias(value))),
                               F.array().cast(f"array<struct<week_date:date,{value}:double>>")))
    out = (binned.select(key, "week_date", value, F.lead("week_date").over(_w(key)).alias("_next"))
           .select(key, F.explode(rows).alias("_r")).select(key, "_r.week_date", f"_r.{value}"))
    if zero_fill:
        out = out.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))
    return out


def calendar_spine(binned: DataFrame, key: str) -> DataFrame:
    """(key, week_date) for every week from each series' first to last bin."""
    return to_spine(binned.select(key, "week_date", F.lit(0.0).alias("_v")), key, "_v").select(key, "week_date")


def resample_week_sum(df: DataFrame, key: str, ts_col: str, value_col: str, out: str = "value") -> DataFrame:
    return to_spine(resample_week(df, key, ts_col, value_col, "sum", out), key, out, zero_fill=True)


def resample_week_mean(df: DataFrame, key: str, ts_col: str, value_col: str, out: str = "value") -> DataFrame:
    return to_spine(resample_week(df, key, ts_col, value_col, "mean", out), key, out, zero_fill=False)


def interpolate_linear(df: DataFrame, key: str, value: str, order: str = "week_date",
                       direction: str = "forward", out: str | None = None) -> DataFrame:
    """Linear interpolation by position within each series.

    forward: leading NULLs stay NULL, trailing NULLs take the last value.
    both:    leading NULLs also take the first value.
    """
    out = out or value
    w = _w(key, order)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    d = df.withColumn("_pos", F.row_number().over(w))
    has = F.col(value).isNotNull()
    d = (d.withColumn("_pv", F.last(F.col(value), ignorenulls=True).over(before))
          .withColumn("_pp", F.last(F.when(has, F.col("_pos")), ignorenulls=True).over(before))
          .withColumn("_nv", F.first(F.col(value), ignorenulls=True).over(after))
          .withColumn("_np", F.first(F.when(has, F.col("_pos")), ignorenulls=True).over(after)))
    interior = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (F.col("_pos") - F.col("_pp")) / (F.col("_np") - F.col("_pp"))
    filled = (F.when(has, F.col(value))
              .when(F.col("_pv").isNotNull() & F.col("_nv").isNotNull(), interior)
              .when(F.col("_pv").isNotNull(), F.col("_pv")))
    if direction == "both":
        filled = filled.otherwise(F.col("_nv"))
    return d.withColumn(out, filled.cast("double")).drop("_pos", "_pv", "_pp", "_nv", "_np")


def fill_forward_backward(df: DataFrame, key: str, value: str, order: str = "week_date",
                          out: str | None = None) -> DataFrame:
    out = out or value
    w = _w(key, order)
    ff = F.last(F.col(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    bf = F.first(F.col(value), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(out, F.coalesce(F.col(value), ff, bf))


def lag_shift(df: DataFrame, key: str, value: str, k: int, order: str = "week_date",
              out: str | None = None) -> DataFrame:
    """Shift by k rows within the series (k < 0 looks ahead)."""
    w = _w(key, order)
    col = F.lag(value, k).over(w) if k >= 0 else F.lead(value, -k).over(w)
    return df.withColumn(out or f"{value}_lag{k}", col)


def zscore(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(x - mean)/sample sd over the whole series partition; sd 0/NULL -> NULL."""
    p = Window.partitionBy(key)
    return df.withColumn(out, F.try_divide(F.col(value) - F.avg(value).over(p), F.stddev_samp(value).over(p)))


def holdout_split(df: DataFrame, key: str, rule: str = "B", order: str = "week_date") -> DataFrame:
    """Tag the last h rows of each series as test.

    rule A: h = 52 if n > 104 else max(4, min(12, n div 4))
    rule B: h = 52 if n > 104 else max(6, n div 4), clamped to n - 1

    n and the position come from the series' shared window ordering (the
    last h rows are those with position > n - h), so no descending sort.
    """
    n = F.count(F.lit(1)).over(_whole(key, order))
    if rule == "A":
        h = F.when(n > 104, 52).otherwise(F.greatest(F.lit(4), F.least(F.lit(12), F.floor(n / 4).cast("int"))))
    else:
        h = F.when(n > 104, 52).otherwise(F.least(F.greatest(F.lit(6), F.floor(n / 4).cast("int")), n - 1))
    return (df.withColumn("n_points", n.cast("bigint")).withColumn("h", h.cast("int"))
            .withColumn("is_test", F.row_number().over(_w(key, order)) > F.col("n_points") - F.col("h")))


def week_53_rows(df: DataFrame, year: str = "year", week: str = "week") -> DataFrame:
    """(year, n_rows, is_short_year) of the rows filed under a week 53.

    A short year has 52 ISO weeks (28 December lies in its last); there ``iso_week_to_monday`` puts
    the rows on the first Monday of the year after, where they add to that year's week 1.
    """
    last = F.weekofyear(F.make_date(F.col(year), F.lit(12), F.lit(28)))
    rows = df.filter((F.col(week) == 53) & F.col(year).isNotNull())
    return rows.groupBy(year).agg(F.count(F.lit(1)).alias("n_rows")).select(year, "n_rows", (last < 53).alias("is_short_year"))


# ---------------------------------------------------------------- analogues

def region_case_series(spark: SparkSession, d: str) -> DataFrame:
    """Weekly cases per region (series_id = lower-cased region name), gap-free.

    (ISO year, ISO week) -> ISO Monday -> weekly bin, summed in one
    aggregation (the mapping from (year, week) to its bin is a function, so
    summing per bin directly equals summing per week first), then the
    zero-filled spine.
    """
    v = visit_sums(spark, d, "year", "week")
    bins = (v.dropna(subset=["year", "week", "region_label"])
            .groupBy(F.lower(F.trim("region_label")).alias("series_id"),
                     week_bin_monday(iso_week_to_monday("year", "week")).alias("week_date"))
            .agg(F.sum("total").cast("double").alias("cases")))
    # a negative week is a correction in the source data: clamped to 0 as in the case series of the reports
    return to_spine(bins.withColumn("cases", clamp_nonnegative("cases").cast("double")), "series_id", "cases", zero_fill=True)


def climate_monday(spark: SparkSession, d: str) -> DataFrame:
    """Weekly mean temperature keyed by (city, ISO Monday), one aggregation over readings.

    ISO (year, week) keys map one-to-one to their Monday, so the mean per
    Monday equals the mean per ISO week.
    """
    r = readings(spark, d).dropna(subset=["reading_ts", "temperature", "city"])
    monday = week_bin_monday(iso_week_to_monday(iso_year("reading_ts"), iso_week("reading_ts")))
    return (r.groupBy(F.lower(F.trim("city")).alias("series_id"), monday.alias("week_date"))
            .agg(F.avg("temperature").alias("temperature")))


def city_climate_series(spark: SparkSession, d: str) -> DataFrame:
    """Climate on its own weekly spine: interpolate forward, then ffill/bfill."""
    c = to_spine(climate_monday(spark, d), "series_id", "temperature", zero_fill=False)
    c = interpolate_linear(c, "series_id", "temperature")
    return fill_forward_backward(c, "series_id", "temperature")


def aligned_cases_climate(spark: SparkSession, d: str) -> DataFrame:
    """Climate re-indexed onto the case calendar, interpolated both ways, filled.

    Returns (series_id, week_date, cases, temperature) with NULL-free pairs.
    """
    cases = region_case_series(spark, d)
    clim = climate_monday(spark, d)
    a = cases.join(clim, ["series_id", "week_date"], "left")
    a = interpolate_linear(a, "series_id", "temperature", direction="both")
    a = fill_forward_backward(a, "series_id", "temperature")
    return a.dropna(subset=["cases", "temperature"])


def inner_aligned(spark: SparkSession, d: str) -> DataFrame:
    """Case and climate series each on their own spine, inner-joined on the week."""
    return (region_case_series(spark, d)
            .join(city_climate_series(spark, d), ["series_id", "week_date"], "inner")
            .dropna(subset=["cases", "temperature"]))


def round_cols(df: DataFrame, cols, nd: int = 4) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, round_half_up(F.col(c), nd))
    return df
