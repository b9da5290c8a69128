"""Correlation, lagged correlation, trend and holdout metrics.

All statistics are SQL aggregates over series partitions. Lagged
correlations are computed for every lag in one pass: one window sort per
series produces all shifted columns, then one aggregate computes every
lag's moments together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators.series import holdout_split


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over complete pairs; NULL (not an error) for constant input.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant series; this
    form returns NULL instead, like the source's NaN.
    """
    xc = F.when(y.isNotNull(), x)
    yc = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xc, yc), F.stddev_pop(xc) * F.stddev_pop(yc))


def corr_lag0(aligned: DataFrame, key: str = "series_id", x: str = "cases", y: str = "temperature") -> DataFrame:
    return aligned.groupBy(key).agg(R(pearson(F.col(x), F.col(y))).alias("corr"))


def lag_correlation(aligned: DataFrame, key: str = "series_id", x: str = "cases", y: str = "temperature",
                    max_lag: int = 8, signed: bool = False, order: str = "week_date",
                    rounded: bool = True) -> DataFrame:
    """corr(x_t, y_{t-k}) for k in -max_lag..max_lag, per series, 2*max_lag+1 rows.

    Faithful mode (``signed=False``) shifts by |k| for both signs, so
    corr(-k) == corr(k), as the source analyses do. ``signed=True`` uses a
    lead for negative k (the stated intent).
    """
    w = Window.partitionBy(key).orderBy(order)
    shifted = {0: F.col(y)}
    for k in range(1, max_lag + 1):
        shifted[k] = F.lag(y, k).over(w)
        if signed:
            shifted[-k] = F.lead(y, k).over(w)
    d = aligned.select(key, F.col(x).alias("_x"), *[c.alias(f"_y{k}".replace("-", "m")) for k, c in shifted.items()])
    aggs = [pearson(F.col("_x"), F.col(f"_y{k}".replace("-", "m"))).alias(f"_c{k}".replace("-", "m"))
            for k in shifted]
    g = d.groupBy(key).agg(*aggs)
    rows = []
    for lag in range(-max_lag, max_lag + 1):
        src = lag if signed else abs(lag)
        rows.append(F.struct(F.lit(lag).alias("lag"), F.col(f"_c{src}".replace("-", "m")).alias("corr")))
    out = g.select(key, F.explode(F.array(*rows)).alias("_r")).select(key, "_r.lag", "_r.corr")
    return out.withColumn("corr", R(F.col("corr"))) if rounded else out


def best_lag(lag_corr: DataFrame, key: str = "series_id") -> DataFrame:
    """Lag with the largest |corr| (first lag on ties; NULLs ignored).

    Expressed as ``min(struct(-|corr|, lag))``: a decomposable aggregate, no
    per-series sort.
    """
    c = lag_corr.filter(F.col("corr").isNotNull())
    m = F.min(F.struct((-F.abs(F.col("corr"))).alias("_a"), F.col("lag"), F.col("corr"))).alias("_m")
    return c.groupBy(key).agg(m).select(key, F.col("_m.lag").alias("best_lag"),
                                        R(F.col("_m.corr")).alias("best_corr"))


def correlation_summary(lag_corr: DataFrame, key: str = "series_id") -> DataFrame:
    """Lag-0 correlation, best lag and its correlation, from one lag table, one aggregate."""
    best = F.min(F.when(F.col("corr").isNotNull(),
                        F.struct((-F.abs(F.col("corr"))).alias("_a"), F.col("lag"), F.col("corr"))))
    return lag_corr.groupBy(key).agg(
        F.max(F.when(F.col("lag") == 0, F.col("corr"))).alias("corr_lag0"),
        best.getField("lag").alias("best_lag"), best.getField("corr").alias("best_corr"))


def linear_trend(weekly: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """OLS y ~ x per series: slope, intercept, R^2 and fitted values.

    Computed as window aggregates over the series partition (no join back).
    """
    p = Window.partitionBy(key)
    slope = F.regr_slope(F.col(y), F.col(x)).over(p)
    icpt = F.regr_intercept(F.col(y), F.col(x)).over(p)
    r2 = F.regr_r2(F.col(y), F.col(x)).over(p)
    return (weekly.withColumn("_s", slope).withColumn("_i", icpt).withColumn("_r2", r2)
            .select(key, x, y,
                    R(F.col("_i") + F.col("_s") * F.col(x)).alias("fitted"),
                    R(F.col("_s")).alias("slope"), R(F.col("_i")).alias("intercept"), R(F.col("_r2")).alias("r2")))


def seasonal_naive(series: DataFrame, key: str = "series_id", value: str = "cases", season: int = 52,
                   rule: str = "B") -> DataFrame:
    """Holdout predictions yhat(t) = y(t - season); the lag is taken before the split."""
    w = Window.partitionBy(key).orderBy("week_date")
    d = series.withColumn("yhat", F.lag(value, season).over(w))
    d = holdout_split(d, key, rule)
    return d.filter("is_test").select(key, "week_date", F.col(value).alias("y"), "yhat")


def holdout_metrics(pred: DataFrame, key: str = "series_id") -> DataFrame:
    """MAE and RMSE per series; NULL when any prediction in the holdout is missing."""
    complete = F.count(F.lit(1)) == F.count("yhat")
    err = F.col("y") - F.col("yhat")
    return pred.groupBy(key).agg(
        R(F.when(complete, F.avg(F.abs(err)))).alias("mae"),
        R(F.when(complete, F.sqrt(F.avg(err * err)))).alias("rmse"),
        F.count(F.lit(1)).alias("n_test"))


def deviation_alerts(pred: DataFrame, key: str = "series_id", tol: float = 0.2) -> DataFrame:
    """Weeks whose actual deviates from the forecast by more than tol*|forecast|."""
    dev = F.abs(F.col("y") - F.col("yhat"))
    return (pred.filter(F.col("yhat").isNotNull() & (dev > F.lit(tol) * F.abs(F.col("yhat"))))
            .select(key, "week_date", "y", "yhat",
                    R(F.try_divide(dev, F.abs(F.col("yhat")))).alias("rel_deviation")))
