"""Report tables: peak alerts, climate report, model comparison and leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.cleaning import clean_header, round_half_up as R
from hebdo.operators.forecast import DEFAULT_ORDER

# Model labels of the metrics table and the missing-value text.
MODEL_BASE = "SARIMAX"
MODEL_CLIMATE = "SARIMAX+Clima"
MISSING_TEXT = "N/D"
SYNTHETIC_SPREAD = 5.0   # temp_min / temp_max default to temperature -/+ 5 when absent


def peak_alert_report(flagged_fact: DataFrame, estab_unique: DataFrame) -> DataFrame:
    names = estab_unique.select("estab_code", "estab_label")
    return (flagged_fact.filter(F.col("is_peak") == 1).join(names, "estab_code", "left")
            .select("time_id", "estab_label", "total", "is_peak"))


def climate_report(climate_weekly: DataFrame) -> DataFrame:
    """year, week, city, temperature and min/max; min/max are synthetic (+-5) when absent."""
    c = climate_weekly
    has_min, has_max = "temp_min" in c.columns, "temp_max" in c.columns
    tmin = F.col("temp_min") if has_min else F.col("temperature") - SYNTHETIC_SPREAD
    tmax = F.col("temp_max") if has_max else F.col("temperature") + SYNTHETIC_SPREAD
    return c.select("year", "week", "city", R(F.col("temperature")).alias("temperature"),
                    R(tmin).alias("temp_min"), R(tmax).alias("temp_max"),
                    F.lit(not (has_min and has_max)).alias("is_synthetic"))


def model_comparison(base: DataFrame, climate: DataFrame, key: str = "series_id") -> DataFrame:
    """Base and climate metrics per series; the climate row is omitted when its fit failed."""
    b = base.select(key, F.lit(MODEL_BASE).alias("model"), "mae", "rmse")
    c = (climate.filter((F.col("error") == "") & F.col("mae").isNotNull() & F.col("rmse").isNotNull())
         .select(key, F.lit(MODEL_CLIMATE).alias("model"), "mae", "rmse"))
    return b.unionByName(c)


def metrics_pair(metrics: DataFrame, key: str = "series_id") -> DataFrame:
    """Per series: the base row (model == SARIMAX, trimmed, any case) and the first
    row whose model contains 'clima' (any case)."""
    m = metrics.withColumn("_m", F.trim(F.col("model").cast("string")))
    is_base = F.upper("_m") == MODEL_BASE
    is_clim = F.lower("_m").contains("clima")
    # the whole first row (by label, then metrics): MAE and RMSE never come from different rows
    pick = lambda cond: F.min(F.when(cond, F.struct("_m", F.col("mae").isNull().alias("none"), "mae", "rmse")))
    return (m.groupBy(key).agg(pick(is_base).alias("b"), pick(is_clim).alias("c"))
            .select(key, F.col("b.mae").alias("base_mae"), F.col("b.rmse").alias("base_rmse"),
                    F.col("c.mae").alias("clima_mae"), F.col("c.rmse").alias("clima_rmse")))


def metrics_pair_from_kv(kv: DataFrame, key: str = "series_id", metric: str = "metric", value: str = "value"):
    """Older two-column form (metric, value): pivoted into a base row."""
    p = kv.groupBy(key).pivot(metric, ["MAE", "RMSE"]).agg(F.min(F.col(value).cast("double")))
    return p.select(key, F.col("MAE").alias("base_mae"), F.col("RMSE").alias("base_rmse"),
                    F.lit(None).cast("double").alias("clima_mae"), F.lit(None).cast("double").alias("clima_rmse"))


def metrics_layout(metrics: DataFrame) -> dict[str, str]:
    """Which columns hold what, by their cleaned names: a long table (model, mae, rmse) or key/value pairs (metric, value).

    The second is any table that has, beside the series key, just two columns, the first of them text.
    """
    at = {clean_header(c): c for c in metrics.columns}
    model = at.get("modelo", at.get("model"))
    if model and "mae" in at and "rmse" in at:
        return {"layout": "long", "model": model, "mae": at["mae"], "rmse": at["rmse"]}
    rest = [c for c in metrics.columns if clean_header(c) != "series_id"]
    if len(rest) == 2 and dict(metrics.dtypes)[rest[0]] == "string":
        return {"layout": "pairs", "metric": rest[0], "value": rest[1]}
    raise ValueError(f"metrics in no known layout; columns: {', '.join(metrics.columns)}")


def load_metrics_pair(metrics: DataFrame, key: str = "series_id") -> DataFrame:
    """``metrics_pair`` of a metrics table of either layout; one without ``key`` is one series of an empty name."""
    at = metrics_layout(metrics)
    if key not in metrics.columns:
        metrics = metrics.withColumn(key, F.lit(""))
    num = lambda c: F.trim(F.col(f"`{c}`").cast("string")).try_cast("double")
    if at["layout"] == "long":
        long = metrics.select(key, F.col(f"`{at['model']}`").alias("model"), num(at["mae"]).alias("mae"), num(at["rmse"]).alias("rmse"))
        return metrics_pair(long, key)
    pairs = metrics.select(key, F.upper(F.trim(f"`{at['metric']}`")).alias("metric"), num(at["value"]).alias("value"))
    return metrics_pair_from_kv(pairs, key)


def _fmt2(c):
    txt = F.format_string("%.2f", F.round(c.cast("decimal(38,10)"), 2).cast("double"))
    return F.when(c.isNull(), F.lit(MISSING_TEXT)).otherwise(txt)


def model_report_metrics(pair: DataFrame, key: str = "series_id") -> DataFrame:
    """Two report rows per series, metrics at 2 decimals, 'N/D' when missing."""
    rows = F.array(
        F.struct(F.lit(MODEL_BASE).alias("model"), _fmt2(F.col("base_mae")).alias("mae"),
                 _fmt2(F.col("base_rmse")).alias("rmse")),
        F.struct(F.lit(MODEL_CLIMATE).alias("model"), _fmt2(F.col("clima_mae")).alias("mae"),
                 _fmt2(F.col("clima_rmse")).alias("rmse")))
    return pair.select(key, F.explode(rows).alias("r")).select(key, "r.*")


def leaderboard(rows: DataFrame, key: str = "series_id") -> DataFrame:
    """Rank candidates per series by RMSE, then AIC, missing values last."""
    w = Window.partitionBy(key).orderBy(F.col("rmse").asc_nulls_last(), F.col("aic").asc_nulls_last(),
                                        "model", F.col("candidate_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(w))


def best_model(lb: DataFrame, key: str = "series_id") -> DataFrame:
    """First SARIMA-family row with an RMSE per series; default order when none."""
    ok = lb.filter((F.col("model") == MODEL_BASE) & F.col("rmse").isNotNull())
    first = ok.groupBy(key).agg(F.min(F.struct("rank", "candidate_id", "p", "q", "sp", "sq", "order", "seasonal",
                                               "aic", "mae", "rmse")).alias("b"))
    allk = lb.select(key).distinct()
    p, q, P, Q = DEFAULT_ORDER
    out = allk.join(first, key, "left")
    dflt = lambda c, v: F.coalesce(F.col(f"b.{c}"), F.lit(v))
    return out.select(key, dflt("candidate_id", 0).alias("candidate_id"), dflt("p", p).alias("p"),
                      dflt("q", q).alias("q"), dflt("sp", P).alias("sp"), dflt("sq", Q).alias("sq"),
                      dflt("order", f"({p},1,{q})").alias("order"),
                      dflt("seasonal", f"({P},1,{Q},52)").alias("seasonal"),
                      F.col("b.aic").alias("aic"), F.col("b.mae").alias("mae"), F.col("b.rmse").alias("rmse"),
                      F.col("b").isNull().alias("is_default"))
