"""Star schema: dimensions, surrogate ids and foreign-key checks.

Dimensions are ``select -> dropna(key) -> distinct`` (a hash aggregate with
map-side combine). "First row per key" uses ``min(struct(order_key, ...))``
as an aggregate rather than ``row_number()`` over a key partition, so a hot
key never lands whole in one sort: each map task keeps one candidate per key.
Orphan checks are ``left_anti`` joins; the planner broadcasts the dimension
side when AQE measures it small and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.functions.calendar import jan1_offset_date, quarter_of_month, season_of_month, time_key
from hebdo.functions.cleaning import round_half_up


def distinct_dim(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    return df.select(*cols).dropna(subset=[key]).distinct()


def dim_region(visits: DataFrame) -> DataFrame:
    return distinct_dim(visits, ["region_code", "region_label"], "region_code")


def dim_commune(visits: DataFrame, with_region: bool = True) -> DataFrame:
    cols = ["commune_code", "commune_label"] + (["region_code"] if with_region else [])
    return distinct_dim(visits, cols, "commune_code")


def dim_health_service(visits: DataFrame) -> DataFrame:
    return distinct_dim(visits, ["service_code", "service_label"], "service_code")


def dim_cause(visits: DataFrame) -> DataFrame:
    return distinct_dim(visits, ["cause_code", "cause"], "cause_code")


def _year_weeks(df: DataFrame) -> DataFrame:
    return df.select(F.col("year").cast("int").alias("year"), F.col("week").cast("int").alias("week")) \
             .dropna().distinct()


def dim_time(df: DataFrame) -> DataFrame:
    """(year, week) -> time_id, month of Jan 1 + 7*max(week-1, 0), quarter, winter flag."""
    m = F.month(jan1_offset_date("year", "week", offset_weeks=-1, clip_at_zero=True))
    return (_year_weeks(df)
            .withColumn("time_id", time_key("year", "week"))
            .withColumn("month", m)
            .withColumn("quarter", quarter_of_month(F.col("month")))
            .withColumn("is_winter", F.col("month").isin(6, 7, 8).cast("int")))


def dim_time_season(df: DataFrame) -> DataFrame:
    """Variant: month of Jan 1 + 7*week (one week later), southern season name."""
    m = F.month(jan1_offset_date("year", "week", offset_weeks=0, clip_at_zero=False))
    return (_year_weeks(df)
            .withColumn("time_id", time_key("year", "week"))
            .withColumn("month", m)
            .withColumn("season", season_of_month(F.col("month"))))


ESTAB_ATTRS = ["estab_code", "estab_label", "region_code", "commune_code", "service_code"]
#: All twelve attributes of a conformed raw table.
ESTAB_ATTRS_FULL = [*ESTAB_ATTRS, "estab_type", "admin_dependency", "care_level", "emergency_type", "complexity_level",
                    "latitude", "longitude"]


def dim_establishment(visits: DataFrame, attrs=ESTAB_ATTRS) -> DataFrame:
    """Distinct full attribute rows (may hold several rows per code)."""
    return distinct_dim(visits, [c for c in attrs if c in visits.columns], "estab_code")


def first_per_key(df: DataFrame, key: str, order_col: str, cols: list[str]) -> DataFrame:
    """First row per key by ``order_col`` (file order), as an aggregate.

    ``min(struct(order, ...))`` is decomposable: partial minima are taken per
    map task, so a key holding a third of all rows costs one row per task in
    the shuffle. NULL keys form their own group (kept, like pandas).
    """
    packed = F.min(F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in cols if c != key])).alias("_m")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_m.{c}").alias(c) for c in cols if c != key])


def dim_establishment_unique(visits: DataFrame) -> DataFrame:
    return first_per_key(visits, "estab_code", "visit_id",
                         ["estab_code", "estab_label", "region_code", "commune_code"])


def surrogate_id(df: DataFrame, coarse: list[str], fine: list[str], out: str = "surrogate_id") -> DataFrame:
    """Dense 1..n id in (coarse..., fine...) order without a global sort.

    Rows are numbered inside each coarse group (distributed window), and each
    group's offset is the running count of the groups before it, computed on
    the per-group counts (one row per coarse key, e.g. one per week).
    """
    within = F.row_number().over(Window.partitionBy(*coarse).orderBy(*fine))
    counts = df.groupBy(*coarse).agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy(*coarse).rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0))).drop("_n")
    return (df.withColumn("_k", within).join(offs, coarse)
            .withColumn(out, (F.col("_off") + F.col("_k")).cast("bigint")).drop("_k", "_off"))


def dim_temperature(climate_weekly: DataFrame, dim_t: DataFrame) -> DataFrame:
    """Weekly climate limited to weeks present in the time dimension, with id."""
    c = (climate_weekly.withColumn("time_id", time_key("year", "week"))
         .join(dim_t.select("time_id"), "time_id", "left_semi"))
    c = surrogate_id(c, ["year", "week"], ["city"], "temperature_id")
    return c.select("temperature_id", "time_id", "year", "week", "city",
                    round_half_up(F.col("temperature")).alias("temperature"))


def dim_temperature_by_code(climate_weekly: DataFrame) -> DataFrame:
    """Distinct (time_id, city, temperature), no averaging, no time filter."""
    return (climate_weekly.select(time_key("year", "week").alias("time_id"), "city",
                                  round_half_up(F.col("temperature")).alias("temperature"))
            .distinct())


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension row (left anti join)."""
    dim_key = dim_key or fact_key
    d = dim.select(F.col(dim_key).alias(fact_key)).dropna().distinct()
    return fact.join(d, fact_key, "left_anti")
