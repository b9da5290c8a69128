"""Base tables and the two analogue views the analyses run on.

The domain inputs (raw emergency-visit rows, temperature readings) are
stood in for by views over the driver's TPC-H-like tables:

* ``visits``   = lineitem joined to supplier (establishment) -> nation
  (commune) -> region, and to part (cause). One row per line item.
* ``readings`` = orders joined to customer -> nation -> region; the region
  name plays the city and the order price the temperature.

Join strategy: nation (25 rows) and region (5 rows) are fixed-size by the
TPC-H spec and always broadcast. supplier, customer and part grow with the
scale factor: they are broadcast only after a row-count check against
``hebdo.broadcast.maxRows`` (see ``sizing``), and otherwise joined by
shuffling both sides on the key. The fact side (lineitem, orders) is never
broadcast. The small dimension chain (supplier -> nation -> region) is
resolved first, so lineitem meets a single pre-joined geography table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hebdo.functions.calendar import iso_week, iso_year, time_key
from hebdo.sources import sizing


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Base table reader, memoised per session and path.

    Resolving a parquet relation lists files and reads footers; the resolved
    DataFrame is immutable and reused by every query of the session (like a
    catalog table). ``forget_tables()`` drops the memo after files change.
    """
    key = (spark.sparkContext.applicationId, path_of(sf_dir, name))
    if key not in _TABLES or _TABLES[key].sparkSession is not spark:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


def forget_tables() -> None:
    _TABLES.clear()
    sizing.forget_sizes()


def geography(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """nation -> region chain keyed by nation key (25 rows by spec: broadcast)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias(key),
                    F.col("r_regionkey").alias("region_code"),
                    F.col("r_name").alias("region_label"),
                    F.col("n_nationkey").alias("commune_code"),
                    F.col("n_name").alias("commune_label")))


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier with its geography: the establishment attribute table."""
    s = table(spark, sf_dir, "supplier")
    geo = F.broadcast(geography(spark, sf_dir, "s_nationkey"))
    return (s.join(geo, "s_nationkey")
            .select(F.col("s_suppkey").alias("estab_code"),
                    F.col("s_name").alias("estab_label"),
                    "region_code", "region_label", "commune_code", "commune_label",
                    (F.col("commune_code") % 3).alias("service_code"),
                    F.concat(F.lit("HS_"), (F.col("commune_code") % 3).cast("string")).alias("service_label")))


def estab_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(estab_code, estab_label) from the supplier table itself: no line is read for a label."""
    n = sizing.table_rows(spark, path_of(sf_dir, "supplier"))
    return sizing.dimension(establishments(spark, sf_dir).select("estab_code", "estab_label"), n)


def cause_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cause, cause_code): dense rank of the cause name.

    The window runs over the *distinct* cause vocabulary (a few dozen to a
    few hundred names), never over data rows.
    """
    part = table(spark, sf_dir, "part")
    return (part.select(F.col("p_type").alias("cause")).distinct()
            .withColumn("cause_code", F.dense_rank().over(Window.orderBy("cause")).cast("bigint")))


def causes_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, cause, cause_code); at most one row per part.

    The cause list is joined on its own (checked) count, a few hundred names
    whatever the number of parts, so ``part`` is not shuffled on the cause.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("cause"))
    codes = cause_codes(spark, sf_dir)
    return part.join(sizing.dimension(codes, sizing.distinct_rows(codes, f"{path_of(sf_dir, 'part')}#cause")), "cause")


def visits(spark: SparkSession, sf_dir: str, with_cause: bool = True) -> DataFrame:
    """The visit-level analogue table (internal schema).

    ``with_cause=False`` leaves out the part dimension, whose only use is the
    cause attribute; queries that do not group or filter by cause skip that
    join entirely.
    """
    l = table(spark, sf_dir, "lineitem")
    n_supp = sizing.table_rows(spark, path_of(sf_dir, "supplier"))
    est = sizing.dimension(establishments(spark, sf_dir), n_supp)
    qty = F.col("l_quantity").cast("bigint")
    zero = F.lit(0).cast("bigint")
    flag = F.col("l_returnflag")
    v = l.join(est, l.l_suppkey == F.col("estab_code")).select(
        "*",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("visit_id"),
        flag.alias("age_group"), F.col("l_shipdate").alias("visit_ts"),
        iso_year("l_shipdate").alias("year"), iso_week("l_shipdate").alias("week"), qty.alias("total"),
        F.when(flag == "A", qty).otherwise(zero).alias("band_a"),
        F.when(flag == "N", qty).otherwise(zero).alias("band_n"),
        F.when(flag == "R", qty).otherwise(zero).alias("band_r"))
    cols = ["visit_id", "estab_code", "estab_label", "region_code", "region_label",
            "commune_code", "commune_label", "service_code", "service_label",
            "age_group", "visit_ts", "year", "week", "total", "band_a", "band_n", "band_r"]
    if with_cause:
        n_part = sizing.table_rows(spark, path_of(sf_dir, "part"))
        part = sizing.dimension(causes_by_part(spark, sf_dir), n_part)
        v = v.join(part, v.l_partkey == part.p_partkey)
        cols = cols[:9] + ["cause", "cause_code"] + cols[9:]
    return v.select(*cols, time_key("year", "week").alias("time_id"))


#: Columns that a line item has by itself; all others of ``visits`` come from the establishment or the cause.
_LINE = {"visit_ts": lambda: F.col("l_shipdate"), "age_group": lambda: F.col("l_returnflag"),
         "year": lambda: iso_year("l_shipdate"), "week": lambda: iso_week("l_shipdate"),
         "quantity": lambda: F.col("l_quantity").cast("bigint")}


def visit_sums(spark: SparkSession, sf_dir: str, *by: str, with_cause: bool = False) -> DataFrame:
    """``visits`` summed per (establishment, ``by``..., cause) *before* the establishment is joined.

    ``by`` names columns of the line item itself (visit_ts, age_group, year, week, quantity). Each row stands for all
    its visits, with their metrics summed and the least ``visit_id``, so sums, distinct values and
    first rows over it equal those over ``visits``. Past the broadcast bound the join with the
    establishments shuffles these sums, not line items. The cause needs the line's part: there each line meets its part
    once (by shuffle past the bound), and is summed right after.
    """
    line = table(spark, sf_dir, "lineitem")
    qty, flag = F.col("l_quantity").cast("bigint"), F.col("l_returnflag")
    keys = [F.col("l_suppkey").alias("estab_code"), *[_LINE[c]().alias(c) for c in by]]
    if with_cause:
        parts = sizing.dimension(causes_by_part(spark, sf_dir), sizing.table_rows(spark, path_of(sf_dir, "part")))
        line = line.join(parts, line.l_partkey == parts.p_partkey)
        keys += [F.col("cause"), F.col("cause_code")]
    band = lambda f: F.sum(F.when(flag == f, qty).otherwise(F.lit(0).cast("bigint"))).alias(f"band_{f.lower()}")
    sums = line.filter(F.col("l_suppkey").isNotNull()).groupBy(*keys).agg(
        F.sum(qty).alias("total"), band("A"), band("N"), band("R"),
        F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("visit_id"))
    n_supp = sizing.table_rows(spark, path_of(sf_dir, "supplier"))
    out = sums.join(sizing.dimension(establishments(spark, sf_dir), n_supp), "estab_code")
    return out.withColumn("time_id", time_key("year", "week")) if {"year", "week"} <= set(by) else out


def cause_week_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_week_estab_cause`` over ``visits``: the weekly sums are its rows already, so they are not grouped again."""
    v = visit_sums(spark, sf_dir, "year", "week", with_cause=True).dropna(subset=["year", "week", "estab_code", "cause_code"])
    long = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "band_a", "band_n", "band_r")]
    return v.select("time_id", "estab_code", "cause_code", *long)


def first_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visit of the least id of each (establishment, cause), with the establishment joined to these rows only."""
    line = table(spark, sf_dir, "lineitem").filter(F.col("l_suppkey").isNotNull())
    parts = sizing.dimension(causes_by_part(spark, sf_dir), sizing.table_rows(spark, path_of(sf_dir, "part")))
    one = F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("visit_id"), F.col("l_quantity").cast("bigint").alias("total"))
    first = (line.join(parts, line.l_partkey == parts.p_partkey).groupBy(F.col("l_suppkey").alias("estab_code"), "cause", "cause_code")
             .agg(F.min(one).alias("v")).select("estab_code", "cause", "cause_code", "v.*"))
    n_supp = sizing.table_rows(spark, path_of(sf_dir, "supplier"))
    return first.join(sizing.dimension(establishments(spark, sf_dir), n_supp), "estab_code")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature-reading analogue: (reading_ts, city, temperature)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = F.broadcast(geography(spark, sf_dir, "c_nationkey").select("c_nationkey", "region_label"))
    cg = c.join(geo, "c_nationkey")
    n_cust = sizing.table_rows(spark, path_of(sf_dir, "customer"))
    cg = sizing.dimension(cg, n_cust)
    return (o.join(cg, o.o_custkey == cg.c_custkey)
            .select(F.col("o_orderdate").alias("reading_ts"),
                    F.col("region_label").alias("city"),
                    F.col("o_totalprice").alias("temperature")))


def establishment_week_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_week_estab`` over ``visits``, aggregated *before* the dimension join.

    Line items are summed per (establishment key, ISO year, ISO week) first
    (partial aggregation on the map side, then one shuffle of partial sums);
    only then is the establishment dimension consulted, as a semi join that
    keeps the inner-join semantics of ``visits``. When the dimension is too
    large to broadcast, the shuffle for that join moves one row per
    (establishment, week) instead of every raw line.
    """
    l = table(spark, sf_dir, "lineitem")
    year, week = iso_year("l_shipdate"), iso_week("l_shipdate")
    agg = (l.filter(F.col("l_suppkey").isNotNull() & F.col("l_shipdate").isNotNull())
           .groupBy(F.col("l_suppkey").alias("estab_code"), year.alias("year"), week.alias("week"))
           .agg(F.coalesce(F.sum(F.col("l_quantity").cast("bigint")), F.lit(0)).cast("bigint").alias("total")))
    n_supp = sizing.table_rows(spark, path_of(sf_dir, "supplier"))
    keys = sizing.dimension(establishments(spark, sf_dir).select("estab_code"), n_supp)
    return (agg.join(keys, "estab_code", "left_semi")
            .select("year", "week", "estab_code", "total", time_key("year", "week").alias("time_id")))
