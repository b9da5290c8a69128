"""§2.1 sources/sinks and §2.2 schema, cleaning and profiles as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.cleaning import (clamp_nonnegative, coerce_datetime, coerce_numeric, display_title,
                                      fill_zero_int, normalize_key_text, round_half_up as R)
from hebdo.operators import aggregates as A
from hebdo.operators import joins as J
from hebdo.operators import profile as PR
from hebdo.operators import star as ST
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import iso_monday_sql, r4, week_bin_sql, with_views
from hebdo.session import checkpoint_dir
from hebdo.sources import files as FS
from hebdo.sources.tables import cause_week_fact, first_visits, readings, table, visit_sums, visits

# raw header -> internal column of the visit analogue (messy on purpose: BOM,
# padding, mixed case, numbers as text, one unparsable count value)
_RAW_HEADERS = [
    ("﻿EstablecimientoCodigo", "estab_code"), (" EstablecimientoGlosa ", "estab_label"),
    ("RegionCodigo", "region_code"), ("RegionGlosa", "region_label"),
    ("ComunaCodigo", "commune_code"), ("ComunaGlosa", "commune_label"),
    ("ServicioSaludCodigo", "service_code"), ("ServicioSaludGlosa", "service_label"),
    ("Anio", "year"), ("SemanaEstadistica", "week"), ("OrdenCausa", "cause_code"), ("Causa", "cause"),
    ("NumTotal", "total"), ("NumMenor1Anio", "band_a"), ("Num1a4Anios", "band_n"), ("Num5a14Anios", "band_r"),
]


def raw_visits(spark, d):
    """The visit analogue as a raw text table with source-style headers."""
    v = visits(spark, d, with_cause=True)
    cols = []
    for raw, src in _RAW_HEADERS:
        c = F.col(src).cast("string")
        if src == "total":
            c = F.when((F.col("age_group") == "R") & (F.col("week") == 1), F.lit("n/d")).otherwise(c)
        cols.append(c.alias(raw))
    return v.select(*cols)


_RAW_SQL = {"raw": """
SELECT CAST(estab_code AS VARCHAR) AS establecimientocodigo, estab_label AS establecimientoglosa,
       CAST(region_code AS VARCHAR) AS regioncodigo, region_label AS regionglosa,
       CAST(commune_code AS VARCHAR) AS comunacodigo, commune_label AS comunaglosa,
       CAST(service_code AS VARCHAR) AS serviciosaludcodigo, service_label AS serviciosaludglosa,
       CAST(year AS VARCHAR) AS anio, CAST(week AS VARCHAR) AS semanaestadistica,
       CAST(cause_code AS VARCHAR) AS ordencausa, cause AS causa,
       CASE WHEN age_group = 'R' AND week = 1 THEN 'n/d' ELSE CAST(total AS VARCHAR) END AS numtotal,
       CAST(band_a AS VARCHAR) AS nummenor1anio, CAST(band_n AS VARCHAR) AS num1a4anios,
       CAST(band_r AS VARCHAR) AS num5a14anios
FROM visits"""}


_CONFORM_SQL = """
SELECT TRY_CAST(trim(establecimientocodigo) AS BIGINT) AS estab_code, establecimientoglosa AS estab_label,
       TRY_CAST(trim(regioncodigo) AS BIGINT) AS region_code, regionglosa AS region_label,
       TRY_CAST(trim(comunacodigo) AS BIGINT) AS commune_code, comunaglosa AS commune_label,
       TRY_CAST(trim(serviciosaludcodigo) AS BIGINT) AS service_code, serviciosaludglosa AS service_label,
       TRY_CAST(trim(anio) AS INTEGER) AS year, TRY_CAST(trim(semanaestadistica) AS INTEGER) AS week,
       TRY_CAST(trim(ordencausa) AS BIGINT) AS cause_code, causa AS cause,
       COALESCE(TRY_CAST(trim(numtotal) AS BIGINT), 0) AS total,
       COALESCE(TRY_CAST(trim(nummenor1anio) AS BIGINT), 0) AS band_under1,
       COALESCE(TRY_CAST(trim(num1a4anios) AS BIGINT), 0) AS band_1_4,
       COALESCE(TRY_CAST(trim(num5a14anios) AS BIGINT), 0) AS band_5_14
FROM raw"""


def _completeness_sql() -> str:
    present = {r.replace("﻿", "").strip().lower() for r, _ in _RAW_HEADERS}
    parts = []
    for src, (dst, kind) in PR.RAW_INTERNAL.items():
        if src in present:
            tgt = "DOUBLE" if kind == "count" else ("INTEGER" if kind == "int" else kind.upper())
            cf = ("0" if kind == "string" else
                  f"SUM(CASE WHEN {src} IS NOT NULL AND TRY_CAST(trim({src}) AS {tgt}) IS NULL THEN 1 ELSE 0 END)")
            parts.append(f"SELECT '{src}' AS column_name, TRUE AS present, CAST(COUNT({src}) AS BIGINT) AS non_null, "
                         f"CAST({cf} AS BIGINT) AS cast_failures FROM raw")
        else:
            parts.append(f"SELECT '{src}' AS column_name, FALSE AS present, CAST(0 AS BIGINT) AS non_null, "
                         f"CAST(0 AS BIGINT) AS cast_failures")
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ §2.2

@register("conform_table", "2.2", with_views(_CONFORM_SQL, "visits", extra=_RAW_SQL))
def q_conform_table(spark, d):
    return PR.conform_table(raw_visits(spark, d))


@register("role_completeness", "2.2", with_views(_completeness_sql(), "visits", extra=_RAW_SQL))
def q_role_completeness(spark, d):
    return PR.role_completeness(raw_visits(spark, d))


@register("dedupe_rows", "2.2", with_views("""
SELECT DISTINCT estab_code, cause, age_group, year, week, total FROM visits""", "visits"))
def q_dedupe_rows(spark, d):
    v = visit_sums(spark, d, "age_group", "year", "week", "quantity", with_cause=True)
    return PR.dedupe_rows(v.select("estab_code", "cause", "age_group", "year", "week", F.col("quantity").alias("total")))


@register("dedupe_by_key", "2.2", with_views("""
SELECT commune_code, cause, visit_id, estab_code, total FROM (
  SELECT *, row_number() OVER (PARTITION BY commune_code, cause ORDER BY visit_id, estab_code, total) AS rn
  FROM visits) t
WHERE rn = 1""", "visits"))
def q_dedupe_by_key(spark, d):
    # the first visit of each establishment, cause and total, then the first of these in the commune
    v = first_visits(spark, d).withColumn("_k", F.struct("commune_code", "cause"))
    out = ST.first_per_key(v, "_k", "visit_id", ["_k", "visit_id", "estab_code", "total"])
    return out.select(F.col("_k.commune_code").alias("commune_code"), F.col("_k.cause").alias("cause"),
                      "visit_id", "estab_code", "total")


@register("coerce_numeric", "2.2", """
SELECT p_partkey, TRY_CAST(trim(substr(p_brand, 7)) AS BIGINT) AS brand_number,
       TRY_CAST(trim(p_type) AS DOUBLE) AS type_as_number FROM part""")
def q_coerce_numeric(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", coerce_numeric(F.substring("p_brand", 7, 100), "bigint").alias("brand_number"),
                    coerce_numeric("p_type", "double").alias("type_as_number"))


@register("coerce_datetime", "2.2", """
SELECT o_orderkey, strftime(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'sin fecha'
                                          ELSE strftime(o_orderdate, '%d/%m/%Y') END, '%d/%m/%Y'),
                            '%Y-%m-%d %H:%M:%S') AS parsed_ts FROM orders""")
def q_coerce_datetime(spark, d):
    o = table(spark, d, "orders")
    txt = F.when(F.col("o_orderstatus") == "P", F.lit("sin fecha")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", F.date_format(coerce_datetime(txt), "yyyy-MM-dd HH:mm:ss").alias("parsed_ts"))


@register("drop_null_keys", "2.2", with_views(f"""
SELECT c.year, c.week, c.city, c.cases, {r4('m.temperature')} AS temperature
FROM (SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
      FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3) c
JOIN climate m ON c.year = m.year AND c.week = m.week AND c.city = m.city
WHERE m.temperature IS NOT NULL""", "visits_nc", "climate"))
def q_drop_null_keys(spark, d):
    cw = J.cases_left_climate(A.cases_by_city_week(visit_sums(spark, d, "year", "week")), A.climate_weekly_mean_exact(readings(spark, d)))
    return cw.dropna(subset=["temperature"]).withColumn("temperature", R(F.col("temperature")))


@register("fill_zero_int", "2.2", """
SELECT l_suppkey AS estab_code,
       CAST(SUM(CAST(COALESCE(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END, 0) AS BIGINT)) AS BIGINT)
         AS total
FROM lineitem GROUP BY 1""")
def q_fill_zero_int(spark, d):
    li = table(spark, d, "lineitem")
    qty = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity"))
    return li.groupBy(F.col("l_suppkey").alias("estab_code")).agg(F.sum(fill_zero_int(qty)).cast("bigint").alias("total"))


@register("clamp_nonnegative", "2.2", """
SELECT CAST(isoyear(l_shipdate) AS INTEGER) AS year, CAST(week(l_shipdate) AS INTEGER) AS week,
       CAST(SUM(greatest(COALESCE(l_quantity - 25, 0), 0)) AS BIGINT) AS clamped_total
FROM lineitem GROUP BY 1, 2""")
def q_clamp_nonnegative(spark, d):
    from hebdo.functions.calendar import iso_week, iso_year
    li = table(spark, d, "lineitem")
    return (li.groupBy(iso_year("l_shipdate").alias("year"), iso_week("l_shipdate").alias("week"))
            .agg(F.sum(clamp_nonnegative(F.col("l_quantity") - 25)).cast("bigint").alias("clamped_total")))


@register("normalize_key_text", "2.2", with_views("""
SELECT lower(trim(commune_label)) AS commune_key,
       array_to_string(list_transform(string_split(lower(trim(commune_label)), ' '),
                       lambda s: upper(s[1]) || lower(s[2:])), ' ') AS commune_display,
       CAST(SUM(total) AS BIGINT) AS total
FROM visits_nc WHERE commune_label IS NOT NULL GROUP BY 1, 2""", "visits_nc"))
def q_normalize_key_text(spark, d):
    v = visit_sums(spark, d).withColumn("commune_key", normalize_key_text("commune_label"))
    return (v.dropna(subset=["commune_key"]).groupBy("commune_key")
            .agg(F.sum("total").cast("bigint").alias("total"))
            .select("commune_key", display_title("commune_key").alias("commune_display"), "total"))


CITY = "asia"


@register("filter_by_city", "2.2", with_views(f"""
SELECT city, year, week, {r4('temperature')} AS temperature FROM climate WHERE city = '{CITY}'""", "climate"))
def q_filter_by_city(spark, d):
    c = A.climate_weekly_mean_exact(readings(spark, d)).filter(F.col("city") == CITY)
    return c.select("city", "year", "week", R(F.col("temperature")).alias("temperature"))


_CW = {"cw": """
SELECT c.year, c.week, c.city, c.cases, m.temperature
FROM (SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
      FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3) c
LEFT JOIN climate m ON c.year = m.year AND c.week = m.week AND c.city = m.city"""}


@register("null_profile", "2.2", with_views(f"""
SELECT column_name, {r4('pct * 100')} AS pct_missing FROM (
  SELECT 'year' AS column_name, AVG(CASE WHEN year IS NULL THEN 1.0 ELSE 0.0 END) AS pct FROM cw
  UNION ALL SELECT 'week', AVG(CASE WHEN week IS NULL THEN 1.0 ELSE 0.0 END) FROM cw
  UNION ALL SELECT 'city', AVG(CASE WHEN city IS NULL THEN 1.0 ELSE 0.0 END) FROM cw
  UNION ALL SELECT 'cases', AVG(CASE WHEN cases IS NULL THEN 1.0 ELSE 0.0 END) FROM cw
  UNION ALL SELECT 'temperature', AVG(CASE WHEN temperature IS NULL THEN 1.0 ELSE 0.0 END) FROM cw) t
ORDER BY pct_missing DESC, column_name LIMIT 10""", "visits_nc", "climate", extra=_CW))
def q_null_profile(spark, d):
    cw = J.cases_left_climate(A.cases_by_city_week(visit_sums(spark, d, "year", "week")), A.climate_weekly_mean_exact(readings(spark, d)))
    return PR.null_profile(cw)


_PROFILED = ["estab_code", "estab_label", "region_label", "commune_code", "age_group", "visit_ts", "year",
             "week", "total"]
_TYPES = {"estab_code": "bigint", "estab_label": "string", "region_label": "string", "commune_code": "int",
          "age_group": "string", "visit_ts": "timestamp_ntz", "year": "int", "week": "int", "total": "bigint"}


@register("column_profile", "2.2", with_views("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{_TYPES[c]}' AS data_type, CAST(COUNT({c}) AS BIGINT) AS non_null, "
    f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct FROM visits_nc" for c in _PROFILED), "visits_nc"))
def q_column_profile(spark, d):
    return PR.column_profile(visits(spark, d, with_cause=False).select(*_PROFILED))


@register("row_col_counts", "2.2", with_views("""
SELECT 'dim_region' AS table_name, COUNT(*) AS n_rows, 2 AS n_cols, COUNT(*) = 0 AS is_empty
  FROM (SELECT DISTINCT region_code, region_label FROM visits WHERE region_code IS NOT NULL) t
UNION ALL SELECT 'dim_commune', COUNT(*), 3, COUNT(*) = 0
  FROM (SELECT DISTINCT commune_code, commune_label, region_code FROM visits WHERE commune_code IS NOT NULL) t
UNION ALL SELECT 'dim_cause', COUNT(*), 2, COUNT(*) = 0
  FROM (SELECT DISTINCT cause_code, cause FROM visits WHERE cause_code IS NOT NULL) t
UNION ALL SELECT 'dim_establishment', COUNT(*), 5, COUNT(*) = 0
  FROM (SELECT DISTINCT estab_code, estab_label, region_code, commune_code, service_code FROM visits
        WHERE estab_code IS NOT NULL) t
UNION ALL SELECT 'fact_week_estab_cause', COUNT(*), 7, COUNT(*) = 0 FROM fact_wec""", "visits", "fact_wec"))
def q_row_col_counts(spark, d):
    # dimensions and fact all follow from the weekly sums: one pass over the lines
    checkpoint_dir(spark)
    v = visit_sums(spark, d, "year", "week", with_cause=True).checkpoint()
    return PR.row_col_counts({"dim_region": ST.dim_region(v), "dim_commune": ST.dim_commune(v),
                              "dim_cause": ST.dim_cause(v), "dim_establishment": ST.dim_establishment(v),
                              "fact_week_estab_cause": A.fact_week_estab_cause(v)})


# ------------------------------------------------------------------ §2.1 sources and sinks

@register("head_preview", "2.1", with_views("""
SELECT * FROM fact_wec ORDER BY time_id, estab_code, cause_code LIMIT 10""", "fact_wec"))
def q_head_preview(spark, d):
    return FS.head_preview(cause_week_fact(spark, d),
                           ["time_id", "estab_code", "cause_code"], 10)


_CITY_WEEK_SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("week", T.IntegerType()),
                                  T.StructField("city", T.StringType()), T.StructField("cases", T.LongType())])


@register("read_delimited", "2.1", with_views("""
SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3""",
                                              "visits_nc"))
def q_read_delimited(spark, d):
    """Round trip: the weekly city table written as ';' text with header, read back typed."""
    path = FS.scratch_path(spark, "cases_city_week_csv")
    FS.write_table(A.cases_by_city_week(visit_sums(spark, d, "year", "week")), path, fmt="csv", sep=";")
    return FS.read_delimited(spark, path, _CITY_WEEK_SCHEMA, sep=";")


@register("write_table", "2.1", with_views("SELECT * FROM fact_wec", "fact_wec"))
def q_write_table(spark, d):
    """Fact table written as parquet (overwrite) and read back."""
    path = FS.scratch_path(spark, "fact_week_estab_cause")
    FS.write_table(cause_week_fact(spark, d), path)
    return spark.read.parquet(path)


_CITY_LINES = {"cw": """
SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3""",
               "widths": """
SELECT s.rank, s.sep, len(string_split(concat_ws(';', year, week, city, cases), s.sep)) AS n_fields, COUNT(*) AS n_lines
FROM cw, (VALUES (0, ','), (1, ';'), (2, chr(9)), (3, '|')) AS s(rank, sep) GROUP BY 1, 2, 3"""}


def _city_lines(spark, d) -> str:
    """The weekly city table as ';' text without header lines, so counts do not depend on the number of files."""
    path = FS.scratch_path(spark, "delim_probe")
    return FS.write_table(A.cases_by_city_week(visit_sums(spark, d, "year", "week")), path, fmt="csv", sep=";", header=False)


@register("delimiter_profile", "2.1", with_views("SELECT * FROM widths", "visits_nc", extra=_CITY_LINES))
def q_delimiter_profile(spark, d):
    """Fields-per-line distribution for each candidate separator over a written ';' file."""
    return FS.delimiter_profile(spark, _city_lines(spark, d))


@register("detect_delimiter", "2.1", with_views("""
SELECT sep, n_fields AS modal_fields FROM (
  SELECT *, row_number() OVER (PARTITION BY sep ORDER BY n_lines DESC, n_fields DESC) AS k FROM widths) t
WHERE k = 1 AND n_fields > 1 ORDER BY n_fields DESC, rank LIMIT 1""", "visits_nc", extra=_CITY_LINES))
def q_detect_delimiter(spark, d):
    return FS.detect_delimiter(FS.delimiter_profile(spark, _city_lines(spark, d)))


@register("bad_line_quarantine", "2.1", with_views("""
SELECT CAST(NULL AS VARCHAR) AS raw_line, year, week, CASE WHEN week < 53 THEN city END AS city,
       CASE WHEN week < 53 THEN cases END AS cases FROM cw WHERE week > 1
UNION ALL
SELECT concat_ws(';', year, week, city, cases, 'x'), NULL, NULL, NULL, NULL FROM cw WHERE week = 1""",
                                                   "visits_nc", extra={"cw": _CITY_LINES["cw"]}))
def q_bad_line_quarantine(spark, d):
    """Lines of week 53 lack two fields and come back padded; lines of week 1 have one too many
    and come back quarantined; the rest comes back typed."""
    cw = A.cases_by_city_week(visit_sums(spark, d, "year", "week"))
    whole = ("year", "week", "city", "cases")
    line = (F.when(F.col("week") == 53, F.concat_ws(";", "year", "week"))
            .when(F.col("week") == 1, F.concat_ws(";", *whole, F.lit("x"))).otherwise(F.concat_ws(";", *whole)))
    path = FS.scratch_path(spark, "with_bad_lines")
    cw.select(line.alias("value")).write.text(path)
    good, bad = FS.bad_line_quarantine(spark, path, _CITY_WEEK_SCHEMA, sep=";", header=False)
    return good.unionByName(bad, allowMissingColumns=True).select("raw_line", *whole)


@register("file_line_counts", "2.1", with_views("""
SELECT 'dim_region' AS table_name, COUNT(*) + 1 AS n_lines
  FROM (SELECT DISTINCT region_code, region_label FROM visits WHERE region_code IS NOT NULL) t
UNION ALL SELECT 'dim_commune', COUNT(*) + 1
  FROM (SELECT DISTINCT commune_code, commune_label, region_code FROM visits WHERE commune_code IS NOT NULL) t
UNION ALL SELECT 'dim_cause', COUNT(*) + 1
  FROM (SELECT DISTINCT cause_code, cause FROM visits WHERE cause_code IS NOT NULL) t""", "visits"))
def q_file_line_counts(spark, d):
    """Lines (header included) of the CSV file of three dimension tables, one file each (short vocabularies)."""
    checkpoint_dir(spark)
    v = visit_sums(spark, d, with_cause=True).checkpoint()
    folder = FS.scratch_path(spark, "dims_csv")
    for name, t in {"dim_region": ST.dim_region(v), "dim_commune": ST.dim_commune(v),
                    "dim_cause": ST.dim_cause(v)}.items():
        FS.write_table(t.repartition(1), f"{folder}/{name}", fmt="csv")
    return FS.file_line_counts(spark, folder, "*/*.csv").select(
        F.regexp_extract("file_path", r"/(dim_[a-z]+)/", 1).alias("table_name"), "n_lines")


# ------------------------------------------------------------------ streaming refresh

@register("weekly_refresh_stream", "2.7", with_views(f"""
SELECT lower(trim(region_label)) AS series_id, {week_bin_sql(iso_monday_sql('year', 'week'))} AS week_date,
       CAST(SUM(total) AS BIGINT) AS cases
FROM visits_nc WHERE visit_ts IS NOT NULL GROUP BY 1, 2""", "visits_nc"))
def q_weekly_refresh_stream(spark, d):
    """Incremental refresh: the line-item files consumed as a stream (available-now
    trigger), per-batch weekly partial sums written idempotently, then combined."""
    from hebdo.streaming.refresh import read_weekly, start_weekly_refresh
    base = FS.scratch_path(spark, "weekly_refresh")
    q = start_weekly_refresh(spark, d, f"{d.rstrip('/')}/lineitem*.parquet", f"{base}/weekly", f"{base}/_checkpoint")
    q.awaitTermination()
    return read_weekly(spark, f"{base}/weekly")
