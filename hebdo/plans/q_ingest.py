"""§2.1-2.4 from raw files and raw headers to dimensions and facts, as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.functions.cleaning import round_half_up as R
from hebdo.operators import aggregates as A
from hebdo.operators import profile as PR
from hebdo.operators import reports as RP
from hebdo.operators import series as S
from hebdo.operators import star as ST
from hebdo.operators import stats as M
from hebdo.plans.registry import register
from hebdo.plans.sqlviews import r4, with_views
from hebdo.sources import files as FS
from hebdo.sources import ingest as IN
from hebdo.sources.tables import readings, visit_sums, visits

_CW = {"cw": """
SELECT year, week, lower(trim(region_label)) AS city, CAST(SUM(total) AS BIGINT) AS cases
FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL GROUP BY 1, 2, 3"""}
_CITY_WEEK = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("week", T.IntegerType()),
                           T.StructField("city", T.StringType()), T.StructField("cases", T.LongType())])


# ------------------------------------------------------------------ §2.1 files of unknown layout

def _city_files(spark, d) -> str:
    """The weekly city table as one text file a city, each with its own separator and lines before the header.

    A city's name of n letters gives n mod 4 preamble lines and the separator n mod 3 of ``, ; tab``.
    """
    cw = A.cases_by_city_week(visit_sums(spark, d, "year", "week"))
    n = F.length("city")
    sep = F.element_at(F.array(F.lit(","), F.lit(";"), F.lit("\t")), n % 3 + 1)
    line = lambda *cols: F.array_join(F.array(*[c.cast("string") for c in cols]), "\x01")
    data = cw.select("city", (F.col("year") * 100 + F.col("week")).alias("ord"),
                     line(*[F.col(c) for c in ("year", "week", "city", "cases")]).alias("value"))
    city = cw.select("city").distinct()
    front = city.select("city", F.explode(F.sequence(F.lit(-4), F.lit(-1))).alias("ord")).filter(-F.col("ord") <= n % 4 + 1)
    text = F.when(F.col("ord") == -1, line(*[F.lit(c) for c in ("year", "week", "city", "cases")])).otherwise(
        F.concat(F.lit("weekly cases of "), F.col("city")))
    front = front.select("city", "ord", text.alias("value"))
    path = FS.scratch_path(spark, "city_files")
    # one task a city: a city has one line a week
    (data.unionByName(front).withColumn("value", F.replace("value", F.lit("\x01"), sep))
     .repartition("city").sortWithinPartitions("city", "ord").select("city", "value").write.partitionBy("city").text(path))
    return path


def _city_of(file):
    return F.replace(F.regexp_extract(file, r"city=([^/]+)/", 1), F.lit("%20"), F.lit(" "))


@register("header_layout", "2.1", with_views("""
SELECT city, CASE length(city) % 3 WHEN 0 THEN ',' WHEN 1 THEN ';' ELSE chr(9) END AS sep,
       CAST(length(city) % 4 AS INTEGER) AS header_offset, 4 AS modal_fields, COUNT(*) AS modal_lines
FROM cw GROUP BY 1, 2, 3""", "visits_nc", extra=_CW))
def q_header_layout(spark, d):
    """Separator and header offset of each file, detected together."""
    found = IN.detect_layout(IN.header_layouts(IN.land_lines(spark, _city_files(spark, d))))
    return found.select(_city_of(F.col("file")).alias("city"), "sep", "header_offset", "modal_fields", "modal_lines")


@register("read_with_preamble", "2.1", with_views("SELECT year, week, city, cases FROM cw", "visits_nc", extra=_CW))
def q_read_with_preamble(spark, d):
    """All the city files read back typed, each by its own detected layout."""
    lines = IN.land_lines(spark, _city_files(spark, d))
    layout = IN.detect_layout(IN.header_layouts(lines))
    return IN.read_landed(lines, _CITY_WEEK, layout=layout)[0]


_NOTE_SQL = """'week ' || week || ';' || chr(10) || '"' || city || '", total' || chr(10) || chr(10)
  || repeat(city || ';"', CAST(CASE WHEN week = 10 THEN 20000 ELSE cases % 7 END AS INTEGER))"""


@register("quoted_records", "2.1", with_views(f"""
SELECT year, week, length({_NOTE_SQL}) AS note_chars, md5({_NOTE_SQL}) AS note_md5, cases, CAST(NULL AS VARCHAR) AS reason
FROM cw WHERE week > 1
UNION ALL
SELECT NULL, NULL, length({_NOTE_SQL}), md5({_NOTE_SQL}), NULL, 'too many fields' FROM cw WHERE week = 1""",
                                              "visits_nc", extra=_CW))
def q_quoted_records(spark, d):
    """Quoted values with separators, doubled quotes and line ends, some of 200,000 characters, read back typed.

    Records of week 1 have a field too many and are quarantined; their note is taken from the raw record.
    """
    cw = A.cases_by_city_week(visit_sums(spark, d, "year", "week"))
    note = F.concat(F.lit("week "), F.col("week").cast("string"), F.lit(';\n"'), F.col("city"), F.lit('", total\n\n'),
                    F.expr("repeat(concat(city, ';\"'), CAST(if(week = 10, 20000, cases % 7) AS INT))"))
    quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(";", "year", "week", quoted, "cases", F.when(F.col("week") == 1, "x"))
    path = FS.scratch_path(spark, "quoted_records")
    cw.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("week", T.IntegerType()),
                           T.StructField("note", T.StringType()), T.StructField("cases", T.LongType())])
    good, bad = IN.read_landed(IN.land_lines(spark, path), schema, sep=";")
    inner = F.regexp_extract("raw_line", r'(?s)^[^"]*"(.*)"[^"]*$', 1)
    back = bad.select(F.replace(inner, F.lit('""'), F.lit('"')).alias("note"), "reason")
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(back, allowMissingColumns=True)
    return both.select("year", "week", F.length("note").cast("bigint").alias("note_chars"), F.md5("note").alias("note_md5"), "cases", "reason")


# ------------------------------------------------------------------ §2.2-2.4 raw headers to facts

#: (raw header, SQL of its text over the visit analogue) of a raw table whose headers are none of the known names.
_FOREIGN = [
    ("﻿Cód. Establecimiento", "CAST(estab_code AS {t})"), (" Nombre Establecimiento ", "estab_label"),
    ("ID Región", "CAST(region_code AS {t})"), ("Región", "region_label"),
    ("Codigo Comuna", "CAST(commune_code AS {t})"), ("COMUNA", "commune_label"),
    ("Servicio (cod)", "CAST(service_code AS {t})"), ("Servicio Salud", "service_label"),
    ("Tipo de Establecimiento", "concat('T', CAST(estab_code % 4 AS {t}))"),
    ("Dependencia", "concat('D', CAST(estab_code % 3 AS {t}))"), ("Nivel de Atención", "concat('N', CAST(estab_code % 5 AS {t}))"),
    ("Tipo Urgencia", "concat('U', CAST(estab_code % 2 AS {t}))"), ("Complejidad", "concat('C', CAST(estab_code % 6 AS {t}))"),
    ("Lat", "concat('-', CAST(estab_code % 56 AS {t}), '.5')"), ("Lon", "concat('-', CAST(66 + estab_code % 9 AS {t}), '.25')"),
    ("Año", "CAST(year AS {t})"), ("Semana", "CAST(week AS {t})"),
    ("Orden Causa", "CASE WHEN visit_id % 97 = 0 THEN 's/c' ELSE CAST(cause_code AS {t}) END"), ("Diagnostico", "cause"),
    ("Casos", "CASE WHEN age_group = 'R' AND week = 1 THEN 'n/d' ELSE CAST(total AS {t}) END"),
    ("Menores de 1 año", "CAST(total {div} 10 AS {t})"), ("1 a 4 años", "CAST(total {div} 8 AS {t})"),
    ("5 a 14 años", "CAST(total {div} 6 AS {t})"), ("15 a 64 años", "CAST(total {div} 4 AS {t})"),
    ("65 y más", "CASE WHEN visit_id % 89 = 0 THEN NULL ELSE CAST(total % 4 AS {t}) END"),
]


def foreign_raw(spark, d):
    """The visit analogue as a raw text table of 25 columns under headers that have to be resolved."""
    v = visits(spark, d, with_cause=True)
    return v.select(*[F.expr(sql.format(t="STRING", div="div")).alias(raw) for raw, sql in _FOREIGN])


_F = {raw: sql.format(t="VARCHAR", div="//") for raw, sql in _FOREIGN}
_EXPECTED = {  # by hand: the header that each required column resolves to, and how
    "establecimientocodigo": ("﻿Cód. Establecimiento", "pattern"), "establecimientoglosa": (" Nombre Establecimiento ", "pattern"),
    "regioncodigo": ("ID Región", "pattern"), "regionglosa": ("Región", "pattern"), "comunacodigo": ("Codigo Comuna", "pattern"),
    "comunaglosa": ("COMUNA", "alias"), "serviciosaludcodigo": ("Servicio (cod)", "pattern"),
    "serviciosaludglosa": ("Servicio Salud", "pattern"), "tipoestablecimiento": ("Tipo de Establecimiento", "pattern"),
    "dependenciaadministrativa": ("Dependencia", "pattern"), "nivelatencion": ("Nivel de Atención", "pattern"),
    "tipourgencia": ("Tipo Urgencia", "pattern"), "nivelcomplejidad": ("Complejidad", "pattern"), "latitud": ("Lat", "pattern"),
    "longitud": ("Lon", "pattern"), "anio": ("Año", "alias"), "semanaestadistica": ("Semana", "alias"),
    "ordencausa": ("Orden Causa", "pattern"), "causa": ("Diagnostico", "alias"), "numtotal": ("Casos", "alias"),
    "nummenor1anio": ("Menores de 1 año", "pattern"), "num1a4anios": ("1 a 4 años", "pattern"), "num5a14anios": ("5 a 14 años", "pattern"),
    "num15a64anios": ("15 a 64 años", "pattern"), "num65omas": ("65 y más", "pattern"),
}
_FAILS = {"ordencausa": "SUM(CASE WHEN visit_id % 97 = 0 THEN 1 ELSE 0 END)",
          "numtotal": "SUM(CASE WHEN age_group = 'R' AND week = 1 THEN 1 ELSE 0 END)"}


@register("role_resolution", "2.2", with_views("\nUNION ALL\n".join(
    f"SELECT '{src}' AS column_name, '{raw}' AS raw_header, '{how}' AS found_by, TRUE AS present, "
    f"CAST(COUNT({_F[raw]}) AS BIGINT) AS non_null, CAST({_FAILS.get(src, '0')} AS BIGINT) AS cast_failures FROM visits"
    for src, (raw, how) in _EXPECTED.items()), "visits"))
def q_role_resolution(spark, d):
    """Which raw header fills each required column, how it was found, and how well it casts."""
    return PR.role_completeness(foreign_raw(spark, d), resolved=True)


_CONFORMED = {"conformed": f"""
SELECT estab_code, estab_label, region_code, commune_code, service_code, concat('T', estab_code % 4) AS estab_type,
       concat('D', estab_code % 3) AS admin_dependency, concat('N', estab_code % 5) AS care_level,
       concat('U', estab_code % 2) AS emergency_type, concat('C', estab_code % 6) AS complexity_level,
       -(estab_code % 56) - 0.5::DOUBLE AS latitude, -66 - (estab_code % 9) - 0.25::DOUBLE AS longitude,
       year, week, CASE WHEN visit_id % 97 <> 0 THEN cause_code END AS cause_code, cause,
       CASE WHEN age_group = 'R' AND week = 1 THEN 0 ELSE total END AS total, total // 10 AS band_under1, total // 8 AS band_1_4,
       total // 6 AS band_5_14, total // 4 AS band_15_64, CASE WHEN visit_id % 89 = 0 THEN 0 ELSE total % 4 END AS band_65_plus
FROM visits"""}


@register("fact_from_raw", "2.3", with_views("""
SELECT CAST(year AS BIGINT) * 100 + week AS time_id, estab_code, cause_code, CAST(SUM(total) AS BIGINT) AS total,
       CAST(SUM(band_under1) AS BIGINT) AS band_under1, CAST(SUM(band_1_4) AS BIGINT) AS band_1_4,
       CAST(SUM(band_5_14) AS BIGINT) AS band_5_14, CAST(SUM(band_15_64) AS BIGINT) AS band_15_64,
       CAST(SUM(band_65_plus) AS BIGINT) AS band_65_plus
FROM conformed WHERE cause_code IS NOT NULL GROUP BY 1, 2, 3""", "visits", extra=_CONFORMED))
def q_fact_from_raw(spark, d):
    """Raw table with foreign headers to the fact with all six metrics, in one plan over one scan."""
    return A.fact_week_estab_cause(PR.conform_table(foreign_raw(spark, d), required=PR.REQUIRED), A.RAW_METRICS)


@register("dim_establishment_full", "2.4", with_views(f"""
SELECT DISTINCT estab_code, estab_label, region_code, commune_code, service_code, estab_type, admin_dependency, care_level,
       emergency_type, complexity_level, latitude, longitude
FROM conformed""", "visits", extra=_CONFORMED))
def q_dim_establishment_full(spark, d):
    """All twelve attributes of an establishment, from the conformed raw table."""
    raw = PR.conform_table(foreign_raw(spark, d), required=PR.REQUIRED)
    return ST.dim_establishment(raw, ST.ESTAB_ATTRS_FULL)


@register("filter_by_city_checked", "2.2", with_views(f"""
SELECT city, year, week, {r4('temperature')} AS temperature, CAST(NULL AS VARCHAR) AS "check" FROM climate WHERE city IN ('asia', 'europe')
UNION ALL SELECT 'atlantis', NULL, NULL, NULL, 'no rows'""", "climate"))
def q_filter_by_city_checked(spark, d):
    """Two cities of the climate table and one that it does not have, which gives a check row."""
    c = A.climate_weekly_mean_exact(readings(spark, d)).select("city", "year", "week", "temperature")
    out = PR.filter_by_city(c, ["asia", "europe", "atlantis"])
    return out.withColumn("temperature", R(F.col("temperature")))


@register("week_53_short_years", "2.6", """
WITH w AS (SELECT CAST(isoyear(l_shipdate) AS INTEGER) + 1 AS year, CAST(week(l_shipdate) AS INTEGER) AS week FROM lineitem)
SELECT year, COUNT(*) AS n_rows, CAST(MAX(CASE WHEN extract('week' FROM make_date(year, 12, 28)) = 53 THEN 0 ELSE 1 END) AS BOOLEAN)
         AS is_short_year
FROM w WHERE week = 53 AND year IS NOT NULL GROUP BY 1""")
def q_week_53_short_years(spark, d):
    """Rows of a week 53 by the year they are filed under, and whether that year has no such week.

    The analogue files each row one year late, as a table with calendar years under ISO weeks does.
    """
    from hebdo.functions.calendar import iso_week, iso_year
    from hebdo.sources.tables import table
    rows = table(spark, d, "lineitem").select((iso_year("l_shipdate") + 1).alias("year"), iso_week("l_shipdate").alias("week"))
    return S.week_53_rows(rows)


# ------------------------------------------------------------------ §2.8 metric tables in either layout

_NAIVE = {"nv": """
SELECT series_id, y, yhat, drift FROM (
  SELECT *, rdesc <= CASE WHEN n > 104 THEN 52 ELSE least(greatest(6, n // 4), n - 1) END AS is_test FROM (
    SELECT series_id, cases AS y, lag(cases, 52) OVER w AS yhat, lag(cases, 1) OVER w AS drift, COUNT(*) OVER (PARTITION BY series_id) AS n,
           row_number() OVER (PARTITION BY series_id ORDER BY week_date DESC) AS rdesc
    FROM case_series WINDOW w AS (PARTITION BY series_id ORDER BY week_date)) a) b WHERE is_test""",
          "pair": """
SELECT series_id, CASE WHEN COUNT(*) = COUNT(yhat) THEN AVG(abs(y - yhat)) END AS bm,
       CASE WHEN COUNT(*) = COUNT(yhat) THEN sqrt(AVG((y - yhat) * (y - yhat))) END AS br,
       CASE WHEN COUNT(*) = COUNT(drift) THEN AVG(abs(y - drift)) END AS cm,
       CASE WHEN COUNT(*) = COUNT(drift) THEN sqrt(AVG((y - drift) * (y - drift))) END AS cr
FROM nv GROUP BY 1"""}


def _naive_metrics(spark, d):
    """A metrics table as the models write it, from two naive forecasts: a year before (base) and a week before (climate)."""
    s = S.region_case_series(spark, d)
    base = M.holdout_metrics(M.seasonal_naive(s)).select("series_id", F.lit(" sarimax").alias("Modelo"), F.col("mae").alias("MAE"),
                                                         F.col("rmse").alias("RMSE"))
    clim = M.holdout_metrics(M.seasonal_naive(s, season=1)).select("series_id", F.lit("SARIMAX + CLIMA").alias("Modelo"),
                                                                   F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"))
    return base.unionByName(clim)


def _pairs(spark, d):
    """The base rows of the same table in the older form of one metric a row."""
    m = _naive_metrics(spark, d).filter("trim(Modelo) = 'sarimax'")
    return m.select("series_id", F.explode(F.array(*[F.struct(F.lit(k).alias("Unnamed: 0"), F.col(k).cast("string").alias("0"))
                                                     for k in ("MAE", "RMSE")])).alias("r")).select("series_id", "r.*")


@register("metrics_pair_naive", "2.8", with_views(f"""
SELECT series_id, {r4('bm')} AS base_mae, {r4('br')} AS base_rmse, {r4('cm')} AS clima_mae, {r4('cr')} AS clima_rmse FROM pair""",
                                                  "case_series", extra=_NAIVE))
def q_metrics_pair_naive(spark, d):
    return RP.load_metrics_pair(_naive_metrics(spark, d))


@register("metrics_pair_key_value", "2.8", with_views(f"""
SELECT series_id, {r4('bm')} AS base_mae, {r4('br')} AS base_rmse, CAST(NULL AS DOUBLE) AS clima_mae, CAST(NULL AS DOUBLE) AS clima_rmse
FROM pair""", "case_series", extra=_NAIVE))
def q_metrics_pair_key_value(spark, d):
    return RP.load_metrics_pair(_pairs(spark, d))


def _report_sql(mae, rmse, model):
    text = lambda c: f"CASE WHEN {c} IS NULL THEN 'N/D' ELSE printf('%.2f', {r4(r4(c), 2)}) END" if c else "'N/D'"
    return f"SELECT series_id, '{model}' AS model, {text(mae)} AS mae, {text(rmse)} AS rmse FROM pair"


@register("model_report_naive", "2.8", with_views(
    f"{_report_sql('bm', 'br', 'SARIMAX')}\nUNION ALL {_report_sql('cm', 'cr', 'SARIMAX+Clima')}", "case_series", extra=_NAIVE))
def q_model_report_naive(spark, d):
    return RP.model_report_metrics(RP.load_metrics_pair(_naive_metrics(spark, d)))


@register("model_report_key_value", "2.8", with_views(
    f"{_report_sql('bm', 'br', 'SARIMAX')}\nUNION ALL {_report_sql(None, None, 'SARIMAX+Clima')}", "case_series", extra=_NAIVE))
def q_model_report_key_value(spark, d):
    return RP.model_report_metrics(RP.load_metrics_pair(_pairs(spark, d)))
