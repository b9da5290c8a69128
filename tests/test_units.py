"""Small-frame unit tests for schema handling, file utilities and report formatting."""

import datetime as dt

from pyspark.sql import functions as F

from hebdo.operators import profile as PR
from hebdo.operators import reports as RP
from hebdo.session import checkpoint_dir
from hebdo.sources import files as FS


def test_clean_header_and_role_resolution():
    from hebdo.functions.cleaning import clean_header
    assert clean_header("﻿ Semana Estadística ") == "semana_estadística"
    assert clean_header("Num-Total") == "numtotal"
    roles = PR.resolve_roles(["anio", "semanaestadistica", "comunaglosa", "numtotal", "causa"])
    assert roles["year"] == "anio" and roles["week"] == "semanaestadistica"
    assert roles["total"] == "numtotal" and roles["commune"] == "comunaglosa"
    # the week column is claimed by the week role, so no date column is invented from it
    assert roles["date"] is None
    regex_only = PR.resolve_roles(["n_total_atenciones", "nombre_comuna_x"])
    assert regex_only["total"] == "n_total_atenciones" and regex_only["commune"] == "nombre_comuna_x"


def test_conform_and_completeness(spark):
    raw = spark.createDataFrame([(" 12", "7", "x"), ("bad", None, "3")], "`AnIo ` string, NumTotal string, Causa string")
    c = PR.conform_table(raw).collect()
    assert [(r.year, r.total, r.cause) for r in c] == [(12, 7, "x"), (None, 0, "3")]
    comp = {r.column_name: r for r in PR.role_completeness(raw).collect()}
    assert comp["anio"].present and comp["anio"].cast_failures == 1 and comp["anio"].non_null == 2
    assert comp["numtotal"].non_null == 1 and comp["numtotal"].cast_failures == 0
    assert not comp["latitud"].present and len(comp) == 25


def test_metrics_pair_forms(spark):
    m = spark.createDataFrame([("s", " sarimax ", 1.234, 2.0), ("s", "SARIMAX+Clima", 3.0, 4.555),
                               ("t", "SARIMAX", 5.0, 6.0)], "series_id string, model string, mae double, rmse double")
    p = {r.series_id: r for r in RP.metrics_pair(m).collect()}
    assert (p["s"].base_mae, p["s"].clima_rmse) == (1.234, 4.555)
    assert p["t"].clima_mae is None
    rep = {(r.series_id, r.model): (r.mae, r.rmse) for r in RP.model_report_metrics(RP.metrics_pair(m)).collect()}
    assert rep[("s", "SARIMAX")] == ("1.23", "2.00") and rep[("s", "SARIMAX+Clima")] == ("3.00", "4.56")
    assert rep[("t", "SARIMAX+Clima")] == ("N/D", "N/D")
    kv = spark.createDataFrame([("s", "MAE", "1.5"), ("s", "RMSE", "2.5")], "series_id string, metric string, value string")
    b = RP.metrics_pair_from_kv(kv).collect()[0]
    assert (b.base_mae, b.base_rmse, b.clima_mae) == (1.5, 2.5, None)


def test_delimiter_detection_and_line_counts(spark):
    checkpoint_dir(spark)
    df = spark.createDataFrame([(i, f"c{i}", float(i)) for i in range(30)], "a int, b string, c double")
    p = FS.scratch_path(spark, "pipe")
    FS.write_table(df, p, fmt="csv", sep="|")
    assert FS.detect_delimiter(FS.delimiter_profile(spark, p)).collect()[0].sep == "|"
    back = FS.read_delimited(spark, p, "a int, b string, c double", sep="|")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    counts = FS.file_line_counts(spark, p, "*.csv").agg(F.sum("n_lines")).collect()[0][0]
    n_files = FS.file_line_counts(spark, p, "*.csv").count()
    assert counts == 30 + n_files  # one header per part file


def test_append_log_creates_then_appends(spark):
    checkpoint_dir(spark)
    p = FS.scratch_path(spark, "log")
    row = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "d date, v double")
    FS.append_log(row, p)
    FS.append_log(row, p)
    assert spark.read.parquet(p).count() == 2


def test_climate_report_synthetic_band(spark):
    c = spark.createDataFrame([(2020, 1, "x", 10.0)], "year int, week int, city string, temperature double")
    r = RP.climate_report(c).collect()[0]
    assert (r.temp_min, r.temp_max, r.is_synthetic) == (5.0, 15.0, True)


def test_a_missing_required_column_is_an_error(spark):
    raw = spark.createDataFrame([("1", "2", "3")], "`Cód Establecimiento` string, Semana string, Casos string")
    import pytest
    with pytest.raises(ValueError, match="anio, ordencausa"):
        PR.conform_table(raw, required=PR.REQUIRED)
    assert PR.conform_table(raw).columns == ["estab_code", "week", "total"]
    comp = {r.column_name: (r.raw_header, r.found_by) for r in PR.role_completeness(raw, resolved=True).collect()}
    assert comp["establecimientocodigo"] == ("Cód Establecimiento", "pattern") and comp["anio"] == (None, "absent")


def test_a_pattern_takes_no_header_that_another_column_names():
    got = PR.resolve_columns(["total_semana", "semanaestadistica", "numtotal", "anio", "comuna_codigo", "comuna"])
    assert got["semanaestadistica"] == ("semanaestadistica", "header") and got["numtotal"] == ("numtotal", "header")
    assert got["comunacodigo"] == ("comuna_codigo", "pattern") and got["comunaglosa"] == ("comuna", "alias")
    ages = PR.resolve_columns(["menor_1", "1_a_4", "5_a_14", "15_a_64", "65_y_mas"])
    assert [ages[c][0] for c in ("nummenor1anio", "num1a4anios", "num5a14anios", "num15a64anios", "num65omas")] == [
        "menor_1", "1_a_4", "5_a_14", "15_a_64", "65_y_mas"]


def test_equal_headers_are_told_apart(spark):
    df = PR.normalize_headers(spark.createDataFrame([(1, 2, 3)], "`A b` int, `a_b` int, c int"))
    assert df.columns == ["a_b", "a_b_2", "c"]


def test_a_fact_without_all_metrics_is_an_error(spark):
    import pytest
    from hebdo.operators.aggregates import fact_week_estab_cause
    with pytest.raises(ValueError, match="no whole set"):
        fact_week_estab_cause(spark.createDataFrame([(1, 1, 1, 1, 2)], "year int, week int, estab_code int, cause_code int, total int"))


def test_unknown_cities_leave_a_check_row(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "city string, v int")
    got = sorted(tuple(r) for r in PR.filter_by_city(df, ["a", "x", "x", "b"]).fillna({"v": -1}).fillna({"check": "-"}).collect())
    assert got == [("a", 1, "-"), ("b", -1, "-"), ("x", -1, "no rows")]
    assert [tuple(r) for r in PR.filter_by_city(df.filter("false"), ["a"]).collect()] == [("a", None, "no rows")]


def test_metric_layouts(spark):
    import pytest
    pairs = spark.createDataFrame([("MAE", "1.5"), ("rmse ", "2.5"), ("n", "3")], "`Unnamed: 0` string, `0` string")
    assert tuple(RP.load_metrics_pair(pairs).collect()[0]) == ("", 1.5, 2.5, None, None)
    long = spark.createDataFrame([("Sarimax ", "1", None), ("x CLIMA", "bad", "4")], "Modelo string, MAE string, RMSE string")
    assert tuple(RP.load_metrics_pair(long).collect()[0]) == ("", 1.0, None, None, 4.0)
    with pytest.raises(ValueError, match="no known layout"):
        RP.load_metrics_pair(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"))
