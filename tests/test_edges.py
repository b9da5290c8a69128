"""Hand-built edge frames (see FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hebdo.functions.calendar import iso_week_to_monday, week_bin_monday
from hebdo.functions.cleaning import clamp_nonnegative, coerce_datetime, coerce_numeric, fill_zero_int
from hebdo.operators import aggregates as A
from hebdo.operators import peaks as P
from hebdo.operators import series as S
from hebdo.operators import stats as T

D = dt.date


def test_iso_week_to_monday_and_fallback(spark):
    df = spark.createDataFrame([(2020, 53), (2021, 1), (2021, 53), (2021, 0), (2021, 54)], "year int, week int")
    got = {(r.year, r.week): r.m for r in df.select("year", "week", iso_week_to_monday("year", "week").alias("m")).collect()}
    assert got == {(2020, 53): D(2020, 12, 28), (2021, 1): D(2021, 1, 4), (2021, 53): D(2022, 1, 3),
                   (2021, 0): D(2020, 12, 25), (2021, 54): D(2022, 1, 7)}


def test_week_bins_sum_mean_and_interpolation(spark):
    df = spark.createDataFrame([("s", dt.datetime(2024, 1, 1), 1.0), ("s", dt.datetime(2024, 1, 2), 2.0),
                                ("s", dt.datetime(2024, 1, 22), 5.0)], "k string, ts timestamp, v double")
    assert [r.m for r in df.select(week_bin_monday("ts").alias("m")).collect()] == \
        [D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 22)]
    s = S.resample_week_sum(df, "k", "ts", "v").orderBy("week_date").collect()
    assert [(r.week_date, r.value) for r in s] == [(D(2024, 1, 1), 1.0), (D(2024, 1, 8), 2.0),
                                                  (D(2024, 1, 15), 0.0), (D(2024, 1, 22), 5.0)]
    m = S.resample_week_mean(df, "k", "ts", "v")
    assert [r.value for r in m.orderBy("week_date").collect()] == [1.0, 2.0, None, 5.0]
    i = S.interpolate_linear(m, "k", "value").orderBy("week_date").collect()
    assert [r.value for r in i] == [1.0, 2.0, 3.5, 5.0]


def test_interpolation_ends(spark):
    df = spark.createDataFrame([("s", D(2024, 1, 1) + dt.timedelta(days=7 * i), v)
                                for i, v in enumerate([None, 1.0, None, 3.0, None])],
                               "k string, week_date date, v double")
    fwd = [r.v for r in S.interpolate_linear(df, "k", "v").orderBy("week_date").collect()]
    both = [r.v for r in S.interpolate_linear(df, "k", "v", direction="both").orderBy("week_date").collect()]
    ffb = [r.v for r in S.fill_forward_backward(df, "k", "v").orderBy("week_date").collect()]
    assert fwd == [None, 1.0, 2.0, 3.0, 3.0]
    assert both == [1.0, 1.0, 2.0, 3.0, 3.0]
    assert ffb == [1.0, 1.0, 1.0, 3.0, 3.0]


def test_percentile_linear(spark):
    df = spark.createDataFrame([(1, v) for v in (1, 2, 3, 10)], "estab_code int, total long")
    assert A.estab_p90_threshold(df).collect()[0].p90 == pytest.approx(7.9)


def test_null_keys_and_all_null_sum(spark):
    df = spark.createDataFrame([(None, 2), ("a", None), ("a", None), ("b", 3)], "k string, total long")
    got = {r.k: r.total for r in A.sum_by(df, ["k"]).collect()}
    assert got == {"a": 0, "b": 3}


def test_constant_series_correlation_is_null(spark):
    df = spark.createDataFrame([("s", D(2024, 1, 1), 1.0, 1.0), ("s", D(2024, 1, 8), 1.0, 1.0)],
                               "series_id string, week_date date, cases double, temperature double")
    assert T.corr_lag0(df).collect()[0].corr is None
    lc = T.lag_correlation(df, max_lag=2).collect()
    assert len(lc) == 5 and all(r.corr is None for r in lc)


def test_lag_correlation_faithful_is_symmetric_and_signed_is_not(spark):
    rows = [("s", D(2020, 1, 6) + dt.timedelta(days=7 * i), float(i % 7 + (i % 3) ** 2), float((i * 5) % 11))
            for i in range(40)]
    df = spark.createDataFrame(rows, "series_id string, week_date date, cases double, temperature double")
    f = {r.lag: r.corr for r in T.lag_correlation(df, max_lag=3).collect()}
    s = {r.lag: r.corr for r in T.lag_correlation(df, max_lag=3, signed=True).collect()}
    assert all(f[k] == f[-k] for k in range(1, 4))
    assert s[0] == f[0] and s[2] == f[2] and s[-2] != f[-2]
    b = T.best_lag(T.lag_correlation(df, max_lag=3)).collect()[0]
    assert b.best_lag <= 0


def test_peak_ties_earliest_week(spark):
    df = spark.createDataFrame([(2020, 5, "x", 10, 3.0), (2020, 2, "x", 10, 1.0), (2019, 9, "x", 4, 1.0)],
                               "year int, week int, city string, cases long, temperature double")
    pk = P.peak_week_cases(df).collect()[0]
    assert (pk.year, pk.week, pk.week_label) == (2020, 2, "2020-W02")
    cold = P.coldest_week(df).collect()[0]
    assert (cold.year, cold.week, cold.cases_at_week) == (2019, 9, 4)


@pytest.mark.parametrize("n,rule,h", [(5, "A", 4), (104, "A", 12), (105, "A", 52),
                                      (5, "B", 4), (104, "B", 26), (105, "B", 52)])
def test_holdout_rules(spark, n, rule, h):
    df = spark.createDataFrame([("s", D(2020, 1, 6) + dt.timedelta(days=7 * i), 1.0) for i in range(n)],
                               "series_id string, week_date date, cases double")
    out = S.holdout_split(df, "series_id", rule).collect()
    assert {r.h for r in out} == {h}
    assert sum(r.is_test for r in out) == h


def test_casts_never_raise(spark):
    df = spark.createDataFrame([("12", "02/01/2024"), ("x", "bad"), (None, None), ("-3", "31-12-2023 10:00")],
                               "n string, d string")
    out = df.select(coerce_numeric("n").alias("n"), fill_zero_int("n").alias("z"),
                    clamp_nonnegative(coerce_numeric("n")).alias("c"), coerce_datetime("d").alias("d")).collect()
    assert [r.n for r in out] == [12.0, None, None, -3.0]
    assert [r.z for r in out] == [12, 0, 0, -3]
    assert [r.c for r in out] == [12.0, 0.0, 0.0, 0.0]
    assert out[0].d == dt.datetime(2024, 1, 2) and out[1].d is None
    assert out[3].d == dt.datetime(2023, 12, 31, 10, 0)


def test_season_names_and_dim_time(spark):
    from hebdo.operators import star as ST
    df = spark.createDataFrame([(2023, 9), (2023, 1), (2023, 26)], "year int, week int")
    t = {r.week: r for r in ST.dim_time(df).collect()}
    s = {r.week: r for r in ST.dim_time_season(df).collect()}
    assert t[9].month == 2 and s[9].month == 3 and s[9].season == "Otoño"
    assert t[26].is_winter == 1 and t[1].quarter == 1 and s[1].season == "Verano"


def test_surrogate_id_dense_in_order(spark):
    from hebdo.operators import star as ST
    rows = [(y, w, c) for y in (2020, 2021) for w in (1, 2, 3) for c in ("b", "a")]
    df = spark.createDataFrame(rows, "year int, week int, city string").repartition(5)
    out = sorted((r.surrogate_id, r.year, r.week, r.city)
                 for r in ST.surrogate_id(df, ["year", "week"], ["city"]).collect())
    assert [o[0] for o in out] == list(range(1, 13))
    assert [o[1:] for o in out] == sorted(r for r in rows)


def test_fill_zero_int_never_raises(spark):
    from hebdo.functions.cleaning import fill_zero_int
    rows = [("NaN",), ("1e30",), ("9007199254740993",), (" 7 ",), ("-2.9",), ("1e3",), ("x",), (None,), ("99999999999999999999",)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(fill_zero_int("v")).collect()]
    assert got == [0, 0, 9007199254740993, 7, -2, 1000, 0, 0, 0]


def test_metrics_pair_takes_one_row(spark):
    from hebdo.operators.reports import metrics_pair
    df = spark.createDataFrame([("a", "SARIMAX", 1.0, 9.0), ("a", "sarimax ", 2.0, 3.0), ("a", "X+clima", None, None)],
                               "series_id string, model string, mae double, rmse double")
    r = metrics_pair(df).first()
    assert (r.base_mae, r.base_rmse) == (1.0, 9.0) and r.clima_mae is None


def test_completeness_of_an_empty_table_without_required_columns(spark):
    from hebdo.operators.profile import RAW_INTERNAL, role_completeness
    got = role_completeness(spark.createDataFrame([], "other string")).collect()
    assert len(got) == len(RAW_INTERNAL) and not any(r["present"] for r in got)


def test_short_lines_are_padded_and_long_lines_quarantined(spark, tmp_path):
    from pyspark.sql import types as T
    from hebdo.sources.files import bad_line_quarantine
    (tmp_path / "a.csv").write_text('n;s\n1;x\n2\n3;"a;b"\n4;y;\nbad;z\n\n')
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    good, bad = bad_line_quarantine(spark, str(tmp_path), schema, sep=";")
    assert {(r.n, r.s) for r in good.collect()} == {(1, "x"), (2, None), (3, "a;b"), (None, "z")}
    assert [r.raw_line for r in bad.collect()] == ["4;y;"]
