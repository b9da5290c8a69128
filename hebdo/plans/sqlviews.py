"""The analogue views as SQL common table expressions, for the DuckDB oracles.

Oracles may reference base tables only, so each oracle string inlines the
views it needs. ``with_views(body, *names)`` prepends the named CTEs (and
what they depend on) in dependency order.
"""

from __future__ import annotations

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, deps: tuple[str, ...], sql: str) -> None:
    _VIEWS[name] = (deps, sql.strip())


_view("estabs", (), """
SELECT s.s_suppkey AS estab_code, s.s_name AS estab_label,
       r.r_regionkey AS region_code, r.r_name AS region_label,
       n.n_nationkey AS commune_code, n.n_name AS commune_label,
       n.n_nationkey % 3 AS service_code,
       CONCAT('HS_', CAST(n.n_nationkey % 3 AS VARCHAR)) AS service_label
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")

_view("causes", (), """
SELECT cause, CAST(DENSE_RANK() OVER (ORDER BY cause) AS BIGINT) AS cause_code
FROM (SELECT DISTINCT p_type AS cause FROM part) t
""")

# visits without the part dimension (queries that never touch cause)
_view("visits_nc", ("estabs",), """
SELECT l.l_orderkey * 10 + l.l_linenumber AS visit_id,
       e.estab_code, e.estab_label, e.region_code, e.region_label,
       e.commune_code, e.commune_label, e.service_code, e.service_label,
       l.l_returnflag AS age_group, l.l_shipdate AS visit_ts,
       CAST(isoyear(l.l_shipdate) AS INTEGER) AS year,
       CAST(week(l.l_shipdate) AS INTEGER) AS week,
       CAST(l.l_quantity AS BIGINT) AS total,
       CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS band_a,
       CASE WHEN l.l_returnflag = 'N' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS band_n,
       CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS band_r,
       CAST(isoyear(l.l_shipdate) AS BIGINT) * 100 + CAST(week(l.l_shipdate) AS BIGINT) AS time_id
FROM lineitem l JOIN estabs e ON l.l_suppkey = e.estab_code
""")

_view("visits", ("estabs", "causes"), """
SELECT l.l_orderkey * 10 + l.l_linenumber AS visit_id,
       e.estab_code, e.estab_label, e.region_code, e.region_label,
       e.commune_code, e.commune_label, e.service_code, e.service_label,
       p.p_type AS cause, c.cause_code,
       l.l_returnflag AS age_group, l.l_shipdate AS visit_ts,
       CAST(isoyear(l.l_shipdate) AS INTEGER) AS year,
       CAST(week(l.l_shipdate) AS INTEGER) AS week,
       CAST(l.l_quantity AS BIGINT) AS total,
       CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS band_a,
       CASE WHEN l.l_returnflag = 'N' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS band_n,
       CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS band_r,
       CAST(isoyear(l.l_shipdate) AS BIGINT) * 100 + CAST(week(l.l_shipdate) AS BIGINT) AS time_id
FROM lineitem l JOIN estabs e ON l.l_suppkey = e.estab_code
JOIN part p ON l.l_partkey = p.p_partkey
JOIN causes c ON p.p_type = c.cause
""")

_view("readings", (), """
SELECT o.o_orderdate AS reading_ts, r.r_name AS city, o.o_totalprice AS temperature
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")

# weekly climate, city key normalised, unrounded mean
_view("climate", ("readings",), """
SELECT lower(trim(city)) AS city, CAST(isoyear(reading_ts) AS INTEGER) AS year,
       CAST(week(reading_ts) AS INTEGER) AS week, AVG(temperature) AS temperature
FROM readings WHERE reading_ts IS NOT NULL AND temperature IS NOT NULL AND city IS NOT NULL
GROUP BY 1, 2, 3
""")

_view("fact_we", ("visits_nc",), """
SELECT year, week, estab_code, CAST(SUM(total) AS BIGINT) AS total,
       CAST(year AS BIGINT) * 100 + week AS time_id
FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND estab_code IS NOT NULL
GROUP BY year, week, estab_code
""")

_view("fact_flag", ("fact_we",), """
SELECT f.*, CASE WHEN f.total > t.p90 THEN 1 ELSE 0 END AS is_peak
FROM fact_we f JOIN (SELECT estab_code, quantile_cont(total, 0.9) AS p90 FROM fact_we GROUP BY estab_code) t
  ON f.estab_code = t.estab_code
""")

_view("fact_wec", ("visits",), """
SELECT time_id, estab_code, cause_code,
       CAST(SUM(total) AS BIGINT) AS total, CAST(SUM(band_a) AS BIGINT) AS band_a,
       CAST(SUM(band_n) AS BIGINT) AS band_n, CAST(SUM(band_r) AS BIGINT) AS band_r
FROM visits WHERE year IS NOT NULL AND week IS NOT NULL AND estab_code IS NOT NULL AND cause_code IS NOT NULL
GROUP BY time_id, estab_code, cause_code
""")

# ISO-Monday helper as SQL: (y, w) -> Monday of ISO week, fallback Jan 1 + 7(w-1)
def iso_monday_sql(y: str, w: str) -> str:
    return (f"CAST(CASE WHEN {w} BETWEEN 1 AND 53 THEN date_trunc('week', make_date({y}, 1, 4)) + "
            f"to_days(CAST(({w} - 1) * 7 AS INTEGER)) ELSE make_date({y}, 1, 1) + "
            f"to_days(CAST(({w} - 1) * 7 AS INTEGER)) END AS DATE)")


def week_bin_sql(d: str) -> str:
    """Monday label of the (Tue..Mon] bin containing date d."""
    return f"CAST(CAST({d} AS DATE) + to_days(CAST((8 - isodow(CAST({d} AS DATE))) % 7 AS INTEGER)) AS DATE)"


# region weekly case series, gap-free (zero filled) from first to last bin
_view("case_bins", ("visits_nc",), f"""
SELECT series_id, {week_bin_sql(iso_monday_sql('year', 'week'))} AS week_date, SUM(cases) AS cases
FROM (SELECT lower(trim(region_label)) AS series_id, year, week, SUM(total) AS cases
      FROM visits_nc WHERE year IS NOT NULL AND week IS NOT NULL AND region_label IS NOT NULL
      GROUP BY 1, 2, 3) t
GROUP BY 1, 2
""")


def spine_sql(binned: str) -> str:
    return (f"SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week_date "
            f"FROM (SELECT series_id, MIN(week_date) AS lo, MAX(week_date) AS hi FROM {binned} GROUP BY 1) m")


_view("case_series", ("case_bins",), f"""
SELECT sp.series_id, sp.week_date, CAST(COALESCE(b.cases, 0) AS DOUBLE) AS cases
FROM ({spine_sql('case_bins')}) sp
LEFT JOIN case_bins b ON sp.series_id = b.series_id AND sp.week_date = b.week_date
""")

_view("climate_monday", ("climate",), f"""
SELECT city AS series_id, {week_bin_sql(iso_monday_sql('year', 'week'))} AS week_date, AVG(temperature) AS temperature
FROM climate GROUP BY 1, 2
""")


def interpolate_sql(src: str, v: str, both: bool = False, key: str = "series_id", order: str = "week_date") -> str:
    """Linear interpolation by position, as SQL over relation ``src``."""
    tail = "nv_" if both else "NULL"
    return f"""
SELECT * EXCLUDE (pos_, pv_, pp_, nv_, np_) REPLACE (
  CAST(CASE WHEN {v} IS NOT NULL THEN {v}
       WHEN pv_ IS NOT NULL AND nv_ IS NOT NULL THEN pv_ + (nv_ - pv_) * (pos_ - pp_) / (np_ - pp_)
       WHEN pv_ IS NOT NULL THEN pv_ ELSE {tail} END AS DOUBLE) AS {v})
FROM (
  SELECT *,
    last_value({v} IGNORE NULLS) OVER wb AS pv_,
    last_value(CASE WHEN {v} IS NOT NULL THEN pos_ END IGNORE NULLS) OVER wb AS pp_,
    first_value({v} IGNORE NULLS) OVER wa AS nv_,
    first_value(CASE WHEN {v} IS NOT NULL THEN pos_ END IGNORE NULLS) OVER wa AS np_
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS pos_ FROM {src}) z
  WINDOW wb AS (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wa AS (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
) y"""


def ffill_bfill_sql(src: str, v: str, key: str = "series_id", order: str = "week_date") -> str:
    return f"""
SELECT * REPLACE (COALESCE({v},
   last_value({v} IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value({v} IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {v})
FROM {src}"""


_view("city_climate_spine", ("climate_monday",), f"""
SELECT sp.series_id, sp.week_date, b.temperature
FROM ({spine_sql('climate_monday')}) sp
LEFT JOIN climate_monday b ON sp.series_id = b.series_id AND sp.week_date = b.week_date
""")
_view("city_climate_interp", ("city_climate_spine",), interpolate_sql("city_climate_spine", "temperature"))
_view("city_climate", ("city_climate_interp",), ffill_bfill_sql("city_climate_interp", "temperature"))

_view("aligned_raw", ("case_series", "climate_monday"), """
SELECT c.series_id, c.week_date, c.cases, m.temperature
FROM case_series c LEFT JOIN climate_monday m ON c.series_id = m.series_id AND c.week_date = m.week_date
""")
_view("aligned_interp", ("aligned_raw",), interpolate_sql("aligned_raw", "temperature", both=True))
_view("aligned_fill", ("aligned_interp",), ffill_bfill_sql("aligned_interp", "temperature"))
_view("aligned", ("aligned_fill",), """
SELECT * FROM aligned_fill WHERE cases IS NOT NULL AND temperature IS NOT NULL
""")
_view("inner_aligned", ("case_series", "city_climate"), """
SELECT c.series_id, c.week_date, c.cases, m.temperature
FROM case_series c JOIN city_climate m ON c.series_id = m.series_id AND c.week_date = m.week_date
WHERE c.cases IS NOT NULL AND m.temperature IS NOT NULL
""")


def r4(expr: str, nd: int = 4) -> str:
    """SQL twin of ``round_half_up``."""
    inner = f"CAST({expr} AS DECIMAL(38,10))"
    if nd < 6:
        inner = f"ROUND({inner}, 6)"
    return f"CAST(ROUND({inner}, {nd}) AS DOUBLE)"


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [(n, _VIEWS[n][1]) for n in order] + list((extra or {}).items())
    if not parts:
        return body.strip()
    ctes = ",\n".join(f"{n} AS (\n{q.strip()}\n)" for n, q in parts)
    return f"WITH {ctes}\n{body.strip()}"
