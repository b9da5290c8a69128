"""Calendar arithmetic as Spark column expressions (all JVM-side, codegen).

Two calendar conventions coexist in the source analyses and are kept as two
named functions:

* ISO Monday: (year, week) -> the Monday of that ISO week. Weeks outside
  1..53 fall back to Jan 1 + 7*(week-1) days. Week 53 of a 52-week year is
  computed arithmetically and lands on the next year's week-1 Monday.
* Jan-1 offset: Jan 1 + 7*k days, used only to derive a month for the time
  dimension (k = max(week-1, 0) for ``dim_time``; k = week for
  ``dim_time_season``, which is one week later).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Southern-hemisphere season names by month.
SEASON_SUMMER = "Verano"      # December, January, February
SEASON_AUTUMN = "Otoño"       # March, April, May
SEASON_WINTER = "Invierno"    # June, July, August
SEASON_SPRING = "Primavera"   # September, October, November


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_year(ts) -> Column:
    """ISO-8601 week-numbering year (2021-01-01 -> 2020)."""
    return F.extract(F.lit("YEAROFWEEK"), _c(ts)).cast("int")


def iso_week(ts) -> Column:
    """ISO-8601 week number 1..53."""
    return F.weekofyear(_c(ts)).cast("int")


def time_key(year, week) -> Column:
    """year*100 + week as BIGINT (the star schema's time id)."""
    return (_c(year).cast("bigint") * 100 + _c(week).cast("bigint"))


def iso_week_to_monday(year, week) -> Column:
    """(year, week) -> Monday of the ISO week; fallback Jan 1 + 7(w-1) days."""
    y, w = _c(year).cast("int"), _c(week).cast("int")
    week1_monday = F.date_trunc("week", F.make_date(y, F.lit(1), F.lit(4))).cast("date")
    iso = F.date_add(week1_monday, (w - 1) * 7)
    fallback = F.date_add(F.make_date(y, F.lit(1), F.lit(1)), (w - 1) * 7)
    return F.when(w.between(1, 53), iso).otherwise(fallback)


def week_bin_monday(ts) -> Column:
    """Label of the weekly bin (Tue..Mon] a timestamp falls in: that Monday.

    A Monday belongs to the bin it labels; Tuesday goes to the next Monday.
    This is not ``date_trunc('week')`` (which maps Tuesday back one day).
    """
    return F.next_day(F.date_sub(F.to_date(_c(ts)), 1), "Mon")


def jan1_offset_date(year, week, offset_weeks: int = -1, clip_at_zero: bool = True) -> Column:
    """Jan 1 of ``year`` plus 7*(week+offset) days (clipped at 0 when asked)."""
    k = _c(week).cast("int") + F.lit(offset_weeks)
    if clip_at_zero:
        k = F.greatest(k, F.lit(0))
    return F.date_add(F.make_date(_c(year).cast("int"), F.lit(1), F.lit(1)), k * 7)


def quarter_of_month(month) -> Column:
    return (F.floor((_c(month) - 1) / 3) + 1).cast("int")


def season_of_month(month) -> Column:
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), F.lit(SEASON_SUMMER))
            .when(m.isin(3, 4, 5), F.lit(SEASON_AUTUMN))
            .when(m.isin(6, 7, 8), F.lit(SEASON_WINTER))
            .otherwise(F.lit(SEASON_SPRING)))


def label_iso_week(year, week) -> Column:
    """``2024-W07`` label (peaks table)."""
    return F.format_string("%d-W%02d", _c(year).cast("int"), _c(week).cast("int"))


def label_stat_week(year, week) -> Column:
    """``2024-S07`` axis label (statistical week)."""
    return F.format_string("%d-S%02d", _c(year).cast("int"), _c(week).cast("int"))
