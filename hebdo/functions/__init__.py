from hebdo.functions.calendar import (  # noqa: F401
    iso_week, iso_week_to_monday, iso_year, jan1_offset_date, label_iso_week,
    label_stat_week, quarter_of_month, season_of_month, time_key, week_bin_monday,
)
from hebdo.functions.cleaning import (  # noqa: F401
    clamp_nonnegative, clean_header, coerce_datetime, coerce_numeric,
    display_title, fill_zero_int, normalize_key_text, round_half_up,
)
