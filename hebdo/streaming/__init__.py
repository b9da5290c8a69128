from hebdo.streaming.refresh import read_weekly, start_weekly_refresh, weekly_partial_sums  # noqa: F401
