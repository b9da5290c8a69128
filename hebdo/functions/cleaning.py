"""Cleaning casts and header normalisation as column expressions.

ANSI mode is on in Spark 4: a bad ``cast`` raises, so every coercion here is a
``try_*`` variant that turns bad input into NULL, which is what the source
analyses do ("bad -> missing").
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first timestamp layouts tried in order by coerce_datetime.
DAYFIRST_FORMATS = (
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm",
    "dd-MM-yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_header(name: str) -> str:
    """strip, lower, spaces -> '_', drop non-word characters, drop a BOM."""
    s = name.replace("﻿", "").strip().lower().replace(" ", "_")
    return re.sub(r"[^\w_]", "", s)


def coerce_numeric(c, to: str = "double") -> Column:
    """text -> number; unparsable -> NULL (never raises)."""
    return F.trim(_c(c).cast("string")).try_cast(to) if to else _c(c)


def coerce_datetime(c, formats=DAYFIRST_FORMATS) -> Column:
    """Day-first text -> timestamp, first format that parses wins; else NULL."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def fill_zero_int(c) -> Column:
    """Count metric as BIGINT: whole numbers exactly, others truncated; NULL, NaN, bad text and
    values beyond BIGINT -> 0."""
    text = F.trim(_c(c).cast("string"))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"),
                      F.nanvl(text.try_cast("double"), F.lit(None).cast("double")).try_cast("bigint"), F.lit(0).cast("bigint"))


def clamp_nonnegative(c) -> Column:
    """NULL -> 0 and negative -> 0 (``greatest`` skips NULLs)."""
    return F.greatest(F.coalesce(_c(c), F.lit(0)), F.lit(0))


def normalize_key_text(c) -> Column:
    """Join-key text: lower + trim."""
    return F.lower(F.trim(_c(c)))


def display_title(c) -> Column:
    """Display form of a normalised key (``initcap``)."""
    return F.initcap(_c(c))


def round_half_up(c, nd: int = 4) -> Column:
    """Round a double HALF_UP via DECIMAL(38,10), first to 6 places, then to nd.

    Sums of the same values in a different order differ by a few ulps; the
    6-place step absorbs that noise so a value sitting on a rounding tie
    rounds the same way whatever the summation order (any engine)."""
    d = _c(c).cast("decimal(38,10)")
    if nd < 6:
        d = F.round(d, 6)
    return F.round(d, nd).cast("double")
