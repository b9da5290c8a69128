"""Size-checked broadcast.

A side is broadcast only after its row count is known to be under a bound
(``hebdo.broadcast.maxRows``, default 2,000,000). Beyond the bound it gets a
``merge`` hint: both sides are shuffled and sort-merged, which spills,
and the fact side is never shipped to the driver.

Counts of base tables come from parquet footers (``count()`` on a plain
parquet scan reads metadata only). They are memoised per relation as read: a
table that changed on disk is read anew after ``forget_tables()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 2_000_000
#: Bytes that one broadcast may hold, by the plan's own estimate of the side's row width.
DEFAULT_MAX_BYTES = 512 << 20
_COUNTS: dict[str, int] = {}


def forget_sizes() -> None:
    """Drop the memoised counts, after files changed."""
    _COUNTS.clear()


def max_rows(spark) -> int:
    return int(spark.conf.get("hebdo.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))


def table_rows(spark, path: str) -> int:
    if path not in _COUNTS:
        _COUNTS[path] = spark.read.parquet(path).count()
    return _COUNTS[path]


def distinct_rows(df: DataFrame, name: str) -> int:
    """Rows of a derived vocabulary, counted once by a small job."""
    if name not in _COUNTS:
        _COUNTS[name] = df.count()
    return _COUNTS[name]


def row_bytes(df: DataFrame) -> int:
    """Width of a row by its schema: 8 bytes a fixed column, 40 a text or nested one."""
    return sum(8 if f.dataType.typeName() in ("long", "integer", "short", "byte", "double", "float", "date", "timestamp", "boolean")
               else 40 for f in df.schema.fields)


def dimension(df: DataFrame, upper_bound_rows: int) -> DataFrame:
    """Broadcast ``df`` when its proven upper bound on rows is under the limits of rows and bytes.

    ``upper_bound_rows`` must be a bound on the rows of ``df`` (e.g. the row
    count of the base table it is derived from by filters/joins on unique
    keys).
    """
    most = int(df.sparkSession.conf.get("hebdo.broadcast.maxBytes", str(DEFAULT_MAX_BYTES)))
    if upper_bound_rows <= max_rows(df.sparkSession) and upper_bound_rows * row_bytes(df) <= most:
        return F.broadcast(df)
    return df.hint("merge")
