"""Helpers shared by the training-data operators.

``stage`` cuts lineage by writing a table into the shared checkpoint folder
(the one the cluster names), so a lost executor costs a re-read of files
that every executor can see. ``small_side`` broadcasts only behind a row
count; past the bound the planner joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.session import ship_package
from hebdo.sources.files import scratch_path

#: Default bound on the rows of a broadcast side (``hebdo.llm.broadcastRows``).
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_workers(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers."""
    ship_package(spark)
    return spark


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint when ``df`` (a staged table) has at most the bound of rows."""
    bound = int(df.sparkSession.conf.get("hebdo.llm.broadcastRows", str(BROADCAST_ROWS)))
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= bound else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not have (case aside)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_runs(batch, column: str, most: int):
    """Slices of an Arrow batch whose texts in ``column`` sum to ``most`` bytes at most (at least one row each)."""
    import numpy as np
    import pyarrow.compute as pc
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        step = max(1, int(np.searchsorted(np.cumsum(size[at:], dtype=np.int64), most, "right")))
        yield batch.slice(at, step)
        at += step


def id_bucket(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null ids: null)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % mod


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, held_mod: int, held_rest: int,
                    max_rows: int) -> DataFrame:
    """(doc_id, text, label): at most about ``max_rows`` labelled rows outside the held-out fold.

    The only bounded sample a classifier is fitted on. Labels are reduced to
    one row per id (conflicting labels: the smaller), thinned by a hash of the
    id to the bound, and only then meet the texts, so the label side is small.
    """
    fold = id_bucket("doc_id", held_mod)
    lab = (labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold != held_rest))
           .groupBy("doc_id").agg(F.min(target).cast("int").alias("label")))
    lab = stage(lab, "labels")
    n = lab.count()
    grain = 1_000_000
    if n > max_rows:
        lab = lab.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < int(grain * max_rows / n))
    return (docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
            .join(small_side(lab, min(n, max_rows)), "doc_id"))
