"""Incremental weekly refresh with Structured Streaming.

The source analyses refresh by re-reading the whole weekly series and
appending a monitoring row. On Spark the same refresh is an incremental
stream: new visit files land in a folder, each micro-batch is joined to the
(static, size-checked) establishment dimension, binned into ISO weeks and
partially summed, and written to a per-batch folder of a weekly table. The
weekly series is the sum over all batch folders.

Exactly-once: each micro-batch writes to ``<table>/batch_id=<n>`` with
``overwrite``, so a batch re-run after a failure replaces its own output
instead of appending twice; the stream checkpoint (in shared storage)
records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.functions.calendar import iso_week, iso_week_to_monday, iso_year, week_bin_monday
from hebdo.sources import sizing
from hebdo.sources.tables import establishments, path_of, table


def weekly_partial_sums(batch: DataFrame, estab: DataFrame) -> DataFrame:
    """One micro-batch of raw lines -> (series_id, week_date, cases) partial sums."""
    v = batch.join(estab, batch.l_suppkey == F.col("estab_code"))
    wk = week_bin_monday(iso_week_to_monday(iso_year("l_shipdate"), iso_week("l_shipdate")))
    return (v.filter(F.col("l_shipdate").isNotNull())
            .groupBy(F.lower(F.trim("region_label")).alias("series_id"), wk.alias("week_date"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("cases")))


def start_weekly_refresh(spark: SparkSession, sf_dir: str, landing_glob: str, table_path: str,
                         checkpoint_path: str, available_now: bool = True, max_files_per_trigger: int = 100):
    """Start the stream; returns the StreamingQuery."""
    schema = table(spark, sf_dir, "lineitem").schema
    n_supp = sizing.table_rows(spark, path_of(sf_dir, "supplier"))
    estab = sizing.dimension(establishments(spark, sf_dir).select("estab_code", "region_label"), n_supp)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing_glob))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (weekly_partial_sums(batch, estab).write.mode("overwrite")
         .parquet(f"{table_path.rstrip('/')}/batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_weekly(spark: SparkSession, table_path: str) -> DataFrame:
    """The refreshed weekly series: partial sums of all batches combined."""
    return (spark.read.parquet(table_path).groupBy("series_id", "week_date")
            .agg(F.sum("cases").cast("bigint").alias("cases")))
