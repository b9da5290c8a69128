"""Delimited-text sources and table sinks.

Files live under a scratch folder inside the shared ``spark.checkpoint.dir``
(never a machine-local temp dir on a cluster): every executor can read what
another wrote, and a lost executor's tasks can be re-run from the files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.session import checkpoint_dir

# Candidate separators for delimiter detection.
CANDIDATE_SEPARATORS = (",", ";", "\t", "|")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/hebdo-io/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ",",
                mode: str = "overwrite", partition_by: list[str] | None = None, header: bool = True) -> str:
    """Write (CSV: with a header unless told otherwise) and overwrite; returns the path."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).option("sep", sep).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                   encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """Delimited text with header and an explicit schema (no inference pass)."""
    return (spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def bad_line_quarantine(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                        header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined raw lines with a reason): records with too many fields are kept aside, not lost.

    Short records are padded with nulls and a value that does not parse is null.
    Separators and line ends inside quotes do not count. With ``header``, the first line of each file is one; a line
    equal to it elsewhere is data. See ``ingest.read_landed``.
    """
    from hebdo.sources import ingest
    good, bad = ingest.read_landed(ingest.land_lines(spark, path), schema, sep=sep, header_offset=0 if header else None)
    return good, bad.select("raw_line", "reason")


def delimiter_profile(spark: SparkSession, path: str, seps=CANDIDATE_SEPARATORS) -> DataFrame:
    """For each candidate separator, the distribution of fields per line.

    Runs over every line of the file(s) (``spark.read.text``), one pass:
    each line is exploded into one (sep, n_fields) pair per candidate and
    counted. The winner per file set is the separator whose modal width is
    largest (and > 1); ties go to the candidate listed first.
    """
    lines = spark.read.text(path).filter(F.length("value") > 0)
    pairs = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("sep"),
                               (F.size(F.split(F.col("value"), _regex_quote(s))) ).alias("n_fields"))
                      for i, s in enumerate(seps)])
    dist = (lines.select(F.explode(pairs).alias("p")).groupBy("p.rank", "p.sep", "p.n_fields")
            .agg(F.count(F.lit(1)).alias("n_lines")))
    return dist


def detect_delimiter(dist: DataFrame) -> DataFrame:
    """Winner from a ``delimiter_profile``: highest modal field count > 1."""
    modal = (dist.groupBy("rank", "sep")
             .agg(F.max(F.struct("n_lines", "n_fields")).alias("m"))
             .select("rank", "sep", F.col("m.n_fields").alias("modal_fields"), F.col("m.n_lines").alias("modal_lines")))
    best = modal.filter(F.col("modal_fields") > 1).agg(
        F.min(F.struct((-F.col("modal_fields")).alias("k"), F.col("rank"), F.col("sep"))).alias("b"))
    return best.select(F.col("b.sep").alias("sep"), (-F.col("b.k")).alias("modal_fields"))


def _regex_quote(s: str) -> str:
    return "\\t" if s == "\t" else "\\" + s if s in "|.^$*+?()[]{}\\" else s


def file_line_counts(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Line count per file under a folder (all lines, header included)."""
    return (spark.read.text(f"{folder.rstrip('/')}/{pattern}")
            .groupBy(F.input_file_name().alias("file_path")).agg(F.count(F.lit(1)).alias("n_lines")))


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows to a history table, creating it the first time."""
    df.write.mode("append").format(fmt).save(path)
    return path


def head_preview(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """First n rows by an explicit total order (TakeOrdered, no full sort)."""
    return df.orderBy(*order_by).limit(n)
