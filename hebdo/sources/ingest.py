"""Delimited text with preamble lines, unknown separators and quoted values that cross line ends.

``land_lines`` copies the raw lines once into a table that keeps each line's place
(file, start of its block, number within the scan), under the shared
checkpoint folder. Later passes agree on places because they read this table:
the place of a line in a second scan of the files could differ, as Spark deals
blocks by the executors it has just then.

Quotes are followed by a linear pass over the pieces between quote characters
(``scan``), never by a regular expression with a repeated group, which recurses in
Java and ends the JVM on long values. A line maps the state it begins in
(outside or inside a quoted value) to the state it ends in. These maps are
composed along each file in two steps, inside blocks and over blocks, so a file of
any size is followed by many tasks. Only files in which some line leaves a quote
open take part; all others have one record a line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.sources import sizing
from hebdo.sources.files import CANDIDATE_SEPARATORS, scratch_path

#: Header offsets looked at: none, or 1 to 9 lines before the header.
OFFSETS = 10
#: Lines that one quoted record may span; a longer one has a stray quote and is quarantined line by line.
MAX_RECORD_LINES = 10_000
OUTSIDE, INSIDE, CLOSED = 0, 1, 2


def land_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, block, line, value) of every line of the files under ``path``; (block, line) orders a file's lines."""
    raw = spark.read.option("encoding", encoding).text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("line"), "value")
    out = scratch_path(spark, "landed-lines")
    lines.write.parquet(out)
    return spark.read.schema(lines.schema).parquet(out)


# ---- one line -----------------------------------------------------------------------------

def _count(text: Column, sep: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, sep, F.lit("")))) / F.length(sep)).cast("int")


def scan(value: Column, sep: Column, inside: bool = False) -> Column:
    """struct(mode, fields) after a text that begins outside or inside a quoted value.

    A quote opens a value at the start of a field only; a doubled one inside a value is a
    character; one in the middle of an unquoted field is too. ``fields`` counts separators outside values, plus one.
    """
    state = lambda mode, opens, fields: F.struct(
        (F.lit(mode) if isinstance(mode, int) else mode).alias("mode"), opens.alias("opens"), fields.alias("fields"))
    pieces = F.split(value, '"', -1)
    first = F.element_at(pieces, 1)
    no = F.lit(False)
    start = state(INSIDE, no, F.lit(1)) if inside else state(
        OUTSIDE, (first == "") | F.endswith(first, sep), F.lit(1) + _count(first, sep))

    def step(s, piece):
        text = state(OUTSIDE, F.endswith(piece, sep), s["fields"] + _count(piece, sep))
        quoted = state(INSIDE, no, s["fields"])
        return (F.when(s["mode"] == CLOSED, quoted)
                .when(s["mode"] == INSIDE, F.when(piece == "", state(CLOSED, no, s["fields"])).otherwise(text))
                .otherwise(F.when(s["opens"], quoted).otherwise(text)))

    out = F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), start, step)
    plain = F.struct(F.lit(INSIDE if inside else OUTSIDE).alias("mode"), F.lit(False).alias("opens"),
                     (F.lit(1) if inside else 1 + _count(value, sep)).alias("fields"))
    return F.when(F.contains(value, F.lit('"')), out).otherwise(plain)


def n_fields(value: Column, sep: Column) -> Column:
    return scan(value, sep)["fields"]


# ---- separator and header offset -----------------------------------------------------------

def heads(lines: DataFrame, n: int = OFFSETS) -> DataFrame:
    """The first ``n`` lines of each file with their ``position`` from 0; each task passes on n lines of a file."""
    w = Window.partitionBy("file").orderBy("block", "line")
    return (lines.withColumn("position", F.row_number().over(w) - 1).filter(F.col("position") < n))


def header_layouts(lines: DataFrame, seps=CANDIDATE_SEPARATORS) -> DataFrame:
    """Each file's candidates: (file, rank, sep, header_offset, header_fields, modal_fields, modal_lines).

    A candidate is a separator and a number of lines before the header (0 to 9). The modal width is
    that of the lines after the header; it follows from the counts over all lines less the few in front.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("sep")) for i, s in enumerate(seps)]))
    width = n_fields(F.col("value"), F.col("c.sep"))
    counts = (lines.filter(F.trim("value") != "").select("file", "value", each.alias("c"))
              .groupBy("file", "c.rank", "c.sep", width.alias("n_fields")).agg(F.count(F.lit(1)).alias("n_lines")))
    front = (heads(lines).select("file", "position", "value", each.alias("c"))
             .select("file", "c.rank", "position", F.when(F.trim("value") != "", width).alias("w"))
             .groupBy("file", "rank").agg(F.sort_array(F.collect_list(F.struct("position", "w"))).alias("front")))
    offsets = counts.join(front, ["file", "rank"]).select(
        "*", F.explode(F.transform("front", lambda p: p["position"])).alias("header_offset"))
    before = F.size(F.filter("front", lambda p: (p["position"] <= F.col("header_offset")) & (p["w"] == F.col("n_fields"))))
    header = F.element_at("front", F.col("header_offset") + 1)["w"]
    rest = offsets.select("file", "rank", "sep", "header_offset", header.alias("header_fields"), "n_fields",
                          (F.col("n_lines") - before).alias("n_lines")).filter("n_lines > 0")
    return (rest.groupBy("file", "rank", "sep", "header_offset")
            .agg(F.first("header_fields").alias("header_fields"), F.max(F.struct("n_lines", "n_fields")).alias("m"))
            .select("file", "rank", "sep", "header_offset", "header_fields", F.col("m.n_fields").alias("modal_fields"),
                    F.col("m.n_lines").alias("modal_lines")))


def detect_layout(candidates: DataFrame) -> DataFrame:
    """(file, sep, header_offset, modal_fields, modal_lines): the winner of each file.

    The header must be as wide as most lines after it, and wider than one field. The widest wins, then
    the earliest header, then the separator listed first. A file without such a candidate has no row.
    """
    ok = candidates.filter("modal_fields > 1 and header_fields = modal_fields")
    order = F.struct((-F.col("modal_fields")).alias("k"), "header_offset", "rank", "sep", "modal_lines")
    return (ok.groupBy("file").agg(F.min(order).alias("b"))
            .select("file", "b.sep", "b.header_offset", (-F.col("b.k")).alias("modal_fields"), "b.modal_lines"))


# ---- records ---------------------------------------------------------------------------------

def _sized(df: DataFrame) -> DataFrame:
    return sizing.dimension(df, df.count())


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def records(lines: DataFrame, sep: Column, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """(file, block, line, value, problem) of every record; lines of a quoted value are joined by a newline.

    ``sep`` may depend on columns of ``lines``. A quote never closed, or only after more than ``max_lines`` lines, makes
    each of its lines a row of its own with a ``problem``.
    """
    extra = [c for c in lines.columns if c not in ("block", "line", "value")]
    opens = scan(F.col("value"), sep)["mode"] == INSIDE
    dirty = _kept(lines.filter(opens).select("file").distinct(), "open-quotes")
    if dirty.isEmpty():
        return lines.withColumn("problem", F.lit(None).cast("string"))
    side = _sized(dirty)
    clean = lines.join(side, "file", "left_anti").withColumn("problem", F.lit(None).cast("string"))
    placed = _states(lines.join(side, "file", "left_semi"), sep)
    place = F.struct("block", "line")
    spans = placed.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"), F.max_by("after", place).alias("open"))
    long = _kept(spans.filter((F.col("n") > 1) | (F.col("open") == 1)), "long-records")
    work = placed.join(long, ["file", "record"], "left")
    stray = (F.col("open") == 1) | (F.col("n") > max_lines)
    single = work.filter(F.col("n").isNull() | stray).select(
        *extra, "block", "line", "value", F.when(stray, F.lit("unclosed quote")).alias("problem"))
    joined = (work.filter(F.col("n").isNotNull() & ~stray).groupBy(*extra, "record")
              .agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
              .select(*extra, "record.block", "record.line", F.array_join("parts.value", "\n").alias("value"),
                      F.lit(None).cast("string").alias("problem")))
    return clean.select(single.columns).unionByName(single).unionByName(joined)


def _states(lines: DataFrame, sep: Column) -> DataFrame:
    """``lines`` with ``after`` (1: a quote is open behind the line) and ``record``, the place of its record's first line."""
    end = lambda inside: (scan(F.col("value"), sep, inside)["mode"] == INSIDE).cast("int")
    block = Window.partitionBy("file", "block").orderBy("line")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    work = lines.withColumn("f0", end(False)).withColumn("f1", end(True))
    work = _composed(work, so_far)
    # a block as a whole maps states like a line does
    last = lambda c: F.max_by(c, "line").alias(c)
    blocks = (work.groupBy("file", "block").agg(last("swaps"), F.max_by("settled", "line").alias("settled"))
              .select("file", "block", _after(F.lit(0)).alias("f0"), _after(F.lit(1)).alias("f1")))
    order = Window.partitionBy("file").orderBy("block")
    blocks = _composed(blocks, order.rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.withColumn("after", _after(F.lit(0))).select(
        "file", "block", F.coalesce(F.lag("after").over(order), F.lit(0)).alias("begin"))
    work = work.join(_sized(_kept(blocks, "block-states")), ["file", "block"])
    work = work.withColumn("after", _after(F.col("begin"))).withColumn("before", F.coalesce(F.lag("after").over(block), "begin"))
    start = F.when(F.col("before") == 0, F.struct("block", "line"))
    work = _kept(work.withColumn("own", F.last(start, ignorenulls=True).over(so_far)), "quote-states")
    ends = work.groupBy("file", "block").agg(F.max("own").alias("own"))
    carried = ends.select("file", "block", F.last("own", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    work = work.join(_sized(_kept(carried, "block-starts")), ["file", "block"])
    return work.withColumn("record", F.coalesce("own", "earlier")).drop(
        "f0", "f1", "swaps", "settled", "begin", "before", "own", "earlier")


def _composed(df: DataFrame, so_far) -> DataFrame:
    """``swaps`` so far, and ``settled``: the last row that ends in one state whatever came before, with the swaps up to it."""
    df = df.withColumn("swaps", F.sum(F.when((F.col("f0") == 1) & (F.col("f1") == 0), 1).otherwise(0)).over(so_far))
    fixed = F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("state"), F.col("swaps").alias("swaps")))
    return df.withColumn("settled", F.last(fixed, ignorenulls=True).over(so_far))


def _after(begin: Column) -> Column:
    """State behind a row, from the state its group begins in."""
    return F.when(F.col("settled").isNull(), (begin + F.col("swaps")) % 2).otherwise(
        (F.col("settled.state") + F.col("swaps") - F.col("settled.swaps")) % 2).cast("int")


# ---- typed rows ------------------------------------------------------------------------------

def read_landed(lines: DataFrame, schema: T.StructType, sep: str | None = None, header_offset: int | None = None,
                layout: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantine (file, raw_line, reason)) of landed lines.

    With ``layout`` (from ``detect_layout``) each file has its own separator and header offset;
    otherwise ``sep`` holds for all, and ``header_offset`` lines and the header line are left out of each file
    (None: there is no header). Files that the layout does not list go to the quarantine.
    Blank lines are left out, short records are padded with nulls, a value that does not parse is null; records with too many fields,
    and lines of a quote that is never closed, are quarantined.
    """
    if layout is not None:
        lines = lines.join(_sized(layout.select("file", "sep", F.col("header_offset").alias("_skip"))), "file", "left")
    else:
        lines = lines.withColumn("sep", F.lit(sep)).withColumn("_skip", F.lit(-1 if header_offset is None else header_offset))
    if layout is not None or header_offset is not None:
        top = heads(lines).filter(F.col("position") == F.col("_skip")).select(
            "file", F.struct("block", "line").alias("_top"))
        lines = lines.join(_sized(_kept(top, "headers")), "file", "left").filter(
            F.col("_top").isNull() | (F.struct("block", "line") > F.col("_top"))).drop("_top")
    lines = lines.drop("_skip")
    found = records(lines.withColumn("sep", F.coalesce("sep", F.lit("\n"))), F.col("sep")).filter(F.trim("value") != "")
    reason = (F.when(F.col("sep") == "\n", "no layout").when(F.col("problem").isNotNull(), F.col("problem"))
              .when(n_fields(F.col("value"), F.col("sep")) > len(schema.fields), "too many fields"))
    found = found.withColumn("reason", reason)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    seps = CANDIDATE_SEPARATORS if layout is not None else (sep,)
    parsed = reduce(lambda rest, s: F.when(F.col("sep") == s, F.from_csv(
        "value", ddl, {"sep": s, "mode": "PERMISSIVE", "escape": '"', "lineSep": "\x00"})).otherwise(rest),
        reversed(seps), F.lit(None).cast(schema))
    good = found.filter("reason is null").select(parsed.alias("r")).select("r.*")
    return good, found.filter("reason is not null").select("file", F.col("value").alias("raw_line"), "reason")
