"""Landed lines: header offsets, quoted values across lines and blocks, long values, against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.session import checkpoint_dir
from hebdo.sources import ingest as IN
from hebdo.sources.files import bad_line_quarantine, scratch_path

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in "abcd"])


def folder(spark, tmp_path, files: dict):
    checkpoint_dir(spark)
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


@pytest.fixture
def tiny_blocks(spark):
    """Files cut into blocks of a few lines, so that quotes cross block ends."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "160b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def fields_of(spark, texts, sep):
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    return [r[0] for r in rows.select(IN.n_fields(F.col("value"), F.lit(sep)), "value").collect()]


def test_fields_are_counted_outside_quotes(spark):
    rng = random.Random(1)
    texts = ["", "a", "a;b", '"a;b";c', '"a""b;";c', 'a"b;c"d', '"x";"y"', '""', '"";""', 'x;""";"";y', '"a"b;c', ";;", '"'] + [
        "".join(rng.choice('ab;""') for _ in range(rng.randrange(14))) for _ in range(300)]
    want = []
    for t in texts:
        got = list(csv.reader([t + "\n"], delimiter=";"))
        want.append(len(got[0]) if got and got[0] else 1)
    assert fields_of(spark, texts, ";") == want
    tabbed = [t.replace(";", "\t") for t in texts]
    assert fields_of(spark, tabbed, "\t") == want


@pytest.mark.parametrize("seed", range(2))
def test_records_across_lines_and_blocks_match_csv(spark, tmp_path, tiny_blocks, seed):
    rng = random.Random(seed)
    files, want = {}, []
    for k in range(4):
        rows = []
        for i in range(25):
            word = lambda: "".join(rng.choice('xy;"\n ') for _ in range(rng.randrange(9)))
            rows.append([f"{k}-{i}", "p" + word().replace("\n", ""), word(), rng.choice(["", "z", word()])])
        out = io.StringIO()
        csv.writer(out, delimiter=";", lineterminator="\n", quoting=csv.QUOTE_MINIMAL if k % 2 else csv.QUOTE_ALL).writerows(rows)
        files[f"{k}.csv"] = "a;b;c;d\n" + out.getvalue()
        want += rows
    lines = IN.land_lines(spark, folder(spark, tmp_path, files))
    assert lines.select("file", "block").distinct().count() > 6
    good, bad = IN.read_landed(lines, TEXT, sep=";", header_offset=0)
    assert bad.count() == 0
    assert sorted([c or "" for c in r] for r in good.collect()) == sorted(want)


def test_stray_quotes_and_wide_records_are_quarantined(spark, tmp_path):
    files = {"stray.csv": 'a;b;c;d\n1;2;3;4\n5;"open;7;8\n9;9;9;9\n', "wide.csv": 'a;b;c;d\n1;2;3;4;5\n"x;y";2;3;4\n\n6;7\n',
             "inch.csv": 'a;b;c;d\n1;5" pipe;3;4\n', "same.csv": "a;b;c;d\na;b;c;d\n", "empty.csv": ""}
    good, bad = IN.read_landed(IN.land_lines(spark, folder(spark, tmp_path, files)), TEXT, sep=";", header_offset=0)
    assert sorted(tuple(r) for r in good.collect()) == sorted([("1", "2", "3", "4"), ("x;y", "2", "3", "4"), ("6", "7", None, None),
                                                              ("1", '5" pipe', "3", "4"), ("a", "b", "c", "d")], key=str)
    assert sorted((r["raw_line"], r["reason"]) for r in bad.collect()) == [
        ("1;2;3;4;5", "too many fields"), ('5;"open;7;8', "unclosed quote"), ("9;9;9;9", "unclosed quote")]


def test_records_beyond_the_line_bound_are_quarantined_whole(spark, tmp_path):
    files = {"a.csv": 'h;i;j;k\n"' + "\n".join("abcdef") + '";2;3;4\n1;2;3;4\n'}
    lines = IN.land_lines(spark, folder(spark, tmp_path, files))
    found = IN.records(lines, F.lit(";"), max_lines=3)
    assert found.filter("problem is not null").count() == 6 and found.filter("problem is null").count() == 2
    assert IN.records(lines, F.lit(";")).filter("value like '%a\\nb%'").count() == 1


def test_a_value_of_a_million_characters(spark, tmp_path):
    big, quotes = "x;y " * 250_000, '""' * 300_000
    files = {"big.csv": f'a;b;c;d\n1;"{big}";3;4\n2;"{quotes}";3;4\n3;"{"l" * 400_000}\n{"m" * 400_000}";3;4\n' + "4" * 1_000_000 + ";b;c;d\n"}
    path = folder(spark, tmp_path, files)
    for good, bad in (IN.read_landed(IN.land_lines(spark, path), TEXT, sep=";", header_offset=0),
                      bad_line_quarantine(spark, path, TEXT, sep=";")):
        got = {r["a"][:1]: r for r in good.collect()}
        assert got["1"]["b"] == big and got["2"]["b"] == '"' * 300_000 and len(got["3"]["b"]) == 800_001 and len(got["4"]["a"]) == 1_000_000
        assert bad.count() == 0


def test_layout_of_each_file(spark, tmp_path, tiny_blocks):
    body = lambda sep, n: "\n".join(sep.join([str(i), "x, y" if sep != "," else "x", str(i * 2)]) for i in range(n)) + "\n"
    files = {"a.csv": "k,l,m\n" + body(",", 30), "b.csv": "Report; of; the; week\nSource\n\nk;l;m\n" + body(";", 30),
             "c.csv": "t\n" * 9 + "k\tl\tm\n" + body("\t", 12), "d.csv": "k|l|m\n" + body("|", 3), "e.csv": "no table\nhere\n", "f.csv": ""}
    lines = IN.land_lines(spark, folder(spark, tmp_path, files))
    layout = IN.detect_layout(IN.header_layouts(lines))
    got = {r["file"][-5:]: (r["sep"], r["header_offset"], r["modal_fields"], r["modal_lines"]) for r in layout.collect()}
    assert got == {"a.csv": (",", 0, 3, 30), "b.csv": (";", 3, 3, 30), "c.csv": ("\t", 9, 3, 12), "d.csv": ("|", 0, 3, 3)}
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("l", T.StringType()), T.StructField("m", T.IntegerType())])
    good, bad = IN.read_landed(lines, schema, layout=layout)
    rows = [tuple(r) for r in good.collect()]
    assert len(rows) == 75 and all(m == 2 * k and l.startswith("x") for k, l, m in rows)
    assert sorted((r["raw_line"], r["reason"]) for r in bad.collect()) == [("here", "no layout"), ("no table", "no layout")]


def test_the_composed_states_equal_a_walk(spark, tiny_blocks, tmp_path):
    rng = random.Random(7)
    lines = ["".join(rng.choice('a;"') for _ in range(rng.randrange(7))) for _ in range(120)]
    landed = IN.land_lines(spark, folder(spark, tmp_path, {"walk.csv": "\n".join(lines) + "\n"}))
    got = [(r["after"], r["record"]["block"], r["record"]["line"], r["block"], r["line"]) for r in
           IN._states(landed, F.lit(";")).orderBy("block", "line").collect()]
    probe = spark.createDataFrame([(t,) for t in lines], "value string").select(
        "value", *[(IN.scan(F.col("value"), F.lit(";"), i)["mode"] == 1).cast("int").alias(f"f{int(i)}") for i in (False, True)])
    ends = {r["value"]: (r["f0"], r["f1"]) for r in probe.collect()}
    state, first, want = 0, None, []
    for t, g in zip(lines, got):
        if state == 0:
            first = g[3:]
        state = ends[t][state]
        want.append((state, *first, *g[3:]))
    assert got == want
