"""Embedding near duplicates, connected components and WARC archives on small frames."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import types as T

from hebdo.llm import nn_descent as nn
from hebdo.llm import warc_writer as warc
from hebdo.llm.graph import components
from hebdo.sources.files import scratch_path

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def brute(rows, threshold=0.98):
    good = [i for i, (v, x, lab) in enumerate(rows) if v is not None and lab is not None and x
            and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    unit = {i: np.float32(rows[i][1]).astype(float) / np.linalg.norm(np.float32(rows[i][1]).astype(float)) for i in good}
    links, parent = [0] * len(rows), list(range(len(rows)))
    for i, j in itertools.combinations(good, 2):
        if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
            links[i] += 1
            links[j] += 1
            a, b = nn.root(parent, i), nn.root(parent, j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            r = nn.root(parent, i)
            least[r] = min(least.get(r, v), v)
    return [(v, links[i], least.get(nn.root(parent, i)), v is None or least[nn.root(parent, i)] == v) for i, (v, _, _) in enumerate(rows)]


@pytest.mark.parametrize("tile", [1024, 40])
def test_links_match_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(nn, "TILE", tile)
    rng = np.random.default_rng(4)
    base = rng.standard_normal(16)
    rows = []
    for i in range(400):
        x = base + rng.standard_normal(16) * 0.12 if i % 3 == 0 else rng.standard_normal(16)
        rows.append((i, [float(c) for c in x], int(i % 2)))
    for i in range(0, 40, 2):  # pairs close to others, and exact copies
        rows.append((500 + i, [c * (1 + 0.01 * ((i + k) % 3)) for k, c in enumerate(rows[i + 1][1])], rows[i + 1][2]))
        rows.append((700 + i, list(rows[3][1]), rows[3][2]))
    got = nn.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted(brute(rows))
    assert got[0]["audit_recall"] >= 0.9


def test_rare_links_are_all_found_when_the_search_misses_them(spark, monkeypatch):
    """A search too weak for the table: links that the audit is too small to judge, or sees missing, come from the exact pass."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.standard_normal(16)], int(i % 2)) for i in range(600)]
    rows += [(1000 + i, [c * (1 + 0.02 * (k % 3)) for k, c in enumerate(rows[i][1])], rows[i][2]) for i in range(0, 600, 150)]
    chain = [rng.standard_normal(16), rng.standard_normal(16)]
    rows += [(2000 + i, [float(c) for c in chain[0] * np.cos(i / 9) + chain[1] * np.sin(i / 9)], 0) for i in range(12)]
    want = sorted(brute(rows))
    for name, value in (("BLOCK", 2), ("ORDERS", 1), ("ROUNDS", 0), ("STARTS", 2), ("WIDE", 100), ("STRIP", 30)):
        monkeypatch.setattr(nn, name, value)
    for need in (1000, 1):  # too few links to measure a recall; recall measured and too low
        monkeypatch.setattr(nn, "AUDIT_LINKS", need)
        got = nn.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
        assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == want


def test_large_labels_are_never_compared_pair_by_pair(spark, monkeypatch):
    """One linked vector in hundreds, labels beyond the bound: NN-descent alone gives the whole result, and says its recall."""
    rng = np.random.default_rng(11)
    rows = [(i, [float(c) for c in rng.standard_normal(16)], int(i % 2)) for i in range(1400)]
    rows += [(5000 + i, [c * (1 + 0.01 * (k % 3)) for k, c in enumerate(rows[i][1])], rows[i][2]) for i in range(0, 1400, 350)]
    want = sorted(brute(rows))
    monkeypatch.setattr(nn, "EXACT_ROWS", 100)
    monkeypatch.setattr(nn, "exact_edges", lambda *_: pytest.fail("all pairs of a large label"))
    got = nn.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == want
    assert got[0]["audit_recall"] == 1.0 and sum(r["n_links"] for r in got) == 8


@pytest.mark.parametrize("bound", [10, 10**6])
def test_the_exact_pass_follows_what_was_found_not_a_size(spark, monkeypatch, bound):
    """Labels on either side of the bound: a search that found all needs no exact pass, one that misses links gets it whole."""
    rng = np.random.default_rng(21)
    rows = [(i, [float(c) for c in rng.standard_normal(16)], int(i % 2)) for i in range(240)]
    rows += [(1000 + i, [c * (1 + 0.02 * (k % 3)) for k, c in enumerate(rows[i][1])], rows[i][2]) for i in range(60)]
    want = sorted(brute(rows))
    monkeypatch.setattr(nn, "EXACT_ROWS", bound)
    passes, exact = [], nn.exact_edges
    monkeypatch.setattr(nn, "exact_edges", lambda *a: passes.append(1) or exact(*a))

    def found():
        got = nn.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
        assert {r["audit_recall"] for r in got} == {1.0}
        return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got)

    assert found() == want and not passes
    # a weak search, and an audit that sees only a part of the links
    for name, value in (("BLOCK", 2), ("ORDERS", 1), ("ROUNDS", 0), ("STARTS", 2), ("AUDIT", (40,)), ("AUDIT_LINKS", 1)):
        monkeypatch.setattr(nn, name, value)
    assert found() == want and passes


def test_a_recall_below_the_floor_fails(spark, monkeypatch):
    rng = np.random.default_rng(12)
    base = [[float(c) for c in rng.standard_normal(16)] for _ in range(150)]
    rows = [(i, v, 1) for i, v in enumerate(base)] + [(1000 + i, [c * (1 + 0.01 * (k % 3)) for k, c in enumerate(v)], 1) for i, v in enumerate(base)]
    for name, value in (("EXACT_ROWS", 100), ("FLOOR", 1.1), ("STARTS", 1)):
        monkeypatch.setattr(nn, name, value)
    with pytest.raises(RuntimeError, match="links audited"):
        nn.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()


def test_very_small_and_large_components_keep_their_direction():
    x = nn.unit([np.array(v, "f8").tobytes() for v in ([1e-200, 2e-200], [1e200, 2e200], [1.0, 2.0])], "f8")
    assert np.allclose(x @ x.T, 1)


def test_audit_without_links_reports_no_recall(spark):
    rows = [(i, [float(i == k) for k in range(12)], 1) for i in range(12)]
    got = nn.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert all(r["audit_recall"] is None and r["n_links"] == 0 for r in got)


def test_search_grows_with_the_largest_label():
    small, large = nn.search_size(5_000, 0.98), nn.search_size(10**8, 0.98)
    assert small == (6, 12, 3) and all(b > a for a, b in zip(small, large))


def test_vector_edges(spark):
    one = [1.0, 2.0]
    rows = [(1, one, 1), (2, one, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1),
            (8, [float("inf"), 1.0], 1), (9, [2.0, 4.0], 1), (9, one, 1), (9, one, 1), (None, one, 1), (10, [1.0, 2.0, 0.0], 1), (11, one, 2)]
    df = spark.createDataFrame(rows, VECTORS)
    for c in ("node", "grp", "component", "n_links"):
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("mine"))
    key = lambda r: tuple(map(str, r))
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in nn.near_duplicates(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert nn.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160)) and 200 not in got


PAGES = "page_id long, url string, html string"


def brute_pages(rows):
    best = {}
    for p, u, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            best[b] = max(best.get(b, (-1, "")), (-1 if p is None else p, u or ""))
    out, given = [], set()
    for p, u, h in rows:
        b = (h or "").encode()
        me = (-1 if p is None else p, u or "")
        revisit = b in best and (me != best[b] or b in given)
        if b in best and me == best[b]:
            given.add(b)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", best[b][0] if revisit else None))
    return out


def page_rows():
    big, long = "x" * 1000, "ü" * 300_000
    return [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/4", "x" * 999), (5, "http://a/5", "x" * 999),
            (6, "u v\r\nWARC: x", ""), (7, "http://b", None), (None, "http://c", "<html>"), (8, "http://a/1", long), (9, "http://z", "\r\n\r\nWARC/1.1"),
            (10, "http://r", big * 2), (10, "http://r", big * 2), (10, "http://r", big * 2)]


def test_archive_reads_back(spark):
    rows = page_rows()
    df = spark.createDataFrame(rows, PAGES)
    manifest, folder = warc.archive(df)
    got = warc.read(manifest, folder).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(
        brute_pages(rows), key=key)
    for r in got:
        assert r["payload"] is None if r["record_type"] == "revisit" else hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"]
    assert {(r["page_id"], r["url"]) for r in got} == {(p, u or "") for p, u, _ in rows}


def test_archive_is_deterministic_and_rolls(spark):
    df = spark.createDataFrame([(i, f"http://h/{i % 5}", f"<p>{i}" * 300) for i in range(300)], PAGES)
    files = []
    for parts in (1, 7):
        folder = scratch_path(spark, "warc-test")
        m = warc.write(df.repartition(parts), folder, roll_bytes=2_000, shards=4)
        files.append(sorted(map(tuple, m.collect())))
        assert warc.read(m, folder).count() == 300
    assert files[0] == files[1] and len(files[0]) > 8 and sum(f[1] for f in files[0]) == 300


@pytest.mark.parametrize("n, shards", [(0, 4), (1, 3), (5, 9), (300, 7), (300, 1)])
def test_shard_bounds_cut_the_sorted_keys_evenly(spark, n, shards):
    rows = [(i, f"http://h/{i * 7 % 5}" if i % 9 else None, "x") for i in range(n)]
    want = sorted((u or "", p) for p, u, _ in rows)
    want = sorted({want[n * k // shards] for k in range(1, shards)}) if n else []
    for parts in (1, 6):
        assert warc.shard_bounds(spark.createDataFrame(rows, PAGES).repartition(parts), shards) == want


def test_a_hot_url_is_split_and_no_bound_is_in_the_plan(spark, monkeypatch):
    plans, df = [], spark.createDataFrame([(i, "http://hot", "x") for i in range(400)], PAGES)
    keep = type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, *a: (plans.append(self), keep(self, *a))[1])
    files = [r["file"] for r in warc.write(df, scratch_path(spark, "warc-hot"), shards=8).collect()]
    assert len({f[:12] for f in files}) == 8
    assert "http://hot" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()


def test_damaged_record_is_found():
    import io
    data = warc.record("1", "http://a", b"payload", hashlib.sha1(b"payload").hexdigest(), None, 7)
    [(head, block)] = list(warc.records(io.BytesIO(data)))
    assert block.endswith(b"payload") and head["WARC-Type"] == "response" and int(head["Content-Length"]) == len(block)
    two = list(warc.records(io.BytesIO(data + data), chunk=7))
    assert len(two) == 2


def test_empty_archive(spark):
    manifest, folder = warc.archive(spark.createDataFrame([], PAGES))
    assert manifest.count() == 0 and warc.read(manifest, folder).count() == 0
