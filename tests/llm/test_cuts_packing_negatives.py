"""Fill-in-the-middle cuts, best-fit packing and hard negatives, each against a plain Python version."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.llm import best_fit_packing as pk
from hebdo.llm import fill_in_middle as fim
from hebdo.llm import hard_negatives as hn
from hebdo.llm.common import read
from hebdo.llm.queries import op12_best_fit_packing
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, edge_rows

PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^.!?\n]*[.!?\n]|[^.!?\n]+", "word": r"[^ \n]*[ \n]|[^ \n]+", "character": r"(?s)."}


# ---- fill in the middle -------------------------------------------------------------------
@pytest.mark.parametrize("unit", PATTERNS)
def test_boundaries_match_a_regular_expression(unit):
    rng = random.Random(3)
    texts = ["", "a", "\n", "\n\n", "a\nb", "漢字\n😀 x.\n"] + ["".join(rng.choice("ab .\n!é😀1") for _ in range(rng.randrange(80)))
                                                           for _ in range(200)] + ["long line " * 9000 + "\nend"]
    units = [re.findall(PATTERNS[unit], t) for t in texts]
    found = fim.Boundaries(texts, fim.UNITS[unit])
    assert found.units().tolist() == [len(u) for u in units]
    for _ in range(4):
        k = [rng.randint(0, len(u)) for u in units]
        assert found.locate(np.array(k)).tolist() == [sum(map(len, u[:i])) for u, i in zip(units, k)]


def test_wavelet_matrix_ranks_every_class():
    rng = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 8, n).astype(np.uint8)
        m, at = fim.WaveletMatrix(s), np.arange(n + 1)
        for c in range(8):
            assert m.rank(c, at).tolist() == [int((s[:i] == c).sum()) for i in at]


def brute_fim(doc_id, text, unit="line", seed=7, rate=100, spm_rate=50):
    t = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    u = re.findall(PATTERNS[unit], t)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(u), "plain", None, None, t
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < spm_rate:
        return doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,rate,spm_rate", [("line", 100, 50), ("sentence", 60, 20), ("word", 100, 100)])
def test_cuts_and_restored_texts(spark, monkeypatch, unit, rate, spm_rate):
    monkeypatch.setattr(fim, "RUN", 500)
    rng = random.Random(8)
    rows = edge_rows()
    rows += [(100 + i, "".join(rng.choice("ab. \n<é😀") for _ in range(rng.randrange(90)))) for i in range(150)]
    rows += [(300, "holds <P> itself"), (301, "<M>\n"), (302, "x<S"), (303, "<\nP>\n<S\n>"), (304, "a\r\nb\n\n")]
    out = fim.transform(docs(spark, rows, clash=True).withColumn("form", F.lit("mine")), unit, rate=rate, spm_rate=spm_rate)
    got = out.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    # the other units' classes hold more blanks and stops than the patterns; the random rows have none of them
    seen = [i for i, _ in rows if unit == "line" or i is not None and 100 <= i < 300]
    want = sorted((brute_fim(i, t, unit, 7, rate, spm_rate) for i, t in rows if i in seen), key=key)
    assert sorted((tuple(r)[:6] for r in got if r["doc_id"] in seen), key=key) == want
    assert sorted((r["doc_id"] or -1, r["back"]) for r in got) == sorted((i or -1, t or "") for i, t in rows)
    assert fim.transform(docs(spark, [])).count() == 0


# ---- packing --------------------------------------------------------------------------------
def test_the_fullest_that_fits_is_found_and_the_fullest_closes_first():
    rng = random.Random(2)
    for most in (1, 3, 50):
        bins, free, n = pk.OpenBins(40, most), {}, 0
        for _ in range(3000):
            size = rng.randint(1, 40)
            fits = [f for f in free.values() if f >= size]
            at, offset = bins.place(size)
            if fits:
                assert free[at] == min(fits) and offset == 40 - free[at]
            else:
                assert at == n and offset == 0
                n += 1
            left = (free.pop(at) if fits else 40) - size
            if left:
                free[at] = left
                if len(free) > most:
                    gone = min(free.values())
                    gone = at if free[at] == gone else next(b for b in free if free[b] == gone and all(b != r for r, _ in bins.rests()))
                    del free[gone]
            assert sorted(bins.rests()) == sorted((b, 40 - f) for b, f in free.items())


def check_packing(rows, packed, length, whole):
    """Every document once, cut only beyond the length; sequences gapless and within it."""
    want = sorted(((i if i is not None else -1), k, s, min(length, len(ids) - s), ids[s:s + length].tobytes())
                  for i, t in rows for ids in [whole(t or "")] for k, s in enumerate(range(0, len(ids), length)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in packed) == want
    held = defaultdict(list)
    for r in packed:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in held.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= length
    return len(held), -(-sum(r["length"] for r in packed) // length)


@pytest.mark.parametrize("length,bins,parts", [(4096, 512, 3), (50, 2, 8), (16, 4, 1)])
def test_packing_keeps_every_token(spark, length, bins, parts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(pk.tokenizer_path(pk.TOKENIZER))
    whole = lambda x: np.array([*t.encode(x, add_special_tokens=False).ids, 1], np.uint32)
    odd = "It's\tTAB nbsp em ́accent Å \x1c\x85 <|endoftext|> x<|startoftext|>y ǅ İstanbul ΣΑΣ 12345 ---..."
    rows = [*edge_rows(), (20, odd), (21, "w" * 5000), (22, " lead  and \n\n trail ")]
    rows += [(30 + i, "word " * (i % 40)) for i in range(300)]
    d = docs(spark, rows, clash=True).withColumn("offset", F.lit("mine")).repartition(parts)
    packed = pk.pack(d, length=length, open_bins=bins).collect()
    used, least = check_packing(rows, packed, length, whole)
    assert used <= 1.25 * least + 1
    assert pk.pack(docs(spark, [])).count() == 0


def test_rests_of_many_tasks_are_merged(spark):
    rows = [(i, "one two three") for i in range(64)]
    packed = pk.pack(docs(spark, rows).repartition(16), length=64)
    one = packed.select("sequence_id").distinct().count()
    assert one == 4  # 64 documents of 4 tokens, in sequences of 64
    whole = pk.sequences(packed).collect()
    assert sum(r["n_pieces"] for r in whole) == 64 and all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)


def test_registered_packing_on_a_whole_table(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(pk.tokenizer_path(pk.TOKENIZER))
    got = op12_best_fit_packing(spark, SF_SMALL).collect()
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF_SMALL, "documents").collect()]
    want = []
    for (i, x), e in zip(rows, t.encode_batch([x or "" for _, x in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        want += [(i, k, s, min(4096, len(ids) - s), zlib.crc32(ids[s:s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert len({r["sequence_id"] for r in got}) <= 1.02 * sum(r["length"] for r in got) / 4096 + 1


def test_a_tokenizer_that_keeps_blanks_gets_whole_texts():
    w = pk.Words(pk.tokenizer_path("byte_bpe_50k.json"))
    assert not w.by_word and len(w.encode(["a b  c\n"])[0]) > 0 and pk.Words(pk.tokenizer_path(pk.TOKENIZER)).by_word


# ---- hard negatives ---------------------------------------------------------------------------
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def brute_negatives(rows, k=5, m=5, low=80, high=100):
    good = {(i, tuple(np.float32(v).tolist()), lab) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    q = [(i, [math.floor(256 * x) for x in v], lab, v) for i, v, lab in good]
    out = []
    for i, a, lab, v in q:
        if i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, b)), j, other) for j, b, other, w in q if len(b) == len(a) and (j, w, other) != (i, v, lab)]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, j, _ in [r for r in scored if r[2] == lab][:k]:
            band = [r for r in scored if r[2] != lab and low * p <= 100 * r[0] <= high * p][:m]
            out += [(i, j, n + 1, r[1], p, r[0]) for n, r in enumerate(band)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("block", [4096, 23])
def test_negatives_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "CANDIDATES", block)
    monkeypatch.setattr(hn, "ANCHORS", block // 3)
    rng = np.random.default_rng(6)
    base = rng.standard_normal(12)
    rows = [(i * 10, [float(x) for x in base * (i % 3) + rng.standard_normal(12)], [1, 1, 2, 3, 5][i % 5]) for i in range(300)]
    same = rows[30]
    rows += [(4000 + i, same[1], i % 3) for i in range(40)]  # a hot vector under several labels, with ties
    rows += [rows[0], (0, rows[7][1], 1), (5000, None, 1), (5100, [1.0, None], 1), (5200, [float("nan")] * 12, 1), (5300, rows[3][1], None),
             (None, rows[3][1], 1), (5400, [0.0] * 12, 1), (5500, [1.0, 2.0], 2), (5501, [1.5, 2.0], 2), (5502, [1.0, 1.9], 3),
             (5600, [], 1), (5601, [], 2), (5700, [float("inf")] * 12, 2)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("mine")).withColumn("row", F.lit(1)).withColumn("id", F.lit("x"))
    assert mined(hn.mine(df)) == brute_negatives(rows)
    assert hn.mine(spark.createDataFrame([], VECTORS)).count() == 0


def test_components_of_any_size_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i * 50, [float(np.float32(x)) for x in (rng.standard_normal(6) + 1) * 10.0 ** (i % 4 // 2 * 9)], i % 3) for i in range(60)]
    got = mined(hn.mine(spark.createDataFrame(rows, VECTORS)))
    cut = lambda s: s if -(1 << 63) <= s < 1 << 63 else None
    want = [(a, p, r, n, cut(x), cut(y)) for a, p, r, n, x, y in brute_negatives(rows)]
    assert any(w[4] is None for w in want) and any(w[4] is not None for w in want)
    key = lambda r: r[:4]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_packed_products_take_one_field_each():
    rng = np.random.default_rng(1)
    for low, high in ((-160, 160), (0, 1), (-5, -5), (-2**40, 2**40)):
        c, a = rng.integers(low, high + 1, (77, 9)), [int(x) for x in rng.integers(low, high + 1, 9)]
        p = hn.Packed(c, sum(map(abs, a)))
        assert [int(s) for s in p.scores(a)] == [sum(int(x) * y for x, y in zip(row, a)) for row in c]
