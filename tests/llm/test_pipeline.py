"""The pipeline, stage by stage, against plain Python over the stage's own input."""

import corpus_pipeline as cp
from hebdo.llm import phrase_index as ph
from hebdo.llm import pii_surrogate as pii
from hebdo.llm import sentencepiece_viterbi as spv
from hebdo.llm.common import read, stage
from tests.conftest import SF_SMALL
from tests.llm.helpers import CLASH, docs, edge_rows
from tests.llm.test_text_operators import brute_contamination, brute_links


def test_stages_against_brute_force(spark):
    import re

    import sentencepiece
    d = read(spark, SF_SMALL, "documents")
    cols = d.columns
    q = stage(cp.quality(spark, d, SF_SMALL), "t-q")
    assert q.columns == cols and 0 < q.count() < d.count()

    n = stage(cp.near_duplicates(spark, q, SF_SMALL), "t-n")
    rows = [(r["doc_id"], r["text"]) for r in q.select("doc_id", "text").collect()]
    assert n.columns == cols and sorted(r["doc_id"] for r in n.collect()) == sorted({c for _, _, c in brute_links(rows)})

    c = stage(cp.decontaminate(spark, n, SF_SMALL), "t-c")
    rows = [(r["doc_id"], r["text"]) for r in n.select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in read(spark, SF_SMALL, "benchmark").collect()]
    clean = sorted(r[0] for r in brute_contamination(rows, items) if not r[-1])
    assert c.columns == cols and sorted(r["doc_id"] for r in c.collect()) == clean

    p = stage(cp.private(spark, c, SF_SMALL), "t-p")
    before = {r["doc_id"]: r["text"] for r in c.collect()}
    after = {r["doc_id"]: r for r in p.collect()}
    assert p.columns == cols and set(before) == set(after)
    for i, t in before.items():
        new = after[i]["text"]
        for x in re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b[0-9a-f]{40}\b|\b\d+\.\d+\.\d+\.\d+\b", t):
            assert x not in new
        assert after[i]["n_chars"] == len(new)

    out = cp.tokenize(spark, p, SF_SMALL).collect()
    m = sentencepiece.SentencePieceProcessor(model_file=spv.MODEL)
    assert all(r["round_trip"] and r["ids"] == m.encode(after[r["doc_id"]]["text"]) for r in out) and len(out) == len(after)


def test_stages_take_edges_and_empty_tables(spark):
    for rows in (edge_rows(), []):
        d = docs(spark, rows, clash=True)
        for name, step in cp.STAGES:
            before = d
            d = stage(step(spark, d, SF_SMALL), f"edge-{name}")
            if name != cp.STAGES[-1][0]:
                assert d.columns == before.columns and d.filter(" or ".join(f"`{c}` <> 'mine'" for c in CLASH)).count() == 0
        assert d.count() <= len(rows) and "ids" in d.columns


def test_run_is_the_composition(spark):
    out = cp.run(spark, SF_SMALL)
    assert out.count() > 0 and out.filter("not round_trip").count() == 0
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "private", "tokenize"]
    assert pii.PATTERNS and ph.WINDOW == 13
