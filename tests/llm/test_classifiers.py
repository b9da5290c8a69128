"""Quality rules, toxicity and language: held-out accuracy on the given tables, edges on small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hebdo.llm import ftrl_toxicity as tox
from hebdo.llm import rules_quality as rq
from hebdo.llm import svm_language as lang
from hebdo.llm.common import read
from tests.conftest import SF_CHECK
from tests.llm.helpers import docs, edge_rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    return read(spark, SF_CHECK, "documents"), read(spark, SF_CHECK, "labels")


def test_quality_held_out(spark, tables):
    d, lab = tables
    got = rq.score(d, rq.train(d, lab)).join(lab, "doc_id").filter("held_out").select("predicted", "quality").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.95
    assert (got.predicted[got.quality == 1] == 1).mean() >= 0.95


def test_quality_edges_and_clashes(spark, tables):
    model = rq.train(*tables)
    got = rq.score(docs(spark, edge_rows(), clash=True), model).collect()
    assert len(got) == len(edge_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len({r["score"] for r in got if r["text"] == edge_rows()[6][1]}) == 1
    assert got[0]["class"] == "mine"


def test_quality_without_or_with_one_class(spark):
    empty = docs(spark, [])
    assert rq.score(empty, rq.train(empty, labels(spark, []))).count() == 0
    one = docs(spark, [(i, f"text number {i}") for i in range(20)])
    model = rq.train(one, labels(spark, [(i, 1, 0) for i in range(20)]))
    assert model.rules == () and rq.score(one, model).filter("score > 0.5").count() == 20


def test_rules_are_column_expressions(tables):
    """Scoring is one projection over the scan: no Python, no exchange."""
    model = rq.train(*tables)
    plan = rq.score(tables[0], model)._jdf.queryExecution().executedPlan().toString()
    assert model.rules and "Python" not in plan and "Exchange" not in plan


def test_tree_paths_are_conjunctions():
    text = "If (feature 0 <= 0.5)\n If (feature 1 <= 2.0)\n  Predict: 0.0\n Else (feature 1 > 2.0)\n  Predict: 1.0\nElse (feature 0 > 0.5)\n Predict: 1.0"
    assert rq.tree_paths(text, ["a", "b"]) == {
        (("a", "<=", 0.5),), (("a", ">", 0.5),), (("a", "<=", 0.5), ("b", "<=", 2.0)), (("a", "<=", 0.5), ("b", ">", 2.0))}


def test_toxicity_learns_words_and_ignores_the_held_out_fold(spark):
    rng = np.random.default_rng(0)
    vocab = [f"w{i}" for i in range(200)]
    rows, lab = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = list(rng.choice(vocab, 40)) + (["vile"] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        lab.append((i, 1, int(bad)))
    d, lab = docs(spark, rows), labels(spark, lab)
    model = tox.train(d, lab)
    got = tox.score(d, model).join(lab, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.toxic).mean() >= 0.95
    assert len(model.cells) < 2_000  # sparse
    flipped = lab.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tox.train(d, flipped)
    assert np.array_equal(model.cells, again.cells) and np.allclose(model.values, again.values)


def test_toxicity_edges(spark):
    model = tox.train(docs(spark, []), labels(spark, []))
    got = tox.score(docs(spark, edge_rows(), clash=True), model).collect()
    assert len(got) == len(edge_rows()) and all(r["score"] == 0.5 for r in got)


def test_a_long_text_sets_few_of_the_cells():
    """A clean text of 20,000 words meets few weights of strangers by chance."""
    text = " ".join(f"w{i}" for i in range(20_000))
    assert len(tox.Hasher(tox.BITS).cells(text)) < 0.06 * (1 << tox.BITS)


def test_packed_state_comes_back():
    at = np.array([0, 3, 4, 999])
    rows = tox.packed(2, at, 1000, at.astype(np.float32), -at.astype(np.float32))
    back, (a, b) = tox.unpacked(rows, 1000, "f4", "a", "b")
    assert back.tolist() == at.tolist() == a.tolist() and (b == -a).all() and set(rows["shard"]) == {2} and len(rows) == 2
    assert tox.unpacked(tox.packed(0, at[:0], 1000), 1000, "f4")[0].size == 0


def test_ftrl_step_is_the_per_coordinate_rule():
    rule, z, n = tox.Ftrl(alpha=0.15, l1=0.6, l2=0.5), np.zeros(4), np.zeros(4)
    rule.step(z, n, np.array([1, 3]), 1.0)
    assert z.tolist() == [0, -0.5, 0, -0.5] and n.tolist() == [0, 0.25, 0, 0.25]
    assert rule.weights(z, n).tolist() == [0, 0, 0, 0]  # within the L1 bound
    rule.step(z, n, np.array([1]), 1.0)
    w = rule.weights(z, n)
    assert w[1] == pytest.approx((1.0 - rule.l1) / ((rule.beta + np.sqrt(0.5)) / rule.alpha + rule.l2)) and w[3] == 0


def test_language_held_out(spark, tables):
    d, _ = tables
    got = lang.predict(d, lang.train(d)).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_language_edges(spark, tables):
    model = lang.train(tables[0])
    got = lang.predict(docs(spark, edge_rows(), clash=True), model).collect()
    assert len(got) == len(edge_rows())
    assert sorted(r["lang_pred"] for r in got).count("und") == 5
    none = lang.train(docs(spark, []))
    assert {r["lang_pred"] for r in lang.predict(docs(spark, edge_rows()), none).collect()} == {"und"}


@pytest.mark.parametrize("text", ["½", "²³ ²", "Ⅷ", "٣٤", "12 ½ ___ !"])
def test_numerals_are_no_letters(text):
    assert lang.profile(text) is None and lang.profile(text + " a") is not None


def test_predictions_match_a_plain_vote(spark, tables):
    """Every document's language by counting the pairwise margins in plain Python."""
    d, _ = tables
    model = lang.train(d)
    at = {p: w for p, w in zip(model.pairs, model.weights.astype(np.float32))}

    def winner(options, x):
        wins = {o: [0, 0.0] for o in options}
        for (a, b), w in at.items():
            if a in wins and b in wins:
                m = float(x @ w[:-1] + w[-1])
                wins[a if m > 0 else b][0] += 1
                wins[a][1] += m
                wins[b][1] -= m
        return min(options, key=lambda o: (-wins[o][0], -wins[o][1], o))

    got = {r["doc_id"]: r["lang_pred"] for r in lang.predict(d, model).collect()}
    for r in d.collect():
        x = lang.profile(r["text"])
        want = "und" if x is None else winner([(v,) for v in winner(model.families, x)], x)[0]
        assert got[r["doc_id"]] == want


def test_languages_learned_are_bounded(spark):
    rows = docs(spark, [(i, f"some words in tongue {chr(97 + i % 7) * 4}") for i in range(200)])
    many = rows.withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 7).cast("string")))
    assert sum(map(len, lang.train(many, languages=3).families)) == 3


def test_language_steps():
    near = {"a": np.array([1.0, 0, 0]), "b": np.array([0.9, 0.1, 0]), "c": np.array([0, 0, 1.0]), "d": np.array([0, 0.1, 0.9])}
    assert lang.make_families(near) == (("a", "b"), ("c", "d"))
    assert lang.vote((("a",), ("b",)), {(("a",), ("b",)): -1.0})[0] == ("b",)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 5)).astype(np.float32)
    y = np.where(x[:, 0] > 0, 1.0, -1.0)
    w = lang.fit_pair(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.95
