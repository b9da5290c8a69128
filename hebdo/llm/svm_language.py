"""Language identification in two steps: family, then one-versus-one linear SVMs.

Character uni-, bi- and trigrams of the whole lower-cased text (runs of
non-letters become one blank) are counted into hashed cells. Learned from text and language
alone: languages whose centroids are closer than the mean pair form one
family; a linear SVM per pair of families, and one per pair of languages
inside a family, are fitted by sub-gradient descent, each pair as one Spark
task on a bounded sample. Prediction votes among families first, then among the
languages of that family only.

Defined results: a text that is null or has no letter (Unicode category L; numerals such as a half or a
Roman eight are none) is ``und`` with score 0;
with no training rows every text is ``und``. Ties go to the larger summed
margin, then the smaller name. Rows are judged one by one, repeated ones alike, very long texts whole; an empty
table gives no rows. Only the id, text and language columns are read; other columns are neither used nor returned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import id_bucket, stage, with_workers

#: Bound on the training documents of each language.
MAX_PER_LANGUAGE = 600
#: Bound on the languages learned, the most frequent ones: every pair of a family gets a machine.
MAX_LANGUAGES = 256
CELLS = 1 << 12
GAP = re.compile(r"[\W\d_]+")


def profile(text: str | None) -> np.ndarray | None:
    """Unit-length vector of damped gram counts; None without letters."""
    s = GAP.sub(" ", text.lower()).strip() if text else ""
    if not any(map(str.isalpha, s)):
        return None
    c = np.frombuffer(f" {s} ".encode("utf-32-le"), np.uint32)
    one = c * np.uint32(2654435761)
    two = (one[:-1] ^ (c[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two[:-1] ^ (c[2:] * np.uint32(668265263))) * np.uint32(374761393)
    grams = np.concatenate([one, two, three]) >> np.uint32(20)
    x = np.sqrt(np.bincount(grams, minlength=CELLS)).astype(np.float32)
    return x / np.linalg.norm(x)


def pieces(text: str, words: int = 12, most: int = 4) -> list[str]:
    """The text itself, and runs of a few words spread over all of it, so short texts are learned too."""
    w = text.split()
    if len(w) <= words:
        return [text]
    starts = np.unique(np.linspace(0, len(w) - words, most).astype(int))
    return [text] + [" ".join(w[i:i + words]) for i in starts]


def fit_pair(x: np.ndarray, y: np.ndarray, passes: int = 12, lam: float = 1e-5, seed: int = 1) -> np.ndarray:
    """Weights and bias of a linear SVM (hinge loss, averaged mini-batch sub-gradients)."""
    rng, w, mean, t = np.random.default_rng(seed), np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    for _ in range(passes):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            t += 1
            bad = at[y[at] * (x[at] @ w[:-1] + w[-1]) < 1]
            rate = 2.0 / (1 + 0.02 * t)
            w *= 1 - lam * rate
            if len(bad):
                w[:-1] += rate / len(at) * (y[bad] @ x[bad])
                w[-1] += rate / len(at) * y[bad].sum()
            mean += (w - mean) / t
    return mean


@dataclass(frozen=True)
class LanguageModel:
    families: tuple  # of tuples of languages
    pairs: tuple     # (group a, group b) each a tuple of languages
    weights: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1] if len(self.pairs) else []
        at = {p: m for p, m in zip(self.pairs, margins)}
        family, a = vote(self.families, at)
        lang, b = vote(tuple((v,) for v in family), at)
        return lang[0], a * b


def vote(options: tuple, margins: dict) -> tuple[tuple, float]:
    """The option that wins most pairs, and the logistic of its narrowest margin."""
    if len(options) == 1:
        return options[0], 1.0
    own = {o: [] for o in options}
    for a, b in combinations(options, 2):
        m = margins[a, b]
        own[a].append(m)
        own[b].append(-m)
    best = min(options, key=lambda o: (-sum(m > 0 for m in own[o]), -sum(own[o]), o))
    return best, float(1 / (1 + np.exp(-4 * np.clip(min(own[best]), -8, 8))))


def make_families(centroids: dict[str, np.ndarray]) -> tuple:
    """Single-link groups of languages whose centroids are closer than the mean pair."""
    names = sorted(centroids)
    sims = {(a, b): float(centroids[a] @ centroids[b]) for a, b in combinations(names, 2)}
    group = {v: v for v in names}
    if len(names) > 2:
        mean = sum(sims.values()) / len(sims)
        for (a, b), s in sorted(sims.items(), key=lambda p: (-p[1], p[0])):
            if s > mean and len(set(group.values())) > 2:
                old, new = group[b], group[a]
                group = {v: new if g == old else g for v, g in group.items()}
    else:
        group = {v: "all" for v in names}
    return tuple(sorted(tuple(v for v in names if group[v] == g) for g in set(group.values())))


def train(docs: DataFrame, held_mod: int = 4, held_rest: int = 2, per_language: int = MAX_PER_LANGUAGE,
          languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Families and pairwise SVMs from a bounded hashed sample outside the held-out fold."""
    import pandas as pd
    spark = with_workers(docs.sparkSession)
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
                        & (id_bucket("doc_id", held_mod) != held_rest))
    most = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    if not counts:
        return LanguageModel((), (), np.zeros((0, CELLS + 1)))
    grain = 1_000_000
    share = F.create_map(*[F.lit(v) for lang, n in counts.items()
                           for v in (lang, int(grain * min(1.0, per_language / n)))])
    rows = stage(known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share[F.col("lang")])
                 .select("lang", "text", F.xxhash64("doc_id").alias("h")), "language-sample")

    def centroid(batches):
        total = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                x = profile(text)
                if x is not None:
                    total[lang] = total.get(lang, 0) + x.astype(np.float64)
        yield pd.DataFrame({"lang": list(total), "x": [v.tolist() for v in total.values()]})

    sums: dict[str, np.ndarray] = {}
    for r in rows.mapInPandas(centroid, "lang string, x array<double>").toLocalIterator():
        sums[r["lang"]] = sums.get(r["lang"], 0) + np.array(r["x"])
    families = make_families({v: x / np.linalg.norm(x) for v, x in sums.items()})
    pairs = list(combinations(families, 2))
    for f in families:
        pairs += combinations(tuple((v,) for v in f), 2)
    pairs = list(dict.fromkeys(pairs))
    sides = [(lang, i, 1 if lang in a else -1) for i, (a, b) in enumerate(pairs) for lang in (*a, *b)]
    if not sides:
        return LanguageModel(families, (), np.zeros((0, CELLS + 1)))
    side = F.broadcast(spark.createDataFrame(sides, "lang string, pair int, y int"))

    def fit(pdf):
        x, y = [], []
        for text, sign in zip(pdf["text"], pdf["y"]):
            for part in pieces(text):
                v = profile(part)
                if v is not None:
                    x.append(v)
                    y.append(sign)
        return pd.DataFrame({"pair": [int(pdf["pair"].iloc[0])], "w": [fit_pair(np.stack(x), np.array(y, float)).tolist()]})

    fitted = (rows.join(side, "lang").sort("h").groupBy("pair").applyInPandas(fit, "pair int, w array<double>")
              .collect())
    weights = np.zeros((len(pairs), CELLS + 1))
    for r in fitted:
        weights[r["pair"]] = r["w"]
    return LanguageModel(families, tuple(pairs), weights)


def predict(docs: DataFrame, model: LanguageModel, held_mod: int = 4, held_rest: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    spark = with_workers(docs.sparkSession)
    shared = spark.sparkContext.broadcast((model.families, model.pairs, model.weights.astype(np.float32)))

    def run(batches):
        import pyarrow as pa
        m = LanguageModel(*shared.value)
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                x = profile(text) if m.families else None
                found.append(("und", 0.0) if x is None else m.predict(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
           .mapInArrow(run, "doc_id long, lang_pred string, score double"))
    return out.select("doc_id", F.coalesce(id_bucket("doc_id", held_mod) == held_rest, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
