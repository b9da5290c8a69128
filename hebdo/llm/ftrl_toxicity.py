"""Toxicity classifier: FTRL-proximal logistic regression on hashed word features.

Features of a text are the set of its lower-cased words, adjacent word pairs,
and pairs with one word between, hashed into ``2**bits`` cells. The cells that enough texts have are
numbered densely, and training keeps FTRL state (z, n) for them only: per-coordinate rates fall with the squared gradients seen,
and the L1 term leaves most weights exactly 0, so the model is a short list of
cells that is cheap to broadcast (never more than ``2**bits`` weights).

The bounded labelled sample is dealt into shards; each runs FTRL over its rows
from the common state, the states are averaged per cell in Spark, and the next
pass starts from the average. States travel as packed arrays, one row for a range of cells. Scoring is a ``mapInArrow`` over whole texts.

Defined results: null texts, empty texts and texts without words have no features; their score
is the bias alone. Rows are scored one by one, so ties and repeats get equal scores.
With no training rows the score is 0.5.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import id_bucket, labelled_sample, stage, with_workers

#: Bound on the labelled rows the model is fitted on.
MAX_TRAIN = 30_000
BITS = 20
#: Ranges of cells that travel as one row.
RANGES = 64
WORD = re.compile(r"[^\W_]+")
PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Hasher:
    """Feature cells of a text; word hashes are remembered up to a bound."""

    def __init__(self, bits: int, memory: int = 500_000):
        self.mask, self.memory, self.known = np.uint64((1 << bits) - 1), memory, {}

    def word(self, w: str) -> int:
        import xxhash
        h = self.known.get(w)
        if h is None:
            if len(self.known) >= self.memory:
                self.known.clear()
            h = self.known[w] = xxhash.xxh64_intdigest(w)
        return h

    def cells(self, text: str | None) -> np.ndarray:
        words = WORD.findall(text.lower()) if text else []
        if not words:
            return np.empty(0, np.int64)
        h = np.fromiter(map(self.word, words), np.uint64, len(words))
        parts = [h, h[:-1] * PAIR + h[1:], h[:-2] * SKIP + h[2:]]
        mixed = np.concatenate(parts)
        mixed ^= mixed >> np.uint64(29)
        return np.unique((mixed & self.mask).astype(np.int64))


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, z: np.ndarray, n: np.ndarray, cells: np.ndarray, label: float) -> None:
        zi, ni = z[cells], n[cells]
        w = self.weights(zi, ni)
        p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / self.alpha
        z[cells] = zi + g - sigma * w
        n[cells] = ni + g * g


@dataclass(frozen=True)
class ToxicModel:
    cells: np.ndarray
    values: np.ndarray
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros((1 << self.bits) + 1)
        w[self.cells] = self.values
        return w


def packed(shard: int, at: np.ndarray, size: int, *values: np.ndarray):
    """Values at the sorted places ``at`` below ``size``: a row (shard, part, mask, a, b) for each range of places that has any."""
    import pandas as pd
    width, out = -(-size // RANGES), []
    edges = np.searchsorted(at, np.arange(RANGES + 1) * width)
    for k, (i, j) in enumerate(zip(edges, edges[1:])):
        if i < j:
            mask = np.zeros(width, bool)
            mask[at[i:j] - k * width] = True
            out.append((int(shard), k, np.packbits(mask).tobytes(), *(v[i:j].tobytes() for v in values)))
    return pd.DataFrame(out, columns=["shard", "part", "mask", *"ab"[:len(values)]])


def unpacked(rows, size: int, kind: str, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and values of packed rows, one after the other."""
    width = -(-size // RANGES)
    at = [k * width + np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8), count=width)) for k, m in zip(rows["part"], rows["mask"])]
    return np.concatenate([np.empty(0, np.int64), *at]), [np.frombuffer(b"".join(rows[c]), kind) for c in names]


def fit(sample: DataFrame, bits: int = BITS, passes: int = 4, shard_rows: int = 4_000, min_docs: int = 3,
        rule: Ftrl = Ftrl()) -> ToxicModel:
    """FTRL with state averaging over (doc_id, text, label) rows; ``sample`` must be bounded.

    Cells seen in fewer than ``min_docs`` of its texts take no part: a pair of words that
    one text alone has would only learn that text by heart.
    """
    spark = with_workers(sample.sparkSession)
    rows = stage(sample.select("text", F.col("label").cast("double").alias("label"), F.xxhash64("doc_id").alias("h")),
                 "toxic-sample")
    # shards follow from the rows alone, whatever the number of partitions
    shards = max(1, rows.count() // shard_rows)
    # dealt once: every pass reads the texts where they are
    rows = rows.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).repartitionByRange(2 * shards, "shard").persist(StorageLevel.DISK_ONLY)

    def seen_in(pdf):
        hasher, n = Hasher(bits), np.zeros(1 << bits, np.int32)
        for text in pdf["text"]:
            n[hasher.cells(text)] += 1
        at = np.flatnonzero(n)
        return packed(pdf["shard"].iloc[0], at, 1 << bits, n[at])

    def usual_in(pdf):
        at, (n,) = unpacked(pdf, 1 << bits, "i4", "a")
        cells, place = np.unique(at, return_inverse=True)
        return packed(0, cells[np.bincount(place, n, len(cells)) >= min_docs], 1 << bits)

    def collected(found, size, kind, *names):
        out = found.select("part", "mask", *names).collect()
        return unpacked({c: [r[c] for r in out] for c in ("part", "mask", *names)}, size, kind, *names)

    cells, _ = collected(rows.groupBy("shard").applyInPandas(seen_in, "shard int, part int, mask binary, a binary")
                         .groupBy("part").applyInPandas(usual_in, "shard int, part int, mask binary"), 1 << bits, "i4")
    cells = np.sort(cells)  # dense number of a cell: its place here
    bias = len(cells)       # the number after them
    allowed = spark.sparkContext.broadcast(cells)
    z, n = np.zeros(bias + 1, np.float32), np.zeros(bias + 1, np.float32)
    for turn in range(passes):
        start = spark.sparkContext.broadcast((z, n))

        def train(pdf):
            z, n = (a.astype(np.float64) for a in start.value)
            hasher, touched = Hasher(bits), np.zeros(bias + 1, bool)
            number = np.full(1 << bits, -1, np.int32)
            number[allowed.value] = np.arange(bias)
            pdf = pdf.sort_values(["h", "text"], kind="stable")
            order = np.argsort([hash((int(x), turn)) for x in pdf["h"]], kind="stable")
            for text, label in zip(pdf["text"].to_numpy()[order], pdf["label"].to_numpy()[order]):
                at = number[hasher.cells(text)]
                at = np.append(at[at >= 0], bias)
                rule.step(z, n, at, label)
                touched[at] = True
            at = np.flatnonzero(touched)
            return packed(pdf["shard"].iloc[0], at, bias + 1, z[at].astype(np.float32), n[at].astype(np.float32))

        def averaged(pdf):
            at, (z, n) = unpacked(pdf.sort_values("shard"), bias + 1, "f4", "a", "b")
            cells, place, times = np.unique(at, return_inverse=True, return_counts=True)
            z, n = ((np.bincount(place, v, len(cells)) / times).astype(np.float32) for v in (z, n))
            return packed(0, cells, bias + 1, z, n)

        state = "shard int, part int, mask binary, a binary, b binary"
        at, (new_z, new_n) = collected(rows.groupBy("shard").applyInPandas(train, state).groupBy("part")
                                       .applyInPandas(averaged, state), bias + 1, "f4", "a", "b")
        z, n = z.copy(), n.copy()
        z[at], n[at] = new_z, new_n
        start.unpersist()
    rows.unpersist()
    w = rule.weights(z.astype(np.float64), n.astype(np.float64))
    at = np.flatnonzero(w)
    return ToxicModel(np.append(cells, 1 << bits)[at], w[at].astype(np.float32), bits)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, bits: int = BITS) -> ToxicModel:
    return fit(labelled_sample(docs, labels, "toxic", 5, 0, max_train), bits)


def score(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    spark = with_workers(docs.sparkSession)
    weights = spark.sparkContext.broadcast((model.cells, model.values))
    bits = model.bits

    def run(batches):
        import pyarrow as pa
        w, hasher = ToxicModel(*weights.value, bits).dense(), Hasher(bits)
        for batch in batches:
            margin = np.array([w[hasher.cells(t)].sum() + w[-1] for t in batch.column("text").to_pylist()], float)
            p = 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    scored = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(run, "doc_id long, score double"))
    return scored.select("doc_id", F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
