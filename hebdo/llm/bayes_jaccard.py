"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents are linked when the Jaccard similarity of their sets of five-word
shingles is at least 0.8 (fewer than five words: one shingle of all).

1. Equal texts form a class (MD5 of the text), so copies never meet each other.
2. MinHash values are banded; classes that share a band value are candidates.
   Each band value links its classes to the least of them (one row per
   class, not all pairs), and the connected candidates form a cluster.
3. Only cluster members' texts move. A cluster is cut into blocks and every pair of
   blocks is one tile. In a tile MinHash values are compared a few at a time:
   with m of n equal and a uniform prior, P(J >= t) is the lower tail of a
   Binomial(n + 1, t) at m; a pair goes when it falls below ``TOLERANCE``.
4. Pairs left are verified exactly on their shingle sets. A tile returns, per
   member, its number of linked documents and one edge of its spanning forest, never the
   pairs, so a group of g near copies gives O(g) rows per block.

With 32 bands of 6 values a pair at exactly 0.8 shares no band with probability 6e-5
(at 0.9: 4e-11), and clusters close gaps through third documents.

Defined results: null texts and texts without words link with nothing, and
stay. Class and component ids are least doc_ids (nulls last; all null: null). Of a
component one row stays: least doc_id, then least class, first of repeated rows.
"""

from __future__ import annotations

import re
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import fresh, small_side, stage, with_workers
from hebdo.llm.graph import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 6
TOLERANCE = 1e-6
STEP = 32
#: Members of one block of a tile, and its rough bound on text characters.
BLOCK, BLOCK_CHARS = 400, 3_000_000
WORD = re.compile(r"\w+")


class Shingler:
    """64-bit hashes of word shingles, and MinHash values over them."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11, memory: int = 500_000):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, self.memory, self.known = bands, rows, memory, {}
        self.mul = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.add = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def word(self, w: str) -> int:
        import xxhash
        h = self.known.get(w)
        if h is None:
            if len(self.known) >= self.memory:
                self.known.clear()
            h = self.known[w] = xxhash.xxh64_intdigest(w)
        return h

    def shingles(self, text: str | None) -> np.ndarray:
        """Ascending distinct shingle hashes."""
        words = WORD.findall(text.lower()) if text else []
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.word, words), np.uint64, len(words))
        k = min(SHINGLE, len(h))
        out = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            out = (out ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return np.unique(out + np.uint64(k))

    def signature(self, sets: list[np.ndarray]) -> np.ndarray:
        """MinHash values (uint32) of non-empty sets, one row each."""
        flat = np.concatenate(sets)
        x = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
        cuts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        out = np.empty((len(sets), len(self.mul)), np.uint32)
        for k, (a, b) in enumerate(zip(self.mul, self.add)):
            y = x * a + b
            y ^= y >> np.uint32(15)
            out[:, k] = np.minimum.reduceat(y * np.uint32(0x85EBCA6B), cuts)
        return out

    def band_keys(self, sig: np.ndarray) -> np.ndarray:
        """One int64 per band, distinct between bands."""
        s = sig.reshape(len(sig), self.bands, self.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), s.shape[:2]).copy()
        for r in range(self.rows):
            key = (key ^ s[:, :, r]) * np.uint64(0xC2B2AE3D27D4EB4F)
            key ^= key >> np.uint64(29)
        return key.view(np.int64)


def least_matches(total: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP) -> dict[int, int]:
    """n -> least number of equal values, of n compared, that keeps a pair alive."""
    out = {}
    for n in range(step, total + 1, step):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def surviving_pairs(a: np.ndarray, b: np.ndarray, same: bool, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs left after comparing signatures ``need`` step by step."""
    found_i, found_j = [], []
    first = min(need)
    for at in range(0, len(a), 64):
        eq = np.zeros((len(a[at:at + 64]), len(b)), np.uint8)
        for k in range(first):
            eq += a[at:at + 64, k, None] == b[None, :, k]
        i, j = np.nonzero(eq >= need[first])
        if same:
            keep = i + at < j
            i, j = i[keep], j[keep]
        m = eq[i, j].astype(np.int32)
        done = first
        for n in sorted(need)[1:]:
            for lo in range(0, len(i), 200_000):
                s = slice(lo, lo + 200_000)
                m[s] += (a[i[s] + at, done:n] == b[j[s], done:n]).sum(1)
            keep = m >= need[n]
            i, j, m, done = i[keep], j[keep], m[keep], n
        found_i.append(i + at)
        found_j.append(j)
    return np.concatenate(found_i or [np.empty(0, int)]), np.concatenate(found_j or [np.empty(0, int)])


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    both = int((x[at] == y).sum())
    return both / (len(x) + len(y) - both)


def root(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def candidate_clusters(docs: DataFrame) -> DataFrame:
    """(class, cluster) of the text classes that share a band value with another class; staged."""
    with_workers(docs.sparkSession)

    def bands(batches):
        import pyarrow as pa
        sh = Shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [(k, sh.shingles(t)) for k, t in zip(part.column("class").to_pylist(), part.column("text").to_pylist())]
                sets = [(k, s) for k, s in sets if len(s)]
                if not sets:
                    continue
                keys = sh.band_keys(sh.signature([s for _, s in sets]))
                flat = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in sets]), flat], ["class", "bands"])

    text = F.col("text").cast("string")
    rows = docs.filter(text != "").select(F.md5(text).alias("class"), text.alias("text"))
    rows = stage(rows.mapInArrow(bands, "class string, bands array<long>"), "bands")
    rows = rows.select("class", F.explode("bands").alias("band"))
    shared = (rows.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("most"))
              .filter("least <> most").select("band", "least"))
    edges = rows.join(shared, "band").filter(F.col("class") != F.col("least")).select(
        F.col("class").alias("a"), F.col("least").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("class"), F.col("component").alias("cluster"))


def link_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(class, n_links, edge): per class and tile, linked documents of other classes and a spanning edge; staged."""
    text = F.col("text").cast("string")
    clusters = stage(candidate_clusters(docs), "clusters")
    keyed = docs.select(F.md5(text).alias("class"), text.alias("text")).join(small_side(clusters), "class")
    members = stage(keyed.groupBy("class", "cluster").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")),
                    "cluster-texts")
    # blocks by a hash of the class: bounded in members and, for very long texts, in characters
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    size = stage(size.select("cluster", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("chars") / BLOCK_CHARS))
                             .cast("int").alias("blocks")), "cluster-sizes")
    tiles = members.join(small_side(size), "cluster").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = tiles.select("class", "cluster", "copies", "text", "block", "blocks", other)
    # small clusters share a group, large ones have a group per pair of blocks
    total = members.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    packs = max(64, int(total // (BLOCK_CHARS // 2)) + 1)
    group = F.when(F.col("blocks") == 1, F.concat(F.lit("p"), F.pmod(F.xxhash64("cluster"), F.lit(packs)))).otherwise(
        F.concat_ws("-", "cluster", F.least("block", "other"), F.greatest("block", "other")))
    tiles = tiles.withColumn("tile", group)
    need = least_matches(BANDS * ROWS, threshold)

    def run(pdf):
        import pandas as pd
        sh, out = Shingler(), []
        for _, part in pdf.groupby("cluster", sort=True):
            part = part.sort_values("class")
            sets = [sh.shingles(t) for t in part["text"]]
            sig = sh.signature(sets)
            names, copies, block = part["class"].tolist(), part["copies"].to_numpy(), part["block"].to_numpy()
            low = np.flatnonzero(block == block.min())
            high = np.flatnonzero(block == block.max())
            if part["blocks"].iloc[0] > 1 and len(low) == len(block) and part["other"].iloc[0] != block[0]:
                continue  # the second block has no member here
            same = block.min() == block.max()
            i, j = surviving_pairs(sig[low], sig[high], same, need)
            links, parent = np.zeros(len(names), np.int64), {k: k for k in range(len(names))}
            for x, y in zip(low[i].tolist(), high[j].tolist()):
                if min(len(sets[x]), len(sets[y])) < threshold * max(len(sets[x]), len(sets[y])):
                    continue
                if jaccard(sets[x], sets[y]) >= threshold:
                    links[x] += copies[y]
                    links[y] += copies[x]
                    a, b = root(parent, x), root(parent, y)
                    parent[max(a, b)] = min(a, b)
            for k in np.flatnonzero(links):
                out.append((names[k], int(links[k]), names[root(parent, int(k))]))
        return pd.DataFrame(out, columns=["class", "n_links", "edge"])

    return stage(tiles.groupBy("tile").applyInPandas(run, "class string, n_links long, edge string"), "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per text class with a link or a copy: class, n_class, class_id, n_links, component_id, best (class of the row that stays)."""
    text = F.col("text").cast("string")
    links = link_classes(docs, threshold)
    counts = links.groupBy("class").agg(F.sum("n_links").alias("far"))
    cc = components(links.select(F.col("class").alias("a"), F.col("edge").alias("b")))
    classes = (docs.filter(text.rlike(r"[\p{L}\p{M}\p{N}_]")).groupBy(F.md5(text).alias("class"))
               .agg(F.count(F.lit(1)).alias("n_class"), F.min(F.col("doc_id").cast("long")).alias("class_id")))
    table = stage(classes.join(counts, "class", "left").join(cc, classes["class"] == cc["node"], "left").select(
        "class", "n_class", "class_id", F.coalesce("far", F.lit(0)).alias("far"),
        F.coalesce("component", classes["class"]).alias("component")).filter("far > 0 or n_class > 1"), "near-classes")
    order = F.struct(F.col("class_id").isNull().alias("none"), "class_id", "class")
    # staged, so that its join is by broadcast or has shuffles of its own, which AQE splits where one component is large
    best = stage(table.groupBy("component").agg(F.min(order).alias("b")), "near-best")
    return stage(table.join(small_side(best), "component").select(
        "class", "n_class", "class_id", (F.col("far") + F.col("n_class") - 1).alias("n_links"),
        F.col("b.class_id").alias("component_id"), F.col("b.class").alias("best")), "near-duplicates")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, component_id, kept."""
    found = near_duplicates(docs, threshold)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("string")).alias("class"))
    out = own.join(small_side(found), "class", "left")
    stays = F.col("best").isNull() | ((F.col("class") == F.col("best")) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out.select(
        "doc_id", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        stays.alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all its columns unchanged."""
    found = near_duplicates(docs, threshold)
    cls, best, least = fresh(docs, "_class", "_best", "_id")
    work = docs.withColumn(cls, F.md5(F.col("text").cast("string")))
    side = found.select(F.col("class").alias(cls), F.col("best").alias(best), F.col("component_id").alias(least))
    stays = (F.col(cls) == F.col(best)) & F.col("doc_id").cast("long").eqNullSafe(F.col(least))
    out = work.join(small_side(side), cls, "left").filter(F.col(best).isNull() | stays)
    # rows repeated with one id: only then is a second look needed, at the rows that stay
    twice = (work.select(cls, F.col("doc_id").cast("long").alias(least)).join(
        small_side(side.filter(F.col(cls) == F.col(best)).select(cls, least)), [cls, least])
        .groupBy(cls).count().filter("count > 1"))
    if twice.isEmpty():
        return out.select(*docs.columns)
    return out.filter(F.col(best).isNull()).select(*docs.columns).unionByName(
        out.filter(F.col(best).isNotNull()).dropDuplicates([cls]).select(*docs.columns))
