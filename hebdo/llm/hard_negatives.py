"""Hard negatives by exact inner products, Kronecker-packed.

Vectors are quantised to integers, floor(scale * x). A block of candidates is
packed component by component: each candidate's j-th component, shifted to be
non-negative, takes a field of its own in one wide integer. An anchor
multiplies that integer once by its own j-th component, for every j; the sum
of the products holds, in each field, that candidate's inner product (and a constant
that keeps fields from going below zero). Fields are as wide as the largest
sum needs, so the scores taken out are exact whatever the components' size.

Two passes, both joins on block numbers: anchors meet the candidates of their own label
for the positives, then, with the positives' scores known, all
candidates for the negatives. Blocks are dealt by a hash of the id, inside the label
in the first pass, so a hot label or vector is split like any other; a
group holds one block of either side, and only the best of each block go on.

Result: for each anchor its first ``positives`` other rows of the same label, by
score (higher first, ties by smaller id), and for each of these the first ``negatives`` rows of other
labels with low * positive <= 100 * negative <= high * positive.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no
part; equal repeated rows count once, different rows under one id are all
rows; vectors of unequal length are not compared. Scores beyond 64 bits are returned as
null, their order and band are exact all the same. An anchor without a positive, or a
positive without a negative in its band, gives no row. Other columns are neither used nor returned, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from fractions import Fraction
from operator import mul

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.llm.common import small_side, stage, with_workers

#: Rows of a candidate block and of an anchor block, on average.
CANDIDATES, ANCHORS = 4096, 4096
#: Wide scores as fixed-length hexadecimal text: scores are below 2**2100 for components of any double.
WIDE = 2112
SCORE = "tier byte, wide string, score long"


def quantise(vectors, scale: float):
    """Integer matrix floor(scale * x), x as double; Python integers where 62 bits don't hold them."""
    import numpy as np
    x = np.array([np.asarray(v, np.float64) for v in vectors], np.float64).reshape(len(vectors), -1)
    with np.errstate(over="ignore"):
        q = np.floor(x * scale)
    if not q.size or np.abs(q).max() < 2.0 ** 62:
        return q.astype(np.int64)
    exact = lambda v, f: int(f) if math.isfinite(f) else math.floor(Fraction(v) * Fraction(scale))
    return np.array([[exact(float(v), float(f)) for v, f in zip(a, b)] for a, b in zip(x, q)], object).reshape(x.shape)


def split_score(s: int):
    """(tier, wide, score): ordered like the integer itself; wide is set where 64 bits don't hold it."""
    if -(1 << 63) <= s < 1 << 63:
        return 0, None, s
    return (1 if s > 0 else -1), f"{s + (1 << WIDE):0{WIDE // 4 + 1}x}", None


def joined_score(wide, score) -> int:
    return int(wide, 16) - (1 << WIDE) if wide is not None else int(score)


class Packed:
    """A block of candidates packed for anchors whose absolute components sum to ``reach`` at most."""

    def __init__(self, candidates, reach: int):
        import numpy as np
        self.n, dims = candidates.shape
        self.low = int(candidates.min()) if candidates.size else 0
        high = int(candidates.max()) - self.low if candidates.size else 0
        self.shift = reach * high  # no inner product with shifted candidates is below -shift or above it
        self.width = (max(2 * self.shift, high).bit_length() + 7) // 8 or 1
        self.fits = 100 * (2 * self.shift + abs(self.low) * reach) < 1 << 62
        lift = int.from_bytes((b"\1" + bytes(self.width - 1)) * self.n, "little")
        self.floor = lift * self.shift
        self.fields = []
        for j in range(dims):
            column = candidates[:, j] - self.low
            if high < 1 << 62:
                cells = np.zeros((self.n, max(8, self.width)), np.uint8)
                cells[:, :8] = column.astype("<u8").view(np.uint8).reshape(self.n, 8)
                raw = cells[:, :self.width].tobytes()
            else:
                raw = b"".join(int(c).to_bytes(self.width, "little") for c in column)
            self.fields.append(int.from_bytes(raw, "little"))

    def scores(self, anchor: list[int]):
        """Inner products with every candidate of the block, in order."""
        import numpy as np
        raw = sum(map(mul, self.fields, anchor), self.floor).to_bytes(self.n * self.width, "little")
        back = self.low * sum(anchor) - self.shift
        if self.fits:
            cells = np.zeros((self.n, 8), np.uint8)
            cells[:, :self.width] = np.frombuffer(raw, np.uint8).reshape(self.n, self.width)
            return cells.view("<i8").reshape(self.n) + back
        w = self.width
        return np.array([int.from_bytes(raw[i * w:(i + 1) * w], "little") + back for i in range(self.n)], object)


def best(scores, ids, among, k: int):
    """Positions of the first k of ``among`` (a mask): higher scores first, ties by smaller id."""
    import numpy as np
    at = np.flatnonzero(among)
    if scores.dtype == object:
        return sorted(at, key=lambda i: (-scores[i], ids[i]))[:k]
    if len(at) > k:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def by_length(left, right, scale: float):
    """(candidates, anchors, quantised candidates, quantised anchors) for each vector length that both sides have."""
    for length, c in left.groupby(left["x"].map(len)):
        a = right[right["x"].map(len) == length]
        if len(a):
            yield c, a, quantise(c["x"].tolist(), scale), quantise(a["x"].tolist(), scale)


def block_scores(left, right, scale: float):
    """(candidates, anchor, scores) of every anchor of a block pair."""
    for c, a, qc, qa in by_length(left, right, scale):
        parts = [[int(v) for v in row] for row in qa]
        packed = Packed(qc, max(sum(map(abs, p)) for p in parts))
        for (_, anchor), part in zip(a.iterrows(), parts):
            yield c, anchor, packed.scores(part)


def rows_of(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, x, row) of the rows that take part; ``row`` tells rows under one id apart."""
    whole = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("x"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & whole)
            .dropDuplicates(["id", "label", "x"]).withColumn("row", F.xxhash64("label", "x")))


def paired(candidates: DataFrame, anchors: DataFrame, keys: list[str]):
    """Both sides by (keys, candidate block, anchor block); ``c_blocks`` and ``a_blocks`` are their numbers."""
    block = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    left = candidates.withColumn("cb", block("c", "c_blocks")).withColumn("ab", each("a_blocks"))
    right = anchors.withColumn("ab", block("a", "a_blocks")).withColumn("cb", each("c_blocks"))
    # under aliases, as both sides come from one table
    side = lambda d: d.select(*[F.col(c).alias(c) for c in d.columns if c not in ("c_blocks", "a_blocks")])
    return side(left).groupBy(*keys, "cb", "ab").cogroup(side(right).groupBy(*keys, "cb", "ab"))


def find_positives(rows: DataFrame, anchor: Column, scale: float, k: int) -> DataFrame:
    """(anchor_id, anchor_row, other_id, tier, wide, score): the first k other rows of the anchor's label."""
    counts = stage(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(anchor.cast("long")).alias("a"))
                   .filter("a > 0"), "label-sizes")
    sizes = counts.select("label", F.ceil(F.col("n") / CANDIDATES).alias("c_blocks"), F.ceil(F.col("a") / ANCHORS).alias("a_blocks"))
    sized = rows.join(small_side(sizes), "label")

    def run(left, right):
        import pandas as pd
        out = []
        for c, a, scores in block_scores(left, right, scale):
            ids = c["id"].to_numpy()
            other = (ids != a["id"]) | (c["row"].to_numpy() != a["row"])
            out += [(a["id"], a["row"], ids[i], *split_score(int(scores[i]))) for i in best(scores, ids, other, k)]
        return pd.DataFrame(out, columns=["anchor_id", "anchor_row", "other_id", "tier", "wide", "score"], dtype=object)

    found = paired(sized, sized.filter(anchor), ["label"]).applyInPandas(
        run, f"anchor_id long, anchor_row long, other_id long, {SCORE}")
    return first(found, ["anchor_id", "anchor_row"], k).drop("place")


def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of each key, numbered; Spark keeps k a key in each task before it shuffles."""
    order = [F.desc("tier"), F.desc("wide"), F.desc("score"), F.asc("other_id")]
    return (found.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .filter(F.col("place") <= k))


def find_negatives(rows: DataFrame, anchors: DataFrame, scale: float, k: int, low: int, high: int) -> DataFrame:
    """For each anchor and each wanted positive score, the first k rows of other labels in its band.

    ``anchors`` has id, row, label, x and ``wanted``, at most a handful of scores.
    """
    n, a = rows.count(), anchors.count()
    size = lambda d: d.withColumn("c_blocks", F.lit(max(1, -(-n // CANDIDATES)))).withColumn(
        "a_blocks", F.lit(max(1, -(-a // ANCHORS))))

    def run(left, right):
        import pandas as pd
        out = []
        for c, a, scores in block_scores(left, right, scale):
            ids, other = c["id"].to_numpy(), (c["label"] != a["label"]).to_numpy()
            for want in a["wanted"]:
                p = joined_score(want["wide"], want["score"])
                if low * p > high * p:
                    continue
                if scores.dtype != object and 100 * abs(p) >= 1 << 62:
                    scores = scores.astype(object)
                among = other & (100 * scores >= low * p).astype(bool) & (100 * scores <= high * p).astype(bool)
                out += [(a["id"], a["row"], want["tier"], want["wide"], want["score"], ids[i], *split_score(int(scores[i])))
                        for i in best(scores, ids, among, k)]
        return pd.DataFrame(out, columns=["anchor_id", "anchor_row", "p_tier", "p_wide", "p_score", "other_id",
                                          "tier", "wide", "score"], dtype=object)

    found = paired(size(rows), size(anchors), []).applyInPandas(
        run, f"anchor_id long, anchor_row long, p_tier byte, p_wide string, p_score long, other_id long, {SCORE}")
    return first(found, ["anchor_id", "anchor_row", "p_tier", "p_wide", "p_score"], k)


def mine(vectors: DataFrame, anchor: Column | None = None, scale: float = 256, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on the column ``id`` (ids divisible by 100 by default).
    """
    with_workers(vectors.sparkSession)
    anchor = F.col("id") % 100 == 0 if anchor is None else anchor
    rows = stage(rows_of(vectors, key, vector, label), "vectors")
    pos = stage(find_positives(rows, anchor, scale, positives), "positives")
    wanted = (pos.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_row").alias("row"))
              .agg(F.collect_set(F.struct("tier", "wide", "score")).alias("wanted")))
    anchors = stage(rows.filter(anchor).join(wanted, ["id", "row"]), "anchors")
    neg = find_negatives(rows, anchors, scale, negatives, low, high).select(
        "anchor_id", "anchor_row", "p_tier", "p_wide", "p_score", F.col("place").alias("rank"),
        F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    p = pos.select("anchor_id", "anchor_row", F.col("other_id").alias("positive_id"), F.col("tier").alias("p_tier"),
                   F.col("wide").alias("p_wide"), F.col("score").alias("p_score"))
    on = [F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("p_tier", "p_wide", "p_score")]
    both = p.alias("p").join(neg.alias("n"), [F.col("p.anchor_id") == F.col("n.anchor_id"),
                                              F.col("p.anchor_row") == F.col("n.anchor_row"), *on])
    return both.select("p.anchor_id", "p.positive_id", F.col("n.rank").cast("int").alias("rank"), "n.negative_id",
                       F.col("p.p_score").alias("positive_score"), "n.negative_score")
