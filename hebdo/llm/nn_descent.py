"""Embedding near-duplicates by NN-descent, with exact link counts.

Vectors are comparable when their labels are equal and not null and their
lengths agree. Equal vectors are one node with a weight, so copies never meet.

1. Start: several random-projection orders; consecutive blocks of a fixed number of
   vectors are compared and give each node its first neighbour list. A block never
   grows with a hot label or code; orders and code bits grow with the largest label.
2. Descent: at every node its neighbours and reverse neighbours (split into
   bounded groups for hubs) are compared with each other; better neighbours enter
   the lists, until few change. Lists whose every entry is a link are saturated
   and double for the next round, up to ``MOST_NEIGHBOURS``.
3. All links seen on the way (not only list entries) are kept as spanning edges,
   and connected components formed.
4. The exact way for saturated lists: all vectors of a component are compared, in tiles of two
   blocks; a tile returns a weighted link count per vector, never the pairs.
5. Audit: hashed samples of nodes, growing up to ``AUDIT[-1]``, are compared with all vectors until they
   hold ``AUDIT_LINKS`` links (at most ``PER_NODE`` of one node). Below ``RECALL`` of these links inside
   components, another start and descent follows, up to ``STARTS``.
6. Where the audit holds too few links to measure that recall, wider starts follow until one joins no two
   components and every audited link is found. If the starts end before either is reached, all pairs of each
   label that are in different components are compared in tiles. What is searched and compared depends on
   what was found, never on a label's size: a table gets one and the same way whatever its rows are part of.
   The pairs of a label grow with its square, so beyond ``EXACT_ROWS`` vectors a warning goes before them.
   If the recall is below ``FLOOR`` even then, the operator fails instead of returning a part.

``audit_recall`` is the share of the audit's links inside the final components, without the audit's own
edges; null where the audit found no link.

Cosines are computed in double precision. Defined results: vectors that are
null, empty, zero, or hold null or non-finite components, or have a null label, link
with nothing and form their own component; so do rows with a null vec_id, which no one counts. Rows that repeat a vec_id count each.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.bayes_jaccard import root
from hebdo.llm.common import small_side, stage, with_workers
from hebdo.llm.graph import components

THRESHOLD = 0.98
ORDERS, BLOCK = 6, 256
NEIGHBOURS, MOST_NEIGHBOURS = 8, 32
ROUNDS, ENOUGH = 3, 0.002
TILE = 1024
STARTS = 6
#: Audit: sizes of the node sample, bound on its bytes, links it must hold, of one node at most, share to be found.
AUDIT, AUDIT_BYTES = (1024, 8192), 64_000_000
AUDIT_LINKS, PER_NODE, RECALL = 1000, 8, 0.999
#: Vectors of a label whose comparison pair by pair is announced by a warning, and the recall below which there is no result.
EXACT_ROWS, FLOOR = 16_384, 0.9
#: Vectors in a block of the exact pass, and rows of it compared at a time.
WIDE, STRIP = 2048, 512
#: Reverse neighbours that one group of a hub takes.
HUB = 64


def unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small or large components stay in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def link_edges(sims: np.ndarray, nodes: list, threshold: float) -> list[tuple]:
    """Spanning forest of the links in a square similarity matrix, as (node, node) pairs."""
    i, j = np.nonzero(np.triu(sims >= threshold, 1))
    parent, out = {}, []
    for x, y in zip(i.tolist(), j.tolist()):
        parent.setdefault(x, x)
        parent.setdefault(y, y)
        a, b = root(parent, x), root(parent, y)
        if a != b:
            parent[b] = a
            out.append((nodes[x], nodes[y]))
    return out


def nodes_of(embeddings: DataFrame) -> DataFrame:
    """Distinct comparable vectors: node, grp, vec (packed), weight, least id; staged."""
    x = F.col("embedding")
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0)
            & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
            & F.exists(x, lambda v: v != 0))
    rows = embeddings.filter(F.coalesce(fine, F.lit(False))).select(
        F.concat_ws("/", F.col("label").cast("string"), F.size(x).cast("string")).alias("grp"), x.alias("embedding"),
        F.col("vec_id").cast("long").alias("vec_id"))
    return stage(rows.groupBy("grp", "embedding").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
                 .withColumn("node", F.monotonically_increasing_id()), "vectors")


def packed(nodes: DataFrame, kind: str) -> DataFrame:
    """(node, grp, vec, weight) with the components as bytes, so they travel compactly; staged."""
    def run(batches):
        import pyarrow as pa
        typ = np.dtype(kind)
        for b in batches:
            vec = [np.asarray(v, typ).tobytes() for v in b.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("grp"), pa.array(vec, pa.binary()), b.column("weight")],
                                             ["node", "grp", "vec", "weight"])
    return stage(nodes.select("node", "grp", "embedding", "weight").mapInArrow(
        run, "node long, grp string, vec binary, weight long"), "packed-vectors")


EDGE = "a long, b long, sim double, link boolean"


def best_pairs(nodes: np.ndarray, grp: np.ndarray, x: np.ndarray, k: int, threshold: float,
               worst: np.ndarray | None = None) -> list[tuple]:
    """Each node's ``k`` best others (beyond ``worst``, where given), and spanning edges of the links."""
    sims = x @ x.T
    sims[grp[:, None] != grp[None, :]] = -2
    np.fill_diagonal(sims, -2)
    out = [(a, b, 1.0, True) for a, b in link_edges(sims, nodes.tolist(), threshold)]
    k = min(k, len(nodes) - 1)
    if k > 0:
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        s = np.take_along_axis(sims, top, 1)
        good = s > (-1.5 if worst is None else np.maximum(worst, -1.5)[:, None])
        i, j = np.nonzero(good)
        out += zip(nodes[i].tolist(), nodes[top[i, j]].tolist(), s[i, j].tolist(), [False] * len(i))
    return out


def search_size(largest: int, threshold: float) -> tuple[int, int, int]:
    """(orders, code bits, rounds) for a largest label of so many vectors.

    A code's cell stays smaller than a block however large the label is; each bit more parts
    two vectors at the threshold with probability angle / pi, which more orders make up for.
    """
    bits = max(12, math.ceil(math.log2(max(1, largest) / BLOCK)) + 4)
    apart = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    return math.ceil(ORDERS / (1 - apart) ** (bits - 12)), bits, ROUNDS + (bits - 12) // 4


def start_edges(vectors: DataFrame, kind: str, salt: int, threshold: float, orders: int = ORDERS, bits: int = 12) -> DataFrame:
    """First neighbours and links from blocks of random-projection orders; staged."""
    def ordered(batches):
        import pandas as pd
        for pdf in batches:
            for _, part in pdf.groupby(pdf["vec"].str.len(), sort=True):
                x = unit(part["vec"].tolist(), kind)
                rng = np.random.default_rng(salt)
                for t in range(orders):
                    p = x @ rng.standard_normal((x.shape[1], bits + 1))
                    code = (p[:, :bits] > 0) @ (1 << np.arange(bits))
                    yield pd.DataFrame({"t": t, "grp": part["grp"].to_numpy(), "code": code, "p": p[:, bits],
                                        "node": part["node"].to_numpy(), "vec": part["vec"].to_numpy()})

    def compare(batches):
        import pandas as pd
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            full = len(pdf) // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                yield block(pdf.iloc[at:at + BLOCK])
            rest = pdf.iloc[full:]
        if rest is not None and len(rest):
            yield block(rest)

    def block(part):
        import pandas as pd
        out = []
        for _, one in part.groupby(["t", part["vec"].str.len()], sort=True):
            out += best_pairs(one["node"].to_numpy(), one["grp"].to_numpy(), unit(one["vec"].tolist(), kind), NEIGHBOURS, threshold)
        return pd.DataFrame(out, columns=["a", "b", "sim", "link"])

    keyed = vectors.select("node", "grp", "vec").mapInPandas(
        ordered, "t int, grp string, code long, p double, node long, vec binary")
    return stage(keyed.repartitionByRange("t", "grp", "code", "p").sortWithinPartitions("t", "grp", "code", "p", "node")
                 .mapInPandas(compare, EDGE), "nn-start")


def best_lists(edges: DataFrame, lists: DataFrame | None, threshold: float) -> DataFrame:
    """(node, k, top array<struct<sim, b>>, changed): the k best neighbours of each node; staged."""
    pairs = edges.filter("not link").select("a", "b", "sim")
    if lists is not None:
        pairs = pairs.unionByName(lists.select(F.col("node").alias("a"), F.explode("top").alias("n")).select(
            "a", F.col("n.b").alias("b"), F.col("n.sim").alias("sim")))
    best = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim")).groupBy("a").agg(
        F.sort_array(F.collect_list(F.struct("sim", "b")), asc=False).alias("all"))
    if lists is None:
        best = best.withColumn("k", F.lit(NEIGHBOURS)).withColumn("old", F.lit(None).cast("array<struct<sim:double,b:bigint>>"))
    else:
        full = (F.size("top") >= F.col("k")) & (F.element_at("top", -1)["sim"] >= threshold)
        best = best.join(lists.select(F.col("node").alias("a"), F.when(full, F.least(F.col("k") * 2, F.lit(MOST_NEIGHBOURS)))
                                      .otherwise(F.col("k")).alias("k"), F.col("top").alias("old")), "a")
    top = F.slice("all", F.lit(1), F.col("k"))
    out = best.select(F.col("a").alias("node"), "k", top.alias("top"), "old")
    changed = F.size(F.array_except(F.col("top.b"), F.coalesce(F.col("old.b"), F.array().cast("array<bigint>"))))
    return stage(out.select("node", "k", "top", changed.alias("changed")), "nn-lists")


def descend(lists: DataFrame, vectors: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Compare the neighbours and reverse neighbours of every node with each other; staged edges."""
    worst = F.when(F.size("top") < F.col("k"), F.lit(-2.0)).otherwise(F.element_at("top", -1)["sim"])
    own = lists.select("node", F.explode("top.b").alias("b"))
    reverse = own.select(F.col("b").alias("via"), F.col("node").alias("member"))
    degree = reverse.groupBy("via").agg(F.ceil(F.count(F.lit(1)) / HUB).cast("int").alias("groups"))
    # a node's own list goes to each of its groups; its reverse neighbours are dealt over them
    forward = own.select(F.col("node").alias("via"), F.col("b").alias("member")).join(degree, "via", "left").select(
        "via", "member", F.explode(F.sequence(F.lit(0), F.coalesce("groups", F.lit(1)) - 1)).alias("part"))
    back = reverse.join(degree, "via").select("via", "member", F.pmod(F.xxhash64("member"), F.col("groups")).cast("int").alias("part"))
    members = forward.unionByName(back).distinct()
    data = vectors.join(lists.select("node", worst.alias("worst")), "node").select(F.col("node").alias("member"), "grp", "vec", "worst")
    n = lists.count()
    packs = max(64, n // 1500)
    rows = members.join(data, "member").withColumn("pack", F.pmod(F.xxhash64("via", "part"), F.lit(packs)))

    def run(pdf):
        import pandas as pd
        out = []
        pdf = pdf.sort_values(["via", "part", "member"])
        node, grp, worst = pdf["member"].to_numpy(), pdf["grp"].to_numpy(), pdf["worst"].to_numpy()
        vec = pdf["vec"].tolist()
        key = pdf[["via", "part"]].to_numpy()
        cuts = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        for s in np.split(np.arange(len(key)), cuts):
            if len(s) > 1:
                out += best_pairs(node[s], grp[s], unit([vec[i] for i in s], kind), 4, threshold, worst[s])
        found = pd.DataFrame(list(set(out)), columns=["a", "b", "sim", "link"]).astype({"link": bool})
        # of one node no more than fill its list leave the task, however many groups it is in
        near = found[~found["link"]].sort_values(["a", "sim", "b"], ascending=[True, False, True])
        return pd.concat([found[found["link"]], near.groupby("a").head(MOST_NEIGHBOURS)])

    return stage(rows.groupBy("pack").applyInPandas(run, EDGE), "nn-descent")


def links_of(edges: DataFrame) -> DataFrame:
    return edges.filter("link").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def audit(vectors: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(a, b) links of hashed samples of nodes b, at most ``PER_NODE`` of each, against all vectors; staged.

    The sample grows until it holds ``AUDIT_LINKS`` links or is as large as it may get.
    """
    n, longest = vectors.agg(F.count(F.lit(1)), F.max(F.length("vec"))).first()
    most = max(1, AUDIT_BYTES // max(1, longest or 0))
    for size in AUDIT:
        found = sampled_links(vectors, kind, threshold, min(size, most), n)
        if found.count() >= AUDIT_LINKS or size >= min(n, most):
            break
    return found


def sampled_links(vectors: DataFrame, kind: str, threshold: float, size: int, n: int) -> DataFrame:
    spark = vectors.sparkSession
    grain = 1_000_000_000
    share = min(grain, max(1, int(grain * size / max(1, n))))
    sample = vectors.filter(F.pmod(F.xxhash64("node"), F.lit(grain)) < share).select("node", "grp", "vec").collect()
    shared = spark.sparkContext.broadcast([(r["node"], r["grp"], bytes(r["vec"])) for r in sample])

    def least(parts):
        import pandas as pd
        return pd.concat(parts).sort_values(["b", "h", "a"]).groupby("b").head(PER_NODE)

    def run(batches):
        import pandas as pd
        by: dict[str, list] = {}
        for node, grp, vec in shared.value:
            by.setdefault(grp, []).append((node, vec))
        by = {g: (np.array([v[0] for v in rows]), unit([v[1] for v in rows], kind)) for g, rows in by.items()}
        out = [pd.DataFrame({"a": [], "b": [], "h": []}, dtype="int64")]
        for pdf in batches:
            # in the order of a hash, so that of a node's many links those kept do not depend on the partition
            pdf = pdf.assign(h=(pdf["node"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)).astype(np.int64))
            for grp, part in pdf.sort_values(["h", "node"]).groupby("grp", sort=True):
                if grp not in by:
                    continue
                others, y = by[grp]
                for at in range(0, len(part), STRIP):
                    strip = part.iloc[at:at + STRIP]
                    node, h = strip["node"].to_numpy(), strip["h"].to_numpy()
                    near = (unit(strip["vec"].tolist(), kind) @ y.T >= threshold) & (node[:, None] != others[None, :])
                    if near.any():
                        near &= np.cumsum(near, axis=0, dtype=np.int32) <= PER_NODE
                        i, j = np.nonzero(near)
                        out.append(pd.DataFrame({"a": node[i], "b": others[j], "h": h[i]}))
            out = [least(out)]
        yield out[0]

    found = vectors.select("node", "grp", "vec").mapInPandas(run, "a long, b long, h long").groupBy("b").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("h", "a"))), 1, PER_NODE).alias("near"))
    return stage(found.select(F.explode("near.a").alias("a"), "b"), "nn-audit")


def exact_edges(vectors: DataFrame, cc: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(a, b): edges for all links between different components of ``cc``, from all pairs of a label in tiles; staged.

    A tile returns one edge for each two components it links, never the links.
    """
    rows = stage(vectors.join(small_side(cc), "node", "left").select(
        "node", "grp", "vec", F.coalesce("component", "node").alias("component")), "exact-vectors")
    size = stage(rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / WIDE).cast("int").alias("blocks")), "exact-sizes")
    packs = max(64, rows.count() // WIDE)
    rows = rows.join(small_side(size), "grp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.when(F.col("blocks") == 1, F.concat(F.lit("p"), F.pmod(F.xxhash64("grp"), F.lit(packs)))).otherwise(
        F.concat_ws("-", "grp", F.least("block", "other"), F.greatest("block", "other")))

    def run(pdf):
        import pandas as pd
        out = [np.empty((0, 2), np.int64)]
        for _, part in pdf.groupby("grp", sort=True):
            x, c, low = unit(part["vec"].tolist(), kind), part["component"].to_numpy(), (part["block"] <= part["other"]).to_numpy()
            one = np.flatnonzero(low)
            two = one if low.all() else np.flatnonzero(~low)
            for at in range(0, len(one), STRIP):
                s = one[at:at + STRIP]
                i, j = np.nonzero((x[s] @ x[two].T >= threshold) & (c[s][:, None] != c[two][None, :]))
                out.append(np.unique(np.sort(np.column_stack([c[s][i], c[two][j]]), axis=1), axis=0))
        return pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])

    return stage(rows.withColumn("tile", tile).groupBy("tile").applyInPandas(run, "a long, b long").distinct(), "exact-edges")


def count_links(vectors: DataFrame, cc: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(node, far): weight of the linked other nodes, counted exactly inside each component."""
    rows = stage(vectors.join(small_side(cc), "node").select("node", "component", "vec", "weight"), "component-vectors")
    size = stage(rows.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks")), "component-sizes")
    rows = rows.join(small_side(size), "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    packs = max(64, cc.count() // TILE)
    tile = F.when(F.col("blocks") == 1, F.concat(F.lit("p"), F.pmod(F.xxhash64("component"), F.lit(packs)))).otherwise(
        F.concat_ws("-", "component", F.least("block", "other"), F.greatest("block", "other")))

    def run(pdf):
        import pandas as pd
        out = []
        for _, part in pdf.groupby("component", sort=True):
            x, w = unit(part["vec"].tolist(), kind), part["weight"].to_numpy()
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            block, crossing = part["block"].to_numpy(), part["other"].iloc[0] != part["block"].iloc[0]
            if crossing:
                near &= block[:, None] != block[None, :]
            out.append(pd.DataFrame({"node": part["node"].to_numpy(), "far": near @ w}))
        return pd.concat(out)

    return (rows.withColumn("tile", tile).groupBy("tile").applyInPandas(run, "node long, far long")
            .groupBy("node").agg(F.sum("far").alias("far")))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept, audit_recall (null: no link to measure it on)."""
    with_workers(embeddings.sparkSession)
    kind = "f4" if "float" in embeddings.schema["embedding"].dataType.simpleString() else "f8"
    nodes = nodes_of(embeddings)
    vectors = packed(nodes, kind)
    n = vectors.count()
    truth = audit(vectors, kind, threshold)
    measured = truth.count() >= AUDIT_LINKS
    largest = vectors.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    orders, bits, rounds = search_size(largest, threshold)
    links, lists, joined, settled = None, None, None, False
    for salt in range(STARTS):
        edges = start_edges(vectors, kind, salt, threshold, orders * (1 + salt // 2), bits)
        links = links_of(edges) if links is None else links.union(links_of(edges))
        lists = best_lists(edges, lists, threshold)
        for _ in range(rounds):
            edges = descend(lists, vectors, kind, threshold)
            links = links.union(links_of(edges))
            lists = best_lists(edges, lists, threshold)
            if (lists.agg(F.sum("changed")).first()[0] or 0) <= ENOUGH * n * NEIGHBOURS:
                break
        cc = components(links)
        recall = audited(truth, cc)
        if measured:
            settled = recall >= RECALL
        else:
            before, joined = joined, cc.agg(F.count(F.lit(1)) - F.count_distinct("component")).first()[0]
            settled = joined == before and recall in (None, 1.0)
        if settled:
            break
    if not settled:
        if largest > EXACT_ROWS:
            warnings.warn(f"after {STARTS} starts links are missing: all pairs of labels of up to {largest} vectors are compared")
        links = links.union(exact_edges(vectors, cc, kind, threshold))
        recall = audited(truth, components(links))
    if recall is not None and recall < FLOOR:
        raise RuntimeError(f"of {truth.count()} links audited only the share {recall:.3f} was found: allow more starts or orders")
    links = links.union(truth)
    cc = components(links)
    far = count_links(vectors, cc, kind, threshold)
    table = (nodes.select("node", "grp", "embedding", "weight", "least").join(cc, "node", "left").join(far, "node", "left")
             .select("grp", "embedding", "weight", "least", F.coalesce("component", "node").alias("component"),
                     F.coalesce("far", F.lit(0)).alias("far")))
    table = stage(table, "vector-components")
    first = table.groupBy("component").agg(F.min("least").alias("component_id"))
    table = stage(table.join(first, "component").select(
        F.col("grp").alias("_grp"), F.col("embedding").alias("_vec"), (F.col("far") + F.col("weight") - 1).alias("n_links"),
        "component_id"), "vector-results")
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.when(
        F.col("vec_id").isNotNull(), F.concat_ws("/", F.col("label").cast("string"), F.size("embedding").cast("string"))).alias("grp"))
    out = own.join(table, (own["grp"] == table["_grp"]) & (own["embedding"] == table["_vec"]), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"), F.lit(recall).cast("double").alias("audit_recall"))


def audited(truth: DataFrame, cc: DataFrame) -> float | None:
    """Share of the audit's links whose ends lie in one component; None without links, which measure nothing."""
    total = truth.count()
    if not total:
        return None
    a = cc.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = cc.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return truth.join(a, "a").join(b, "b").filter("ca = cb").count() / total
