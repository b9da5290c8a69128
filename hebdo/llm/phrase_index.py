"""Benchmark decontamination on a distributed positional inverted index.

``build_index`` cuts the documents of each partition into blocks of about
``BLOCK_WORDS`` words and stores, per block and term, the ascending positions
of the term in the block's word stream (documents are laid end to end with a
gap between them), and per document its start and length. Blocks never meet, so a
frequent term's postings are spread over all blocks and building shuffles nothing.

``search`` cuts the benchmark into phrases, counts their terms over the index and joins the rarest
term of each to the postings, so a block meets only the phrases whose rarest term it holds. There a phrase
starts from a rare term: that list, less the term's offset, gives the
candidate starts, which are intersected with the other lists, rarest first,
until none is left. With ``within``, it also finds the items whose terms all stand near each other, in any
order: around a position of the item's rarest term every other one must occur within that many
words, in the same document. Rarest is the term of the fewest postings in the whole index
(ties: the smaller term), so the matches do not depend on how documents fall into blocks.

The phrases are dealt to slices of about ``CHUNK_WORDS`` words by a hash of their text, and a task
takes one block and one slice, so its memory does not grow with the benchmark. They are broadcast only where there is
one slice. Nothing of the benchmark passes through the driver but the number of its words.

Words: A-Z lower-cased, then runs of letters, digits and non-ASCII characters.
Defined results: null, empty and word-free texts have no words, no hits and are
not contaminated; null or word-free items match nothing; null item ids are left out.
Equal items each count; repeated document rows each give a row. An empty index gives no rows and an empty
benchmark no hits. A very long text is one block, a very long item many phrases. Only doc_id and text, item_id and text
are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import small_side, stage, with_workers

WINDOW = 13
BLOCK_WORDS = 400_000
CHUNK_WORDS = 2_000_000
#: Phrases in one Arrow batch of the cut benchmark.
CUT_ROWS = 10_000
#: Byte table of the word rule: capitals to small letters, separators to blanks.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def build_index(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(postings: block, term, positions; documents: block, doc_id, key, start, n_words), both staged.

    ``key`` is the MD5 of the text, for joining decisions back to rows.
    """
    with_workers(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId(), 0
        terms: dict[bytes, int] = {}
        ids: list[np.ndarray] = []
        at: list[np.ndarray] = []
        rows, end = [], 0

        def block():
            number = (part << 32) + serial
            stream = np.concatenate(ids) if ids else np.empty(0, np.int32)
            where = np.concatenate(at) if at else np.empty(0, np.int32)
            order = np.argsort(stream, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(stream, minlength=len(terms)))]).astype(np.int32)
            n, m = len(terms), len(rows)
            empty = pa.nulls(n, pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(where[order]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.array([t.decode("utf-8", "replace") for t in terms], pa.string()), lists,
                 empty, pa.nulls(n, pa.string()), empty, empty], names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * m, pa.int64()), pa.nulls(m, pa.string()), pa.nulls(m, pa.list_(pa.int32())),
                 *[pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))]],
                names)

        for batch in batches:
            for doc_id, key, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = words_of(text)
                ids.append(np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int32, len(words)))
                at.append(np.arange(end, end + len(words), dtype=np.int32))
                rows.append((doc_id, key, end, len(words)))
                end += len(words) + 1
                if end >= block_words:
                    yield from block()
                    serial, end = serial + 1, 0
                    terms, ids, at, rows = {}, [], [], []
        if rows:
            yield from block()

    names = ["block", "term", "positions", "doc_id", "key", "start", "n_words"]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("string")).alias("key"),
                         F.col("text").cast("string").alias("text"))
    table = stage(source.mapInArrow(run, "block long, term string, positions array<int>, doc_id long, key string, "
                                         "start long, n_words long"), "phrase-index")
    fresh = lambda *names: [F.col(n).alias(n) for n in names]  # noqa: E731 - own columns, as both sides meet again
    return (table.filter("term is not null").select(*fresh("block", "term", "positions")),
            table.filter("term is null").select(*fresh("block", "doc_id", "key", "start", "n_words")))


def cut_phrases(benchmark: DataFrame, window: int = WINDOW, within: int | None = None) -> DataFrame:
    """(near, phrase, items), staged: every run of ``window`` words of an item, or the whole item where it has fewer,
    and with ``within`` also each whole item (``near``). Words are joined by blanks; equal phrases share a row."""
    with_workers(benchmark.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w.decode("utf-8", "replace") for w in words_of(text)]
                if not words:
                    continue
                last = max(0, len(words) - window) if window else -1
                for at in range(0, last + 1, CUT_ROWS):
                    found = [" ".join(words[i:i + window]) for i in range(at, min(at + CUT_ROWS, last + 1))]
                    yield pa.RecordBatch.from_pydict({"near": [False] * len(found), "phrase": found, "item": [item] * len(found)})
                if within is not None:
                    yield pa.RecordBatch.from_pydict({"near": [True], "phrase": [" ".join(words)], "item": [item]})

    source = (benchmark.filter("item_id is not null and text is not null")
              .select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")))
    cut = source.mapInArrow(run, "near boolean, phrase string, item string")
    return stage(cut.groupBy("near", "phrase").agg(F.array_sort(F.collect_set("item")).alias("items")), "phrases")


def ranked_phrases(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """(near, phrase, items, term), staged: the phrases all of whose words the index holds, with their rarest word."""
    words = F.array_distinct(F.split("phrase", " "))
    spelled = phrases.select("near", "phrase", "items", F.explode(words).alias("term"))
    vocabulary = stage(spelled.select("term").distinct(), "phrase-words")
    counts = stage(postings.join(small_side(vocabulary), "term", "left_semi")
                   .groupBy("term").agg(F.sum(F.size("positions")).alias("n")), "phrase-word-counts")
    ranked = (spelled.join(small_side(counts), "term").groupBy("near", "phrase")
              .agg(F.first("items").alias("items"), F.min(F.struct("n", "term"))["term"].alias("term"), F.count(F.lit(1)).alias("n")))
    return stage(ranked.filter(F.col("n") == F.size(words)).drop("n"), "phrases-ranked")


def phrase_starts(phrase: list[str], lists: dict[str, np.ndarray]) -> np.ndarray:
    """Starts of exact matches: lists less their offset, intersected from the rarest term on."""
    order = sorted(range(len(phrase)), key=lambda i: len(lists[phrase[i]]))
    starts = lists[phrase[order[0]]] - order[0]
    for i in order[1:]:
        have = lists[phrase[i]]
        at = np.searchsorted(have, starts + i)
        at[at == len(have)] = 0
        starts = starts[have[at] == starts + i]
        if not len(starts):
            break
    return starts


def near_starts(anchor: str, others: list[str], lists: dict[str, np.ndarray], within: int, bounds: np.ndarray) -> np.ndarray:
    """Positions of ``anchor`` around which every other term occurs, within ``within`` words and in the document."""
    base = lists[anchor]
    doc = np.searchsorted(bounds, base, side="right") - 1
    low = np.maximum(base - within, bounds[doc])
    high = np.minimum(base + within, np.append(bounds[1:], np.iinfo(np.int32).max)[doc] - 1)
    for t in others:
        have = lists[t]
        ok = np.searchsorted(have, high, side="right") > np.searchsorted(have, low)
        base, low, high = base[ok], low[ok], high[ok]
        if not len(base):
            break
    return base


RESULT = "doc_id long, key string, n_words long, hits array<int>, items array<string>, near_items array<string>, n_near long"


def search(index: tuple[DataFrame, DataFrame], benchmark: DataFrame, window: int = WINDOW,
           chunk_words: int = CHUNK_WORDS, within: int | None = None) -> DataFrame:
    """Per document: positions hit by exact matches of item windows, the items found, and with
    ``within`` the items found near and the number of their (item, position) matches."""
    postings, documents = index
    phrases = ranked_phrases(postings, cut_phrases(benchmark, window, within))
    words = phrases.agg(F.sum(F.size(F.split("phrase", " ")) + F.size("items"))).first()[0]
    if not words:
        none = [F.array().cast(t).alias(c) for c, t in (("hits", "array<int>"), ("items", "array<string>"), ("near_items", "array<string>"))]
        return documents.select("doc_id", "key", "n_words", *none, F.lit(0).cast("long").alias("n_near"))
    n = -(-words // chunk_words)
    phrases = phrases.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(n)).cast("int"))
    table = _search(postings, documents, phrases, n, within)
    if n == 1:
        return table.drop("block", "start")
    whole = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return (table.groupBy("block", "start", "doc_id", "key", "n_words")
            .agg(whole("hits"), whole("items"), whole("near_items"), F.sum("n_near").alias("n_near")).drop("block", "start"))


def proximity(index: tuple[DataFrame, DataFrame], benchmark: DataFrame, within: int,
              chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(doc_id, key, n_words, items, n_near): the proximity half of ``search`` alone."""
    found = search(index, benchmark, 0, chunk_words, within)
    return found.select("doc_id", "key", "n_words", F.col("near_items").alias("items"), "n_near")


def _search(postings: DataFrame, documents: DataFrame, phrases: DataFrame, n: int, within: int | None) -> DataFrame:
    """Matches by (block, slice): the phrases whose rarest word the block holds meet the block's lists of their words."""
    vocabulary = stage(phrases.select("slice", F.explode(F.split("phrase", " ")).alias("term")).distinct(), "phrase-lists")
    lists = postings.join(small_side(vocabulary), "term").select(
        "block", "slice", "term", "positions", F.lit(None).cast("boolean").alias("near"),
        F.lit(None).cast("string").alias("phrase"), F.lit(None).cast("array<string>").alias("items"))
    # one slice holds at most chunk_words words, which bounds the side sent to all executors
    anchors = F.broadcast(phrases) if n == 1 else phrases
    live = postings.select("block", "term").join(anchors, "term").select(
        "block", "slice", "term", F.lit(None).cast("array<int>").alias("positions"), "near", "phrase", "items")
    sliced = documents.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    def run(_, left, right):
        import pandas as pd
        is_list = left["phrase"].isna()
        lists = {t: np.asarray(p, np.int32) for t, p in zip(left["term"][is_list], left["positions"][is_list])}
        live = left[~is_list]
        docs = right.sort_values("start", kind="stable").reset_index(drop=True)
        starts = docs["start"].to_numpy(np.int64)
        hits: dict[int, set] = {}
        items: dict[int, set] = {}
        around: dict[int, set] = {}
        matches: dict[int, int] = {}
        place = lambda found: (np.searchsorted(starts, found, side="right") - 1).tolist()
        for rarest, near, phrase, names in zip(live["term"], live["near"], live["phrase"], live["items"]):
            words = phrase.split(" ")
            if any(t not in lists for t in words):
                continue
            if near:
                for d in place(near_starts(rarest, sorted(set(words) - {rarest}, key=lambda t: len(lists[t])), lists, within, starts)):
                    around.setdefault(d, set()).update(names)
                    matches[d] = matches.get(d, 0) + len(names)
                continue
            found = phrase_starts(words, lists)
            for s, d in zip(found.tolist(), place(found)):
                hits.setdefault(d, set()).update(range(s - int(starts[d]), s - int(starts[d]) + len(words)))
                items.setdefault(d, set()).update(names)
        size = len(docs)
        docs["hits"] = [sorted(hits.get(i, ())) for i in range(size)]
        docs["items"] = [sorted(items.get(i, ())) for i in range(size)]
        docs["near_items"] = [sorted(around.get(i, ())) for i in range(size)]
        docs["n_near"] = [matches.get(i, 0) for i in range(size)]
        docs["doc_id"] = docs["doc_id"].astype("Int64")
        return docs[["block", "start", "doc_id", "key", "n_words", "hits", "items", "near_items", "n_near"]]

    return (lists.unionByName(live).groupBy("block", "slice").cogroup(sliced.groupBy("block", "slice"))
            .applyInPandas(run, f"block long, start long, {RESULT}"))


def contamination(found: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated) from ``search`` results,
    and of proximity matches (n_near, n_near_items, near_sha256)."""
    hit = F.size("hits").cast("long")
    digest = lambda c: F.sha2(F.array_join(c, ","), 256)
    return found.select(
        "doc_id", "key", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        digest("items").alias("items_sha256"), "n_near", F.size("near_items").cast("long").alias("n_near_items"),
        digest("near_items").alias("near_sha256"), ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"))
