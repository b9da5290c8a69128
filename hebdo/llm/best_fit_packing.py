"""Packing of token sequences: bounded-space online best-fit.

A document is its ids from a public tokenizer and an end id. Longer documents than a sequence,
and only these, are cut into pieces of a sequence's length, the last one
shorter. Each task streams its documents once and holds a fixed number of
open sequences. Their free spaces are bits of one integer, so the fullest that a
piece fits in is the lowest set bit from the piece's length up. Where none fits, a sequence is
opened; where that would be one too many, the fullest closes first (the lowest
set bit of all). A piece has its place as soon as it is read, and
nothing is shuffled or sorted, so a hot key or source does no harm.

At a task's end its open sequences are left partly filled. Those are packed
among themselves by the same rule, as pieces of their filled length (``merge_rests``): one
row each, in rounds over fewer tasks, and the few that move are joined back by
their number. Each sequence's pieces then still lie gapless from 0.

Tokens: where the tokenizer drops white space before splitting, texts are cut at blanks and
newlines, and each distinct word is encoded once in a worker and remembered, in two generations of
bounded size; a word of Latin letters and punctuation goes to the tokenizer's model run by run. Ids equal the library's for the whole text. Other tokenizers get whole texts.

Defined results: a null text counts as empty, and an empty text is the end id alone; null
and repeated ids, and equal rows, are documents of their own; every row is packed, none cut but
beyond a sequence's length. Only the id and text columns are read; other
columns are neither used nor returned, whatever their names. A text is held whole by one task. An empty table
gives no rows. ``sequence_id`` is any number, unique to its sequence; a task that is run again gives the same
places, since they follow from its rows in order.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import row_runs, small_side, stage, with_workers

#: Tokenizer of the registered query, by its file name; the same place on every executor.
TOKENIZER = "word_bpe_49k.json"
LENGTH, END, OPEN = 4096, 1, 512
# The parts of a tokenizer whose words are lower-cased and split into runs of letters, digits and
# other characters. A word of Latin letters and a run of punctuation then meets its model run by run.
LOWER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                             {"type": "Lowercase"}]}
LETTER_RUNS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-;=?-@\[-`{}~]*)")
#: Sequences of one task's rests that one merging task takes, on average.
RESTS = 4096


def tokenizer_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class Words(dict):
    """Ids of words, found when first asked for, as the bytes of little-endian unsigned 32-bit values."""

    #: Words longer than this are encoded anew each time.
    LONG = 64

    def __init__(self, path: str, memory: int = 400_000):
        import json

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.code = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.by_word = self.ids("a b\nc") == b"".join(map(self.ids, "abc"))
        parts = json.loads(self.tokenizer.to_str())
        self.letters = parts["normalizer"] == LOWER and parts["pre_tokenizer"] == LETTER_RUNS and parts["model"]["type"] == "BPE"
        if self.letters:
            from tokenizers.pre_tokenizers import ByteLevel
            byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes_of = str.maketrans({c: byte_level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c != "÷"})
        self[""] = b""
        self.older: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {"": b""}
        self.memory = memory

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.code.__getitem__, self.tokenizer.encode(text, add_special_tokens=False).ids))

    def run(self, letters: str) -> bytes:
        """Ids of a run of lower-case letters, which the tokenizer hands to its model as one piece."""
        tokens = self.tokenizer.model.tokenize(letters if letters.isascii() else letters.translate(self.bytes_of))
        return b"".join([self.code[t.id] for t in tokens])

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            plain = PLAIN.fullmatch(word) if self.letters else None
            if plain is None:
                out = self.ids(word)
            else:
                letters, marks = plain[1].lower(), plain[2]
                if (out := self.runs.get(letters)) is None:
                    out = self.run(letters)
                    if len(letters) <= self.LONG:
                        self.runs[letters] = out
                if marks:
                    out += self.marks(marks)
        if len(word) <= self.LONG:
            self[word] = out
        return out

    def marks(self, marks: str) -> bytes:
        out = self.runs.get(marks) or self.ids(marks)
        if len(marks) <= self.LONG:
            self.runs[marks] = out
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self.ids(t) for t in texts]
        if len(self) > self.memory:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        if len(self.runs) > self.memory // 2:
            self.runs = {"": b""}
        return [b"".join(map(self.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """One in a worker process, so that later tasks find known words."""
    return Words(path)


class OpenBins:
    """At most ``most`` open sequences, found by free space in a bitset."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most = length, most
        self.bits, self.open, self.opened = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]

    def take(self, free: int) -> int:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of ``size`` (1 to the length)."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            at = self.take(free)
        else:
            free, at = self.length, self.opened
            self.opened += 1
        offset, left = self.length - free, free - size
        if left:
            if self.open == self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest >= left:  # this one is the fullest: it closes
                    return at, offset
                self.take(fullest)
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(at)
            self.open += 1
        return at, offset

    def rests(self):
        """(sequence, tokens it holds) of those still open."""
        return [(at, self.length - free) for free, held in enumerate(self.by_free) for at in held]


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, end: int | None = END, open_bins: int = OPEN,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids, sequence_id, offset) of every piece.

    ``ids`` are little-endian unsigned 32-bit values; ``start`` counts the document's ids before the piece.
    """
    spark = with_workers(docs.sparkSession)
    path = tokenizer_path(tokenizer)
    work = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    closing = end.to_bytes(4, "little") if end is not None else b""
    most = 2 << 20  # bytes of texts turned into Python objects at once (at least one row)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        words, bins = words_of(path), OpenBins(length, open_bins)
        base = TaskContext.get().partitionId() << 40
        names = ["key", "piece", "start", "length", "ids", "sequence_id", "offset", "rest"]
        long = lambda x: pa.array(x, pa.int64())
        key_type = None
        for batch in batches:
            key_type = batch.column("key").type
            for part in row_runs(batch, "text", most):
                row, piece, start, span, ids, seq, offset = ([] for _ in range(7))
                for i, coded in enumerate(words.encode(part.column("text").to_pylist())):
                    coded += closing
                    n = len(coded) // 4
                    for k, first in enumerate(range(0, n, length)):
                        chunk = min(length, n - first)
                        where, place = bins.place(chunk)
                        row.append(i), piece.append(k), start.append(first), span.append(chunk)
                        ids.append(coded[4 * first:4 * (first + chunk)]), seq.append(base + where), offset.append(place)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(row, pa.int64())), long(piece), long(start), long(span),
                     pa.array(ids, pa.binary()), long(seq), long(offset), long([None] * len(row))], names)
        rests = bins.rests()
        if rests:
            n = len(rests)
            none = long([None] * n)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, key_type), none, none, none, pa.nulls(n, pa.binary()),
                                              long([base + s for s, _ in rests]), none, long([r for _, r in rests])], names)

    kind = work.schema["key"].dataType.simpleString()
    placed = stage(work.mapInArrow(run, f"key {kind}, piece long, start long, length long, ids binary, "
                                        "sequence_id long, offset long, rest long"), "packed")
    pieces = placed.filter("rest is null").drop("rest")
    rests = placed.filter("rest is not null").select("sequence_id", F.col("rest").alias("held"))
    moves = merge_rests(rests, length, open_bins)
    # one row a sequence that moves: broadcast within the checked bound, by shuffle beyond it
    out = pieces.join(small_side(moves), "sequence_id", "left")
    return out.select(F.col("key").alias(key), "piece", "start", "length", "ids",
                      F.coalesce("into", "sequence_id").alias("sequence_id"),
                      (F.col("offset") + F.coalesce("shift", F.lit(0).cast("long"))).alias("offset"))


def merge_rests(rests: DataFrame, length: int = LENGTH, open_bins: int = OPEN, most: int = RESTS) -> DataFrame:
    """(sequence_id, into, shift) of open sequences that move behind another one's tokens.

    The open sequences of many tasks meet in about one task for each ``most`` of them, dealt by
    their number, and are packed by the same rule; a sequence into which others move keeps its place.
    """
    with_workers(rests.sparkSession)
    rests = stage(rests, "rests")
    tasks = max(1, -(-rests.count() // most))
    dealt = rests.repartition(tasks, "sequence_id").sortWithinPartitions("sequence_id")

    def run(batches):
        import numpy as np
        import pyarrow as pa
        bins, first = OpenBins(length, open_bins), {}
        for batch in batches:
            out = []
            for seq, held in zip(*(c.to_pylist() for c in batch.columns)):
                at, offset = bins.place(held)
                if offset:
                    out.append((seq, first[at], offset))
                else:
                    first[at] = seq
            cols = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["sequence_id", "into", "shift"])

    return stage(dealt.mapInArrow(run, "sequence_id long, into long, shift long"), "moves")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, n_tokens, ids) of whole sequences, pieces joined in order; each is bounded by the length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.size("p").cast("long").alias("n_pieces"),
                    F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
                    F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids")))
