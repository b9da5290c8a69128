"""SentencePiece encoding by a shared-prefix Viterbi pass, and decoding.

Texts are marked (blank to U+2581, one in front) and cut before every
mark that follows another character; no piece crosses such a cut, so the
marked words can be encoded on their own. Per batch, the distinct words
not yet known are sorted, which is a depth-first walk of their trie: a word
keeps the forward states of the prefix it shares with the one before and only
extends them.

The forward state of a prefix is the last piece of its best segmentation, and
the longest end of the prefix that begins a piece, from which the pieces that
can end next follow. The model has ranked merges, so "best" is the
segmentation that the merges yield: a piece may follow the state before it only
if merging the two pieces' text gives just these two, and exactly one piece
qualifies. So the pass yields the library's own ids. Characters without a piece
become byte pieces.

Defined results: null text gives null ids and null text back; empty text
no ids. White space other than the blank is kept as it is (its byte pieces);
the mark character itself decodes to a blank, as in the library.
Ids of control pieces found in ids decode to nothing.
Rows are encoded one by one, whole; repeated rows get equal ids. An empty table gives an empty one.
All other columns stay; only input columns named ``ids``, ``n_ids`` or ``text_back`` are replaced.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import with_workers

#: Default place of the model file, the same on every executor; a parameter everywhere.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Ending(dict):
    """What a prefix ends with: the longest end that begins a piece, and (piece, length, Follows) of the pieces that end it.

    The longest piece comes first; a single character is always among them, as
    without a piece it becomes byte pieces. As a dict it leads by the next character to the next ending.
    """

    def __init__(self, pieces: Pieces, begun: str, char: str):
        self.pieces, self.begun = pieces, begun
        ends = (begun[i:] for i in range(len(begun) - 1))
        self.ends = [(p, len(p), pieces.after(p)) for p in [*filter(pieces.stable.__contains__, ends), char]]

    def __missing__(self, char: str) -> Ending:
        begun = self.begun + char
        while begun and begun not in self.pieces.prefixes:
            begun = begun[1:]
        endings = self.pieces.endings
        if (out := endings.get(begun or char)) is None:
            out = endings[begun or char] = Ending(self.pieces, begun, char)
        self[char] = out
        self.pieces.grown += 1
        return out


class Follows(dict):
    """Whether a piece may follow the piece ``left``: the merges leave just these two of their joint text."""

    def __init__(self, pieces: Pieces, left: str):
        self.pieces, self.left = pieces, left

    def __missing__(self, piece: str) -> bool:
        out = self[piece] = not self.left or self.pieces.merge(self.left + piece) == [self.left, piece]
        self.pieces.grown += 1
        return out


class Pieces:
    """Vocabulary of a model file, and encoding of marked words.

    Ids of a word are kept as the bytes of int32 values, so a text's ids are one join.
    """

    #: Words longer than this are encoded anew each time instead of being remembered.
    LONG = 64

    def __init__(self, model: bytes, memory: int = 150_000):
        import sentencepiece as sp
        m = sp.SentencePieceProcessor(model_proto=model)
        self.text = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        plain = [i for i in range(len(self.text)) if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))]
        self.rank = {self.text[i]: (-m.get_score(i), i) for i in plain}
        self.byte = {int(self.text[i][3:5], 16): i for i in range(len(self.text)) if m.is_byte(i)}
        self.unknown = m.unk_id()
        crossing = [p for p in self.rank if re.search(f"[^{MARK}]{MARK}", p)]
        if crossing:
            raise ValueError(f"pieces cross word marks: {crossing[:3]}")
        self.code = {p: array("i", [i]).tobytes() for p, (_, i) in self.rank.items()}
        #: pieces that the merges do yield for their own text
        self.stable = {p for p in self.rank if len(p) == 1 or self.merge(p) == [p]}
        self.prefixes = {p[:k] for p in self.stable for k in range(1, len(p) + 1)}
        self.forget()
        # words of two generations: the older one goes when the newer is full, frequent words move on
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.memory = memory

    # ---- segmentation of one marked word -------------------------------------------------
    def merge(self, text: str) -> list[str]:
        """Segmentation of a short string by ranked merges, the definition that ``Follows`` rests on."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(self.rank[a + b][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def forget(self) -> None:
        """Start over with what has been learned of endings and neighbours."""
        self.grown = 0
        self.endings: dict[str, Ending] = {}
        self.follows: dict[str, Follows] = {}

    def after(self, piece: str) -> Follows:
        if (out := self.follows.get(piece)) is None:
            out = self.follows[piece] = Follows(self, piece)
        return out

    def encode_words(self, words) -> None:
        """Encode the words not yet known, in sorted order, sharing the states of common prefixes."""
        if self.grown > 1_000_000:
            self.forget()
        before, code = "", self.code
        # for each prefix: its Ending, and the Follows of the last piece of its best segmentation
        state, last = [Ending(self, "", "")], [Follows(self, "")]
        for word in sorted(set(words).difference(self.known)):
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del last[same + 1:], state[same + 1:]
            ending = state[same]
            end = same
            for char in word[same:]:
                end += 1
                ending = ending[char]
                for piece, length, follows in ending.ends:
                    if last[end - length][piece]:
                        break
                else:
                    raise AssertionError("no piece ends here")
                last.append(follows)
                state.append(ending)
            ids = []
            while end:
                piece = last[end].left
                ids.append(code.get(piece) or self.by_bytes(piece))
                end -= len(piece)
            ids.reverse()
            self.known[word] = b"".join(ids)
            before = word

    def by_bytes(self, char: str) -> bytes:
        """Byte pieces of a character without a piece (the unknown piece where the model has none)."""
        return array("i", [self.byte.get(b, self.unknown) for b in char.encode()]).tobytes()

    # ---- texts -----------------------------------------------------------------------------
    def encode_batch(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as the bytes of int32 values."""
        cut = [WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        need = {w for words in cut for w in words}
        if len(self.known) > self.memory:
            self.known, self.older = {}, self.known
        self.known.update((w, self.older[w]) for w in need.difference(self.known) if w in self.older)
        self.encode_words(need)
        out = [None if t is None else b"".join(map(self.known.__getitem__, words)) for t, words in zip(texts, cut)]
        for w in need:
            if len(w) > self.LONG:
                del self.known[w]
        return out

    def column(self, batch):
        import numpy as np
        import pyarrow as pa
        coded = self.encode_batch(batch.column("text").to_pylist())
        ends = np.cumsum([0] + [len(c) // 4 if c else 0 for c in coded], dtype=np.int32)
        values = pa.array(np.frombuffer(b"".join(c for c in coded if c), np.int32))
        return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([c is None for c in coded]))


class Decoder:
    """Texts of ids: the bytes of each piece in a row."""

    def __init__(self, model: bytes):
        import pyarrow as pa
        import sentencepiece as sp
        m = sp.SentencePieceProcessor(model_proto=model)
        names = ((i, m.id_to_piece(i)) for i in range(m.get_piece_size()))
        self.pieces = pa.array([bytes([int(p[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) else p.replace(
            MARK, " ").encode() for i, p in names], pa.binary())

    def column(self, batch):
        """Texts of a whole batch: bytes taken by id, joined by row, the blank put in front taken off."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        ids = batch.column("ids")
        ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)), dtype=np.int32)
        pieces = pa.ListArray.from_arrays(pa.array(ends), self.pieces.take(ids.flatten()), mask=ids.is_null())
        raw = pc.binary_join(pieces, b"")
        raw = pc.if_else(pc.starts_with(raw, b" "), pc.binary_replace_slice(raw, 0, 1, b""), raw)
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:  # byte pieces that are no UTF-8 on their own
            return pa.array([r if r is None else r.decode("utf-8", "replace") for r in raw.to_pylist()], pa.string())


@lru_cache(maxsize=2)
def kept(kind: type, model: bytes) -> Pieces | Decoder:
    """One of a kind in a worker process, so that later tasks find known words."""
    return kind(model)


def model_bytes(spark, path: str = MODEL) -> bytes:
    """The model file, read through Spark so that any store will do (a fixed file of under 1 MB)."""
    return bytes(spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").first()["content"])


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``n_ids`` added; all its other columns stay."""
    return _mapped(docs, model, Pieces, "ids", "array<int>").withColumn("n_ids", F.size("ids").cast("long"))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with the decoded ``text_back`` added."""
    return _mapped(encoded, model, Decoder, "text_back", "string")


def _mapped(df: DataFrame, model: str, worker: type, name: str, kind: str) -> DataFrame:
    spark = with_workers(df.sparkSession)
    shared = spark.sparkContext.broadcast(model_bytes(spark, model))
    df = df.drop(name)
    most = 2 << 20  # bytes turned into Python objects at once (at least one row)

    def run(batches):
        import pyarrow as pa
        work = kept(worker, shared.value)
        for batch in batches:
            step = max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield pa.RecordBatch.from_arrays([*part.columns, work.column(part)], [*part.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{name}` {kind}")
