"""Fill-in-the-middle: two cuts at unit boundaries, located on a wavelet matrix of character classes.

The texts of a bounded run of rows are laid end to end as code points, each
code point is mapped to one of eight classes, and one wavelet matrix is
built over the class sequence. A unit ends after a character of the unit kind's
end classes (a line after a newline; a sentence after a full stop, question
or exclamation mark or a newline), and what follows the last end is a unit too:
``[^E]*E|[^E]+`` matched from left to right. So the number of units that end
within the first i characters of a text is the sum over the end classes of
rank(class, start + i) - rank(class, start). The total follows from the
ranks at the text's end, and the cut after k units is the smallest i whose
sum is k, found by bisection on the ranks, for all texts of the run at once.

The random numbers h1 to h4 of a row are the first four 8-digit groups of the
hex SHA-256 of ``seed:id``, so they depend on nothing but the id. Prefix
ends after min, middle after max of h1 and h2 modulo (units + 1).

Forms: ``plain`` (the text), ``psm`` (``<P>prefix<S>suffix<M>middle``) and ``spm``
(``<S>suffix<P>prefix<M>middle``). ``restore`` rebuilds the text in SQL functions.

Defined results: null text counts as empty and is plain, as is a text
that holds a mark itself, so a text can't forge one. Null ids hash as an empty string; rows with equal id
and text get equal results; every row gives one row. Only the id and text columns are
read; other columns are neither used nor returned, whatever their names.
A text is held whole by one task, with about twelve bytes a character; a run
holds ``RUN`` characters or one text. An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import row_runs, with_workers

P, S, M = "<P>", "<S>", "<M>"
OTHER, LETTER, DIGIT, SPACE, NEWLINE, STOP, PUNCTUATION, MARK = range(8)
#: Unit kinds by their end classes.
UNITS = {"line": (NEWLINE,), "sentence": (STOP, NEWLINE), "word": (SPACE, NEWLINE),
         "character": (OTHER, LETTER, DIGIT, SPACE, NEWLINE, STOP, PUNCTUATION, MARK)}
STOPS = ".!?。！？।"
#: Characters of one wavelet matrix, at most (or one text).
RUN = 2_000_000


@lru_cache(maxsize=1)
def class_table():
    """Class of every code point, by Unicode's general categories."""
    import numpy as np
    of = {"L": LETTER, "N": DIGIT, "Z": SPACE, "P": PUNCTUATION, "M": MARK}
    out = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[[9, 11, 12, 13]] = SPACE
    out[[ord(c) for c in STOPS]] = STOP
    out[10] = NEWLINE
    return out


class Bits:
    """Bit sequence with rank: packed words and the ones before each word."""

    def __init__(self, bits):
        import numpy as np
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank1(self, at):
        """Ones among the first ``at`` bits (an array of positions)."""
        import numpy as np
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Ranks of symbols below 2**width: one bit sequence a level, high bit first, zeros kept in front."""

    def __init__(self, symbols, width: int = 3):
        import numpy as np
        self.levels = []
        for shift in range(width - 1, -1, -1):
            bits = (symbols >> shift) & 1 == 1
            self.levels.append((shift, Bits(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbol: int, at):
        """Occurrences of ``symbol`` among the first ``at`` symbols."""
        import numpy as np
        low, high = np.zeros_like(at), at
        for shift, bits in self.levels:
            ones_low, ones_high = bits.rank1(low), bits.rank1(high)
            if symbol >> shift & 1:
                low, high = bits.zeros + ones_low, bits.zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low


class Boundaries:
    """Unit boundaries of texts laid end to end."""

    def __init__(self, texts: list[str], ends: tuple[int, ...]):
        import numpy as np
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        classes = class_table()[codes]
        self.matrix, self.ends = WaveletMatrix(classes), ends
        lengths = np.array([len(t) for t in texts], np.int64)
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths
        self.base, closed = self.ranks(self.start), self.ranks(self.stop)
        last = classes[np.maximum(self.stop - 1, 0)] if len(codes) else np.zeros(len(texts), np.uint8)
        self.open = (lengths > 0) & ~np.isin(last, ends)
        self.closed = closed - self.base

    def ranks(self, at):
        return sum(self.matrix.rank(c, at) for c in self.ends)

    def units(self):
        """Units of each text."""
        return self.closed + self.open

    def locate(self, k):
        """Characters of each text's first ``k`` units: the least position whose boundary count is k."""
        import numpy as np
        low, high = self.start.copy(), self.stop.copy()
        while (low < high).any():
            mid = (low + high) >> 1
            enough = self.ranks(mid) - self.base >= k
            high, low = np.where(enough, mid, high), np.where(enough | (low >= high), low, mid + 1)
        return np.where(k > self.closed, self.stop, high) - self.start


def assemble(text: str, form: str, prefix: int, middle: int) -> str:
    if form == "plain":
        return text
    head, mid, tail = text[:prefix], text[prefix:prefix + middle], text[prefix + middle:]
    return f"{P}{head}{S}{tail}{M}{mid}" if form == "psm" else f"{S}{tail}{P}{head}{M}{mid}"


def cut_run(texts: list[str], h: list, ends: tuple[int, ...], rate: int, spm_rate: int) -> list[tuple]:
    """(units, form, prefix characters, middle characters, output) of each text; h: arrays h1 to h4."""
    import numpy as np
    found = Boundaries(texts, ends)
    n = found.units()
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    first, second = found.locate(np.minimum(one, two)), found.locate(np.maximum(one, two))
    out = []
    for i, t in enumerate(texts):
        if not t or P in t or S in t or M in t or h[2][i] % 100 >= rate:
            out.append((int(n[i]), "plain", None, None, t))
            continue
        form, a, b = "spm" if h[3][i] % 100 < spm_rate else "psm", int(first[i]), int(second[i] - first[i])
        out.append((int(n[i]), form, a, b, assemble(t, form, a, b)))
    return out


def numbers(key: Column, seed: int) -> Column:
    """The four random numbers of a row."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def transform(docs: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, spm_rate: int = 50,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_units, form, prefix_chars, middle_chars, output) of every row.

    ``rate`` of 100 rows are cut, ``spm_rate`` of 100 of these suffix first.
    """
    with_workers(docs.sparkSession)
    ends, run_chars = UNITS[unit], RUN
    work = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       numbers(F.col(key), seed).alias("h"))

    def run(batches):
        import pyarrow as pa
        schema = pa.schema([("n_units", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                            ("middle_chars", pa.int64()), ("output", pa.string())])
        for batch in batches:
            for part in row_runs(batch, "text", run_chars):  # bytes, so at most as many characters
                h = part.column("h").flatten().to_numpy().reshape(part.num_rows, 4).T
                made = cut_run(part.column("text").to_pylist(), list(h), ends, rate, spm_rate)
                columns = [pa.array(c, f.type) for c, f in zip(zip(*made), schema)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], ["key", *schema.names])

    kind = work.schema["key"].dataType.simpleString()
    out = work.mapInArrow(run, f"key {kind}, n_units long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("key", key)


def restore(output: Column, form: Column) -> Column:
    """The text of an output and its form. No part of a cut text holds a mark, so splitting at marks is exact."""
    parts = F.split(output, f"{P}|{S}|{M}", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
