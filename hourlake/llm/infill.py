"""Fill-in-middle: whole texts cut at two token boundaries and reordered.

Method.  The bytes of a batch of texts get one of four classes: continuation
byte of a code point, code point that is no letter, letter that starts a run,
letter that continues one.  A wavelet matrix over these classes (two bit levels
with rank directories) answers, at any position, how many bytes of a class
stand before it.  Token starts are the two middle classes, code points all but
the first, so boundary counts and lengths are sums of ranks, and a cut behind k
tokens is found for all texts of the batch at once by bisection on ranks.

Tokens are ``[A-Za-z]+|[^A-Za-z]`` over code points.  The draws come from the
sha256 of the seed and the row's ``doc_id``: a re-run task makes the same cuts.

Defined cases: a null text is empty, an empty text and one that holds a marker
stay plain; a null ``doc_id`` draws like an empty one; repeated ids draw alike,
repeated rows come back repeated; an empty table gives an empty table; other
columns of the input, whatever their names, are not read.  Memory follows the
longest text: the arrays of a batch take about ten bytes a byte, and a batch
holds ``PART`` bytes or one longer text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.common import bounded, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PART = 4 << 20

#: Classes of bytes.
INSIDE, SINGLE, START, MORE = range(4)


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte of texts laid end to end from ``starts``."""
    table = np.full(256, SINGLE, np.uint8)
    table[0x80:0xC0] = INSIDE
    table[ord("A"):ord("Z") + 1] = table[ord("a"):ord("z") + 1] = START
    out = table[data]
    letter = out == START
    out[1:][letter[1:] & letter[:-1]] = MORE
    first = starts[starts < len(data)]
    out[first[letter[first]]] = START
    return out


class Ranks:
    """Number of ones before any position of a bit array."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Ranks of values below ``2 ** levels``: each level holds one bit of the
    values, from the highest, in the order that the levels above sorted them."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels = []
        for level in reversed(range(levels)):
            bit = (values >> level) & 1
            self.levels.append((level, Ranks(bit), len(bit) - int(bit.sum())))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` values equal ``value``."""
        low, high = np.zeros_like(at), at
        for level, ranks, zeros in self.levels:
            ones = ranks.ones(low), ranks.ones(high)
            low, high = (zeros + ones[0], zeros + ones[1]) if value >> level & 1 else (low - ones[0], high - ones[1])
        return high - low


class Boundaries:
    """Token and code point counts of the texts of a batch, and its cuts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.start, self.stop = offsets[:-1], offsets[1:]
        self.matrix = WaveletMatrix(classes(data, self.start), 2)
        self.base = self._starts(self.start)
        self.counts = self._starts(self.stop) - self.base

    def _starts(self, at: np.ndarray) -> np.ndarray:
        return self.matrix.rank(SINGLE, at) + self.matrix.rank(START, at)

    def cut(self, k: np.ndarray) -> np.ndarray:
        """The position behind each text's first ``k`` tokens: the last one
        before which no more than ``k`` tokens start."""
        low, high = self.start.copy(), self.stop.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self._starts(middle) - self.base <= k
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low

    def chars(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        inside = self.matrix.rank(INSIDE, stop) - self.matrix.rank(INSIDE, start)
        return stop - start - inside


def draws(doc_id, seed: str) -> list[int]:
    """The first four 32-bit groups of the row's hash."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return np.frombuffer(digest, ">u4", 4).tolist()


def fill_in_middle(docs: DataFrame, seed: str = "1", plain: int = 10, spm: int = 20) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    ``plain`` per cent of the texts stay as they are; ``spm`` per cent of the
    draws for the others put the suffix first, the rest the prefix."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType())])
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches):
        for batch in bounded(batches, "text", PART):
            data, offsets = utf8(batch.column("text"))
            bounds = Boundaries(data, offsets)
            h = np.array([draws(x, seed) for x in batch.column("doc_id").to_pylist()], np.int64)
            k = np.sort(h[:, :2] % (bounds.counts + 1)[:, None], axis=1)
            first, second = bounds.cut(k[:, 0]), bounds.cut(k[:, 1])
            sizes = bounds.chars(bounds.start, first), bounds.chars(first, second)
            raw, forms, outputs = data.tobytes(), [], []
            for a, b, c, d, (_, _, h3, h4) in zip(offsets[:-1].tolist(), first.tolist(), second.tolist(),
                                                  offsets[1:].tolist(), h.tolist()):
                text = raw[a:d]
                if not text or h3 % 100 >= 100 - plain or any(m in text for m in markers):
                    forms.append("plain")
                    outputs.append(text)
                    continue
                parts = raw[a:b], raw[c:d], raw[b:c]
                forms.append("spm" if h4 % 100 < spm else "psm")
                order = (1, 0, 2) if forms[-1] == "spm" else (0, 1, 2)
                outputs.append(b"".join(markers[i] + parts[i] for i in order))
            kept = pa.array([f != "plain" for f in forms])
            null = pa.scalar(None, pa.int64())
            columns = [pa.array(bounds.counts, pa.int64()), pa.array(forms, pa.string()),
                       *(pa.compute.if_else(kept, pa.array(x, pa.int64()), null) for x in sizes),
                       pa.array(outputs, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(output, form):
    """Column: the exact text, rebuilt from an output and its form.  A text that
    was cut holds no marker and no two parts can make one between them, so the
    three markers of the output are the only ones."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix, suffix = (F.when(form == "psm", parts[i]).otherwise(parts[j]) for i, j in ((1, 2), (2, 1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def infill_report(docs: DataFrame) -> DataFrame:
    """Counts, form and digests of every document's output and of the text
    rebuilt from it."""
    rows = fill_in_middle(docs)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
