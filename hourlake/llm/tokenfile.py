"""Token files: the ids of whole texts, Huffman-coded in independent blocks.

Method.  Texts are encoded once and their ids kept in a table; ids are counted
over all documents; the counts give a canonical prefix code of limited length
(package-merge), which its code lengths alone describe.  Rows are sorted by
``doc_id`` over range partitions, and each partition's ids are cut into blocks
of ``BLOCK`` ids, coded one by one.  Every ``EVERY`` ids a checkpoint keeps the
bit offset, so a block is decoded from all its checkpoints at once by a table
of ``2 ** LONGEST`` entries, without any other block.

File format: a folder with two Parquet tables.

* ``codebook``: ``id, length`` of every id that occurs; codes are canonical, that
  is, numbered by (length, id).
* ``blocks``: ``part`` (order of the range), ``block`` (order in the part), ``n_ids``,
  ``bits`` (codes from the highest bit on), ``checkpoints`` (bit offsets), and of
  each document that the block touches ``doc_ids``, ``docs`` (number in the part),
  ``starts`` (ids before it in the part) and ``lengths`` (its ids, the end id
  included), so that a document may span any number of blocks.

Texts are encoded by the tokenizers library.  It drops white space and no token
spans it, so a text's ids are those of its words, one after the other; each
worker asks the library once for a word and keeps the answer, up to ``KEPT``
bytes.  Text is parted at space, tab and line feed only: other white
space is left to the library.

Defined cases: a null text is empty and has the end id only; null ids come
first; rows that share an id are ordered by their ids' hash, equal rows stand
beside each other in any order; an empty table gives an empty folder and no
rows; other columns of the input, whatever their names, are not read.  A long
text is held whole by one task, as one string and its ids, and encoded part by
part.  What the driver
holds is bounded by the vocabulary.  No group of rows is put together: equal
ids are split over ranges by hash and row.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.common import bounded, written
from hourlake.session import ensure_checkpoint_dir

#: Longest code, ids in a block, ids between checkpoints, bytes of kept words.
LONGEST, BLOCK, EVERY, KEPT = 18, 1 << 16, 64, 128 << 20
#: Bytes of text encoded and blocks decoded at once.
PART, GROUP = 8 << 20, 16


def _path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of texts by the library, which gets each new word once."""

    def __init__(self, path: str, end_id: int, kept: int = KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_type(max(self.tokenizer.get_vocab_size(), end_id + 1))
        self.end, self.limit, self.size, self.known = end_id, kept, 0, {"": b""}
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.plain = Tokenizer.from_str(json.dumps(json.loads(self.tokenizer.to_str()) | {
            "normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}))

    def _joined(self, tokenizer, words: list[str]):
        """Ids of words that don't hold the mark: the tokenizer gets many at
        once, with marks between them."""
        for k in range(0, len(words), JOINED):
            some = words[k:k + JOINED]
            text = f" {MARK} ".join(some) + f" {MARK}"
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            raw, width, start = ids.tobytes(), ids.itemsize, 0
            for word, stop in zip(some, (np.flatnonzero(ids == self.mark) * width).tolist()):
                yield word, raw[start:stop]
                start = stop + width

    def _each(self, words: list[str]):
        for word, coded in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            yield word, np.array(coded.ids, self.kind).tobytes()

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that aren't kept."""
        if self.mark is None:
            return dict(self._each(words))
        cut, letters, other, marked = {}, set(), set(), []
        for word in words:
            if plain := PLAIN(word.lower()):
                cut[word] = stem, _ = plain.groups()
                letters.add(stem)
            elif MARK in word:
                marked.append(word)
            else:
                other.add(word)
        ids = {stem: self.known[stem] for stem in letters if stem in self.known}
        ids.update(self._joined(self.plain, list(letters.difference(ids))))
        stops = dict(self._each(sorted(STOPS)))
        stops[""] = b""
        out = {word: ids[stem] + stops[stop] for word, (stem, stop) in cut.items()}
        out.update(self._joined(self.tokenizer, list(other)))
        out.update(self._each(marked))
        return ids | out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each followed by the end id, end to end, and their
        offsets."""
        parted = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " "), " ")
        words = parted.flatten().dictionary_encode()
        names = words.dictionary.to_pylist()
        found = [self.known.get(w) for w in names]
        fresh = self._new([w for w, ids in zip(names, found) if ids is None])
        found = [fresh[w] if ids is None else ids for w, ids in zip(names, found)]
        if self.size < self.limit:  # then it keeps what it has: frequent words come early
            self.known.update(fresh)
            self.size += sum(map(len, fresh)) + sum(map(len, fresh.values())) + 180 * len(fresh)
        pool, width = np.frombuffer(b"".join(found), self.kind), np.dtype(self.kind).itemsize
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // width
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        word = words.indices.to_numpy()
        sizes, begins = sizes[word], begins[word]
        ends = np.cumsum(sizes, dtype=np.int32)  # texts of a batch have fewer ids than 2^31
        ids = pool[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        last = np.concatenate([[0], ends])[parted.offsets.to_numpy()[1:] - parted.offsets[0].as_py()]
        offsets = np.concatenate([[0], last + np.arange(1, len(texts) + 1)])
        out = np.empty(offsets[-1], self.kind)
        text_end = np.zeros(len(out), bool)
        text_end[offsets[1:] - 1] = True
        out[text_end], out[~text_end] = self.end, ids
        return out, offsets

    def encode_long(self, text: str) -> np.ndarray:
        """Ids of one long text, a part of about ``PART`` characters at a time,
        cut behind a space."""
        out, start = [], 0
        while start < len(text):
            stop = text.find(" ", start + PART) + 1 or len(text)
            out.append(self.encode(pa.array([text[start:stop]], pa.large_string()))[0][:-1])
            start = stop
        return np.concatenate([*out, np.array([self.end], self.kind)])


#: Put between words: one token, that no word without this character has, and
#: that no other character is normalised to.
MARK, JOINED = "~", 1000
#: Words that are, in small letters, of letters below this and perhaps a stop
#: behind them: normalising leaves them as they are, every version of Unicode
#: calls them letters, and both parts are tokens of their own.
STOPS, LETTERS = ".,;:!?", 0x250
PLAIN = re.compile("([{}]+)([{}]?)".format("".join(c for c in map(chr, range(LETTERS)) if c.isalpha() and c.islower()), STOPS)).fullmatch


@lru_cache(maxsize=2)
def shared_encoder(path: str, end_id: int) -> WordEncoder:
    """A worker's encoder, with the words it met in earlier tasks."""
    return WordEncoder(path, end_id)


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, ids`` (bytes) of every row, and from each task, in rows without
    ``ids``, how often it met each id: ``counts``, pairs of 64-bit integers."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.BinaryType()),
                           T.StructField("counts", T.BinaryType())])

    def run(batches):
        encoder, total, kind = shared_encoder(path, end_id), np.zeros(0, np.int64), None
        for batch in bounded(batches, "text", PART):
            kind = batch.column("doc_id").type
            texts = batch.column("text").fill_null("")
            if batch.num_rows == 1 and len(texts[0].as_py()) > PART:
                ids = encoder.encode_long(texts[0].as_py())
                offsets = np.array([0, len(ids)])
            else:
                ids, offsets = encoder.encode(texts)
            n = np.bincount(ids, minlength=len(total))
            n[:len(total)] += total
            total = n
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [
                None, pa.py_buffer((offsets * ids.itemsize).astype(np.int64)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column.cast(pa.binary()), pa.nulls(batch.num_rows, pa.binary())], schema.names)
        if kind is not None:
            met = np.flatnonzero(total)
            pairs = np.stack([met, total[met]], axis=1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([pairs], pa.binary())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Integers of a binary column end to end, and the rows' offsets."""
    column = column.cast(pa.large_binary())
    width = np.dtype(kind).itemsize
    if not len(column):
        return np.empty(0, kind), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw.view(kind) if raw.flags.aligned and not raw.ctypes.data % width else raw.copy().view(kind), \
        (offsets - offsets[0]) // width


def id_counts(coded: DataFrame) -> DataFrame:
    """``id, n`` over all rows, from what the tasks counted."""

    def run(batches):
        for batch in batches:
            for pairs in batch.column("counts"):
                ids, n = np.frombuffer(pairs.as_buffer(), "<i8").reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["id", "n"])

    rows = coded.where("counts IS NOT NULL").select("counts").mapInArrow(run, "id long, n long")
    return rows.groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Code lengths of least total for symbols with these counts, none above
    ``longest`` (or the bits that so many symbols need): package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    longest = max(longest, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    packages, levels = np.empty(0, np.int64), []
    for _ in range(longest):
        merged = np.concatenate([leaves, packages])
        by_weight = np.argsort(merged, kind="stable")
        levels.append(by_weight < n)
        merged = merged[by_weight]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:taken].sum())
        lengths[:chosen] += 1
        taken = 2 * (taken - chosen)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes from ids and their lengths; coding and decoding tables."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = np.asarray(ids, np.int64)[order], np.asarray(lengths, np.int64)[order]
        self.longest = int(self.lengths.max(initial=1))
        room = np.left_shift(1, self.longest - self.lengths)
        first = np.cumsum(room) - room
        codes = first >> (self.longest - self.lengths)
        size = int(self.ids.max(initial=-1)) + 1
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[self.ids], self.length[self.ids] = codes.astype(np.uint64), self.lengths
        # what a window starts with: a symbol, and below it the length of its code
        self.entry = np.ones(1 << self.longest, np.int64)
        self.entry[:room.sum()] = np.repeat(self.ids << 5 | self.lengths, room)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """Bits of ids, and the bit offset of each ``every``-th of them."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        word = starts >> 5
        shifted = self.code[ids] << (64 - lengths - (starts & 31)).astype(np.uint64)
        n = (int(ends[-1]) + 31 >> 5) + 1 if len(ids) else 0
        # No two codes share a bit, so sums of them are exact below 2^32.
        words = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), n)
        words += np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        size = int(ends[-1]) + 7 >> 3 if len(ids) else 0
        return words.astype(">u4").tobytes()[:size], starts[::every]

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]], every: int) -> list[np.ndarray]:
        """Ids of blocks of (bits, checkpoints, number of ids), all checkpoints
        side by side."""
        # the last checkpoint of a block may read past its end: every step 25 bits at most
        raw = np.frombuffer(b"".join(bits for bits, _, _ in blocks) + b"\0" * (4 * every + 8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        base = np.cumsum([0, *(len(bits) for bits, _, _ in blocks)]) * 8
        at = np.concatenate([b + c for b, (_, c, _) in zip(base, blocks)]).astype(np.int64)
        out, above, mask = np.empty((every, len(at)), np.uint32), 32 - self.longest, (1 << self.longest) - 1
        for step in range(every):
            entry = self.entry[window[at >> 3] >> (above - (at & 7)) & mask]
            out[step] = entry >> 5
            at += entry & 31
        out = out.T
        rows, lane = [], 0
        for _, checkpoints, n in blocks:
            rows.append(out[lane:lane + len(checkpoints)].reshape(-1)[:n])
            lane += len(checkpoints)
        return rows


def _block_schema(doc_type: T.DataType) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("bits", T.BinaryType()), T.StructField("checkpoints", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(doc_type)), T.StructField("docs", longs), T.StructField("starts", longs),
        T.StructField("lengths", longs)])


def _blocks(batches, book: Codebook, kind: str, block: int, every: int, schema: T.StructType):
    """Blocks of one partition's rows, in their order."""
    arrow = pa.schema([(f.name, _ARROW[f.name]) for f in schema if f.name in _ARROW])
    part = TaskContext.get().partitionId()
    pending, done, number = np.empty(0, kind), 0, 0
    names, starts, lengths = [], np.empty(0, np.int64), np.empty(0, np.int64)
    doc_type = None

    def emitted(stop: int) -> list[list]:
        nonlocal pending, done, number, names, starts, lengths
        rows = []
        while done < stop:
            n = min(block, stop - done)
            bits, checkpoints = book.encode(pending[:n], every)
            last = int(np.searchsorted(starts, done + n))
            rows.append([part, done // block, n, bits, checkpoints, names[:last], np.arange(number, number + last), starts[:last], lengths[:last]])
            pending, done = pending[n:], done + n
            gone = int(np.searchsorted(starts + lengths, done, side="right"))
            names, starts, lengths, number = names[gone:], starts[gone:], lengths[gone:], number + gone
        return rows

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(c, arrow.field(f.name).type) if f.name in _ARROW else pa.array(c, pa.list_(doc_type))
                  for f, c in zip(schema, columns)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    for batch in batches:
        doc_type = batch.column("doc_id").type
        ids, offsets = flat(batch.column("ids"), kind)
        at = done + len(pending)
        names += batch.column("doc_id").to_pylist()
        starts = np.concatenate([starts, at + offsets[:-1]])
        lengths = np.concatenate([lengths, np.diff(offsets)])
        pending = np.concatenate([pending, ids])
        if rows := emitted((done + len(pending)) // block * block):
            yield batch_of(rows)
    if rows := emitted(done + len(pending)):
        yield batch_of(rows)


_ARROW = {"part": pa.int32(), "block": pa.int64(), "n_ids": pa.int64(), "bits": pa.binary(), "checkpoints": pa.list_(pa.int32()),
          "docs": pa.list_(pa.int64()), "starts": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64())}


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1, longest: int = LONGEST,
                      block: int = BLOCK, every: int = EVERY) -> str:
    """Encode every row's text and write the token files; gives the folder.

    ``longest`` may be 25 bits at most (a decoding window has 32)."""
    path, spark = _path(path), docs.sparkSession
    from tokenizers import Tokenizer

    kind = id_type(max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1))
    coded = tokenised(docs, path, end_id)
    coded = written(coded.withColumn("_hash", F.xxhash64("ids")).withColumn("_row", F.monotonically_increasing_id()))
    counts = id_counts(coded).collect()  # a row for each id of the vocabulary at most
    ids, n = (np.array([r[i] for r in counts], np.int64) for i in (0, 1))
    lengths = code_lengths(n, longest)
    book = [(int(a), int(b)) for a, b in zip(ids, lengths)]
    spark.createDataFrame(book, "id int, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    schema = _block_schema(docs.schema["doc_id"].dataType)

    def run(batches):
        return _blocks(batches, Codebook(ids, lengths), kind, block, every, schema)

    keys = ["doc_id", "_hash", "_row"]
    ordered = coded.where("ids IS NOT NULL").drop("counts").repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "ids")
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/blocks")
    return folder


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column of integers."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _book(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray]:
    rows = spark.read.schema("id int, length int").parquet(f"{folder}/codebook").collect()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in (0, 1))


def _decoded(spark: SparkSession, folder: str, value: str, kind: T.DataType, of, block: int, every: int) -> DataFrame:
    """``part, doc, doc_id, start, n_tokens, at`` and ``value`` of each document's
    piece in each block: ``of(ids of the piece, ids after it)``."""
    ids, lengths = _book(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    doc_type = blocks.schema["doc_ids"].dataType.elementType
    long = T.LongType()
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("doc", long), T.StructField("doc_id", doc_type),
                           T.StructField("start", long), T.StructField("n_tokens", long), T.StructField("at", long),
                           T.StructField(value, kind)])

    def run(batches):
        book = Codebook(ids, lengths)
        for batch in batches:
            names = batch.column("doc_ids").values
            ends = batch.column("doc_ids").offsets.to_pylist()
            docs, starts, sizes = (_lists(batch.column(c)) for c in ("docs", "starts", "lengths"))
            part, number, held = (batch.column(c).to_numpy() for c in ("part", "block", "n_ids"))
            bits, checkpoints = batch.column("bits").to_pylist(), _lists(batch.column("checkpoints"))
            for first in range(0, batch.num_rows, GROUP):
                rows = range(first, min(first + GROUP, batch.num_rows))
                decoded = book.decode([(bits[i], checkpoints[i], int(held[i])) for i in rows], every)
                begin = np.repeat(number[first:rows.stop] * block, [len(docs[i]) for i in rows])
                end = np.repeat(number[first:rows.stop] * block + held[first:rows.stop], [len(docs[i]) for i in rows])
                start, size = (np.concatenate([x[i] for i in rows]) for x in (starts, sizes))
                low, high = np.maximum(start, begin), np.minimum(start + size, end)
                own = np.repeat(np.arange(len(rows)), [len(docs[i]) for i in rows])
                values = [of(decoded[i][a:b], after) for i, a, b, after in
                          zip(own.tolist(), (low - begin).tolist(), (high - begin).tolist(), (start + size - high).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[first:rows.stop][own]), pa.array(np.concatenate([docs[i] for i in rows])),
                     names.slice(ends[first], ends[rows.stop] - ends[first]), pa.array(start), pa.array(size), pa.array(low - start),
                     pa.array(values, _VALUE[value])], schema.names)

    return blocks.mapInArrow(run, schema)


_VALUE = {"ids": pa.list_(pa.int32()), "crc": pa.int64()}


def _with_start(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Documents with ``start`` counted from the first part on.  A part is a
    range of the sort, so the window runs over as many rows as it had tasks."""
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = F.sum("_ids").over(Window.orderBy("part")) - F.col("_ids")
    parts = sizes.select(F.col("part").alias("_part"), before.alias("_before"))
    joined = docs.join(parts, F.col("part") == F.col("_part"))
    return joined.withColumn("start", F.col("start") + F.col("_before")).drop("part", "doc", "_part", "_before")


def read_token_files(spark: SparkSession, folder: str, block: int = BLOCK, every: int = EVERY) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of the folder."""
    pieces = _decoded(spark, folder, "ids", T.ArrayType(T.IntegerType()), lambda ids, after: ids.astype(np.int32), block, every)
    whole = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.max("start").alias("start"), F.max("n_tokens").alias("n_tokens"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "ids"))), lambda p: p["ids"])).alias("ids"))
    return _with_start(whole, spark.read.parquet(f"{folder}/blocks"))


#: CRC-32, as public standards give it: the reversed polynomial.
POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), highest power in the lowest bit,
    modulo the CRC's."""
    out = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def crc_before(crc: int, n_bytes: int) -> int:
    """What bytes of this CRC-32 contribute to that of themselves and ``n_bytes``
    more: the CRC of a whole is the XOR of its parts' contributions."""
    step = 1 << 23  # one byte
    while n_bytes:
        if n_bytes & 1:
            crc = _times(step, crc)
        step = _times(step, step)
        n_bytes >>= 1
    return crc


def _crc_piece(ids: np.ndarray, after: int) -> int:
    crc = zlib.crc32(ids.astype("<u4", copy=False))
    return crc_before(crc, 4 * after) if after else crc


def token_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the token files of all documents into the shared folder, read them
    back, and digest each document's ids as read."""
    spark = docs.sparkSession
    folder = write_token_files(docs, f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}", path)
    pieces = _decoded(spark, folder, "crc", T.LongType(), _crc_piece, BLOCK, EVERY)
    whole = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.max("start").alias("start"), F.max("n_tokens").alias("n_tokens"),
        F.bit_xor("crc").alias("ids_crc32"))
    return _with_start(whole, spark.read.parquet(f"{folder}/blocks")).select("doc_id", "start", "n_tokens", "ids_crc32")
