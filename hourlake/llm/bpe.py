"""Byte-level BPE encoding and decoding against a given rank file.

Pre-tokenisation runs on whole batches without regular expressions.  Every
code point becomes a symbol (its class, joined with what little of its right
neighbours matters); every symbol stands for a function between the states of
a small automaton.  Composition of functions is associative, so the state at
every position comes from a blocked scan: blocks are reduced to one function
each, the block functions are scanned by doubling, and each block is then run
from its known entry state, all blocks side by side.  A token starts where
(state before, symbol) says so.  The slices are merged by rank; merged slices
are cached, and the character offsets of the tokens are kept.

Defined cases: a null text counts as empty and gives no tokens; rows are
encoded one by one, so repeated rows and null ids need no care; an empty table
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.common import bounded

# Symbols.
LETTER, NUMBER, OTHER = 0, 1, 2
SUFFIX1, SUFFIX2 = 3, 4  # an apostrophe before one of s t m d, before one of re ve ll
SPACE, LEAD, ALONE = 5, 6, 7  # white space before more of it or the end; a last blank; another last white space
BREAK = 8  # between two texts
SYMBOLS = 9

# States: what the last code point was.
LETTERS, NUMBERS, OTHERS, SPACES, BLANK, WAIT1, WAIT2, FRESH = range(8)
STATES = 8


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token starts here", by symbol and state."""
    step, start = np.zeros((SYMBOLS, STATES), np.uint8), np.ones((SYMBOLS, STATES), bool)
    for state in range(STATES):
        for symbol, target in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS),
                               (SUFFIX1, OTHERS), (SUFFIX2, OTHERS)):
            step[symbol, state] = target
            start[symbol, state] = state not in (target, BLANK)
        if state not in (OTHERS, BLANK):  # an apostrophe that begins a token
            step[SUFFIX1, state], step[SUFFIX2, state] = WAIT1, WAIT2
        step[SPACE, state], start[SPACE, state] = SPACES, state != SPACES
        step[LEAD, state] = BLANK
        step[ALONE, state] = FRESH
        step[BREAK, state] = FRESH
    step[LETTER, WAIT2], start[LETTER, WAIT2] = WAIT1, False
    step[LETTER, WAIT1], start[LETTER, WAIT1] = FRESH, False
    return step, start


STEP, START = _automaton()
BLOCK = 64
#: Bytes of text scanned at a time (a longer text stays whole).
PART = 512 << 10


def states_before(symbols: np.ndarray) -> np.ndarray:
    """State before each position, by an associative scan of the symbols'
    transition functions from FRESH."""
    n = len(symbols)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, BREAK, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    flat = STEP.ravel()
    total = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))  # each block's function, from the identity
    for row in grid:
        total = flat[row[:, None].astype(np.int16) * STATES + total]
    reach = 1
    while reach < blocks:  # inclusive scan of the block functions by doubling
        later = np.take_along_axis(total[reach:], total[:-reach].astype(np.intp), 1)
        total = np.concatenate([total[:reach], later])
        reach *= 2
    state = np.empty(blocks, np.uint8)
    state[:1], state[1:] = FRESH, total[:-1, FRESH]
    out = np.empty((BLOCK, blocks), np.uint8)
    for i, row in enumerate(grid):
        out[i] = state
        state = flat[row.astype(np.int16) * STATES + state]
    return out.T.reshape(-1)[:n]


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """0 letter, 1 number, 2 other, 5 white space, by code point, as the
    tokenizer library's own matcher sees them: each class is asked from it
    once, by matching every code point."""
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        single = tiktoken.Encoding("class", pat_str=pattern, special_tokens={},
                                   mergeable_ranks={bytes([i]): i for i in range(256)})
        members = bytes(single.encode_ordinary(every)).decode()
        classes[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = symbol
    return classes


def token_starts(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """True where a pre-token starts.  ``points`` holds the texts end to end
    with one code point after each text, at ``breaks``, that parts them."""
    symbols = code_point_classes()[points]
    symbols[breaks] = BREAK
    white = symbols == SPACE
    before_word = np.zeros(len(points), bool)
    before_word[:-1] = (symbols[1:] < SPACE)
    last = white & before_word
    symbols[last] = np.where(points[last] == 32, LEAD, ALONE)
    quote = np.flatnonzero((points == 39) & (symbols == OTHER))
    first = points[np.minimum(quote + 1, len(points) - 1)]
    second = points[np.minimum(quote + 2, len(points) - 1)]
    symbols[quote[np.isin(first, [ord(c) for c in "stmd"])]] = SUFFIX1
    two = (second == ord("e")) & np.isin(first, [ord("r"), ord("v")]) | (first == ord("l")) & (second == ord("l"))
    symbols[quote[two]] = SUFFIX2
    starts = START.ravel()[symbols.astype(np.int16) * STATES + states_before(symbols)]
    starts[breaks] = True
    return starts


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


NO_RANK = 1 << 60


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Merge the adjacent pair of lowest rank, the leftmost of equals, until no
    pair has a rank."""
    if len(piece) > 100:
        return merge_long(piece, ranks)
    get = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [get(piece[i:i + 2], NO_RANK) for i in range(len(piece) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == NO_RANK:
            break
        i = pairs.index(lowest)
        joined = parts[i] + parts[i + 1]
        parts[i:i + 2] = [joined]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(joined + parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = get(parts[i - 1] + joined, NO_RANK)
    return tuple(map(ranks.__getitem__, parts))


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same with a heap over a linked list: n log n for n bytes."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    alive = bytearray(b"\x01") * n

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            rank = ranks.get(piece[i:end[end[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[end[i]]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue  # one of its parts has been merged since
        middle = end[i]
        alive[middle] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return tuple(out)


class Encoder:
    """Encodes batches of texts; keeps a cache of merged pieces, cleared when
    full and without pieces of over 64 bytes, so its memory is bounded."""

    def __init__(self, path: str, cache_size: int = 200_000):
        self.ranks, self.cache, self.cache_size = load_ranks(path), {}, cache_size

    def piece(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        ids = (rank,) if rank is not None else merge(piece, self.ranks)
        if len(piece) <= 64:
            if len(self.cache) >= self.cache_size:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids, and the byte offset at which each id starts, of each text."""
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        breaks = np.cumsum([len(t) + 1 for t in texts]) - 1
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate([[0], np.cumsum(width)])
        where = np.flatnonzero(token_starts(points, breaks))
        cuts = at[where].tolist()  # byte offsets of the pieces; one piece for each break too
        data, cache, piece = joined.encode(), self.cache, self.piece
        ends = np.searchsorted(where, breaks)
        out, first = [], 0
        for last in ends.tolist():
            ids: list[int] = []
            for k in range(first, last):
                part = data[cuts[k]:cuts[k + 1]]
                ids += cache.get(part) or piece(part)
            out.append(np.array(ids, np.uint32))
            first = last + 1
        lengths = self.lengths
        return [(ids, np.concatenate([[0], np.cumsum(lengths[ids])[:-1]]) if len(ids) else np.empty(0, np.int64))
                for ids in out]

    @property
    def lengths(self) -> np.ndarray:
        if not hasattr(self, "_lengths"):
            self._lengths = np.zeros(max(self.ranks.values(), default=-1) + 1, np.int64)
            for token, rank in self.ranks.items():
                self._lengths[rank] = len(token)
        return self._lengths


@lru_cache(maxsize=4)
def load_tokens(path: str) -> list[bytes]:
    """The bytes of every token, by rank."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decode(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def pack(ids: np.ndarray) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return ids.astype("<u4").tobytes()


def _path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _coded(batches, path: str):
    """Parts of the record batches, with the ids and offsets of their texts.
    The scan's arrays take some forty bytes a byte of text, so parts are small."""
    encoder = Encoder(path)
    for batch in bounded(batches, "text", PART):
        yield batch, encoder.encode([t or "" for t in batch.column("text").to_pylist()])


def encode_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, offsets`` of every whole text: token ids without special
    tokens, and the byte offset in the text at which each token starts."""
    path = _path(path)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("offsets", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch, coded in _coded(batches, path):
            ends = np.cumsum([0, *(len(ids) for ids, _ in coded)]).astype(np.int32)
            flat = [np.concatenate([x[i] for x in coded]) for i in (0, 1)]
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind)))
                       for values, kind in zip(flat, (np.int32, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "ids", "offsets"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_bpe(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` (with ``ids``) plus ``decoded``, the bytes the ids stand for,
    and ``packed``, the ids as little-endian unsigned 32-bit integers."""
    path = _path(path)
    names = coded.columns
    schema = T.StructType([*coded.schema.fields, T.StructField("decoded", T.BinaryType()),
                           T.StructField("packed", T.BinaryType())])

    def run(batches):
        tokens = load_tokens(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("ids")
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            rows = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
            decoded = pa.array([decode(ids, tokens) for ids in rows], pa.binary())
            packed = pa.array([pack(ids) for ids in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns)), decoded, packed], [*names, "decoded", "packed"])

    return coded.mapInArrow(run, schema)


def bpe_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode, decode and digest every document, in one pass over the texts:
    ids and decoded bytes stay in the worker that made them."""
    path = _path(path)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    digest = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches):
        tokens = load_tokens(path)
        for batch, coded in _coded(batches, path):
            ids = [ids for ids, _ in coded]
            columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array([digest(pack(x)) for x in ids], pa.string()),
                       pa.array([digest(decode(x, tokens)) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
