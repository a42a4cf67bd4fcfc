"""Exact top-k search with multi-resolution segment statistics.

A vector cut into segments of equal length has a mean and a deviation per
segment.  For two vectors the squared distance is at least
``sum(length * ((m1 - m2)^2 + (s1 - s2)^2))`` over the segments; with both
norms known that lower bound is the same as an upper bound
``sum(length * (m1 * m2 + s1 * s2))`` on their inner product.  One segment is
the coarsest level; finer levels are tighter, the finest is exact.

Candidates are dealt to the nearest of a bounded sample of pivots, pivots with
many candidates are split by hash, and each block keeps its centre and, at every
level, the least and greatest mean and the greatest deviation of the segments
of its members less the centre.  That bounds a query's product with any member:

1.  A query first meets the block of the greatest bound (and further ones, while
    those have too few members): its k-th best score there is its floor.
2.  Then it meets the other blocks whose bound reaches the floor.  Inside, bounds
    of single members are taken from coarse to fine, and only pairs that pass all
    levels are scored.

Nothing is left out but what a bound shows to be below the floor, so the result
is exact.  A block is one row of its table, of ``BLOCK_BYTES`` bytes (more only
beyond ``MOST_BLOCKS`` blocks), so no task holds more than a block and a bounded
number of queries, whatever the data's skew.  What is broadcast are pivots and
block summaries, both of at most ``SUMMARY_BYTES``.

Defined cases: rows whose id is null, or whose vector is null or empty or holds
a null or non-finite component, take no part; vectors of another length than the
query's aren't its candidates; a query id given twice searches with its
smallest vector; a candidate id given twice counts once a row; ties go to the
smaller id; scores beyond a long's range are cut to it; an empty table gives an
empty result; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import Scratch, written

QUERY_BLOCK = 1024
BLOCK_BYTES, SUMMARY_BYTES = 1 << 20, 64 << 20
MOST_BLOCKS, MOST_PIVOTS = 1 << 16, 1 << 12
#: Candidates bounded and scored together inside a cell.
STRIP = 2048
#: Segments of the blocks' summaries, and of single members (to their length).
LEVELS, FINER = (1, 4, 16), (1, 4, 16, 32, 64)


def quantise(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component, as whole doubles."""
    def whole(x: Column) -> Column:  # doubles from 2^52 on are whole; floor() makes longs of the others
        scaled = F.lit(scale) * x.cast("double")
        return F.when(F.abs(scaled) < float(1 << 52), F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """By row: sqrt(length) * mean, then sqrt(length) * deviation, of each
    segment; a product of two such rows bounds the rows' inner product.  The
    last segment takes the shorter rest."""
    size = rows.shape[1]
    cuts = np.unique(np.linspace(0, size, min(segments, size) + 1).astype(int))
    length = np.diff(cuts)
    mean = np.add.reduceat(rows, cuts[:-1], axis=1) / length
    square = np.add.reduceat(rows * rows, cuts[:-1], axis=1) / length
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([length, length]))


def exact_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products, exact also where doubles would round."""
    top = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * queries.shape[1]
    if top < 2 ** 53:
        return (queries @ candidates.T).astype(np.int64)
    big = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in candidates]
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(sum(a * b for a, b in zip(q, c)), low), high) for c in big[1]] for q in big[0]],
                    np.int64).reshape(len(queries), len(candidates))


def live_scores(queries: np.ndarray, rows: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Scores of the pairs alive (others hold anything): all at once where many
    are, else pair by pair."""
    of_query, of_row = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    out = np.zeros(alive.shape, np.int64)
    top = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if top < 2 ** 53 and 8 * alive.sum() < len(of_query) * len(of_row):
        a, b = np.nonzero(alive)
        out[a, b] = np.einsum("ij,ij->i", queries[a], rows[b]).astype(np.int64)
    else:
        out[np.ix_(of_query, of_row)] = exact_scores(queries[of_query], rows[of_row])
    return out


def search_cell(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, rows: np.ndarray,
                centre: np.ndarray, k: int, levels=FINER) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best k of each query among ``rows``, none below its floor: query
    positions, ids, scores; and how many pairs were scored."""
    apart = rows - centre
    order = np.argsort(-np.einsum("ij,ij->i", rows, rows), kind="stable")  # large norms raise the floor early
    ids, rows, apart = ids[order], rows[order], apart[order]
    best_score = np.full((len(queries), k), np.iinfo(np.int64).min)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    found, scored = np.zeros(len(queries), int), 0
    to_centre = queries @ centre
    used = sorted({min(n, rows.shape[1]) for n in levels})
    bounds = [(segment_statistics(queries, n), segment_statistics(apart, n)) for n in used]
    reach = np.linalg.norm(rows, axis=1).max(initial=0) + 2 * np.linalg.norm(centre)
    slack = 1e-9 * np.linalg.norm(queries, axis=1) * reach + 1e-6
    for at in range(0, len(rows), STRIP):
        strip = slice(at, at + STRIP)
        floor = np.maximum(np.where(found >= k, best_score[:, -1], -np.inf), floors)
        least = (floor - slack - to_centre)[:, None]
        alive = query_ids[:, None] != ids[strip][None, :]
        for of_queries, of_rows in bounds:  # coarse to fine; what is dead isn't bounded again
            some, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if len(some) and len(columns):
                alive[np.ix_(some, columns)] &= of_queries[some] @ of_rows[strip][columns].T >= least[some]
        if not alive.any():
            continue
        scored += int(alive.sum())
        scores = live_scores(queries, rows[strip], alive)
        for q in np.flatnonzero(alive.any(axis=1)):
            take = alive[q] & (scores[q] >= floors[q])
            score = np.concatenate([best_score[q, :found[q]], scores[q, take]])
            ident = np.concatenate([best_id[q, :found[q]], ids[strip][take]])
            first = np.lexsort((ident, -score.astype(object) if len(score) and score.min() == np.iinfo(np.int64).min
                                else -score))[:k]
            found[q] = len(first)
            best_score[q, :len(first)], best_id[q, :len(first)] = score[first], ident[first]
    where = np.repeat(np.arange(len(queries)), found)
    rank = np.concatenate([np.arange(n) for n in found]) if len(found) else np.empty(0, int)
    return where, best_id[where, rank], best_score[where, rank], scored


def block_summary(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre of a block, and by level the least and greatest segment mean and
    the greatest deviation of its members less the centre."""
    centre = rows.mean(axis=0)
    parts = []
    for n in LEVELS:
        stats = segment_statistics(rows - centre, n)
        half = stats.shape[1] // 2
        parts += [stats[:, :half].min(axis=0), stats[:, :half].max(axis=0), stats[:, half:].max(axis=0)]
    return centre, np.concatenate(parts)


class Blocks:
    """Summaries of all blocks of one vector length, for bounding queries."""

    def __init__(self, rows: list):
        self.names = np.array([r["block"] for r in rows], object)
        self.members = np.array([r["n"] for r in rows], np.int64)
        self.centres = np.stack([np.frombuffer(r["centre"]) for r in rows])
        self.stats = np.stack([np.frombuffer(r["summary"]) for r in rows])
        self.reach = 3 * np.linalg.norm(self.centres, axis=1) + np.abs(self.stats).sum(axis=1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No member's product with the query is above this, by query and block."""
        best, at = None, 0
        for n in LEVELS:
            stats = segment_statistics(queries, n)
            half = stats.shape[1] // 2
            low, high, deviation = (self.stats[:, at + i * half:at + (i + 1) * half] for i in range(3))
            at += 3 * half
            mean = stats[:, :half]
            bound = np.maximum(mean, 0) @ high.T + np.minimum(mean, 0) @ low.T + stats[:, half:] @ deviation.T
            best = bound if best is None else np.minimum(best, bound)
        slack = 1e-9 * np.linalg.norm(queries, axis=1)[:, None] * self.reach[None, :] + 1e-6
        return queries @ self.centres.T + best + slack

    def first(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """The blocks that each query meets first: by bound, while those before
        have no more than k members."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(self.members[order], axis=1) - self.members[order]
        out = np.zeros(bounds.shape, bool)
        np.put_along_axis(out, order, before <= k, axis=1)
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch, vector: str = "vector"):
    """A batch's rows by the length of their vectors."""
    ends = batch.column(vector).offsets.to_numpy()
    sizes = np.diff(ends)
    for size in np.unique(sizes).tolist():
        yield size, batch if len(set(sizes.tolist())) == 1 else batch.take(pa.array(np.flatnonzero(sizes == size)))


def _dealt(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``pivot``, the nearest pivot of the row's length (-1 without any)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for size, part in _by_length(batch):
                nearest = np.full(part.num_rows, -1, np.int32)
                if size in pivots:
                    p, x = pivots[size], _matrix(part.column("vector"))
                    for k in range(0, len(x), STRIP):
                        nearest[k:k + STRIP] = ((p * p).sum(axis=1) - 2 * (x[k:k + STRIP] @ p.T)).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("vector"), part.column("_row"), pa.array(nearest)], ["vec_id", "vector", "_row", "pivot"])

    return rows.select("vec_id", "vector", "_row").mapInArrow(run, "vec_id long, vector array<double>, _row long, pivot int")


def candidate_blocks(rows: DataFrame, n: int, width: int, block: int | None, scratch: Scratch) -> DataFrame:
    """``block, size, n, ids, vectors, centre, summary``: a row a block."""
    most = max(1, min(MOST_BLOCKS, SUMMARY_BYTES // (8 * width + 600)))
    block = max(block or max(1, BLOCK_BYTES // (8 * width)), -(-n // most))
    sample = rows.orderBy(F.xxhash64("vec_id", "_row"), "_row").limit(max(1, min(MOST_PIVOTS, most, -(-n // block)))).select("vector").collect()
    pivots: dict[int, list] = {}
    for r in sample:
        pivots.setdefault(len(r["vector"]), []).append(r["vector"])
    dealt = scratch.written(_dealt(rows, {size: np.array(v) for size, v in pivots.items()}))
    home = ["size", "pivot"]
    dealt = dealt.withColumn("size", F.size("vector"))
    counts = dealt.groupBy(*home).agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("_parts"))
    part = F.pmod(F.xxhash64("_row"), F.col("_parts"))  # equal vectors spread too
    dealt = dealt.join(counts, home).withColumn("block", F.concat_ws(":", "size", "pivot", part))

    def one(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("vector").combine_chunks())
        centre, summary = block_summary(vectors)
        return pa.table({"block": [table.column("block")[0].as_py()], "size": pa.array([vectors.shape[1]], pa.int32()),
                         "n": [len(ids)], "ids": [ids.astype("<i8").tobytes()], "vectors": [vectors.astype("<f8").tobytes()],
                         "centre": [centre.tobytes()], "summary": [summary.tobytes()]})

    schema = "block string, size int, n long, ids binary, vectors binary, centre binary, summary binary"
    return scratch.written(dealt.select("block", "vec_id", "vector").groupBy("block").applyInArrow(one, schema))


def _pairs(asked: DataFrame, blocks: dict[int, Blocks], k: int, later: bool) -> DataFrame:
    """``block, query_id, vector, floor``: the blocks that each query meets first,
    or the others whose bound reaches its floor."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for size, part in _by_length(batch):
                if size not in blocks:
                    continue
                for low in range(0, part.num_rows, 256):
                    some = part.slice(low, 256)
                    bounds = blocks[size].bounds(_matrix(some.column("vector")))
                    pick = blocks[size].first(bounds, k)
                    if later:
                        pick = ~pick & (bounds >= some.column("floor").to_numpy()[:, None])
                    row, column = np.nonzero(pick)
                    for at in range(0, len(row), 4096):
                        own = some.take(pa.array(row[at:at + 4096]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(blocks[size].names[column[at:at + 4096]], pa.string()), own.column("vec_id"), own.column("vector"), own.column("floor")],
                            ["block", "query_id", "vector", "floor"])

    return asked.select("vec_id", "vector", "floor").mapInArrow(run, "block string, query_id long, vector array<double>, floor double")


def _cells(pairs: DataFrame, blocks: DataFrame, k: int, query_block: int, scratch: Scratch) -> DataFrame:
    """``query_id, vec_id, score``: each pair's best k.  A block goes to as many
    tasks as its queries fill."""
    pairs = scratch.written(pairs)
    parts = pairs.groupBy("block").agg(F.ceil(F.count("*") / F.lit(query_block)).cast("long").alias("_parts"))
    left = pairs.join(parts, "block").withColumn("_part", F.pmod(F.xxhash64("query_id"), F.col("_parts"))).drop("_parts")
    right = blocks.join(parts, "block").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    right = right.select("block", "_part", "ids", "vectors", "centre")

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            centre = np.frombuffer(right["centre"][0])
            ids, rows = np.frombuffer(right["ids"][0], "<i8"), np.frombuffer(right["vectors"][0], "<f8").reshape(-1, len(centre))
            for low in range(0, len(left), query_block):
                some = left.iloc[low:low + query_block]
                ask = some["query_id"].to_numpy(np.int64)
                where, found, score, _ = search_cell(ask, np.stack(some["vector"].to_list()), some["floor"].to_numpy(), ids, rows, centre, k)
                out.append(pd.DataFrame({"query_id": ask[where], "vec_id": found, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "vec_id", "score")})

    cells = left.groupBy("block", "_part").cogroup(right.groupBy("block", "_part"))
    return scratch.written(cells.applyInPandas(cell, "query_id long, vec_id long, score long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = 20, query_block: int = QUERY_BLOCK,
          candidate_block: int | None = None, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id of the rows that meet the
    condition ``queries``, the ``k`` best of all other rows.  ``candidate_block``
    is the number of rows of a block, by default what ``BLOCK_BYTES`` hold."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col(vector)))
    rows = rows.select("vec_id", quantise(F.col(vector)).alias("vector"), queries.alias("_asks"))
    rows = scratch.written(rows.withColumn("_row", F.monotonically_increasing_id()))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not size["n"]:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    asked = scratch.written(rows.where("_asks").groupBy("vec_id").agg(F.min("vector").alias("vector")))
    table = candidate_blocks(rows, size["n"], size["width"], candidate_block, scratch)
    summaries: dict[int, list] = {}
    for r in table.select("block", "size", "n", "centre", "summary").collect():  # SUMMARY_BYTES at most
        summaries.setdefault(r["size"], []).append(r)
    blocks = {length: Blocks(some) for length, some in summaries.items()}
    first = _cells(_pairs(asked.withColumn("floor", F.lit(float("-inf"))), blocks, k, False), table, k, query_block, scratch)
    floors = _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    floored = asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    later = _cells(_pairs(floored, blocks, k, True), table, k, query_block, scratch)
    best = written(_best(first.unionByName(later), k).select("query_id", "rank", "vec_id", "score"))
    scratch.clear()
    return best
