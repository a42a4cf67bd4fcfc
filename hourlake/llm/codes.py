"""Vector codes: vectors cut into parts, each named by its codebook's entry.

Method.  Member-resident Lloyd.  A vector's parts are rows that live with the
owner of their (position, entry, salt); the salt is a hash of the row, so an
entry with very many members has as many owners as there are partitions.  Each
round an owner assigns its resident members to the new codebook; those that
keep their entry stay where they are, and only the others travel, in the next
shuffle, to their new owners.  Owners then sum their resident members, the sums
are added up by (position, entry), and the new codebook, whose size is fixed by
its parameters, goes out with the next round.

The residents are RDD partitions of arrays under one partitioner: a union of
what stayed with what arrived keeps it, so nothing else is shuffled (DataFrame
unions lose their partitioning).  Rounds persist to memory and disk and can be
recomputed from the written parts table when an executor is lost; every
``CUT`` rounds they are checkpointed.

Components become integers ``floor(scale * x)``, held within +-2^26 so that squared
distances fit 64 bits.  Distances are exact: products of doubles while they stay
below 2^53, integers otherwise.

Defined cases: vectors that are null, hold null or non-finite components, have
no positive multiple of ``parts`` components, or another length than the kept one
of the smallest id take no part and are not returned.  Fewer kept rows than
entries give a smaller codebook.  Rows with a null id come last, repeated ids
are ordered by their components and all get codes; ties go to the lower index.
Null labels form one group.  An empty table gives no rows.  Other columns of
the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import mixed, written
from hourlake.session import ensure_checkpoint_dir

#: Rounds between checkpoints, and parts that are compared with a codebook at once.
CUT, CHUNK = 8, 1 << 13
LARGEST = 1 << 26


def integers(rows: DataFrame, scale: int, parts: int) -> DataFrame:
    """``row, vec_id, label, v`` of the vectors that take part, by their lengths
    so far; ``row`` numbers them."""
    x = F.col("embedding")
    whole = lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    kept = rows.select("vec_id", "label", "embedding").where(x.isNotNull() & ~bad & (F.size(x) > 0) & (F.size(x) % parts == 0))
    return kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform(x, whole).alias("v"))


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each member's nearest entry, the lower one of equals, and the
    squared distance."""
    entry, error = np.empty(len(members), np.int64), np.empty(len(members), np.int64)
    for low in range(0, len(members), CHUNK):
        some = members[low:low + CHUNK]
        largest = max(int(np.abs(some).max(initial=0)), int(np.abs(book).max(initial=0)))
        if 4 * largest * largest * members.shape[1] < 1 << 52:
            a, b = some.astype(np.float64), book.astype(np.float64)
            distance = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        else:
            distance = np.stack([np.square(some - one).sum(1) for one in book], axis=1)
        best = distance.argmin(1)
        entry[low:low + CHUNK], error[low:low + CHUNK] = best, distance[np.arange(len(some)), best].astype(np.int64)
    return entry, error


class Members:
    """Resident parts: their positions, rows and components, and entries."""

    def __init__(self, position, row, part, entry):
        self.position, self.row, self.part, self.entry = position, row, part, entry

    def take(self, which: np.ndarray) -> Members:
        return Members(self.position[which], self.row[which], self.part[which], self.entry[which])

    @staticmethod
    def joined(some: list[Members]) -> Members:
        return Members(*(np.concatenate([getattr(x, a) for x in some]) for a in ("position", "row", "part", "entry")))

    def assigned(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry, error = np.empty(len(self.row), np.int64), np.empty(len(self.row), np.int64)
        for p, book in enumerate(books):
            at = np.flatnonzero(self.position == p)
            entry[at], error[at] = nearest(self.part[at], book)
        return entry, error

    def sums(self, entries: int) -> dict:
        """Sum and number of the members of each (position, entry)."""
        key = self.position.astype(np.int64) * entries + self.entry
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        totals = np.add.reduceat(self.part[order], first, axis=0) if len(first) else []
        counts = np.diff(np.append(first, len(key)))
        return {int(k): (t, int(n)) for k, t, n in zip(key[order][first], totals, counts)}


def dealt(members: Members, entries: int, partitions: int) -> np.ndarray:
    """The partition of each member's owner, from (position, entry, salt)."""
    with np.errstate(over="ignore"):
        salt = (mixed(members.row.astype(np.uint64)) % np.uint64(partitions)).astype(np.int64)
    return (members.position.astype(np.int64) * entries + members.entry + salt) % partitions


def same(key: int) -> int:
    return key


def _split(members: Members, target: np.ndarray):
    order = np.argsort(target, kind="stable")
    first = np.flatnonzero(np.diff(target[order], prepend=-1))
    for rows in np.split(order, first[1:]):
        if len(rows):
            yield int(target[rows[0]]), members.take(rows)


def _read(kept: DataFrame, parts: int):
    """The written vectors as one block of members a batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = batch.column("v").flatten().to_numpy().astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("row").to_numpy().astype("<i8").tobytes()], pa.binary()),
                                                  pa.array([v], pa.binary())], ["row", "v"])

    def members(r) -> Members:
        row = np.frombuffer(r["row"], "<i8")
        part = np.frombuffer(r["v"], "<i8").reshape(len(row) * parts, -1)
        return Members(np.tile(np.arange(parts, dtype=np.int16), len(row)), np.repeat(row, parts), part, np.full(len(row) * parts, -1))

    return kept.select("row", "v").mapInArrow(run, "row binary, v binary").rdd.map(members)


def lloyd(kept: DataFrame, books: np.ndarray, rounds: int, partitions: int):
    """The last codebooks, and the resident members as an RDD of
    (partition, members)."""
    entries = books.shape[1]

    def arrive(some, books):
        for members in some:
            members.entry = members.assigned(books)[0]
            yield from _split(members, dealt(members, entries, partitions))

    def step(index, pairs, books):
        some = [m for _, m in pairs]
        if some:
            members = Members.joined(some)
            members.entry = members.assigned(books)[0]
            yield from _split(members, np.where(dealt(members, entries, partitions) == index, index, dealt(members, entries, partitions)))

    def total(pairs):
        for _, members in pairs:
            yield from members.sums(entries).items()

    resident, before = None, None
    for number in range(rounds):
        if resident is None:
            moved = _read(kept, books.shape[0]).mapPartitions(lambda some, b=books: arrive(some, b))
            now = resident = moved.partitionBy(partitions, same)
        else:
            now = resident.mapPartitionsWithIndex(lambda i, pairs, b=books: step(i, pairs, b), preservesPartitioning=True)
            now = now.persist(StorageLevel.MEMORY_AND_DISK)
            stay = now.mapPartitionsWithIndex(lambda i, pairs: (x for x in pairs if x[0] == i), preservesPartitioning=True)
            left = now.mapPartitionsWithIndex(lambda i, pairs: (x for x in pairs if x[0] != i))
            resident = stay.union(left.partitionBy(partitions, same))
        if number % CUT == CUT - 1:
            resident = resident.mapPartitions(list, preservesPartitioning=True)
            resident.checkpoint()
        sums = resident.mapPartitions(total).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), partitions).collect()
        books = books.copy()  # positions x entries sums came to the driver
        for key, (s, n) in sums:
            books[key // entries, key % entries] = s // n
        if before is not None:
            before.unpersist()
        before = now if now is not resident else None
    return books, resident


def vector_codes(vectors: DataFrame, scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4,
                 partitions: int | None = None) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every vector that takes part (a byte, or
    as many hex digits as entries need, for each part), and the codebooks."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    kept = written(integers(vectors, scale, parts))
    order = [F.col("vec_id").asc_nulls_last(), "v", "row"]
    smallest = kept.orderBy(*order).limit(1).collect()
    size = len(smallest[0]["v"]) if smallest else 0
    kept = kept.where(F.size("v") == size)
    seeds = kept.orderBy(*order).limit(entries).select("v").collect()  # as many rows as a codebook has entries
    books = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), parts, size // parts).swapaxes(0, 1).copy()
    if not smallest:
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    books, resident = lloyd(kept, books, rounds, partitions)
    if resident is None:
        resident = _read(kept, parts).map(lambda m: (0, m))

    def final(pairs):
        for _, members in pairs:
            entry, error = members.assigned(books)
            yield tuple(bytearray(x.astype("<i8").tobytes()) for x in (members.row, members.position, entry, error))

    def unpacked(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                columns = [np.frombuffer(batch.column(c)[i].as_py(), "<i8") for c in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "position", "entry", "error"])

    blocks = spark.createDataFrame(resident.mapPartitions(final), "row binary, position binary, entry binary, error binary")
    cells = blocks.mapInArrow(unpacked, "row long, position long, entry long, error long")
    digits = max(2, len(f"{entries - 1:x}"))
    name = F.lower(F.lpad(F.hex("entry"), digits, "0"))
    coded = cells.groupBy("row").agg(F.concat(*(F.max(F.when(F.col("position") == p, name)) for p in range(parts))).alias("code"),
                                     F.sum("error").alias("error"))
    return kept.select("row", "vec_id", "label").join(coded, "row").drop("row"), books


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components in order, as decimal numbers and commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame) -> DataFrame:
    """Codes and errors of all vectors, the errors of their labels, and the
    codebooks' digest.  Labels are summed first, so the join back has one row a
    label on one side; a label of very many rows is the other side's skew, which
    Spark splits."""
    coded, books = vector_codes(vectors)
    coded = written(coded)
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
