"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from hourlake.session import ensure_checkpoint_dir

#: The six ASCII white-space characters that separate words in the contracts.
WHITESPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def share_package(spark) -> None:
    """Let Python workers started from now on import this library from the
    folder it is in, where no installation provides it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def written(rows, folder: str | None = None):
    """The rows, written as a Parquet table in the shared checkpoint folder and
    read again: cuts the lineage as ``checkpoint()`` does, but keeps columns
    compressed, where a checkpoint keeps whole rows as they are in memory.

    What made the rows is not needed any more.  Spark's cleaner learns that from
    collections on the driver (the second one meets what the first let go, half
    a second later) and then deletes the shuffle files behind the rows."""
    spark = rows.sparkSession
    path = f"{folder or ensure_checkpoint_dir(spark)}/written-{uuid.uuid4().hex}"
    schema = rows.schema
    rows.write.option("compression", "zstd").parquet(path)
    del rows
    for pause in (0.5, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)
    return spark.read.schema(schema).parquet(path)


class Scratch:
    """Tables written on the way to a result, in a folder of their own in the
    shared one; ``clear`` deletes them once the result is written itself."""

    def __init__(self, spark):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def written(self, rows):
        return written(rows, self.folder)

    def clear(self) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``text``
    at most (a single longer text stays whole): the working memory of a task
    then follows the longest text, not the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and the rows' offsets into
    them; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def maybe_in(rows, keys, name: str, bits: int = 1 << 23):
    """Rows whose 64-bit hash in column ``name`` may occur in that column of
    ``keys``: none that does is lost, most that don't are dropped before a
    shuffle.  The broadcast is a bitmap of ``bits`` bits (1 MB as 64-bit
    words), whatever the number of keys; when full it lets all rows through."""
    from pyspark.sql import functions as F

    slot = F.pmod(F.col(name), F.lit(bits))
    word, bit = F.shiftright(slot, 6).cast("int"), F.pmod(F.col(name), F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = keys.groupBy(word.alias("_w")).agg(F.bit_or(one).alias("_bits"))
    joined = rows.withColumn("_w", word).join(F.broadcast(words), "_w")
    return joined.where(F.col("_bits").bitwiseAND(one) != 0).select(*rows.columns)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Rolling:
    """Hashes of any slice of a byte array, or of an array of 64-bit hashes, from
    its running polynomial sums, modulo 2^64."""

    def __init__(self, data: np.ndarray, seed: int):
        random = np.random.default_rng(seed)
        table = random.integers(0, 1 << 64, 256, np.uint64)
        self.base = base = int(random.integers(0, 1 << 64, dtype=np.uint64)) | 1
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            self.sums[1:] = table[data] if data.dtype == np.uint8 else data
            self.sums[1:] *= self._powers(base, len(data) + 1)[:-1]
            np.cumsum(self.sums, out=self.sums)
            self.down = self._powers(pow(base, -1, 1 << 64), len(data) + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base & ((1 << 64) - 1), np.uint64)
        out[0] = 1
        return np.cumprod(out, out=out)

    def values(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Polynomials of slices; ``joined`` makes that of two neighbours."""
        with np.errstate(over="ignore"):
            return (self.sums[stop] - self.sums[start]) * self.down[start]

    def slices(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return self.named(self.values(start, stop), stop - start)

    @staticmethod
    def named(value: np.ndarray, size) -> np.ndarray:
        """The hash of slices from their polynomials and sizes."""
        with np.errstate(over="ignore"):
            return mixed(value + np.asarray(size).astype(np.uint64))

    def joined(self, left: np.ndarray, size: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Polynomials of slices of the given sizes with others behind them."""
        powers = self._powers(self.base, int(size.max(initial=0)) + 1)
        with np.errstate(over="ignore"):
            return left + powers[size] * right
