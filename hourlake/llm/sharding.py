"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size; shards take turns, each claiming its next free slot, until the table is
full.  A key's hash picks a slot and the slot names the shard: placement costs
one lookup, shards differ by one slot at most, and adding a shard moves few
keys.  The table has ``table_size`` rows whatever the input, so it is broadcast.

Only DataFrame functions touch rows; the table is filled on the driver, once,
in ``table_size`` steps and some misses.  Defined cases: a null id is replaced
by a hash of the text, so such rows spread; repeated ids go to one shard (as
their key says) but are dealt out over ``spread`` tasks within it, so a hot key
never meets in one task; empty, null or very long texts are placed like
others; an empty table stays empty.  Input columns named ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A prime, far above a hundred slots a shard.
TABLE_SIZE = 65_537
SHARDS = 64
#: Rows that a task of a shard is dealt, where the spread isn't given.
ROWS_A_TASK = 100_000


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Index into ``shards`` by slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table's size must be a prime")
    if len(shards) > size:
        raise ValueError("more shards than slots")
    # with a prime size, every step from 1 to size - 1 visits every slot
    place = [_hash(s, "offset") % size for s in shards]
    step = [_hash(s, "skip") % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while table[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % size
            table[place[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def assign_shards(docs: DataFrame, shards: list[str] | None = None, table_size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (an index into ``shards``)."""
    docs = docs.drop("slot", "shard")
    rows = list(enumerate(lookup_table(shards or shard_names(), table_size)))
    table = docs.sparkSession.createDataFrame(rows, "slot int, shard int")
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.withColumn("slot", F.pmod(key, F.lit(table_size)).cast("int")).join(F.broadcast(table), "slot")


def place(docs: DataFrame, spread: int | None = None, **options) -> DataFrame:
    """``assign_shards`` with the rows of a shard brought together, each shard
    over ``spread`` tasks dealt by the text, for writing by shard; by default as
    many as the rows need, a count of which reads no text."""
    if spread is None:
        shards = len(options.get("shards") or shard_names())
        spread = max(4, -(-docs.count() // (shards * ROWS_A_TASK)))
    rows = assign_shards(docs, **options)
    salt = F.pmod(F.xxhash64(*(c for c in docs.columns if c not in ("slot", "shard"))), F.lit(spread))
    return rows.withColumn("_s_salt", salt).repartition("shard", "_s_salt").drop("_s_salt")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder a shard."""
    place(docs, **options).write.partitionBy("shard").parquet(path)
