"""Set-based upsert, rollback and idempotent partition writes
(SURVEY §2.9 I1-I8, A5-A8).

``merge_upsert`` is the MERGE of the reference as one full outer join on
the key.  ``upsert_partitioned`` applies it to a Parquet table partitioned
by day: only the partitions the source touches are read and rewritten,
through a staging copy, because Spark cannot overwrite files it is reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourlake.session import scratch_root


def require_unique(source: DataFrame, keys) -> DataFrame:
    """A MERGE source with a duplicated key is an error.  The check is
    lazy and distributed: a count per key raises inside the task."""
    w = Window.partitionBy(*keys)
    msg = F.concat(F.lit("duplicate upsert key: "), F.to_json(F.struct(*keys)))
    checked = source.withColumn("_dups", F.count(F.lit(1)).over(w))
    return checked.filter(F.when(F.col("_dups") > 1, F.raise_error(msg)).otherwise(F.lit(True))).drop("_dups")


def merge_upsert(target: DataFrame, source: DataFrame, keys, update_cols, load_ts, batch_id,
                 inserted_col: str = "inserted_at", modified_col: str = "modified_at",
                 batch_col: str = "batch_id", insert_only_cols=(), action_col: str | None = None) -> DataFrame:
    """Matched rows take the source's ``update_cols``, the load time as
    modification time and the load batch; unmatched source rows are inserted
    with both audit times set to the load time; target rows the source does
    not touch pass unchanged.  Other source columns (and
    ``insert_only_cols``) come from the source on insert and are kept from
    the target on update.  ``action_col`` adds what was done with the row:
    ``inserted``, ``updated`` or ``kept``."""
    keys = list(keys)
    load_ts = F.lit(load_ts).cast("timestamp_ntz") if isinstance(load_ts, str) else load_ts
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    audit = {inserted_col, modified_col, batch_col} - {None}
    t_cols = [c for c in target.columns if c not in keys]
    # Like MERGE ... WHEN NOT MATCHED THEN INSERT: every other source column
    # is written on insert and left alone on update.
    insert_cols = [c for c in t_cols if c not in update_cols and c not in audit
                   and (c in source.columns or c in insert_only_cols)]
    src = require_unique(source, keys)
    s_cols = list(update_cols) + insert_cols
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in s_cols], F.lit(True).alias("_s"))
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in t_cols], F.lit(True).alias("_t"))
    j = t.join(s, keys, "full")
    in_s, in_t = F.col("_s").isNotNull(), F.col("_t").isNotNull()
    out = [F.col(k) for k in keys]
    for c in t_cols:
        if c == inserted_col:
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(load_ts).alias(c))
        elif c == modified_col:
            out.append(F.when(in_s, load_ts).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c == batch_col:
            out.append(F.when(in_s, batch).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in insert_cols:
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    if action_col:
        out.append(F.when(~in_t, F.lit("inserted")).when(in_s, F.lit("updated")).otherwise(F.lit("kept")).alias(action_col))
    return j.select(*out)


def rollback_batch(target: DataFrame, batch_id, batch_col: str = "batch_id") -> DataFrame:
    """The table without the rows of one batch."""
    b = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return target.filter(~F.col(batch_col).eqNullSafe(b))


# ---- persisted tables -------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, partition_cols, fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """Dynamic partition overwrite -- re-running an hour
    replaces only that hour's partitions.  Rows are clustered by the
    partition columns first so each task writes few files."""
    (df.repartition(*[F.col(c) for c in partition_cols])
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).format(fmt).save(path))


def empty_target(source: DataFrame, inserted_col: str = "inserted_at", modified_col: str = "modified_at",
                 batch_col: str = "batch_id", **_) -> DataFrame:
    """A table without rows for a first load: the source's columns and the
    audit columns."""
    types = {inserted_col: "timestamp_ntz", modified_col: "timestamp_ntz", batch_col: "string"}
    return source.limit(0).select(*source.columns, *[F.lit(None).cast(t).alias(c) for c, t in types.items()
                                                     if c and c not in source.columns])


def upsert_partitioned(spark: SparkSession, path: str, source: DataFrame, keys, update_cols,
                       partition_col: str, load_ts, batch_id, **kw) -> str:
    """Upsert ``source`` into the Parquet table at ``path`` partitioned by
    ``partition_col``.  Returns the staging folder used.

    1. touched partitions = distinct partition values of the source;
    2. target rows of those partitions only (partition pruning) are merged
       with the source;
    3. the merged rows are written to a staging folder in the shared
       warehouse, then copied over the touched partitions with a dynamic
       partition overwrite.  A failure before step 3 leaves the table as it
       was; re-running the same load gives the same table (idempotent).
    """
    from pyspark.sql.utils import AnalysisException

    # The touched partition values are few (days of one load); as literals
    # they prune the target scan to those partitions.
    touched = [r[0] for r in source.select(partition_col).distinct().collect()]
    try:
        target = spark.read.parquet(path).filter(F.col(partition_col).isin(touched))
    except AnalysisException as error:
        # only a missing table is a first load; any other fault must not overwrite
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = None
    if target is None:
        merged = merge_upsert(empty_target(source, **kw), source, keys, update_cols, load_ts, batch_id, **kw)
    else:
        merged = merge_upsert(target, source.select(*target.columns) if set(target.columns) <= set(source.columns)
                              else source, keys, update_cols, load_ts, batch_id, **kw)
    staging = f"{scratch_root(spark)}/staging/{uuid.uuid4().hex}"
    write_partitioned(merged, staging, [partition_col])
    write_partitioned(spark.read.schema(merged.schema).parquet(staging), path, [partition_col])
    return staging


def delete_batch_partitioned(spark: SparkSession, path: str, batch_id: str, partition_col: str,
                             batch_col: str = "batch_id") -> str:
    """I6 on a table: rewrite only the partitions holding the batch."""
    current = spark.read.parquet(path)
    touched = [r[0] for r in current.filter(F.col(batch_col) == batch_id)
               .select(partition_col).distinct().collect()]
    staging = f"{scratch_root(spark)}/staging/{uuid.uuid4().hex}"
    kept = rollback_batch(current.filter(F.col(partition_col).isin(touched)), batch_id, batch_col)
    write_partitioned(kept, staging, [partition_col])
    # nothing is staged when the batch owns all its partitions: the schema is the table's
    staged = spark.read.schema(current.schema).parquet(staging)
    # a partition left empty must still be replaced: write it from the
    # staging copy, or drop its rows by overwriting with the staged rows.
    write_partitioned(staged, path, [partition_col])
    empty = set(touched) - {r[0] for r in staged.select(partition_col).distinct().collect()}
    if empty:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for v in empty:
            p = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={v}")
            p.getFileSystem(conf).delete(p, True)
    return staging
