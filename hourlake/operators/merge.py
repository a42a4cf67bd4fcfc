"""Source merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_outer_merge(left: DataFrame, right: DataFrame, keys=("place", "slot"),
                     shared=("hour_ts",)) -> DataFrame:
    """Full outer equi-join on ``keys``; the key columns and the
    ``shared`` attributes are coalesced, so a side that is empty degrades to
    the other side's rows with NULL metrics.

    Both inputs are unique on ``keys`` (keep-last ran before), so the join is
    1:1 and its hash partitioning on (place, slot) stays balanced even when
    one place is hot.  When both sides come out of a window partitioned on
    the same keys, Spark reuses that partitioning and adds no exchange.
    """
    keys = list(keys)
    l_sh = {s: f"_l_{s}" for s in shared if s in left.columns}
    r_sh = {s: f"_r_{s}" for s in shared if s in right.columns}
    lf = left.withColumnsRenamed(l_sh)
    rf = right.withColumnsRenamed(r_sh)
    j = lf.join(rf, on=keys, how="full")
    merged = {s: F.coalesce(*[F.col(n) for n in (l_sh.get(s), r_sh.get(s)) if n]) for s in shared}
    return j.withColumns(merged).drop(*l_sh.values(), *r_sh.values())
