"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate: its target share of the mixture over
its own rows.  A document's number of copies is the Poisson distribution of
that mean inverted at a number in [0, 1) that only a hash of the seed and the
document decides, so a lost task writes the same copies again.  Copies are
dealt out and ordered by a second hash: a global shuffle.

A rate above ``PART`` is split into equal parts, each inverted at its own
number; their sum has the wanted distribution, and no tail is cut: every table
of the distribution ends where doubles reach 1.  A source's rate does not
depend on its being in one task: counts are summed map-side.  The table of rates
has a row a source: it is written and counted, and broadcast while it has at
most ``MOST_SOURCES`` rows, so texts move once, to their place in the mixture.
Beyond that rows meet the rates through an equality join, each source dealt over
``SALTS`` tasks.

Only DataFrame functions are used.  Defined cases: a null source is a source of
its own; a null id is replaced by a hash of the text; repeated rows draw the
same number and so have the same number of copies each; a null or empty text
is a document like any other, and a very long one moves whole, once a copy; a source without a target weight gets rate 0 (no
copy); an empty table stays empty.  Input columns named ``copy`` or
``shuffle_key`` are replaced; working columns start with ``_m_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.session import cut_lineage

SEED = 17
PART = 32.0
#: Terms of a part's distribution table; at a mean of 32 the last term is 1 to
#: the precision of doubles long before.
TERMS = 128
#: Sources whose rates are broadcast: 1 KB each.
MOST_SOURCES = 20_000
#: Tasks a source is dealt over where they aren't.
SALTS = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def target_rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5,
                 total: float | None = None) -> DataFrame:
    """``_m_source, _m_rate``: mean copies of each row of a source.

    ``weights`` (``source``, ``weight``) names the target shares; without it
    they follow ``count ** temperature``.  ``total`` is the mixture's expected
    number of rows, by default that of the input."""
    counts = docs.groupBy(F.col("source").alias("_m_source")).agg(F.count("*").alias("_m_n"))
    if weights is None:
        shares = counts.withColumn("_m_weight", F.pow(F.col("_m_n").cast("double"), F.lit(float(temperature))))
    else:
        given = weights.select(F.col("source").alias("_m_s"), F.col("weight").cast("double").alias("_m_weight"))
        shares = counts.join(given, counts["_m_source"].eqNullSafe(given["_m_s"]), "left").drop("_m_s").na.fill(
            0.0, ["_m_weight"])
    sums = shares.agg(F.sum("_m_weight").alias("w"), F.sum("_m_n").alias("n"))
    size = F.lit(float(total)) if total is not None else sums.select("n").scalar().cast("double")
    rate = F.col("_m_weight") / sums.select("w").scalar() * size / F.col("_m_n")
    return shares.select("_m_source", F.coalesce(rate, F.lit(0.0)).alias("_m_rate"))


def distribution(rates: DataFrame) -> DataFrame:
    """Add ``_m_parts``, and ``_m_cdf``: the cumulated Poisson terms of a part."""
    rates = rates.withColumn("_m_parts", F.greatest(F.lit(1), F.ceil(F.col("_m_rate") / F.lit(PART))).cast("int"))
    rates = rates.withColumn("_m_mean", F.col("_m_rate") / F.col("_m_parts"))
    first = F.exp(-F.col("_m_mean"))
    state = F.struct(F.array(first).alias("cdf"), first.alias("term"))
    step = lambda a, k: F.struct(
        F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + a["term"] * F.col("_m_mean") / k).alias("cdf"),
        (a["term"] * F.col("_m_mean") / k).alias("term"))
    return rates.withColumn("_m_cdf", F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), state, step, lambda a: a["cdf"]))


def with_rates(docs: DataFrame, rates: DataFrame, most: int = MOST_SOURCES) -> DataFrame:
    """Rows with the columns of their source's rate."""
    rates = cut_lineage(rates)
    if rates.count() <= most:
        return docs.join(F.broadcast(rates), docs["source"].eqNullSafe(rates["_m_source"]), "left").drop("_m_source")
    salted = docs.withColumn("_m_salt", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"))
    every = rates.withColumn("_m_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = salted["source"].eqNullSafe(every["_m_source"]) & (F.col("_m_salt") == F.col("_m_s"))
    return salted.join(every, met, "left").drop("_m_source", "_m_s", "_m_salt")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, seed: int = SEED, temperature: float = 0.5,
                total: float | None = None, most: int = MOST_SOURCES) -> DataFrame:
    """``docs`` replicated and shuffled, with ``copy`` (from 1) and
    ``shuffle_key``; each output partition is ordered by the key, and the keys
    of a partition are a random set of all."""
    docs = docs.drop("copy", "shuffle_key")
    rates = distribution(target_rates(docs, weights, temperature, total)).drop("_m_rate", "_m_mean")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    rows = with_rates(docs, rates, most).withColumn("_m_key", key)
    # drawn once a part, outside the search of the table
    draws = F.transform(F.sequence(F.lit(1), F.col("_m_parts")),
                        lambda j: uniform(F.lit(str(seed)), F.col("_m_key"), j.cast("string")))
    rows = rows.withColumn("_m_draws", draws)
    found = F.aggregate("_m_draws", F.lit(0), lambda a, u: a + F.size(F.filter("_m_cdf", lambda c: c < u)))
    rows = rows.withColumn("_m_copies", found).drop("_m_draws", "_m_cdf", "_m_parts").where("_m_copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_m_copies"))))
    rows = rows.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed}s"), "_m_key", "copy")))
    rows = rows.drop("_m_key", "_m_copies")
    return rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
