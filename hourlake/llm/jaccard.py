"""Exact n-gram Jaccard join of documents, by set relations.

A document's set holds its distinct 5-word shingles.  Two documents link when
their sets' Jaccard similarity is 0.75 or more; what is wanted is every
document's class: all that links can reach.

1.  Equal sets are one set with several documents (a sum per task first).
2.  Shingles have one global order, rare first, by the class of a bucketed count
    over all documents.  Sets that link share a shingle among the first
    ``n - ceil(0.75 n) + 1`` of each, so only those go into the index lists;
    lists with one set are dropped at once.
3.  Lists are cut into blocks by set size; blocks too far apart to link are
    skipped, and so are entries whose position in their set's order leaves too
    few shingles to share.
4.  Set relations: a set first meets only the most central set of the blocks it
    is in, the one it meets most.  Sets found similar to it share its class:
    what one of them links with is reached from the others, so lists whose sets
    have one class are done, and elsewhere only sets of different classes still
    have to meet.  That settles groups of near copies in linear work.  The last
    round is complete: every pair of sets of different classes that shares a
    list and passes the size and position bounds is verified on the whole texts,
    so no link between classes is lost.
5.  Classes come from minimum labels over the verified links.

Shingles are 64-bit hashes, sets are named by 64-bit hashes of their shingles;
similarity is counted on whole sets.  Nothing is gathered on the driver but the
bucketed counts (one byte a bucket, ``ORDER_BUCKETS`` in all).

Defined cases: null or wordless texts have an empty set and link with nothing;
a text of fewer than five words is one shingle; a very long text's shingles are
made whole, by one task; of equally frequent shingles the smaller hash comes
first; repeated rows are equal sets; a
null id loses to any other as a class's smallest, and is its class if alone;
repeated ids are one document each; an empty table gives an empty result; other
input columns are ignored by ``components`` and kept by ``keep_one_of_class``,
whose working columns start with ``_j_``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import Rolling, bounded, maybe_in, mixed, utf8
from hourlake.session import cut_lineage

WORDS = 5
#: Similarity as a fraction: 100 * shared >= 75 * united.
SHARED, UNITED = 3, 4
ORDER_BUCKETS = 1 << 20
SEEN = 200_000
#: A star pair meets in one of so many of the larger set's lists.
STAR_PART = 4
#: Bytes of text whose shingles are made at once: they take forty times that.
PART = 1 << 20
#: Stands for a null id; larger than any other.
NULL_ID = (1 << 63) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted by text, then shingle: the texts'
    positions and the shingles."""
    data, offsets = utf8(column)
    space = np.append(_SPACE[data], True)
    data = _LOWER[data]
    # a word also ends where its text does
    first = ~space[:-1]
    inside = first.copy()
    first[1:] &= space[:-2]
    begin = offsets[:-1][np.diff(offsets) > 0]
    first[begin] = inside[begin]
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    end = offsets[1:][np.diff(offsets) > 0] - 1
    last[end] = inside[end]
    stop = np.flatnonzero(last) + 1
    words = Rolling(data, 5).slices(start, stop)
    text = np.searchsorted(offsets, start, side="right") - 1
    n = np.bincount(text, minlength=len(column)) if len(text) else np.zeros(len(column), int)
    before = np.cumsum(n) - n
    head = np.arange(len(words)) - before[text] <= np.maximum(n[text] - WORDS, 0)  # where a shingle starts
    at = np.flatnonzero(head)
    width = np.minimum(n[text[at]], WORDS)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            part = words[np.minimum(at + k, len(words) - 1)] if len(words) else words
            out = np.where(k < width, mixed(out * np.uint64(0x9E3779B97F4A7C15) + part), out)
    out, text = out.view(np.int64), text[at]
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return text[fresh], out[fresh]


def set_names(text: np.ndarray, items: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each text's set."""
    with np.errstate(over="ignore"):
        sums = np.zeros(rows, np.uint64)
        np.add.at(sums, text, mixed(items.view(np.uint64) ^ np.uint64(0xD1B54A32D192ED03)))
        return mixed(sums + np.bincount(text, minlength=rows).astype(np.uint64)).view(np.int64)


def _ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64("doc_id", "text").alias("key"), "text")


def document_sets(docs: DataFrame) -> DataFrame:
    """``id, key, name, n``: the name and size of every document's set; ``key``
    is a hash of the row."""
    def run(batches):
        for batch in bounded(batches, "text", PART):
            text, items = shingles(batch.column("text"))
            n = np.bincount(text, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(set_names(text, items, batch.num_rows)),
                 pa.array(n.astype(np.int32))], ["id", "key", "name", "n"])

    return _ids(docs).mapInArrow(run, "id long, key long, name long, n int")


def shingle_order(docs: DataFrame, buckets: int = ORDER_BUCKETS) -> np.ndarray:
    """By bucket of a shingle's hash: how frequent its shingles are, as the
    rounded logarithm of their count over all documents (in quarter steps)."""
    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in bounded(batches, "text", PART):
            items = shingles(batch.column("text"))[1]
            counts += np.bincount(items & (buckets - 1), minlength=buckets)
        full = np.flatnonzero(counts)
        for k in range(0, len(full), 65_536):
            part = full[k:k + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[part])], ["bucket", "n"])

    counts = _ids(docs).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counts.select("bucket", F.round(4 * F.log2("n")).cast("byte").alias("level")).toArrow()
    level = np.zeros(buckets, np.uint8)
    level[rows.column("bucket").to_numpy()] = rows.column("level").to_numpy()
    return level


def prefix_length(n):
    """Of a set of n, the shingles one of which any linking set has too."""
    return n + 1 + (-n * SHARED // UNITED)


def index_lists(docs: DataFrame, level: np.ndarray) -> DataFrame:
    """``item, name, place``: the first shingles of every set in the global
    order; ``place`` is the set's size, shifted, and the shingle's position.
    A task gives a set once, as far as it remembers the last ``SEEN`` names."""
    spread = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches):
        level, seen = spread.value, set()
        for batch in bounded(batches, "text", PART):
            text, items = shingles(batch.column("text"))
            name = set_names(text, items, batch.num_rows)
            n = np.bincount(text, minlength=batch.num_rows)
            fresh = np.zeros(batch.num_rows, bool)
            for i, x in enumerate(name.tolist()):
                fresh[i] = x not in seen
                seen.add(x)
            if len(seen) > SEEN:
                seen.clear()
            order = np.lexsort((items, level[items & (len(level) - 1)], text))
            items, text = items[order], text[order]
            at = np.arange(len(items)) - (np.cumsum(n) - n)[text]
            keep = np.flatnonzero((at < prefix_length(n)[text]) & fresh[text])
            place = (n[text] << 32) + at
            for k in range(0, len(keep), 100_000):
                part = keep[k:k + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items[part]), pa.array(name[text[part]]), pa.array(place[part])], ["item", "name", "place"])

    return _ids(docs).select("text").mapInArrow(run, "item long, name long, place long")


def block_of(n):
    """Block of a list by set size: sets that link are in one block or in two
    neighbours."""
    return F.floor(F.log(n.cast("double")) / math.log(UNITED / SHARED) + 1e-9).cast("int")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of sets that are similar enough, counted on the whole
    texts of one document of each."""
    one = lambda c: classes.select(F.col("name").alias(c), F.col("head.id").alias(f"{c}_id"), F.col("head.key").alias(f"{c}_key"))
    pairs = cut_lineage(pairs.join(one("a"), "a").join(one("b"), "b"))
    wanted = pairs.select(F.explode(F.array("a_key", "b_key")).alias("key")).distinct()
    rows = maybe_in(_ids(docs), wanted, "key")
    of = lambda c: rows.select(F.col("id").alias(f"{c}_id"), F.col("key").alias(f"{c}_key"), F.col("text").alias(f"{c}_text"))
    both = pairs.join(of("b"), ["b_id", "b_key"]).join(of("a"), ["a_id", "a_key"])

    def run(batches):
        for batch in bounded(batches, "a_text", PART):
            for part in bounded([batch], "b_text", PART):
                (text, items), (text2, items2) = shingles(part.column("a_text")), shingles(part.column("b_text"))
                n, n2 = (np.bincount(t, minlength=part.num_rows) for t in (text, text2))
                every, row = np.concatenate([items, items2]), np.concatenate([text, text2])
                order = np.lexsort((every, row))
                every, row = every[order], row[order]
                twice = (every[1:] == every[:-1]) & (row[1:] == row[:-1])
                shared = np.bincount(row[1:][twice], minlength=part.num_rows)
                hit = pa.array(np.flatnonzero(UNITED * shared >= SHARED * (n + n2 - shared)))
                yield pa.RecordBatch.from_arrays([part.column(c).take(hit) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long").distinct()


def minimum_labels(links: DataFrame) -> DataFrame:
    """``name, label`` of every set in a link: the smallest name its links
    reach.  Labels jump to their label's label each round, so a chain takes
    rounds by the logarithm of its length."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = cut_lineage(both)
    labels = both.groupBy(F.col("a").alias("name")).agg(F.min("b").alias("low"))
    labels = cut_lineage(labels.select("name", F.least("name", "low").alias("label")))
    while True:
        of = labels.select(F.col("name").alias("b"), F.col("label").alias("near"))
        lowest = both.join(of, "b").groupBy(F.col("a").alias("name")).agg(F.min("near").alias("near"))
        step = labels.join(lowest, "name").select("name", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("name").alias("next"), F.col("label").alias("further"))
        step = step.join(jump, "next", "left").select(
            "name", F.col("label").alias("old"), F.least("next", "further").alias("label"))
        step = cut_lineage(step)
        if not step.where("label < old").limit(1).count():
            return labels
        labels = step.select("name", "label")


def _classed(lists: DataFrame, links: DataFrame) -> DataFrame:
    """The lists with each set's class so far; lists of one class are dropped,
    their sets' answers being known."""
    labels = minimum_labels(links)
    lists = lists.join(labels, "name", "left").withColumn("label", F.coalesce("label", "name"))
    mixed_lists = lists.groupBy("item").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    return cut_lineage(lists.join(mixed_lists.select("item"), "item", "left_semi"))


def _star_pairs(lists: DataFrame) -> DataFrame:
    """For each set the most central set of a block it is in, that it meets in
    most lists, if those are a fair part of its lists.  A set is the more
    central the more sets its lists hold: among near copies, the one with the
    fewest shingles of its own.  What is left out here still meets in the
    complete round."""
    heads = lists.groupBy("item", "block").agg(F.max(F.struct("weight", "name")).alias("h"))
    meets = lists.join(heads, ["item", "block"]).where("name != h.name")
    meets = meets.groupBy(F.col("h.name").alias("a"), F.col("name").alias("b"), "n").agg(F.count("*").alias("k"))
    best = meets.groupBy("b", "n").agg(F.max(F.struct("k", "a")).alias("m"))
    return best.where(STAR_PART * UNITED * F.col("m.k") >= F.col("n")).select(F.col("m.a").alias("a"), "b")


def _all_pairs(lists: DataFrame) -> DataFrame:
    """Every pair of sets of different classes that may link.  Of two sets that
    link, the first shingle that they share has too few before it, in either,
    for the rest to fall short; entries further down a set's order, and blocks
    of other sizes, are skipped."""
    left = lists.where((SHARED + UNITED) * F.col("at") <= F.col("n")).select(
        "item", "name", "label", "n", "at", F.explode(F.array(F.col("block"), F.col("block") + 1)).alias("block"))
    right = lists.select("item", "block", *(F.col(c).alias(f"{c}2") for c in ("name", "label", "n", "at")))
    right = right.withColumnsRenamed({"item": "item2", "block": "block2"})
    n, n2 = F.col("n"), F.col("n2")
    may_link = ((SHARED + UNITED) * F.least(n - F.col("at"), n2 - F.col("at2")) >= SHARED * (n + n2)) & (
        UNITED * n >= SHARED * n2) & ((n < n2) | ((n == n2) & (F.col("name") < F.col("name2"))))
    met = left.join(right, (F.col("item") == F.col("item2")) & (F.col("block") == F.col("block2"))
                    & (F.col("label") != F.col("label2")) & may_link)
    return met.select(F.col("name").alias("a"), F.col("name2").alias("b")).distinct()


def _grouped(docs: DataFrame, order_buckets: int) -> tuple[DataFrame, DataFrame]:
    """Every document's set, and ``name, head, label`` of every set with words:
    its smallest document and its class."""
    documents = cut_lineage(document_sets(docs))
    classes = documents.where("n > 0").groupBy("name").agg(F.min(F.struct("id", "key")).alias("head"))
    # dealt by shingle once: sums by set and counts of sets then stay in place
    lists = index_lists(docs, shingle_order(docs, order_buckets)).repartition("item")
    lists = lists.groupBy("item", "name").agg(F.min("place").alias("place"))
    shared = lists.withColumn("sets", F.count("*").over(Window.partitionBy("item"))).where("sets > 1")
    n = F.shiftright("place", 32).cast("int")
    shared = shared.select("item", "name", n.alias("n"), (F.col("place") % F.lit(1 << 32)).cast("int").alias("at"),
                           block_of(n).alias("block"), "sets")
    # n goes with the name; asking for it here keeps the dealt lists the same on
    # both sides of the join, so that they are made once
    central = shared.groupBy("name", "n").agg(F.sum("sets").alias("weight"))
    lists = cut_lineage(shared.drop("sets").join(central, ["name", "n"]))
    links = cut_lineage(verified(_star_pairs(lists), docs, classes))
    rest = _classed(lists, links)
    links = cut_lineage(links.unionByName(verified(_all_pairs(rest), docs, classes)))
    labels = minimum_labels(links)
    return documents, classes.join(labels, "name", "left").withColumn("label", F.coalesce("label", "name"))


def components(docs: DataFrame, order_buckets: int = ORDER_BUCKETS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    documents, grouped = _grouped(docs, order_buckets)
    smallest = grouped.groupBy("label").agg(F.min("head.id").alias("component"))
    named = grouped.join(smallest, "label").select("name", "component")
    out = documents.join(named, "name", "left").withColumn("component", F.coalesce("component", "id"))
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(known("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      known("component").alias("component_id"))


def keep_one_of_class(docs: DataFrame, order_buckets: int = ORDER_BUCKETS) -> DataFrame:
    """``docs`` with one row of each class, the smallest by id, then row hash,
    and all rows without words; of rows equal in id and text, one.  Classes
    whose smallest ids are equal or null keep a row each."""
    documents, grouped = _grouped(docs, order_buckets)
    heads = grouped.groupBy("label").agg(F.min("head").alias("head")).select("head.id", "head.key")
    kept = heads.unionByName(documents.where("n = 0").select("id", "key").distinct())
    kept = kept.withColumnsRenamed({"id": "_j_id", "key": "_j_key"})
    rows = docs.withColumns({"_j_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
                             "_j_key": F.xxhash64("doc_id", "text")})
    rows = rows.join(kept, ["_j_id", "_j_key"], "left_semi")
    return rows.dropDuplicates(["_j_id", "_j_key"]).select(*docs.columns)
