"""Blocks, bounds and pruning of the top-k search."""

import numpy as np
import pytest
from llm_rows import rows_of
from pyspark.sql import functions as F

from hourlake.llm import topk
from hourlake.llm.common import Scratch, share_package


def clusters(rng, groups=12, each=200, width=32):
    centres = rng.normal(0, 4, (groups, width))
    return np.floor(64 * np.concatenate([c + rng.normal(0, 0.2, (each, width)) for c in centres]))


def summary_of(vectors, names, blocks):
    rows = []
    for name, own in blocks:
        centre, summary = topk.block_summary(vectors[own])
        rows.append({"block": name, "n": len(own), "centre": centre.tobytes(), "summary": summary.tobytes()})
    return topk.Blocks(rows)


def test_block_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    vectors = clusters(rng)
    queries = np.concatenate([vectors[::50], np.floor(64 * rng.normal(0, 4, (20, 32)))])
    owners = [(str(g), np.arange(g * 200, g * 200 + 200)) for g in range(12)]
    blocks = summary_of(vectors, None, owners)
    bounds = blocks.bounds(queries)
    best = np.stack([(queries @ vectors[own].T).max(axis=1) for _, own in owners], axis=1)
    assert (bounds >= best).all()
    first = blocks.first(bounds, 20)
    assert (first.sum(axis=1) == 1).all()  # 200 members are enough
    floors = np.sort(queries @ vectors.T, axis=1)[:, -20]
    assert ((bounds >= floors[:, None]) & ~first).mean() < 0.5  # most other blocks are never met
    few = topk.Blocks([{"block": "a", "n": 3, "centre": vectors[:3].mean(0).tobytes(), "summary": topk.block_summary(vectors[:3])[1].tobytes()},
                       {"block": "b", "n": 18, "centre": vectors[3:21].mean(0).tobytes(), "summary": topk.block_summary(vectors[3:21])[1].tobytes()}])
    assert few.first(few.bounds(queries), 20).all()  # one block can't fill a query


@pytest.mark.parametrize("shift", [0.0, 500.0])
def test_few_pairs_are_scored(shift):
    rng = np.random.default_rng(2)
    vectors = clusters(rng) + shift
    ids = np.arange(len(vectors))
    ask = ids[::40]
    where, found, score, scored = topk.search_cell(ask, vectors[ask], np.full(len(ask), -np.inf), ids, vectors, vectors.mean(0), 20)
    every = len(ask) * (len(ids) - 1)
    assert scored < 0.95 * every  # the first strip must be scored
    exact = vectors[ask] @ vectors.T
    exact[np.arange(len(ask)), ask] = -np.inf
    floors = np.sort(exact, axis=1)[:, -20]
    _, again, score2, scored2 = topk.search_cell(ask, vectors[ask], floors, ids, vectors, vectors.mean(0), 20)
    assert scored2 < 0.25 * every and sorted(again) == sorted(found) and sorted(score) == sorted(score2)
    for q in range(len(ask)):
        want = sorted(zip(-exact[q], ids))[:20]
        assert sorted(zip(-score[where == q], found[where == q])) == want


def test_search_of_clusters(spark):
    share_package(spark)
    rng = np.random.default_rng(3)
    vectors = clusters(rng, 6, 80, 12)
    rows = [(int(i), [float(x) for x in v / 64]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a hot vector: one pivot's block is split
    rows += [(2000 + i, [float(x) for x in rng.normal(0, 1, 5)]) for i in range(30)]  # another length
    rows += [(40, rows[41][1]), (3000, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(a, b, 9, "x") for a, b in rows], "vec_id long, embedding array<double>, score int, block string").repartition(4)
    floors = {i: np.floor(64 * np.array(v)) for i, v in rows}
    own = {}
    for i, v in rows:
        own.setdefault(i, []).append([int(x) for x in np.floor(64 * np.array(v))])
    want = []
    for q in sorted({i for i in floors if i % 20 == 0}):
        ask = min(own[q])
        scores = sorted((-sum(a * b for a, b in zip(ask, v)), i) for i, vs in own.items() for v in vs if i != q and len(v) == len(ask))[:20]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    for block in (25, None):
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, query_block=3, candidate_block=block)
        assert rows_of(got) == sorted(want, key=repr)


def test_blocks_are_bounded(spark):
    share_package(spark)
    scratch = Scratch(spark)
    rows = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(1.0)] * 4).alias("vector"), F.col("id").alias("_row"))
    table = topk.candidate_blocks(rows, 3000, 4, 100, scratch).select("n").collect()  # all equal: one pivot
    assert sum(r.n for r in table) == 3000 and max(r.n for r in table) < 200
