"""The quality score over words and word pairs against brute force."""

import math

import xxhash
from llm_rows import rows_of
from pyspark.sql import functions as F

from hourlake.llm import quality, queries

DOCS = "doc_id long, text string"


def signed(data, seed=42):
    h = xxhash.xxh64_intdigest(data, seed=seed)
    return (h ^ (1 << 63)) - (1 << 63)


def grams_of(text):
    """Hashes of the words, then of the pairs as Spark hashes two longs: the
    first one's hash seeds the second's."""
    words = [signed(w.encode()) for w in (text or "").split()]
    as_bytes = [(w % (1 << 64)).to_bytes(8, "little") for w in words]
    return words + [signed(b, xxhash.xxh64_intdigest(a, seed=42)) for a, b in zip(as_bytes, as_bytes[1:])]


def scores_of(rows, trusted, buckets):
    raw, target = [0] * buckets, [0] * buckets
    for doc_id, text in rows:
        for g in grams_of(text):
            raw[g % buckets] += 1
            target[g % buckets] += doc_id in trusted
    share = lambda n, total: math.log((n + 1) / (total + buckets))
    weight = max(0, 1 - buckets / sum(target))
    ratio = [weight * (share(t, sum(target)) - share(r, sum(raw))) for t, r in zip(target, raw)]
    return {i: sum(ratio[g % buckets] for g in grams_of(t)) / max(1, len(grams_of(t))) for i, t in rows}


def test_words_and_pairs_against_brute_force(spark, corpus):
    rows = [(i, t) for i, t, *_ in corpus if i is not None and i > 3] + [(900, "one"), (901, "one two"), (902, None)]
    trusted = {i for i, _ in rows if i < 30} | {901}
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    want = scores_of(rows, trusted, 64)
    got = quality.quality_report(docs, ids, buckets=64, grams=quality.WORDS).collect()
    assert len(got) == len(rows) and all(math.isclose(r.score, want[r.doc_id], abs_tol=1e-9) for r in got)


def test_query_and_pipeline_tell_texts_by_whole_words_and_their_order(spark, tmpdir_path):
    """Words of equal endings, and equal words in another order, differ."""
    import corpus_pipeline
    base = [f"{a}{b}{c}ent" for a in "bcdf" for b in "aeiou" for c in "lm"]  # 40 words of one ending
    good = [" ".join([*base[:20], f"n{i}", *base[20:]]) for i in range(1000)]
    other = [" ".join(["x" + w for w in base] + [f"n{i}"]) for i in range(1000)]
    turned = [" ".join(reversed(t.split())) for t in good]
    rows = list(enumerate(good + other + turned))
    spark.createDataFrame(rows, DOCS).repartition(2).write.parquet(f"{tmpdir_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1000)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmpdir_path}/labels.parquet")
    got = queries.op3_quality_rules(spark, tmpdir_path)
    kinds = {r.kind: r for r in got.groupBy(F.floor(F.col("doc_id") / 1000).alias("kind")).agg(
        F.min("score").alias("least"), F.max("score").alias("most"), F.bool_or("base_failed").alias("failed")).collect()}
    assert not any(r.failed for r in kinds.values())
    assert kinds[0].least > kinds[2].most > kinds[1].most
    verdicts = got.where("kept").select("doc_id")
    stage = corpus_pipeline.quality_stage(spark, spark.read.parquet(f"{tmpdir_path}/documents.parquet"), tmpdir_path)
    assert rows_of(stage.select("doc_id")) == rows_of(verdicts)
    kept = {r.doc_id for r in verdicts.collect()}
    assert set(range(1000)) <= kept and not kept & set(range(1000, 2000))
