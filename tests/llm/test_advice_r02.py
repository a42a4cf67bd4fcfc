
import random

import corpus_pipeline
from hourlake.llm.common import share_package


def test_jaccard_stage_keeps_every_class(spark):
    share_package(spark)
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice("abcde") for _ in range(6)) for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (None, b + " end"), (3, c), (1, c + " end"), (3, d), (3, d), (9, d + " end"),
            (4, e), (None, e), (None, ""), (None, None), (None, None), (5, " "), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(map(tuple, corpus_pipeline.jaccard_stage(spark, docs, "").collect()), key=repr)
    near_null = [r for r in kept if r[1] in (b, b + " end")]
    assert len(near_null) == 1 and near_null[0][0] is None
    want = [near_null[0], (None, a), (1, c + " end"), (3, d), (4, e), (None, ""), (None, None), (5, " "), (5, None)]
    assert kept == sorted(want, key=repr)
