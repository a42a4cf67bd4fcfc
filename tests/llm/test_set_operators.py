"""Search, joins, mixing, sharding and URL filters against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import rows_of
from pyspark.sql import functions as F

from hourlake.llm import jaccard, mixing, sharding, substring, topk, urls


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, .2, 12)]) for i in range(160)]
    rows += [(160, rows[0][1]), (161, rows[0][1]), (161, rows[1][1]), (None, rows[0][1]), (162, None), (163, []),
             (164, [float("nan")] * 12), (165, [None] * 12), (166, [1.0]), (180, [0.5]), (167, [-1e-20] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(4)
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        v = min(x for i, x in good if i == q)
        scores = sorted((-sum(a * b for a, b in zip(v, c)), i) for i, c in good if i != q and len(c) == len(v))[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, query_block=4, candidate_block=50)
    assert rows_of(got) == sorted(want, key=repr)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_segment_bound_and_large_scores():
    rng = np.random.default_rng(4)
    a, b = rng.normal(0, 9, (30, 13)), rng.normal(0, 9, (40, 13))
    bounds = [topk.segment_statistics(a, n) @ topk.segment_statistics(b, n).T for n in (1, 4, 13)]
    assert all((x >= a @ b.T - 1e-6).all() for x in bounds)
    big = np.array([[2.0 ** 40, -3.0]])
    assert topk.exact_scores(big, big)[0, 0] == (1 << 63) - 1
    assert topk.exact_scores(np.array([[2.0 ** 30, 1.0]]), np.array([[2.0 ** 30, 1.0]]))[0, 0] == (1 << 60) + 1


def brute_components(corpus):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(r[1]) for r in corpus]
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                up[top(i)] = top(j)
    low = {}
    for i, r in enumerate(corpus):
        low[top(i)] = min(low.get(top(i), math.inf), math.inf if r[0] is None else r[0])
    return [(r[0], len(s), None if low[top(i)] == math.inf else low[top(i)]) for i, (r, s) in enumerate(zip(corpus, sets))]


def test_jaccard_components(docs, corpus, empty):
    want = brute_components(corpus)
    assert len({w[2] for w in want}) < len(want) - 20
    assert rows_of(jaccard.components(docs, order_buckets=1 << 10)) == sorted(want, key=repr)
    kept = jaccard.keep_one_of_class(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {w[2] for w in want}
    assert jaccard.components(empty).count() == 0 == jaccard.keep_one_of_class(empty).count()


@pytest.mark.parametrize("keep", ["none", "first"])
def test_substrings(docs, corpus, empty, keep):
    place = defaultdict(list)
    null = -1
    data = [((null if r[0] is None else r[0]), (r[1] or "").encode()) for r in corpus]
    for i, (_, b) in enumerate(data):
        for p in range(len(b) - 399):
            place[b[p:p + 400]].append((i, p))
    got = rows_of(substring.dedup_substrings(docs, keep=keep, texts=True))
    assert len(got) == len(corpus)
    if keep == "none":
        want = []
        for (i, b), row in zip(data, corpus):
            gone = np.zeros(len(b), bool)
            for p in range(len(b) - 399):
                if len(place[b[p:p + 400]]) > 1:
                    gone[p:p + 400] = True
            left = bytes(np.frombuffer(b, np.uint8)[~gone])
            runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
            want.append((row[0], len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest(), bytearray(left)))
        assert got == sorted(want, key=repr)
        hot = substring.repeated_spans(docs, most=1)
        usual = substring.repeated_spans(docs)
        starts = lambda df: sorted((r.id, r.hash, sorted({x for s in r.spans for x in range(s.first, s.last + 1)})) for r in df.collect())
        assert starts(hot) == starts(usual)
    else:
        kept = b"\x00".join(bytes(r[5]) for r in got)
        none = {r.doc_id for r in substring.dedup_substrings(docs).where("n_removed > 0").collect()}
        some = {r[0] for r in got if r[2]}
        assert some < none  # the first copies stay
        for text in place:  # and every string is still somewhere, or its bytes were cut with a neighbour's
            assert text[:1] in kept
    assert substring.dedup_substrings(empty).count() == 0


def test_mixing(spark, docs, corpus, empty):
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 1.0)], "source string, weight double")
    out = mixing.mix_sources(docs.withColumn("copy", F.lit("clash")), weights, total=40_000.0)
    n = Counter(r.source for r in out.select("source").collect())
    assert n["c"] == 0
    for source, share in (("a", .25), ("b", .5), (None, .25)):
        assert abs(n[source] - 40_000 * share) < 5 * math.sqrt(40_000 * share) * 3
    assert rows_of(mixing.mix_sources(docs)) == rows_of(mixing.mix_sources(docs.repartition(3)))
    drawn = [r for r in mixing.distribution(mixing.target_rates(docs)).collect()]
    assert all(abs(r._m_cdf[-1] - 1) < 1e-12 for r in drawn)
    assert mixing.mix_sources(empty).count() == 0


def test_sharding(spark, docs, corpus, empty, tmpdir_path):
    names = sharding.shard_names(7)
    table = sharding.lookup_table(names, 101)
    count = Counter(table)
    assert set(table) == set(range(7)) and max(count.values()) - min(count.values()) <= 1
    more = sharding.lookup_table(names + ["new"], 10_007)
    less = sharding.lookup_table(names, 10_007)
    assert sum(a != b and b != 7 for a, b in zip(less, more)) < 0.1 * 10_007  # few slots move between old shards
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 101)
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)
    got = sharding.place(docs.withColumn("slot", F.lit(1)), shards=names, table_size=101).collect()
    assert len(got) == len(corpus) and all(r.shard == table[r.slot] for r in got)
    assert len({r.shard for r in got if r.doc_id == 3}) == 1
    sharding.write_shards(docs, f"{tmpdir_path}/out", shards=names, table_size=101)
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == len(corpus)
    assert sharding.place(empty).count() == 0


def host_path(url):
    if "://" not in (url or ""):
        return "", ""
    rest = re.split("[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path


def test_urls(spark):
    made = ["http://a.NET/x", "http://net", "https://w.example.net/en/1?x=/de/", "http://example.net/de/", "http://x.example.com/de/9",
            "http://example.com/en/", "http://q.org/fr/1#a", "http://q.org/en/1", "http://badexample.net.com/en/", "no url", "",
            None, "x://", "ftp://h?p/q", "http://n.net?en/", "a://b://c/d", "http://É.org/fr/", "h://" + "z" * 50_000]
    made += [f"http://s{i}.net/de/{i}" for i in range(40)] + [f"http://s{i}.org/fr/{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(made)) + [(None, made[0])], "page_id long, url string")
    got = urls.judge_urls(pages.withColumn("host", F.lit("clash"))).collect()
    assert len(got) == len(made) + 1
    for r in got:
        url = made[r.page_id] if r.page_id is not None else made[0]
        assert (r.host, r.path) == host_path(url)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else ("block" if r.score >= 0.5 else "allow"))
    known = [(r.score >= 0.5) == (r.verdict == "block") for r in got if r.rule]
    assert sum(known) > 0.95 * len(known)
    assert urls.judge_urls(pages.limit(0)).count() == 0
    alone = urls.judge_urls(pages.where("url LIKE '%.net/de%'")).collect()
    assert {r.verdict for r in alone} == {"block"} and all(r.score is None for r in alone)
