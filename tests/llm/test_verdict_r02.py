"""Memory of shingle stages, mixing over few and many sources, sharding and
rules recomputed, copies of whole texts."""

import hashlib
import random
import re
import struct
import tracemalloc

import pyarrow as pa
import pytest
import xxhash
from llm_rows import rows_of
from pyspark.sql import functions as F

from hourlake.llm import jaccard, mixing, queries, secrets, sharding, substring, urls


def test_shingles_of_a_part_stay_small():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(180_000))[:jaccard.PART]
    tracemalloc.start()
    jaccard.shingles(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * jaccard.PART


def test_mixing_joins_rates_both_ways(docs):
    few, many = mixing.mix_sources(docs), mixing.mix_sources(docs, most=0)
    assert rows_of(few) == rows_of(many)
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(shuffle_key") == 1 and "BroadcastHashJoin" in plan
    assert "hashpartitioning(source" not in plan  # texts move once


def naive_table(names, size):
    """Shards take turns over their own orders of preference."""
    digest = lambda name, salt: int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:16], 16)
    orders = []
    for name in names:
        first, step = digest(name, "offset") % size, digest(name, "skip") % (size - 1) + 1
        orders.append(iter([(first + step * i) % size for i in range(size)]))
    table = {}
    while len(table) < size:
        for shard, order in enumerate(orders):
            if len(table) < size:
                table[next(slot for slot in order if slot not in table)] = shard
    return table


def test_slots_and_shards_are_recomputed(spark, docs, corpus):
    names, size = sharding.shard_names(7), 1009
    table = naive_table(names, size)
    rows = sharding.place(docs, shards=names, table_size=size).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        raw = struct.pack("<q", r.doc_id) if r.doc_id is not None else (r.text or "").encode()
        slot = xxhash.xxh64_intdigest(raw, seed=42)
        slot = (slot - (1 << 64) if slot >> 63 else slot) % size
        assert (r.slot, r.shard) == (slot, table[slot])


def test_spread_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_A_TASK", 10)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = lambda: sharding.place(docs, shards=["a", "b"])._jdf.queryExecution().analyzed().toString()
    assert "100" in re.findall(r"pmod\(xxhash64\([^)]*\), (?:cast\()?(\d+)", plan())[-1]


def test_native_queries_have_no_python_node(spark):
    from tests.conftest import SF001
    for name in ("op3_quality_rules", "op6_source_mixing", "op7_url_filters", "op8_sharding"):
        plan = queries.LLM_QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        for node in ("Python", "MapInArrow", "MapInPandas", "FlatMapGroups", "FlatMapCoGroups", "ArrowEval", "BatchEval"):
            assert node not in plan, (name, node)


def test_model_judges_held_out_hosts(spark):
    """Hosts that training never saw, alike in path or ending to those it did."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    made = [(f"https://{word()}.net/{word()}/{i}", "block") for i in range(300)]
    made += [(f"https://{word()}.org/fr/{word()}/{i}", "allow") for i in range(300)]
    labelled = urls.split_urls(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(made[:200] + made[300:500])], "page_id long, url string"))
    labelled = urls.labelled_urls(labelled)
    held = made[200:300] + made[500:]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge_urls(pages, rules=(), labelled=labelled).collect()}
    right = sum(got[i].verdict == verdict for i, (_, verdict) in enumerate(held))
    assert all(r.rule is None for r in got.values()) and right >= 0.95 * len(held)


def naive_base(text):
    """The contract's base of secrets, by plain patterns."""
    out = []
    for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 18), (2, "hex", "[0-9a-f]+", 16)):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [x for _, _, x in sorted(out)]


def test_secret_base_against_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["password", "Api_Key", "apikey", "token", "SECRET", "passwd", "=", ":", " ", "  ", '"', "'", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef",
             "abcdef", "hunter2hunter2", "x.y/z+1==", "é😀", "\n", "\t", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(600)] + [None, "", "z" * 70_000 + " token=abcdefghijkl"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in secrets.secret_report(docs).collect()}
    for i, text in enumerate(texts):
        base = naive_base(text or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), text
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex"))


def brute_cut(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for i, t in enumerate(raw):
        for a in range(len(t) - length + 1):
            seen.setdefault(t[a:a + length], []).append((i, a))
    gone = [set() for _ in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, a in places:
                gone[i].update(range(a, a + length))
    out = []
    for t, g in zip(raw, gone):
        kept = bytes(b for k, b in enumerate(t) if k not in g)
        spans = sum(1 for k in g if k - 1 not in g)
        out.append((len(t), len(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [1 << 23, 64])
def test_whole_copies_and_long_passages(spark, monkeypatch, bits):
    """Copies of texts are settled by digest; a bitmap that lets all rows through
    changes nothing."""
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefghé ") for _ in range(n))
    passage, page, short = letters(1300), letters(900), letters(200)
    texts = [page] * 6 + [page[:500] + letters(300), letters(200) + passage + letters(100), passage, passage, letters(50) + passage[300:900],
                          short, short, None, "", "a" * 399, "b" * 400, "b" * 400, "c" * 900, letters(2000)]
    texts += [f"{letters(30)}{passage[k:k + 420]}{letters(30)}" for k in range(0, 800, 40)]
    monkeypatch.setattr(substring, "maybe_in", lambda rows, keys, name, *_, f=substring.maybe_in: f(rows, keys, name, bits))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in substring.dedup_substrings(docs, texts=True).collect()}
    for i, want in enumerate(brute_cut(texts)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want, i
        assert hashlib.sha256(bytes(got[i].kept)).hexdigest() == want[3]
