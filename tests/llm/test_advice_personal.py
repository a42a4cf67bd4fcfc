
import math
import re
import time
from collections import Counter

from hourlake.llm import pii
from hourlake.llm.common import share_package


def brute_terms(texts):
    """Spans of revealing terms by text, counted over whole texts."""
    words = [{w.lower() for w in re.findall(r"[^\W\d_]+", t or "")} for t in texts]
    base = [pii.base_spans(t or "") for t in texts]
    entities = [{(k, t[a:b]) for k, a, b in s} for t, s in zip(texts, base)]
    once = list({t or "": i for i, t in enumerate(texts)}.values())  # a copy is no evidence
    n_term, n_entity = Counter(w for i in once for w in words[i]), Counter(e for i in once for e in entities[i])
    n_both = Counter((e, w) for i in once for e in entities[i] for w in words[i])
    n = len(once)
    shown = {(e, w) for (e, w), k in n_both.items() if k >= 2 and n_entity[e] < n
             and math.log2(n * k / (n_entity[e] * n_term[w])) >= 0.9 * math.log2(n / n_entity[e])}
    return [[m.span() for m in re.finditer(r"[^\W\d_]+", t or "") if any((e, m[0].lower()) in shown for e in x)
             and not any(a < m.end() and m.start() < b for _, a, b in s)] for t, x, s in zip(texts, entities, base)]


def test_terms_of_whole_texts(spark, corpus):
    share_package(spark)
    far = "plain filler words " * 30
    texts = [f"Zebrafish {far} jo@doe.org {far} Li and 王 met", f"jo@doe.org {far} LI {far} 王 Zebrafish zebrafish, ip 10.0.0.1",
             f"{far} a note", "ip 10.0.0.1 q", "Li alone@doe.org", None, ""] + [r[1] for r in corpus]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: [(s.start, s.end) for s in r.terms] for r in pii.find_personal(docs).collect()}
    want = brute_terms(texts)
    assert got == dict(enumerate(want))
    found = [{texts[i][a:b] for a, b in want[i]} for i in (0, 1)]
    assert {"Zebrafish", "王"} <= found[0] and {"Zebrafish", "zebrafish", "王"} <= found[1]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs.union(docs.where("doc_id = 0"))).collect()}
    assert "王" not in clean[0] and "ebrafish" not in clean[1] and clean[2] == texts[2]
    short = [(1, "mail jo@doe.org for Bo"), (2, "Bo wrote jo@doe.org"), (3, "nothing"), (4, "x"), (5, None)]
    got = {r.doc_id: r.terms for r in pii.find_personal(spark.createDataFrame(short, "doc_id long, text string")).collect()}
    assert (20, 22) in [(s.start, s.end) for s in got[1]]


def test_copies_are_no_evidence(spark):
    share_package(spark)
    page = "Unusual wording about Kraken and jo@doe.org " + " ".join(f"word{chr(97 + i)}" for i in range(20))
    rows = [(i, page) for i in range(10)] + [(20 + i, f"other text number {'x' * i}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii.personal_report(docs).collect()}
    assert all(r.n_term == 0 for r in got.values())
    assert got[0].n_base == got[0].n_total == got[0].n_email == 1
    more = docs.union(spark.createDataFrame([(50, "Kraken met jo@doe.org")], "doc_id long, text string"))
    got = {r.doc_id: r for r in pii.personal_report(more).collect()}
    assert got[3].n_term == 1 and got[50].n_term == 1  # a second text that says so


def test_many_addresses_in_a_text(spark):
    share_package(spark)
    page = " ".join(f"a{i}@doe.org" for i in range(10_000)) + " " + " ".join(
        "".join(chr(97 + int(d)) for d in str(i)) + "zz" for i in range(10_000))
    rows = [(1, page), (2, page + " end"), (3, "none"), (4, "no one"), (5, "nothing"), (6, "nil"), (7, "nought")]
    started = time.time()
    got = {r.doc_id: r for r in pii.personal_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_email == 10_000 and got[1].n_term >= 10_000 and got[2].n_term == got[1].n_term
    assert time.time() - started < 60


def test_terms_are_generalised(spark):
    share_package(spark)
    rows = [(1, "Kraken came in March to jo@doe.org"), (2, "in March jo@doe.org saw a Kraken"), (3, "in"), (4, "came to"), (5, "a"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert got[1] == "[...] came in [MONTH] to [EMAIL]" and got[3] == "in" and got[6] is None
