"""Passages of over 50 words that repeat across documents, though under 400 bytes (FINDINGS_r03.md)."""

import random
from collections import Counter

from hourlake.llm import queries, substring
from hourlake.llm.common import WHITESPACE, share_package

SPACE = str.maketrans(dict.fromkeys(WHITESPACE, " "))


def shares(texts, words):
    """Brute force: whether some window of words occurs in another row."""
    split = [[w for w in (t or "").translate(SPACE).split(" ") if w] for t in texts]
    held = [{tuple(w[i:i + words]) for i in range(len(w) - words + 1)} for w in split]
    rows = Counter(x for h in held for x in h)
    return [any(rows[x] > 1 for x in h) for h in held]


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(3, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    short, less, own = prose(51), prose(50), prose(60)
    assert len(short.encode()) < 400
    texts = [prose(rng.randint(0, 200)) for _ in range(40)]
    texts += [prose(30) + " " + short + " " + prose(200), prose(5) + "\n" + short.replace(" ", " \t"), short]
    texts += [prose(40) + " x " + less + " y " + prose(9), prose(7) + " z " + less]  # 50 words are no passage
    texts += [own + " " + prose(3) + " " + own]  # one that repeats itself only
    texts += [short.replace(" ", "\u00a0"), prose(20) + " " + short[:-1]]  # other words
    texts += [texts[3] + " q", texts[4], texts[4], "one two", "one two", "", None, None, " \n"]
    texts += ["the " * 60, "a " + "the " * 300, "by " * 50, "by " * 50, "it " * 90]
    return texts


def test_shared_passages_equal_brute_force(spark):
    share_package(spark)
    texts = corpus()
    rows = list(enumerate(texts)) + [(None, texts[40]), (7, texts[8]), (7, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for words in (51, 4):
        got = substring.dedup_substrings(docs, words=words).select("doc_id", "n_bytes", "shares_passage").collect()
        want = shares([t for _, t in rows], words)
        assert Counter(map(tuple, got)) == Counter((d, len((t or "").encode()), w) for (d, t), w in zip(rows, want))


def test_a_repeated_line_is_one_run_per_text(spark):
    share_package(spark)
    line = " ".join(f"w{i}" for i in range(7)) + "\n"
    docs = spark.createDataFrame([(1, line * 200), (2, line * 90 + "end")], "digest long, text string")
    rows = substring._passages(docs, 51, True).collect()
    names = Counter((r.digest, r.anchor, n) for r in rows for n in set(r.names))
    assert max(names.values()) <= 2  # a whole run and the text's last, cut short
    assert len({n for r in rows if r.digest == 1 for n in r.names}) == 7


def test_query_tells_passages_under_400_bytes(spark, tmp_path):
    texts = corpus()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op10_substring_dedup(spark, str(tmp_path)).collect()}
    assert [got[i].shares_passage for i in range(len(texts))] == shares(texts, 51)
    # the contract's 400 bytes stay: such a passage is told, not removed
    assert got[40].shares_passage and not got[40].has_repeats and got[40].n_removed == 0
    assert got[45].has_repeats == (got[45].n_removed > 0) and not got[45].shares_passage
    assert substring.dedup_substrings(spark.createDataFrame([], "doc_id long, text string"), words=51).count() == 0
