"""Empty tables, encoded offsets, and texts above the part sizes."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from hourlake.llm import bpe, jaccard, mixing, pii, quality, secrets, sharding, substring
from hourlake.llm.common import share_package

KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tiktoken.Encoding("r", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijé") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", "\n"]) for _ in range(260_000))


def frame(spark, texts):
    share_package(spark)
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], KIND).repartition(3)


def test_empty_tables(spark, empty):
    share_package(spark)
    trusted = empty.select("doc_id")
    for rows in (bpe.bpe_report(empty), bpe.decode_bpe(bpe.encode_bpe(empty)), quality.keep_quality(empty, trusted),
                 jaccard.keep_one_of_class(empty), pii.sanitise(empty), secrets.redact_secrets(empty), mixing.mix_sources(empty), sharding.place(empty)):
        assert rows.collect() == []


def test_pipeline_of_an_empty_table(spark, tmpdir_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    assert corpus_pipeline.run(spark, tmpdir_path).collect() == []


def test_encoded_offsets_and_decoding(spark, library):
    texts = ["Hello, wörld! 中文 😀", None, "", "  a\n\n b\t", "it's we'll", "x" * 700]
    coded = bpe.decode_bpe(bpe.encode_bpe(frame(spark, texts)))
    for r in coded.collect():
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        sizes = [len(library.decode_single_token_bytes(i)) for i in ids]
        assert list(r.ids) == ids and list(r.offsets) == np.cumsum([0, *sizes])[:-1].tolist()
        assert bytes(r.decoded) == text.encode() and bytes(r.packed) == np.array(ids, "<u4").tobytes()


def test_long_text_through_bpe(spark, library, long_text):
    assert len(long_text.encode()) > 2 * bpe.PART
    texts = ["short", long_text, None, "end"]
    for r in bpe.bpe_report(frame(spark, texts)).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_long_text_through_quality(spark, long_text):
    texts = [long_text, "a b c d e f g h i j k l", None]
    got = {r.doc_id: r for r in quality.quality_report(frame(spark, texts), spark.createDataFrame([(0,)], "doc_id long")).collect()}
    words = re.findall(r"[^\x20\x09-\x0D]+", long_text)
    assert got[0].n_words == len(words) and got[0].word_chars == sum(map(len, words))
    lines = [x for x in long_text.split("\n") if x.strip()]
    assert got[0].n_dup_lines == len(lines) - len(set(lines)) and not got[0].base_failed


def test_long_near_copies(spark, long_text):
    assert len(long_text) > jaccard.PART
    cut = long_text[: int(len(long_text) * 0.9)]
    texts = [cut, "other words entirely here now", long_text, "LONG " + long_text, None]
    got = {r.doc_id: r for r in jaccard.components(frame(spark, texts)).collect()}
    assert [got[i].component_id for i in range(5)] == [0, 1, 0, 0, 4]
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), long_text))
    assert got[2].n_shingles == len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})


def test_long_text_through_mixing_and_sharding(spark, long_text):
    docs = frame(spark, [long_text, "b", "c"])
    mixed = mixing.mix_sources(docs, total=30.0)
    assert {r.text for r in mixed.collect()} <= {long_text, "b", "c"}
    assert sorted(len(r.text) for r in sharding.place(docs).collect()) == [1, 1, len(long_text)]


def test_long_text_through_personal_data(spark, long_text):
    half = len(long_text) // 2
    page = long_text[:half] + " jo@doe.org Kraken " + long_text[half:]
    texts = [page, "Kraken wrote to jo@doe.org", "a note", "another", "third", None]
    got = {r.doc_id: r for r in pii.find_personal(frame(spark, texts)).collect()}
    assert [(s.kind, s.start, s.end) for s in got[0].base] == [("email", half + 1, half + 11)]
    assert [page[s.start:s.end] for s in got[0].terms] == ["Kraken"]


def test_long_text_through_substrings(spark, long_text):
    rng = random.Random(2)
    passage = "".join(rng.choice("klmnop ") for _ in range(1000))
    text = long_text[:1_300_000]
    assert len(text.encode()) > substring.PART_BYTES
    place = 1_100_000
    texts = [text[:place] + passage + text[place:], "x" + passage[200:800] + "y", "none"]
    got = {r.doc_id: r for r in substring.dedup_substrings(frame(spark, texts), texts=True).collect()}
    assert [got[i].n_removed for i in range(3)] == [600, 600, 0]
    assert bytes(got[0].kept) == (text[:place] + passage[:200] + passage[800:] + text[place:]).encode()
    assert bytes(got[1].kept) == b"xy"


def test_hot_anchor_in_thousands_of_settings(spark):
    """One passage with other bytes around it in each of very many texts."""
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    core = letters(420)
    texts = [letters(60) + core + letters(60) for _ in range(6000)]
    starts = {}
    for i, t in enumerate(texts):
        for a in range(len(t) - 399):
            starts.setdefault(hash(t[a:a + 400]), []).append((i, a))
    spans = {}
    for places in starts.values():
        if len(places) > 1:
            for i, a in places:
                spans.setdefault(i, []).append(a)
    want = {i: max(a) + 400 - min(a) for i, a in spans.items()}  # all reach over the passage: one span
    got = substring.dedup_substrings(frame(spark, texts)).select("doc_id", "n_removed", "n_spans").collect()
    assert {r.doc_id: r.n_removed for r in got} == want and {r.n_spans for r in got} == {1}
