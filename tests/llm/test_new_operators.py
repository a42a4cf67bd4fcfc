"""Token files, vector codes and fill-in-middle against brute force."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_rows import rows_of
from tokenizers import Tokenizer

from hourlake.llm import codes, infill, queries, tokenfile

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string"


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def encoded(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


# Token files


def test_words_encode_as_whole_texts(library):
    rng = random.Random(3)
    letters = "ab~.,?;IßſKé'strel  \n\t\r\x0b\x1c\x85\xa0　̸́١２3.!中文😀Σς<|>"
    texts = ["", " ", "\n\n", "it's we'll I'D", "<|endoftext|>a <|startoftext|>", "é ́e", "Ὀδυσσεύς ΣΑΣ", "a" * 3000, "中" * 500]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["Word. word, WORD! Éa? éa. ~ a~b ~~ x ~.", "word.. word). word", "Σ. ΑΣ, aǅ. ªb. ŉ, ʼn."]
    encoder = tokenfile.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 1, kept=2000)
    for low in range(0, len(texts), 500):
        some = texts[low:low + 500]
        ids, offsets = encoder.encode(pa.array(["", *some])[1:])  # a slice
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [encoded(library, t) for t in some]


def test_long_texts_are_encoded_in_parts(library, monkeypatch):
    monkeypatch.setattr(tokenfile, "PART", 50)
    encoder = tokenfile.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    for text in ("some words of Text. " * 40, "x" * 300, "a b\n" * 100 + "longlonglong" * 9, " " * 120):
        assert encoder.encode_long(text).tolist() == encoded(library, text)


def huffman_total(counts):
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_code_lengths():
    rng = random.Random(4)
    for n in (2, 3, 7, 300):
        counts = np.array([rng.randint(1, 10 ** rng.randint(1, 6)) for _ in range(n)])
        free = tokenfile.code_lengths(counts, 60)
        assert int((free * counts).sum()) == huffman_total(counts.tolist())
        for longest in (9, 10, 12):
            lengths = tokenfile.code_lengths(counts, longest)
            assert lengths.max() <= longest and (0.5 ** lengths).sum() == 1
            assert (lengths * counts).sum() >= (free * counts).sum()
    # the best code of at most 3 bits for 5 symbols, found by trying all
    counts, best = np.array([50, 20, 3, 2, 1]), None
    for lengths in np.ndindex(3, 3, 3, 3, 3):
        lengths = np.array(lengths) + 1
        if (0.5 ** lengths).sum() <= 1:
            total = int((lengths * counts).sum())
            best = total if best is None else min(best, total)
    assert int((tokenfile.code_lengths(counts, 3) * counts).sum()) == best
    assert tokenfile.code_lengths(np.array([5]), 18).tolist() == [1]
    assert tokenfile.code_lengths(np.ones(40, int), 2).max() == 6  # as many bits as symbols need
    assert tokenfile.code_lengths(np.empty(0, int), 18).tolist() == []


def test_blocks_decode_alone():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.geometric(0.01, 20_000) * 3, 49_000)
    ids[::997] = 60_000
    symbols, counts = np.unique(ids, return_counts=True)
    book = tokenfile.Codebook(symbols, tokenfile.code_lengths(counts, 12))
    blocks = [ids[i:i + 1000] for i in range(0, len(ids), 1000)] + [ids[:1], ids[:64], ids[:65]]
    coded = [(*book.encode(b, 64), len(b)) for b in blocks]
    for block, one in zip(blocks, coded):
        assert book.decode([one], 64)[0].tolist() == block.tolist()
    assert np.concatenate(book.decode(coded, 64)).tolist() == np.concatenate(blocks).tolist()
    bits = sum(len(b) for b, _, _ in coded) * 8
    assert bits < 1.01 * sum(int(book.length[b].sum() + 8) for b in blocks)


def test_crc_of_parts():
    data = random.Random(6).randbytes(5000)
    for cut in (0, 1, 17, 4999, 5000):
        assert tokenfile.crc_before(zlib.crc32(data[:cut]), 5000 - cut) ^ zlib.crc32(data[cut:]) == zlib.crc32(data)


def test_token_report(spark, library):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta's", "中文", "x1"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " ", " ".join(str(rng.random()) for _ in range(12_000)), texts[3], texts[3]]
    rows = [(i * 7, t, "en", "a", 1, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    start, want = 0, []
    for doc_id, text, *_ in rows:
        ids = encoded(library, text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert max(w[2] for w in want) > 2 * tokenfile.BLOCK  # one document over several blocks
    assert sorted(map(tuple, tokenfile.token_report(docs).collect())) == want


def test_token_files_read_back(spark, library, tmpdir_path):
    rows = [(i, f"text {i} of some words" * (i % 4), "en", "a", 1, None) for i in range(50)]
    rows += [(None, "null id", "en", "a", 1, None), (None, "null id", "en", "a", 1, None), (4, "other text", "en", "a", 1, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    folder = tokenfile.write_token_files(docs, f"{tmpdir_path}/files", block=70, every=8)
    back = tokenfile.read_token_files(spark, folder, block=70, every=8).orderBy("start").collect()
    assert sorted(([r.doc_id, list(r.ids)] for r in back), key=repr) == sorted(([r[0], encoded(library, r[1])] for r in rows), key=repr)
    assert [r.start for r in back] == np.cumsum([0, *(r.n_tokens for r in back)])[:-1].tolist()
    assert [r.doc_id for r in back] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    blocks = spark.read.parquet(f"{folder}/blocks").select("part", "block", "n_ids").collect()
    assert all(r.n_ids <= 70 for r in blocks)


def test_token_report_of_no_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert tokenfile.token_report(empty).collect() == []


# Vector codes


def brute_codes(rows, scale=1024, parts=4, entries=256, rounds=4):
    def fine(v):
        return v is not None and len(v) and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)
    kept = [(i, label, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, label in rows if fine(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = len(kept[0][2]) // parts
    cut = [[tuple(r[2][p * width:(p + 1) * width]) for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(assign(p, c[p])[1], []).append(c[p])
            new.append([tuple(sum(col) // len(members[e]) for col in zip(*members[e])) if e in members else old
                        for e, old in enumerate(books[p])])
        books = new
    out, sums = [], {}
    for (vec_id, label, _), c in zip(kept, cut):
        found = [assign(p, c[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((vec_id, "".join(f"{e:02x}" for _, e in found), error, label))
        sums[label] = sums.get(label, 0) + error
    digest = sha(",".join(str(x) for b in books for c in b for x in c).encode())
    return [(i, code, error, sums[label], digest) for i, code, error, label in out]


def test_code_report(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.3) + (i % 5) for _ in range(8)], rng.choice([1, 2, None])) for i in range(400)]
    rows += [(500 + i, [0.5] * 8, 3) for i in range(150)]  # a hot vector
    rows += [(7, rows[9][1], 1), (None, rows[3][1], 2), (None, [9.0] * 8, 2), (900, None, 1), (901, [1.0] * 7 + [None], 1),
             (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (904, [1.0] * 12, 1), (905, [], 1), (906, [1.0] * 7, 1)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows], "vec_id long, embedding array<float>, label int, code string")
    assert rows_of(codes.code_report(frame.repartition(5))) == sorted(brute_codes(rows), key=repr)


def test_vector_codes_of_few_rows(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert codes.code_report(spark.createDataFrame([], kind)).collect() == []
    assert codes.code_report(spark.createDataFrame([(1, None, 1)], kind)).collect() == []
    one = spark.createDataFrame([(1, [0.5, -0.5, 1.0, 2.0], None)], kind)
    assert codes.code_report(one).collect()[0][:4] == (1, "00000000", 0, 0)
    huge = spark.createDataFrame([(1, [3e38, -3e38, 1.0, 2.0], 1), (2, [0.0] * 4, 1)], kind)
    assert len(codes.code_report(huge).collect()) == 2


def test_only_changed_members_travel(spark):
    """After the first round, what is shuffled are members whose entry changed."""
    rng = np.random.default_rng(10)
    v = np.concatenate([rng.normal(c, 0.01, (200, 8)) for c in (0, 3, 6)])
    kept = codes.integers(spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int"), 1024, 4)
    books = np.floor(v[[0, 200, 400]] * 1024).astype(np.int64).reshape(3, 4, 2).swapaxes(0, 1).copy()
    _, resident = codes.lloyd(kept, books, 3, 4)
    assert resident.getNumPartitions() == 4  # the union keeps the partitioner
    assert resident.partitioner is not None
    assert sum(len(m.row) for _, m in resident.collect()) == 600 * 4
    assert resident.filter(lambda pair: False).isEmpty()
    moved = resident.mapPartitionsWithIndex(lambda i, pairs: [sum(len(m.row) for p, m in pairs if p != i)]).sum()
    assert moved == 0


# Fill-in-middle


def brute_infill(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    n = len(tokens)
    digest = sha(f"1:{'' if doc_id is None else doc_id}".encode())
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text.encode()), sha(text.encode())
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    spm = h[3] % 100 < 20
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, "spm" if spm else "psm", len(prefix), len(middle), sha(output.encode()), sha(text.encode())


def test_infill_report(spark, docs, corpus):
    rng = random.Random(11)
    extra = ["".join(rng.choice("abZ é中😀\n<P>SM1") for _ in range(rng.randint(0, 200))) for _ in range(400)]
    extra += ["a" * 100_000, "😀" * 5000, "<P", "<" * 50, "ab<S>", "".join(rng.choice("ab c") for _ in range(300_000))]
    rows = [(1000 + i, t, "en", "a", 1, "n") for i, t in enumerate(extra)]
    more = spark.createDataFrame(rows, "doc_id long, text string, form string, output string, n long, note string")
    assert rows_of(infill.infill_report(more)) == sorted((brute_infill(*r[:2]) for r in rows), key=repr)
    assert rows_of(infill.infill_report(docs)) == sorted((brute_infill(*r[:2]) for r in corpus), key=repr)


def test_infill_of_no_rows(empty):
    assert infill.infill_report(empty).collect() == []


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(12)
    values = rng.integers(0, 8, 1000).astype(np.uint8)
    matrix = infill.WaveletMatrix(values, 3)
    at = np.arange(1001)
    for value in range(8):
        assert matrix.rank(value, at).tolist() == [0, *np.cumsum(values == value).tolist()]


def test_queries_are_registered():
    assert {"op11_token_files", "op12_vector_codes", "op13_fill_in_middle"} <= set(queries.LLM_QUERIES)
