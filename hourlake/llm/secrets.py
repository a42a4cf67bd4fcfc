"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Text from a language compresses well under a byte-pair vocabulary; keys and
passwords do not.  A run of key characters is judged outside base spans, UUIDs
and digests: as a whole, unless all its parts are letters only or digits only,
and then part by part between its separators.  Neighbouring parts whose
characters-per-token ratio is low together are reported as ``random``, whatever
readable text stands beside them.  A part of digits only, or of letters that
are one token, tells nothing by itself.

Runs under ``SHORTEST`` characters are not judged: of random strings that short
too many look like words.  Runs above ``PIECE`` characters are tokenised piece by
piece, which adds a token in each at most.

Defined cases: a null text counts as empty; empty texts have no span; a very long
text is scanned whole by one task; a ratio equal to the greatest is readable; rows are
judged one by one, so repeated rows and null or repeated ids need no care;
other columns of the input are ignored by ``scan_secrets`` and kept as they are
by ``redact_secrets``; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.common import bounded

# The patterns of the contract.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

#: Characters of keys and encoded secrets; shorter runs carry too little to judge.
SHORTEST = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
PART = re.compile(r"[A-Za-z0-9]+")
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
#: Pieces of this length are tokenised one by one, so a run costs linear time.
PIECE = 256

Span = tuple[int, int, str]


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """The contract's matches, ordered by start, then kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def is_digest(part: str) -> bool:
    return len(part) in DIGEST_LENGTHS and bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", part))


def _tokens(text: str, encoding) -> int:
    return sum(len(encoding.encode_ordinary(text[i:i + PIECE])) for i in range(0, len(text), PIECE))


def _surplus(part: str, encoding, max_ratio: float) -> float:
    """By how many characters a part falls short of ``max_ratio`` for each of
    its tokens; below 0 for readable text."""
    if part.isdigit():
        return 0.0
    tokens = _tokens(part, encoding)
    surplus = max_ratio * tokens - len(part)
    return min(surplus, 0.0) if tokens == 1 and part.isalpha() else surplus


def _top_segments(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring runs of a list, first and last position (Ruzzo and
    Tompa): none grows in score by more or fewer neighbours."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sums before and up to the last, a link
    total = 0.0
    for i, score in enumerate(scores):
        if score > 0:
            first, low = i, total
            while True:
                j = len(found) - 1  # the last that starts from a smaller sum; links pass by larger ones
                while j >= 0 and found[j][2] >= low:
                    j = found[j][4]
                if j < 0 or found[j][3] >= total + score:
                    break
                first, low = found[j][0], found[j][2]
                del found[j:]
            found.append((first, i, low, total + score, j))
        total += score
    return [x[:2] for x in found]


def _random_in(text: str, start: int, end: int, encoding, max_ratio: float) -> list[Span]:
    """Random spans in a piece of a run that holds no base span and no UUID."""
    whole = [m.span() for m in PART.finditer(text, start, end)]
    digests = [s for s in whole if is_digest(text[s[0]:s[1]])]
    if not digests:
        named = all(text[c:d].isalpha() or text[c:d].isdigit() for c, d in whole)
        if not named and end - start < max_ratio * _tokens(text[start:end], encoding):
            return [(start, end, KINDS[3])]
    out = []
    for low, high in zip([start] + [d for _, d in digests], [c for c, _ in digests] + [end]):
        parts = [m.span() for m in PART.finditer(text, low, high)]
        # a short part that is no lower-case word may belong to the key beside it
        vague = lambda c, d: d - c <= 3 and not (text[c:d].isalpha() and text[c:d].islower())
        joined: list[list[int]] = []
        for a, b in _top_segments([_surplus(text[c:d], encoding, max_ratio) for c, d in parts]):
            reached = joined[-1][1] if joined else -1
            while a - 1 > reached and vague(*parts[a - 1]):
                a -= 1
            b = max(b, reached)
            while b + 1 < len(parts) and vague(*parts[b + 1]):
                b += 1
            if a <= reached:
                joined[-1][1] = b
            else:
                joined.append([a, b])
        for a, b in joined:
            first, last = low if a == 0 else parts[a][0], high if b == len(parts) - 1 else parts[b][1]
            while last < high and text[last] == "=":
                last += 1
            if last - first >= SHORTEST:
                out.append((first, last, KINDS[3]))
    return out


def random_spans(text: str, base: list[Span], encoding, max_ratio: float) -> list[Span]:
    """Random spans in what base spans and UUIDs leave of the runs."""
    out, taken = [], iter(base)
    near = next(taken, None)
    reach = -1  # largest end of the base spans seen
    for m in RUN.finditer(text):
        cuts = [u.span() for u in UUID.finditer(text, m.start(), m.end())]
        if reach > m.start():
            cuts.append((m.start(), reach))
        while near is not None and near[0] < m.end():
            cuts.append((near[0], near[1]))
            reach, near = max(reach, near[1]), next(taken, None)
        at = m.start()
        for a, b in sorted(cuts) + [(m.end(), m.end())]:
            if min(a, m.end()) - at >= SHORTEST:
                out += _random_in(text, at, min(a, m.end()), encoding, max_ratio)
            at = max(at, b)
    return out


def find_spans(text: str | None, encoding, max_ratio: float) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans by start, then kind as listed."""
    text = text or ""
    base = base_spans(text)
    extra = random_spans(text, base, encoding, max_ratio)
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))


SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType())]))


def _vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path and pattern:
        return path, pattern
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def scan_secrets(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None,
                 max_ratio: float = 2.0) -> DataFrame:
    """``doc_id, base, spans``: arrays of (kind, start, end) in code points, for
    every whole text of ``docs``.  One pass over the texts, no shuffle."""
    path, pattern = _vocabulary(vocabulary, pattern)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("base", SPAN), T.StructField("spans", SPAN)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        encoding = _encoding(path, pattern)
        for batch in bounded(batches, "text"):
            both = [find_spans(t, encoding, max_ratio) for t in batch.column("text").to_pylist()]
            columns = [pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in x[i]] for x in both], kind)
                       for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", vocabulary: str | None = None,
                   pattern: str | None = None, max_ratio: float = 2.0) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark`` (overlapping
    spans by one mark) and ``n_chars``, where there is one, counted anew.
    Texts without a secret, nulls included, are left as they are."""
    path, pattern = _vocabulary(vocabulary, pattern)
    names = docs.columns

    def scan(batches):
        encoding = _encoding(path, pattern)
        for batch in bounded(batches, "text"):
            texts, lengths = [], []
            for text in batch.column("text").to_pylist():
                spans = find_spans(text, encoding, max_ratio)[1]
                out, at = [], 0
                for start, end, _ in spans:
                    if start >= at:
                        out += [text[at:start], mark]
                    at = max(at, end)
                texts.append("".join(out) + text[at:] if spans else text)
                lengths.append(len(texts[-1]) if spans else None)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns[names.index("text")] = pa.array(texts, pa.string())
            if "n_chars" in names:
                old = batch.column("n_chars")
                columns[names.index("n_chars")] = pa.array(
                    [o if n is None else n for o, n in zip(old.to_pylist(), lengths)], old.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(scan, docs.schema)


def join_spans(spans: str):
    """A column of spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document with the counts and digests of its spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan_secrets(docs, **options).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(join_spans("base"), 256).alias("base_sha256"), join_spans("spans").alias("spans"))
