"""Personal data: fixed patterns, and information-theoretic sanitisation of
the terms that reveal what the patterns protect.

The matches of the patterns are protected entities.  A term (a word of letters,
of any length) in a text with an entity reveals it as far as seeing the term
makes the entity less surprising: with frequencies over the different whole texts
of the corpus (a copy is no evidence of its own), the entity has ``log2(N / n_entity)`` bits of information, and
the term gives away ``log2(N * n_both / (n_entity * n_term))`` of them.  A term
that gives away ``disclosure`` of the bits or more, in ``support`` texts or
more, is reported as ``term`` wherever it stands in a text with that entity,
outside the matches.

Terms are counted over all words of all texts, per task first.  As ``n_both`` is
at most ``n_entity`` and ``n_term``, only terms in ``support`` to
``N * (n_entity / N) ** disclosure`` texts can reveal an entity, so only those
are paired with it; no pair that counts is lost.  Entities that stand in the same
texts are one to every term, so a text with very many addresses of its own is
paired once.  Pairs are summed by entity and term, so a frequent entity is
spread over its terms.  Texts without an entity
that occurs in ``support`` texts are never shuffled.  Nothing is gathered in one
place.

Defined cases: a null text counts as empty; empty texts have no span; repeated
rows are one text and get the same spans; a term that gives away just
``disclosure`` of the bits counts; a very long text is held whole by one task; null and repeated ids need
no care, rows are told apart by a number of their own; an empty table gives an
empty result; other input columns are ignored by ``find_personal`` and kept by
``sanitise``, whose working columns start with ``_p_``.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import bounded, maybe_in, written
from hourlake.session import cut_lineage

# The patterns of the contract.
KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# From a digit within a run the rest is the same as from its first digit, so
# only first digits are tried: linear on long runs.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]")

TERM = re.compile(r"[^\W\d_]+")
DISCLOSURE, SUPPORT = 0.9, 2
#: Distinct terms a task holds before it passes its counts on.
HELD = 200_000

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Local part and domain around each @; the scan back stops at the last
    match, so every character is looked at once."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [d * 2 - 9 * (d > 4) for d in values[1::2]]) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's matches by kind as listed, then start."""
    found = [("email", a, b) for a, b in emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if len(m[0]) <= 37:  # 19 digits and what may part them
            digits = "".join(DIGITS.findall(m[0]))
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(DIGITS.findall(m[0])) <= 15]
    return found


def terms_outside(text: str, spans: list[Span]) -> list[tuple[str, int, int]]:
    """The terms of a text that touch none of its base spans, lower-cased."""
    out, order, at, reach = [], sorted(spans), 0, -1
    for m in TERM.finditer(text):
        while at < len(order) and order[at][0] < m.end():
            reach, at = max(reach, order[at][1]), at + 1
        if reach <= m.start():
            out.append((m[0].lower(), *m.span()))
    return out


SPAN = "struct<kind:string,start:int,end:int>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(docs: DataFrame) -> DataFrame:
    """``_p_row, doc_id, _p_hash, _p_copy, _p_base, _p_entities, _p_text`` of
    every row, the text where it has an entity; written, so the rows keep their
    numbers.  ``_p_copy`` names the text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in bounded(batches, "text"):
            base, entities, texts = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                entities.append(sorted({f"{kind}:{text[a:b]}" for kind, a, b in spans}))
                texts.append(text if spans else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_p_hash"), batch.column("_p_copy"), pa.array(base, _SPANS),
                 pa.array(entities, pa.list_(pa.string())), pa.array(texts, pa.string())],
                ["doc_id", "_p_hash", "_p_copy", "_p_base", "_p_entities", "_p_text"])

    named = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_p_hash"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_p_copy"), "text")
    scanned = named.mapInArrow(run, f"doc_id {id_type}, _p_hash long, _p_copy long, _p_base array<{SPAN}>, _p_entities array<string>, _p_text string")
    return written(scanned.withColumn("_p_row", F.monotonically_increasing_id()))


def term_counts(docs: DataFrame) -> DataFrame:
    """``term, n``: in how many rows of ``docs`` (``text``, ``k``) each term stands,
    each row counting ``k`` times.  Summed in each task first, over at most
    ``HELD`` distinct terms at a time."""
    def run(batches):
        held: Counter[str] = Counter()

        def out():
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["term", "n"])
            held.clear()
            return rows

        for batch in bounded(batches, "text"):
            for text, k in zip(batch.column("text").to_pylist(), batch.column("k").to_pylist()):
                terms = {w.lower() for w in set(TERM.findall(text or ""))}
                held.update(terms if k == 1 else dict.fromkeys(terms, k))
                if len(held) >= HELD:
                    yield out()
        yield out()

    return docs.select("text", "k").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def distinct_term_counts(docs: DataFrame, copied: DataFrame) -> DataFrame:
    """``term, n``: in how many different texts each term stands: all rows are
    counted, then of each text that occurs ``k`` times (``copied``: ``_p_hash`` of
    one of its rows, ``k``) the rest is taken off.  Only those texts move."""
    every = term_counts(docs.select("text", F.lit(1).alias("k")))
    named = docs.select(F.xxhash64("doc_id", "text").alias("_p_hash"), "text")
    one = maybe_in(named, copied, "_p_hash").join(copied, "_p_hash").dropDuplicates(["_p_hash"])
    off = term_counts(one.select("text", (1 - F.col("k")).alias("k")))
    return every.unionByName(off).groupBy("term").agg(F.sum("n").alias("n"))


def _texts(scanned: DataFrame, rows: DataFrame) -> DataFrame:
    """``_p_row, _p_text, _p_base`` of the texts that may be among ``rows``."""
    slot = F.xxhash64("_p_row").alias("_p_slot")
    texts = scanned.where("_p_text is not null").select("_p_row", "_p_text", "_p_base", slot)
    return maybe_in(texts, rows.select(slot), "_p_slot").drop("_p_slot")


def _text_terms(texts: DataFrame) -> DataFrame:
    """``_p_row, term``: the distinct terms of each text."""
    def run(batches):
        for batch in bounded(batches, "_p_text", 1 << 20):
            found = [sorted({w.lower() for w in set(TERM.findall(t))}) for t in batch.column("_p_text").to_pylist()]
            rows = batch.column("_p_row").to_numpy().repeat([len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array([t for x in found for t in x], pa.string())], ["_p_row", "term"])

    return texts.select("_p_row", "_p_text").mapInArrow(run, "_p_row long, term string")


def revealing_terms(scanned: DataFrame, docs: DataFrame, disclosure: float = DISCLOSURE,
                    support: int = SUPPORT) -> DataFrame:
    """``_p_row, term``: the terms that give an entity of their text away."""
    texts = cut_lineage(scanned.groupBy("_p_copy").agg(F.min("_p_row").alias("_p_row"), F.min("_p_hash").alias("_p_hash"), F.count("*").alias("k")))
    distinct = texts.select("_p_row")  # a text is evidence once, however often it is copied
    total = float(distinct.count())
    held = scanned.join(distinct, "_p_row", "left_semi").select("_p_row", F.explode("_p_entities").alias("entity"))
    # Entities that stand in the same texts are one to every term: they are named
    # by their texts, so a text with very many addresses that occur nowhere else
    # has one entity.
    slot = F.xxhash64("_p_row")
    of = held.groupBy("entity").agg(F.count("*").alias("n_entity"), F.sum(_spread(slot)).alias("_p_a"),
                                    F.bit_xor(F.xxhash64(F.lit("texts"), "_p_row")).alias("_p_b"))
    of = of.where((F.col("n_entity") >= support) & (F.col("n_entity") < total))
    of = cut_lineage(of.withColumn("group", F.xxhash64("n_entity", "_p_a", "_p_b")).select("entity", "group", "n_entity"))
    every = scanned.select("_p_row", F.explode("_p_entities").alias("entity")).join(of, "entity")
    every = cut_lineage(every.select("_p_row", "group", "n_entity").distinct())
    groups = cut_lineage(every.join(distinct, "_p_row", "left_semi"))
    # how many texts a term can be in that reveals an entity; a little more for rounding
    most = lambda n: F.lit(total) * F.pow(n / F.lit(total), F.lit(float(disclosure))) * (1 + 1e-9)
    bound = groups.agg(F.max(most(F.col("n_entity")))).first()[0] or 0.0
    counts = distinct_term_counts(docs, texts.where("k > 1").select("_p_hash", "k"))
    counts = cut_lineage(counts.where((F.col("n") >= support) & (F.col("n") <= bound)))
    words = _text_terms(_texts(scanned, every)).withColumn("_p_slot", F.xxhash64("term"))
    words = maybe_in(words, counts.select(F.xxhash64("term").alias("_p_slot")), "_p_slot").drop("_p_slot")
    words = written(words.join(counts, "term"))
    pairs = words.join(groups, "_p_row").where(F.col("n") <= most(F.col("n_entity")))
    rows = pairs.groupBy("group", "term").agg(
        F.count("*").alias("n_both"), F.max("n_entity").alias("n_entity"), F.max("n").alias("n")).where(F.col("n_both") >= support)
    bits = F.log2(F.lit(total) / F.col("n_entity"))
    given = F.log2(F.lit(total) * F.col("n_both") / (F.col("n_entity") * F.col("n")))
    shown = cut_lineage(rows.where((bits > 0) & (given >= F.lit(float(disclosure)) * bits)).select("group", "term"))
    words = words.join(shown.select("term").distinct(), "term", "left_semi")
    return words.join(every, "_p_row").join(shown, ["group", "term"]).select("_p_row", "term").distinct()


def _spread(hashed):
    """A summand for an order-free name of a set: sums stay within decimals."""
    return hashed.cast("decimal(20,0)")


def _found(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, _p_hash, base, terms`` of every row."""
    scanned = _scan(docs)
    shown = cut_lineage(revealing_terms(scanned, docs, **options).groupBy("_p_row").agg(F.collect_set("term").alias("_p_shown")))

    def run(batches):
        for batch in bounded(batches, "_p_text"):
            spans = []
            for text, base, shown in zip(*(batch.column(c).to_pylist() for c in ("_p_text", "_p_base", "_p_shown"))):
                shown = set(shown)
                spans.append([{"kind": "term", "start": a, "end": b} for t, a, b in
                              terms_outside(text, [(s["start"], s["end"]) for s in base]) if t in shown])
            yield pa.RecordBatch.from_arrays([batch.column("_p_row"), pa.array(spans, _SPANS)], ["_p_row", "_p_terms"])

    terms = _texts(scanned, shown).join(shown, "_p_row").mapInArrow(run, f"_p_row long, _p_terms array<{SPAN}>")
    out = scanned.select("_p_row", "doc_id", "_p_hash", "_p_base").join(terms, "_p_row", "left")
    return out.select("doc_id", "_p_hash", F.col("_p_base").alias("base"),
                      F.coalesce("_p_terms", F.array().cast(f"array<{SPAN}>")).alias("terms"))


def find_personal(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, base, terms`` of every row: arrays of (kind, start, end) in
    code points, by kind as listed and start, and by start."""
    return _found(docs, **options).drop("_p_hash")


def join_spans(spans):
    """A column of spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document with the counts and digests of its spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_personal(docs, **options).select(
        "doc_id", *(count(k) for k in KINDS[:4]), F.sha2(join_spans("base"), 256).alias("base_sha256"),
        join_spans(F.concat("base", "terms")).alias("spans"), F.size("base").cast("long").alias("n_base"),
        F.size("terms").cast("long").alias("n_term"), (F.size("base") + F.size("terms")).cast("long").alias("n_total"))


#: What a revealing term is generalised to, where something broader is known.
BROADER = {**dict.fromkeys("january february march april may june july august september october november december".split(), "MONTH"),
           **dict.fromkeys("monday tuesday wednesday thursday friday saturday sunday".split(), "DAY")}


def sanitise(docs: DataFrame, broader: dict[str, str] = BROADER, **options) -> DataFrame:
    """``docs`` with entities generalised to their kind (``[EMAIL]``), and
    revealing terms to what ``broader`` says of them in small letters
    (``[MONTH]``), or else removed (``[...]``); rows are matched by id and text."""
    keyed = docs.withColumn("_p_hash", F.xxhash64("doc_id", "text"))
    spans = _found(docs, **options).dropDuplicates(["doc_id", "_p_hash"])
    spans = spans.select(F.col("doc_id").alias("_p_id"), F.col("_p_hash").alias("_p_h"), F.concat("base", "terms").alias("_p_spans"))
    rows = keyed.join(spans, (F.col("_p_hash") == F.col("_p_h")) & F.col("doc_id").eqNullSafe(F.col("_p_id")), "left")
    names = docs.columns

    def run(batches):
        for batch in bounded(batches, "text"):
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("_p_spans").to_pylist()):
                out, at = [], 0
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        term = broader.get(text[s["start"]:s["end"]].lower(), "...")
                        out += [text[at:s["start"]], f"[{term if s['kind'] == 'term' else s['kind'].upper()}]"]
                    at = max(at, s["end"])
                texts.append("".join(out) + text[at:] if spans else text)
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select(*names, "_p_spans").mapInArrow(run, docs.schema)
