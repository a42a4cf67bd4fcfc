"""Quality rules: base rules on words and lines, then a hashed n-gram
log-likelihood ratio between a trusted target and the raw corpus.

With ``grams=WORDS``, as the registered queries and the pipeline have it, the
grams are all words and all pairs of neighbouring words.  ``grams=ENDINGS``, the
default of these functions, takes only the character trigram that ends each word
(a shorter word is its own gram): a cheaper measure, not the n-grams.  Each gram
falls into one of ``buckets`` buckets by hash.  Two multinomials over the
buckets, one from the trusted documents and one from all documents, give each
bucket a log ratio; a document scores the mean ratio of its grams and is kept
from ``threshold`` on.  Few trusted words say little about pairs they lack, so
the ratios of ``WORDS`` are weighted by the share of the trusted grams beyond
one pseudo-count a bucket: 1 for large targets, 0 below ``buckets`` grams.  The score has no random part, so
every document's verdict is deterministic.

Only DataFrame functions are used.  The counts are summed map-side to at most
``buckets`` rows a task, the model is one array of ``buckets`` doubles (256 KB),
and the trusted documents are at most ``max_trusted`` ids, so both broadcasts
have a fixed bound; the corpus counts cover every word of every document.

Defined cases: a null text has no words and fails the base rules, as does an
empty one; a repeated row is judged like its copy; a score equal to the
threshold is kept; a very long text is one row, whose words its task holds; without trusted documents
(or, by ``WORDS``, with fewer trusted grams than ``buckets``) or on an empty table, every ratio is 0 and the base rules alone decide; other
input columns are ignored by ``quality_report`` and kept by ``keep_quality``,
whose working columns start with ``_q_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import WHITESPACE
from hourlake.session import cut_lineage

# Fixed values of the contract.
SYMBOLS = "[#*$%&|<>]"
FULL = "[^\\x20\\x09-\\x0D]"  # a line with a word
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20

#: Pseudo-count of every bucket in both multinomials.
SMOOTHING = 1.0
#: The grams that are counted: every word and every pair of neighbouring words,
#: or only the trigram that ends each word.
WORDS, ENDINGS = "words", "endings"
#: Word pairs are many more than endings.
BUCKETS = {WORDS: 32_768, ENDINGS: 8192}
#: Mean log ratio from which a document is kept; trusted text lies around 0,
#: text of another make far below.  Pairs that are rare everywhere pull the mean
#: of ``WORDS`` towards 0, so its scale is another one.
THRESHOLDS = {WORDS: -0.12, ENDINGS: -1.5}
MAX_TRUSTED = 20_000


def words_of(text: Column) -> Column:
    """Words of a text; null gives none.  White space becomes blanks first:
    a split at one plain character is far cheaper than one at a pattern."""
    text = F.coalesce(text, F.lit(""))
    for space in WHITESPACE.replace(" ", ""):
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")


def bucket_of(gram: Column, buckets: int) -> Column:
    """Bucket of a gram, given by its hash."""
    return F.pmod(gram, F.lit(buckets)).cast("int")


def _ending(word: Column) -> Column:
    return F.xxhash64(F.substring(word, -3, 3))


def _grams_at(word: Column, following: Column, grams: str) -> Column:
    """Hashes of the grams that start at a word; ``following`` is the word
    behind it, null at the end.  Pairs are hashed as ``_joined`` does."""
    if grams == ENDINGS:
        return F.array(_ending(word))
    pair = F.when(following.isNotNull(), F.xxhash64(F.xxhash64(word), F.xxhash64(following)))
    return F.array(F.xxhash64(word), pair)


def train_ratios(docs: DataFrame, trusted: DataFrame, buckets: int | None = None, max_trusted: int = MAX_TRUSTED,
                 smoothing: float = SMOOTHING, grams: str = ENDINGS) -> DataFrame:
    """One row ``_q_ratios``: log(P(bucket | trusted) / P(bucket | all)) by
    bucket.  ``trusted`` holds ``doc_id``s; of more than ``max_trusted`` those
    with the smallest hash are taken.  The raw counts take all documents."""
    buckets = buckets or BUCKETS[grams]
    ids = (trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted).withColumn("_q_target", F.lit(1)))
    words = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left")
             .select("_q_target", words_of(F.col("text")).alias("_q_words")))
    words = words.select("_q_target", "_q_words", F.posexplode("_q_words").alias("_q_at", "_q_word"))
    at = _grams_at(F.col("_q_word"), F.get("_q_words", F.col("_q_at") + 1), grams)
    counts = words.select("_q_target", F.explode(at).alias("_q_gram")).where("_q_gram IS NOT NULL")
    counts = counts.select("_q_target", bucket_of(F.col("_q_gram"), buckets).alias("_q_bucket"))
    counts = counts.groupBy("_q_bucket").agg(F.count("*").alias("raw"), F.count("_q_target").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_q_bucket"))
    table = every.join(counts, "_q_bucket", "left").select(
        "_q_bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    # ``buckets`` rows at most, however large the corpus
    rows = F.sort_array(F.collect_list(F.struct("_q_bucket", "raw", "target")))
    one = table.agg(rows.alias("rows"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    share = lambda n, total: (n + smoothing) / (total + smoothing * buckets)
    ratio = lambda r: F.log(share(r["target"], F.col("n_target")) / share(r["raw"], F.col("n_raw")))
    weight = F.lit(1.0) if grams == ENDINGS else F.greatest(F.lit(0.0), 1 - smoothing * buckets / F.col("n_target"))
    return one.select(F.transform("rows", lambda r: F.when(F.col("n_target") > 0, weight * ratio(r)).otherwise(0.0))
                      .alias("_q_ratios"))


def _joined(left: Column, right: Column, ahead: int) -> Column:
    """Hashes of left[i] and right[i + ahead], while there are both."""
    tail = F.slice(right, ahead + 1, F.greatest(F.size(right) - ahead, F.lit(0)))
    return F.slice(F.zip_with(left, tail, lambda a, b: F.xxhash64(a, b)), 1,
                   F.greatest(F.size(right) - ahead, F.lit(0)))


def _repeated_words(docs: DataFrame) -> DataFrame:
    """Add ``_q_repeat``, the words in windows of five that occur twice or more
    in the text, and ``_q_hashes`` and ``_q_pairs``, the hashes of its words and
    word pairs.  Windows are compared by 64-bit hash, built from pairs and
    fours; a text without a repeated four, nearly every one, ends there."""
    seen, fours = F.col("_q_seen"), F.col("_q_fours")
    docs = docs.withColumn("_q_hashes", F.transform("_q_words", lambda w: F.xxhash64(w)))
    hashes, pairs = F.col("_q_hashes"), F.col("_q_pairs")
    docs = docs.withColumn("_q_pairs", _joined(hashes, hashes, 1))
    docs = docs.withColumn("_q_fours", _joined(pairs, pairs, 2))
    windows = _joined(fours, hashes, WINDOW - 1)
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_q_seen", F.when(F.size(F.array_distinct(fours)) < F.size(fours), ordered))
    same = lambda e, i: ((i > 0) & F.coalesce(F.get(seen, i - 1)["h"] == e["h"], F.lit(False))) | F.coalesce(
        F.get(seen, i + 1)["h"] == e["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter(seen, same), lambda e: e["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    covered = F.aggregate(starts, start, lambda a, p: F.struct(
        p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")), lambda a: a["total"])
    return docs.withColumn("_q_repeat", F.coalesce(covered, F.lit(0)).cast("long")).drop("_q_fours", "_q_seen")


def judge(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, **options) -> DataFrame:
    """``docs`` with the base measures, ``_q_score`` and ``_q_kept``."""
    grams = options.get("grams", ENDINGS)
    buckets = options.get("buckets") or BUCKETS[grams]
    threshold = THRESHOLDS[grams] if threshold is None else threshold
    model = train_ratios(docs, trusted, **options).withColumn("_q_one", F.lit(1))
    text = F.coalesce("text", F.lit(""))
    full_lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(FULL)))
    out = docs.select(
        *docs.columns, words_of(F.col("text")).alias("_q_words"), full_lines.alias("_q_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("_q_symbols"))
    out = out.withColumn("_q_dup", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))
    out = out.withColumn("_q_chars", F.length(F.array_join("_q_words", "")).cast("long"))
    out = _repeated_words(out.drop("_q_lines"))
    out = out.withColumn("_q_n", F.size("_q_words").cast("long"))
    out = out.withColumn("_q_failed", (F.col("_q_n") < MIN_WORDS)
                         | (100 * F.col("_q_repeat") > MAX_REPEAT_PERCENT * F.col("_q_n")))
    # an equality join with the model's one row
    out = out.withColumn("_q_one", F.lit(1)).join(F.broadcast(model), "_q_one", "left").drop("_q_one")
    each = F.transform("_q_words", _ending) if grams == ENDINGS else F.concat("_q_hashes", "_q_pairs")
    total = F.aggregate(each, F.lit(0.0), lambda a, g: a + F.col("_q_ratios")[bucket_of(g, buckets)])
    n = F.col("_q_n") if grams == ENDINGS else F.greatest(2 * F.col("_q_n") - 1, F.lit(0))
    out = out.withColumn("_q_score", total / F.greatest(n, F.lit(1))).drop("_q_words", "_q_hashes", "_q_pairs", "_q_ratios")
    return out.withColumn("_q_kept", ~F.col("_q_failed") & (F.col("_q_score") >= threshold))


def quality_report(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """One row per document with the base measures and both verdicts."""
    return judge(docs.select("doc_id", "text"), trusted, **options).select(
        "doc_id", F.col("_q_n").alias("n_words"), F.col("_q_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), F.col("_q_dup").alias("n_dup_lines"),
        F.col("_q_repeat").alias("n_repeat_words"), F.col("_q_failed").alias("base_failed"),
        F.col("_q_kept").alias("kept"), F.col("_q_score").alias("score"))


def keep_quality(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Verdicts are written first: a filter right above the measures would have
    the optimiser repeat their expressions.  Rows meet them by id and text."""
    key = F.xxhash64("doc_id", "text").alias("_q_key")
    judged = judge(docs.select("doc_id", "text", key), trusted, **options).drop("text")
    kept = cut_lineage(judged).where("_q_kept").select("_q_key", F.col("doc_id").alias("_q_id")).distinct()
    rows = docs.withColumn("_q_key", key)
    met = (rows["_q_key"] == kept["_q_key"]) & rows["doc_id"].eqNullSafe(kept["_q_id"])
    return rows.join(kept, met, "left_semi").select(*docs.columns)
