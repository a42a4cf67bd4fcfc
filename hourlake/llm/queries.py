"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.llm import bpe, codes, infill, jaccard, mixing, pii, quality, secrets, sharding, substring, tokenfile, topk, urls
from hourlake.llm.common import share_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id 20 divides."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded again."""
    return bpe.bpe_report(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdicts of every document, by the ratios of its words
    and word pairs; the trusted target is the labelled documents of quality 1."""
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    return quality.quality_report(_table(spark, sf_dir, "documents"), trusted, grams=quality.WORDS)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near copies of every document."""
    return jaccard.components(_table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents replicated to sources weighted by the square root of
    their size, in shuffled order."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page's URL."""
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard, shards brought together."""
    return sharding.place(_table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data, and of terms that reveal it, in every document."""
    return pii.personal_report(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start twice, and
    whether it shares a passage of over 50 words, of any bytes, with another."""
    rows = substring.dedup_substrings(_table(spark, sf_dir, "documents"), words=substring.WORDS)
    return rows.withColumns({"n_kept": F.col("n_bytes") - F.col("n_removed"), "has_repeats": F.col("n_removed") > 0})


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as token files and read back."""
    return tokenfile.token_report(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector by codebooks of four rounds."""
    return codes.code_report(_table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into prefix, middle and suffix and rebuilt."""
    return infill.infill_report(_table(spark, sf_dir, "documents"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_topk_search, op2_byte_bpe, op3_quality_rules, op4_secret_scans, op5_jaccard_join, op6_source_mixing, op7_url_filters, op8_sharding,
    op9_personal_data, op10_substring_dedup, op11_token_files, op12_vector_codes, op13_fill_in_middle)}

# Poisson terms cumulated in the same order as the operator's table.
OP6_SQL = """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
shares AS (SELECT source, n, pow(n::DOUBLE, 0.5) AS w FROM counts),
rates AS (SELECT source, w / (SELECT sum(w) FROM shares) * (SELECT sum(n) FROM shares)::DOUBLE / n AS rate
          FROM shares),
parts AS (SELECT source, greatest(1, ceil(rate / 32.0))::INT AS parts, rate / greatest(1, ceil(rate / 32.0)) AS mean
          FROM rates),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS term, exp(-mean) AS c FROM parts
  UNION ALL
  SELECT source, mean, k + 1, term * mean / (k + 1), c + term * mean / (k + 1) FROM cdf WHERE k < 128),
draws AS (
  SELECT d.*, p.j, ('0x' || substr(md5('17:' || d.key || ':' || p.j), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM (SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key FROM documents) d
  JOIN (SELECT source AS s, unnest(range(1, parts + 1)) AS j FROM parts) p ON d.source IS NOT DISTINCT FROM p.s),
copies AS (
  SELECT doc_id, text, lang, source, n_chars, key,
         sum((SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draws.source AND c < u)) AS copies
  FROM draws GROUP BY doc_id, text, lang, source, n_chars, key)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5('17s:' || key || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies::BIGINT + 1)) AS copy FROM copies)
"""

OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tokens,
             [('0x' || h[8 * i + 1:8 * i + 8])::BIGINT FOR i IN range(4)] AS h FROM d),
k AS (SELECT *, len(tokens) AS n, least(h[1] % (len(tokens) + 1), h[2] % (len(tokens) + 1)) AS a,
             greatest(h[1] % (len(tokens) + 1), h[2] % (len(tokens) + 1)) AS b FROM t),
p AS (SELECT doc_id, text, n, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
             array_to_string(tokens[b + 1:n], '') AS suffix,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
                  THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def _op12_sql(rounds: int = 4) -> str:
    """Lloyd's rounds, unrolled; parts are (row, position, components)."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT p.rid, p.pos, p.x, arg_min(b.entry, (b.d, b.entry)) AS entry, min(b.d) AS d
  FROM (SELECT p.rid, p.pos, b.entry,
               list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.c[i]) * (p.x[i] - b.c[i])))::BIGINT AS d
        FROM parts p JOIN b{r} b ON p.pos = b.pos) b JOIN parts p ON p.rid = b.rid AND p.pos = b.pos GROUP BY p.rid, p.pos, p.x)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT pos, entry, i, floor(sum(x[i]) / count(*)::DOUBLE)::BIGINT AS c
  FROM (SELECT pos, entry, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY pos, entry, i),
b{r + 1} AS MATERIALIZED (SELECT b.pos, b.entry, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN
  (SELECT pos, entry, list(c ORDER BY i) AS c FROM s{r} GROUP BY pos, entry) n ON n.pos = b.pos AND n.entry = b.entry)""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT rid, pos, e[(len(e) // 4) * pos + 1:(len(e) // 4) * (pos + 1)] AS x
  FROM kept, (SELECT unnest(range(4)) AS pos)),
b0 AS MATERIALIZED (SELECT pos, rid - 1 AS entry, x AS c FROM parts WHERE rid <= 256),{",".join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b{rounds}),
coded AS (SELECT k.vec_id, k.label, string_agg(printf('%02x', a.entry), '' ORDER BY a.pos) AS code, sum(a.d)::BIGINT AS error
  FROM a{rounds} a JOIN kept k ON k.rid = a.rid GROUP BY k.rid, k.vec_id, k.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


LLM_ORACLE = {"op1_topk_search": OP1_SQL, "op6_source_mixing": OP6_SQL, "op12_vector_codes": _op12_sql(), "op13_fill_in_middle": OP13_SQL}
