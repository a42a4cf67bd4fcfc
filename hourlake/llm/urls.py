"""URL filters: host and path rules, and a logistic regression on hashed
character trigrams of host and path for the rest.

Only DataFrame functions and Spark's own learner are used.  Hosts and paths are
cut by plain string functions in linear time.  The learner sees a small table
of labelled URLs of at most ``max_labelled`` rows: by default distinct URLs on
which a rule decides, those with the smallest hash.  Without a table of its own
the model's verdict extrapolates the rules: to a host that no rule names it says
what rules say of URLs that look alike.  Every URL is scored; the model is one
vector of ``buckets`` numbers.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by the model on no trigram; repeated rows are judged
alike; null ids are kept; without labelled URLs of both verdicts there is no
model and the one verdict there is (or ``allow``) holds; an empty table gives
an empty result; other input columns are ignored by ``judge_urls``.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import LOWER, UPPER
from hourlake.session import cut_lineage

# Fixed values of the contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

BUCKETS = 4096
MAX_LABELLED = 4000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.element_at(F.split(rest, "[?#]", 2), 1)  # neither reaches beyond ? or #
    host = F.translate(F.substring_index(rest, "/", 1), UPPER, LOWER)
    path = F.substring(rest, F.length(F.substring_index(rest, "/", 1)) + 1, F.length(rest))
    return host, path


def split_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, _u_rule_verdict`` of every page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for decision, on, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == on) | F.endswith("host", F.lit("." + on))) & F.startswith("path", F.lit(prefix))
        rule, verdict = (F.when(fits, F.lit(x)).otherwise(y) for x, y in ((on + prefix, rule), (decision, verdict)))
    return rows.select("*", rule.alias("rule"), verdict.alias("_u_rule_verdict"))


def trigrams(rows: DataFrame) -> DataFrame:
    """Add ``_u_grams``: trigrams of the host, and of the path with its digits
    made alike, each marked with where it is from."""
    def grams(part: str, mark: str) -> Column:
        chars = F.col(part)
        n = F.size(chars) - 2
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(
            F.lit(mark), F.get(chars, i - 1), F.get(chars, i), F.get(chars, i + 1)))).otherwise(
            F.array().cast("array<string>"))

    rows = rows.withColumn("_u_host", F.split(F.concat(F.lit("^"), "host", F.lit("$")), ""))
    rows = rows.withColumn("_u_path", F.split(F.regexp_replace("path", "[0-9]", "0"), ""))
    return rows.withColumn("_u_grams", F.concat(grams("_u_host", "h"), grams("_u_path", "p"))).drop(
        "_u_host", "_u_path")


def labelled_urls(rows: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``host, path, verdict`` of at most ``max_labelled`` distinct URLs on
    which a rule decides."""
    known = rows.where("rule IS NOT NULL").select("host", "path", F.col("_u_rule_verdict").alias("verdict"))
    return known.distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_labelled)


def train(labelled: DataFrame, buckets: int = BUCKETS):
    """A fitted model, or the one verdict there is."""
    counts = {r["verdict"]: r["count"] for r in labelled.groupBy("verdict").count().collect()}  # two rows at most
    if len(counts) < 2:
        return next(iter(counts), "allow")
    rows = trigrams(labelled).withColumn("label", (F.col("verdict") == "block").cast("double"))
    rows = HashingTF(inputCol="_u_grams", outputCol="features", numFeatures=buckets, binary=True).transform(rows)
    return LogisticRegression(maxIter=50, regParam=0.01).fit(rows.select("label", "features"))


def judge_urls(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, buckets: int = BUCKETS,
               max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page; ``score``
    is the model's probability of ``block``, null without a model."""
    rows = split_urls(pages, rules)
    # written once: the learner passes over it many times
    model = train(cut_lineage(labelled if labelled is not None else labelled_urls(rows, max_labelled)), buckets)
    if isinstance(model, str):
        scored = rows.withColumn("_u_verdict", F.lit(model)).withColumn("score", F.lit(None).cast("double"))
    else:
        hashed = HashingTF(inputCol="_u_grams", outputCol="features", numFeatures=buckets, binary=True)
        scored = model.transform(hashed.transform(trigrams(rows)))
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
        scored = scored.withColumn("_u_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("_u_rule_verdict", "_u_verdict").alias("verdict"), "score")
