"""Allow and block rules on URLs, and a classifier of host and path for URLs that no rule fits.

The classifier is a logistic regression on hashed character n-grams. It learns from a small table of
labelled URLs. All of it is Spark's own: n-grams are array functions, hashing and fitting are those of
Spark's DataFrame-based machine learning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import lower_ascii

# Width of the hashed feature vector: also what the fit sends to the driver, whatever the input.
FEATURES = 1 << 12
NGRAMS = (3, 4)

# Labelled URLs the classifier is fitted on: at most this many distinct (host, path), by hash order.
LABELLED_URLS = 20_000

Rules = Sequence[tuple[str, str]]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null and for text without ``://``.

    The host ends before the first ``/``, ``?`` or ``#`` and is lower-cased (A-Z); the path ends before
    ``?`` or ``#``. Ports and user names stay part of the host. Nothing is decoded.
    """
    has_scheme = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.when(has_scheme, lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")
    path = F.when(has_scheme, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def rule_for(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does.

    A rule is a host and the start of a path. It fits its host and all subdomains.
    """
    by_length = sorted(rules, key=lambda rule: (-len(rule[0]), rule[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in reversed(by_length):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def with_ngrams(urls: DataFrame) -> DataFrame:
    """Adds ``ngrams``: those of ``^host`` and of ``path$``, so that hosts and paths do not mix."""

    def ngrams(text: Column, n: int) -> Column:
        last = F.length(text) - n + 1
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: F.substring(text, at, F.lit(n)))

    texts = (F.concat(F.lit("^"), "host", F.lit("/")), F.concat(F.lit(">"), "path", F.lit("$")))
    return urls.withColumn("ngrams", F.flatten(F.array(*(ngrams(text, n) for text in texts for n in NGRAMS))))


def features(urls: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="ngrams", outputCol="features").transform(
        with_ngrams(urls)
    )


def fit(labelled: DataFrame, max_urls: int = LABELLED_URLS) -> LogisticRegressionModel | None:
    """Fit on ``labelled`` (host, path, verdict); None if it does not hold both verdicts.

    Repeated URLs count once. Of more than ``max_urls`` different ones, those with the smallest hash
    of host and path are taken, so that reruns agree.
    """
    distinct = labelled.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    sample = distinct.orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_urls)
    sample = sample.withColumn("label", (F.col("verdict") == "block").cast("double")).cache()
    try:
        if sample.select("label").distinct().count() < 2:
            return None
        return LogisticRegression(regParam=1e-3, maxIter=50, standardization=False).fit(features(sample))
    finally:
        sample.unpersist()


def filter_urls(
    pages: DataFrame, rules: Rules, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every row of ``pages``.

    ``rules`` are pairs such as ``("example.org/de/", "block")``; the longest that fits decides. Other
    URLs are judged by the classifier: ``score`` is its probability of a block, and from 0.5 on the
    verdict is block. It learns from ``labelled`` (host, path, verdict), by default the URLs that rules
    decide. Without labelled URLs of both verdicts it knows nothing, and the verdict is allow (score 0).

    Null URLs, and texts that are none, have an empty host and path; they are judged like others.
    Repeated rows and ids stay as they are; an empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    urls = urls.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    ruled = urls.select("page_id", "host", "path", rule.alias("rule"), says.alias("verdict"))
    known = ruled.where("rule IS NOT NULL").select("host", "path", "verdict") if labelled is None else labelled
    model = fit(known)
    if model is None:
        scored = ruled.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(features(ruled)).withColumn("score", vector_to_array("probability")[1])
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), "score")
