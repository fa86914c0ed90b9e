"""URL filtering: host and path rules first, then a linear model on hashed character n-grams.

The model is a logistic regression over the character n-grams of host and path, hashed to a fixed
number of features and trained from a small labelled URL table.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from salesflow.session import stage

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    """``model`` is None where the labelled table held fewer than two classes; then
    ``constant`` (1.0: allow) is the answer."""

    model: LogisticRegressionModel | None
    features: int
    n: int
    constant: float = 1.0


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty for null or without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as the host is."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (``rule``, ``verdict``) of the longest rule that fits, null if none does. A rule fits its
    host and all subdomains where the path starts with its own. Of equally long rules the one that
    comes first stands; of equal texts too."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text), reverse=True)[::-1]:
        on_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = on_host & F.startswith(path, F.lit(rule.path))
        found = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def _vectors(df: DataFrame, features: int, n: int) -> DataFrame:
    """``df`` (``host``, ``path``) with ``features``: hashed counts of character n-grams, those of
    host and path told apart by a leading mark."""
    chars = df.withColumn("url_chars", F.concat(
        F.array(F.lit("h:")), F.split("host", ""), F.array(F.lit("p:")), F.split("path", "")))
    grams = NGram(n=n, inputCol="url_chars", outputCol="url_grams").transform(chars)
    hashed = HashingTF(numFeatures=features, inputCol="url_grams", outputCol="features")
    return hashed.transform(grams).drop("url_chars", "url_grams")


def train_url_model(labelled: DataFrame, features: int = 1 << 14, n: int = 3,
                    max_rows: int = 16_000, regularisation: float = 1e-3) -> UrlModel:
    """Fit on a table (``url``, ``label`` 1.0 allow or 0.0 block).

    At most ``max_rows`` distinct rows are used, half of them from each class, chosen by a hash
    of the url: the model is fitted in memory, so its table is bounded by this parameter. Null
    labels are left out. With fewer than two classes the model is the one class, or allow.
    """
    rows = (labelled.where("label IS NOT NULL")
            .select(F.coalesce("url", F.lit("")).alias("url"), F.col("label").cast("double").alias("label"))
            .distinct())
    order = [F.xxhash64("url"), F.col("url")]
    half = [rows.where(F.col("label") == label).orderBy(*order).limit(max_rows // 2) for label in (0.0, 1.0)]
    sample = stage(half[0].union(half[1]).coalesce(1), "url-sample")
    classes = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(classes) < 2:
        return UrlModel(None, features, n, classes[0] if classes else 1.0)
    parts = sample.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label")
    fit = LogisticRegression(regParam=regularisation, maxIter=50, featuresCol="features",
                             labelCol="label").fit(_vectors(parts, features, n))
    return UrlModel(fit, features, n)


def score_urls(df: DataFrame, model: UrlModel) -> DataFrame:
    """``df`` (with ``host`` and ``path``) and ``allow_score``, the model's probability of allow."""
    if model.model is None:
        return df.withColumn("allow_score", F.lit(model.constant))
    vectors = _vectors(df, model.features, model.n)
    score = vector_to_array(F.col("probability"))
    return (model.model.transform(vectors).withColumn("allow_score", F.get(score, F.lit(1)))
            .drop("features", "rawPrediction", "probability", "prediction"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], model: UrlModel,
               threshold: float = 0.5) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``, ``rule``, ``allow_score`` and ``verdict`` of every
    page: the rule's verdict where one fits, else the model's. Repeated rows stay, null urls have
    an empty host and path and are left to the model; other columns are ignored."""
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
    found = parts.withColumn("found", best_rule(F.col("host"), F.col("path"), rules))
    guess = F.when(F.col("allow_score") >= threshold, ALLOW).otherwise(BLOCK)
    return score_urls(found, model).select(
        "page_id", "url", "host", "path", F.col("found.rule").alias("rule"), "allow_score",
        F.coalesce(F.col("found.verdict"), guess).alias("verdict"))


def labels_from_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A labelled table (``url``, ``label``) of the pages that a rule decides."""
    rule = best_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    found = pages.select("url", rule.alias("found")).where("found IS NOT NULL")
    return found.select("url", (F.col("found.verdict") == ALLOW).cast("double").alias("label"))
