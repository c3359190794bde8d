"""Verdicts on URLs from given host rules and mined token rules. DataFrame functions only.

Method: association-rule filtering. The URLs of labelled pages become sets of tokens; Spark's FP-growth
mines combinations that go with a bad label; rules below a support or a confidence are pruned. A URL is
matched by an inverted index: every rule is filed under its rarest token, joined to the URLs that hold that
token, and checked for its other tokens. Given host rules come first; the longest that fits decides.

Rows: one per input row. A null URL or one without `://` has empty host and path, no tokens, and is
allowed. Tables without labels or without bad ones give no mined rule. Repeated rows each get the verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"
MIN_SUPPORT = 0.002  # share of the labelled URLs
MIN_COUNT = 20  # and at least so many of them
MIN_CONFIDENCE = 0.8
_PARTS = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels and domain ends, path segments with numbers folded, query parts."""
    host, path = host_of(url), path_of(url)
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*[^?#]*\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    end = F.when(F.size(labels) > 1, F.concat(F.lit("end="), F.slice(labels, -2, 2).getItem(0), F.lit("."), F.element_at(labels, -1)))
    prefixed = lambda name, parts: F.transform(
        F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(name), F.regexp_replace(x, r"[0-9]+", "#"))
    )
    found = F.concat(
        prefixed("host=", F.flatten(F.transform(labels, lambda x: F.array_append(F.split(x, "-"), x)))),
        F.filter(F.array(end), lambda x: x.isNotNull()),
        prefixed("path=", F.split(path, "/")),
        prefixed("query=", F.split(rest, "&")),
    )
    return F.when(url.contains("://"), F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, tokens, confidence, support of rules "tokens => bad" over `labelled` (url, bad boolean)."""
    baskets = materialise(
        labelled.where("url IS NOT NULL AND bad IS NOT NULL")
        .select(tokens_of(F.col("url")).alias("_t"), "bad")
        .where(F.size("_t") > 0)
        .select(F.when(F.col("bad"), F.array_append("_t", F.lit(BAD))).otherwise(F.col("_t")).alias("items")),
        "baskets",
    )
    n = baskets.count()
    if not n:
        empty = "rule_id long, tokens array<string>, confidence double, support double"
        return labelled.sparkSession.createDataFrame([], empty)
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)), minConfidence=min_confidence
    ).fit(baskets)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    tokens = F.array_sort("antecedent")
    return materialise(
        rules.select(F.xxhash64(tokens).alias("rule_id"), tokens.alias("tokens"), "confidence", "support"), "rules"
    )


def index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """token, rule_id, tokens: every rule once, under its token that the fewest of `urls` (_tokens) hold."""
    asked = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = urls.select(F.explode("_tokens").alias("token")).join(asked, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    listed = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
    rarest = listed.join(seen, "token").groupBy("rule_id").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    return rarest.join(rules.select("rule_id", "tokens", "confidence"), "rule_id")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, rule_id, confidence: the most confident rule that each distinct matching URL of `urls` meets."""
    tokens = urls.select("url").where("url IS NOT NULL").distinct().withColumn("_tokens", tokens_of(F.col("url")))
    posted = index(rules, tokens)
    held = tokens.select("url", "_tokens", F.explode("_tokens").alias("token"))
    hits = held.join(posted, "token").where(F.size(F.array_except("tokens", "_tokens")) == 0)
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", "rule_id")).alias("_best"))
    return best.select("url", F.col("_best.rule_id").alias("rule_id"), F.col("_best.confidence").alias("confidence"))


def host_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value: int) -> Column:
    """Of the longest (verdict, host, path) rule that fits: its text (`value` 0) or verdict (1), else null."""
    out = F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit((h + p, verdict)[value])).otherwise(out)
    return out


def judge(pages: DataFrame, host_rules: Sequence[tuple[str, str, str]], mined: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """`keep` columns, host, path, rule, verdict and the mined rule_id per row of `pages` (url)."""
    by_url = matched(pages, mined).select(F.col("url").alias("_url"), "rule_id")
    # Null URLs match nothing; a key of their own per row keeps them out of one task.
    spread = F.concat(F.lit("null "), F.xxhash64(*keep).cast("string"))
    rows = pages.select(*keep, "url").withColumn("_key", F.coalesce("url", spread))
    rows = rows.join(by_url, F.col("_key") == F.col("_url"), "left")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    given = host_rule(host, path, host_rules, 1)
    other = F.when(F.col("rule_id").isNotNull(), "block").otherwise("allow")
    return rows.select(
        *keep, host.alias("host"), path.alias("path"), host_rule(host, path, host_rules, 0).alias("rule"),
        F.coalesce(given, other).alias("verdict"), "rule_id",
    )
