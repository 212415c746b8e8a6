"""URL filters: given allow/block rules, and association rules that FP-growth mines from the URLs these rules label.

All of it is DataFrame functions and Spark ML's FP-growth; there is no Python code on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import ascii_lower, materialize

#: Thresholds of the mined rules: share of labelled URLs that hold antecedent and verdict, and share of the antecedent's
#: URLs that have the verdict.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8

Rule = tuple[str, str, str]  # verdict, host, path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path. Null, or without "://": both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels, path segments, extension, query keys, and whether there is a fragment."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)

    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    return F.array_sort(F.array_distinct(F.concat(
        tagged("s:", F.array(ascii_lower(F.regexp_extract(url, r"^([^/?#:]*)://", 1)))),
        tagged("h:", F.split(host, r"\.")),
        tagged("p:", F.split(path, "/")),
        tagged("e:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1))),
        tagged("q:", F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0])),
        tagged("f:", F.array(F.regexp_extract(url, r"(#)", 1))),
    )))


def given_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule (host and path together) that fits, as text and verdict; null if none does.

    A rule fits its host and all subdomains when the path starts with the rule's path. The rules are the caller's short
    list and become one conditional expression.
    """
    text = verdict = F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return text, verdict


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Association rules from labelled (tokens, verdict): antecedent, verdict, confidence, support.

    FP-growth runs over the tokens of each URL with its verdict as one more item. Rules with a verdict as consequent
    are kept, and of these the ones that no shorter rule for the same verdict makes redundant (a subset of the tokens
    with at least the confidence). No labelled rows: no rules.
    """
    labelled = materialize(labelled.select(F.array_append("tokens", F.concat(F.lit("="), "verdict")).alias("items"))
                           .where("items IS NOT NULL"))
    if labelled.isEmpty():
        return labelled.selectExpr("items AS antecedent", "'' AS verdict", "0D AS confidence", "0D AS support").limit(0)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(labelled)
    found = materialize(
        model.associationRules.where(F.col("consequent")[0].startswith("=") & ~F.exists("antecedent", lambda x: x.startswith("=")))
        .select(F.array_sort("antecedent").alias("antecedent"), F.expr("substring(consequent[0], 2)").alias("verdict"),
                "confidence", "support"))
    shorter = found.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("had"))
    # Nearly all redundant rules are so by a subset of one token less.
    less = found.where("size(antecedent) > 1").select("antecedent", "verdict", "confidence", F.explode(F.expr(
        "transform(sequence(0, size(antecedent) - 1), k -> filter(antecedent, (x, i) -> i <> k))")).alias("part"))
    found = found.join(less.join(shorter, ["part", "verdict"]).where("had >= confidence").select("antecedent", "verdict"),
                       ["antecedent", "verdict"], "left_anti")
    # For the few that are left all subsets are looked up (the mining itself went through as many); rules aren't paired.
    parts = found.select("antecedent", "verdict", "confidence", F.explode(F.expr(
        "filter(transform(sequence(1, cast(power(2, size(antecedent)) as int) - 2), m -> "
        "filter(antecedent, (x, i) -> (shiftright(m, i) & 1) = 1)), s -> size(s) > 0 AND size(s) < size(antecedent))")
    ).alias("part")).where("size(antecedent) > 1")
    redundant = parts.join(shorter, ["part", "verdict"]).where("had >= confidence").select("antecedent", "verdict")
    return found.join(redundant, ["antecedent", "verdict"], "left_anti")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Judges every page (page_id, url; other columns are ignored).

    Pages that a given rule fits have its verdict, and label the URLs from which further rules are mined. Any other
    page takes the verdict of its matching mined rule with the highest confidence (then support; "block" before
    "allow" if both are equal), or ``default`` if none matches. Mined rules are matched by an inverted index: a rule
    is listed under its rarest token only and its other tokens are then looked up in the page's.

    Returns one row per input row: page_id, host, path, rule, verdict, mined (whether a mined rule decided). A null URL
    or one without "://" has an empty host and path; repeated rows are judged each; a null page_id stays null.
    """
    url = F.col("url").cast("string")
    host, path = url_parts(url)
    text, verdict = given_rule(rules, F.col("host"), F.col("path"))
    judged = (pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", url.alias("url"), host.alias("host"),
                           path.alias("path"))
              .select("rid", "page_id", "host", "path", text.alias("rule"), verdict.alias("given"),
                      url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")))
    labelled = judged.where("given IS NOT NULL").select("tokens", F.col("given").alias("verdict"))
    mined = materialize(mine_rules(labelled, min_support, min_confidence))

    listed = mined.select("antecedent", F.explode("antecedent").alias("token"))
    uses = listed.groupBy("token").agg(F.count("*").alias("uses"))
    anchors = (listed.join(uses, "token").groupBy("antecedent")
               .agg(F.min(F.struct("uses", "token")).alias("least")).select("antecedent", "least.token"))
    index = materialize(mined.join(anchors, "antecedent").select("token", "antecedent", "confidence", "support",
                                                                 F.col("verdict").alias("learned")))
    # Every page has one row at least, so that one pass carries all pages to the end.
    keyed = judged.withColumn("token", F.explode(F.when(F.col("given").isNotNull(), F.array(F.lit("")))
                                                 .otherwise(F.array_append("tokens", F.lit("")))))
    matched = keyed.join(index, "token", "left")
    fits = F.col("learned").isNotNull() & (F.size(F.array_except("antecedent", "tokens")) == 0)
    best = (matched.groupBy("rid").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.first("rule").alias("rule"), F.first("given").alias("given"),
        F.max(F.when(fits, F.struct("confidence", "support", "learned"))).alias("best")))
    return best.select("page_id", "host", "path", "rule",
                       F.coalesce("given", "best.learned", F.lit(default)).alias("verdict"),
                       (F.col("given").isNull() & F.col("best").isNotNull()).alias("mined"))
