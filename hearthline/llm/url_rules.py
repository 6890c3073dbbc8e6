"""URL filters: fixed host and path rules, then association rules mined from labels.

Every url is a set of tokens: host labels, path segments without digits, query keys.
Tokens that stand in exactly the same labelled urls are one group, since combinations
of them have the same support: FP-growth sees groups. It finds combinations that occur often
together with a bad label; those with enough support and confidence block, unless a part
of them says as much. A url has a group if it has any of its tokens. A rule is indexed
under its rarest group, so matching joins urls to few candidates, each then tested in full.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.scratch import materialize

# Rule, verdict.
FIXED_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.6
MAX_LABELLED = 200_000
BAD = "=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Host labels, path segments without digits, and query keys, each marked with its kind."""
    host = F.transform(F.split(host_of(url), r"\."), lambda x: F.concat(F.lit("h:"), x))
    path = F.transform(F.split(path_of(url), "/"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "")))
    query = F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("([^&=]+)(=[^&]*)?"), 1)
    keys = F.transform(query, lambda x: F.concat(F.lit("q:"), x))
    found = F.array_distinct(F.concat(host, path, keys))
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda x: F.length(x) > 2)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the last to fit is the longest
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def token_groups(baskets: DataFrame, min_count: int) -> DataFrame:
    """Tokens of ``min_count`` baskets or more (id, items), those of the same baskets together.

    ``group`` (the first of them), ``members``, ``freq``. Two hashes over the baskets of each
    token tell which are alike; a group's members stand in one basket, so there are few.
    """
    found = baskets.select("id", F.explode("items").alias("token")).filter(F.col("token") != BAD)
    alike = found.groupBy("token").agg(
        F.count("*").alias("freq"),
        F.bit_xor(F.xxhash64("id")).alias("a"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("b"),
    )
    groups = alike.filter(F.col("freq") >= min_count).groupBy("freq", "a", "b")
    return groups.agg(F.array_sort(F.collect_list("token")).alias("members")).select(
        F.col("members")[0].alias("group"), "members", "freq"
    )


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules from rows of url and bad: tokens, confidence, support, index_token (the rarest), members.

    A token stands for its group, whose ``members`` are beside it. Rules of any length are kept,
    except where a part of a rule has at least its confidence. Without rows there are no rules.
    """
    spark = labelled.sparkSession
    bad = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    baskets = labelled.select(
        F.monotonically_increasing_id().alias("id"), F.concat(url_tokens(F.col("url")), bad).alias("items")
    )
    baskets = materialize(baskets.filter(F.size("items") > 0), "url-baskets")
    n = baskets.count()
    schema = "tokens array<string>, confidence double, support double, index_token string, members array<array<string>>"
    if not n:
        return spark.createDataFrame([], schema)
    groups = materialize(token_groups(baskets, math.ceil(min_support * n)), "url-token-groups")
    of_token = groups.select(F.explode("members").alias("token"), "group")
    merged = (
        baskets.select("id", F.explode("items").alias("token"))
        .join(of_token, "token")
        .groupBy("id")
        .agg(F.collect_set("group").alias("groups"))
    )
    is_bad = F.filter("items", lambda x: x == BAD)
    nothing = F.array().cast("array<string>")
    smaller = baskets.join(merged, "id", "left").select(F.concat(F.coalesce("groups", nothing), is_bad).alias("items"))
    smaller = materialize(smaller, "url-groups")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(smaller)
    rules = model.associationRules.filter(
        (F.size("consequent") == 1) & (F.col("consequent")[0] == BAD)
    ).select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    indexed = (
        rules.withColumn("token", F.explode("tokens"))
        .join(groups.select(F.col("group").alias("token"), "members", "freq"), "token")
        .groupBy("tokens", "confidence", "support")
        .agg(
            F.min(F.struct("freq", "token"))["token"].alias("index_token"),
            F.array_sort(F.collect_list(F.struct("token", "members"))).alias("named"),
        )
        .select("tokens", "confidence", "support", "index_token", F.col("named.members").alias("members"))
    )
    return materialize(_without_covered(materialize(indexed, "url-all-rules")), "url-rules")


def _without_covered(rules: DataFrame) -> DataFrame:
    """Rules of which no part is a rule of at least the same confidence."""
    parts = rules.select(
        F.col("index_token").alias("token"), F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence")
    )
    whole = rules.filter(F.size("tokens") > 1).select("tokens", "confidence", F.explode("tokens").alias("token"))
    covered = (
        whole.join(parts, "token")
        .filter((F.col("part_confidence") >= F.col("confidence")) & (F.size("part") < F.size("tokens")))
        .filter(F.size(F.array_except("part", "tokens")) == 0)
        .select("tokens")
        .distinct()
    )
    return rules.join(covered, "tokens", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The most confident rule of every distinct url that has one: url, mined_rule, confidence.

    Of equals the one with most support, then the shortest.
    """
    groups = rules.select(F.explode(F.arrays_zip(F.col("tokens").alias("group"), "members")).alias("x"))
    of_token = groups.select(F.col("x.group").alias("group"), F.explode("x.members").alias("token")).distinct()
    tokens = urls.select("url").filter("url IS NOT NULL").distinct().withColumn("token", F.explode(url_tokens(F.col("url"))))
    has = tokens.join(of_token, "token").groupBy("url").agg(F.collect_set("group").alias("has"))
    text = F.array_join(F.transform("members", lambda x: F.array_join(x, "|")), " ")
    return (
        has.withColumn("index_token", F.explode("has"))
        .join(rules, "index_token")
        .filter(F.size(F.array_except("tokens", "has")) == 0)
        .groupBy("url")
        .agg(F.max(F.struct("confidence", "support", -F.size("tokens"), text.alias("mined_rule"))).alias("best"))
        .select("url", "best.mined_rule", "best.confidence")
    )


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = FIXED_RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Verdict of every row: page_id, host, path, rule, verdict, mined_rule, confidence.

    A fixed rule fits its host and subdomains if the path starts with the rule's; the
    longest wins. Without one, a mined rule blocks and all else is allowed. ``labels``
    (doc_id, quality, toxic) mark the page of that id as bad if quality is 0 or toxic is 1;
    the rules are mined from the ``max_labelled`` labelled rows that come first by a hash.
    A null url, or one without ``://``, has an empty host and path and is allowed. Repeated
    rows each get their row; an empty table gives none. Other columns are not read.
    """
    marked = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.coalesce(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)), F.lit(False)).alias("bad")
    )
    urls = pages.select("page_id", "url")
    labelled = urls.join(marked, "page_id").orderBy(F.xxhash64("page_id"), "page_id", "url").limit(max_labelled)
    mined = match_rules(urls, mine_rules(labelled.select("url", "bad"), min_support, min_confidence))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    mined_verdict = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return (
        urls.join(mined, "url", "left")
        .withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, mined_verdict).alias("verdict"),
            "mined_rule",
            "confidence",
        )
    )
