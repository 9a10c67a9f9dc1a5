"""URL filters by association rules, in DataFrame operations only.

Spark's FP-growth mines the token combinations that a few bad urls share, and an
inverted index counts all labelled urls that hold them. Rules whose confidence is
high enough, and too far above the share of bad urls to be chance, are kept, and
those that a shorter rule of at least the same confidence covers are pruned. Each rule is put in an inverted index under its
rarest token; a url looks up its tokens there and checks the whole rule.
Explicit rules on host and path come first.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path; both empty for null or without ://."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Distinct tokens: host labels, path parts and query names; runs of digits become #."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    plain = lambda x: F.regexp_replace(F.translate(x, UPPER, LOWER), "[0-9]+", "#")
    named = lambda parts, mark: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), plain(x)))
    names = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    return F.array_distinct(F.concat(named(F.split(host, r"\."), "host:"), named(F.split(path, "/"), "path:"),
                                     named(names, "query:")))


def mine_rules(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               label_id_col: str = "doc_id", min_confidence: float = 0.6, min_urls: int = 4, least_z: float = 2.0) -> DataFrame:
    """``(rarest, antecedent, confidence, support)``: the inverted index of the rules kept.

    A labelled url is bad if its quality is 0 or its toxic label is 1; of several
    labels for one id the worst counts; ids that are null, and labels that are
    null in both columns, are left out. No labelled url: no rules. A rule needs
    ``min_urls`` bad urls however many are labelled, a share of bad ones among the
    urls it matches (confidence) of ``min_confidence``, and ``least_z`` standard
    errors between that share and the share among all labelled urls; each further
    token asks for one more, as there are more sets that chance can favour. The rules
    are rows, so their number may grow with the input. ``support`` is the share
    of the labelled urls that are bad and match.
    """
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    marked = (labels.select(F.col(f"`{label_id_col}`").cast("long").alias("id"), bad.alias("bad"))
              .where("id is not null and bad is not null").groupBy("id").agg(F.max("bad").alias("bad")))
    urls = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    # Urls with the same tokens are one row with its counts.
    items = staged(urls.join(marked, "id").select(F.array_sort(url_tokens(F.col("url"))).alias("items"), "bad")
                   .where(F.size("items") > 0).groupBy("items").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")), "url-items")
    empty = items.sparkSession.createDataFrame([], "rarest string, antecedent array<string>, confidence double, support double")
    total, total_bad = items.agg(F.sum("n"), F.sum("bad")).first()
    if not total or total_bad < min_urls:
        return empty
    tokens = staged(items.select(F.explode("items").alias("token"), "bad", "n").groupBy("token")
                    .agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")), "url-tokens")
    # Other tokens are in no rule, or only in rules that a shorter one covers: those that are always bad
    # are rules alone, and those of every url add nothing to a set.
    mined = tokens.where((F.col("bad") >= min_urls) & (F.col("bad") < F.col("n")) & (F.col("n") < total)).select("token")
    single = tokens.where(F.col("bad") >= min_urls).select(F.array("token").alias("antecedent"), "bad", "n")
    parts = staged(items.where("bad > 0").withColumn("row", F.xxhash64("items"))
                   .select("row", "bad", F.explode("items").alias("token")).join(mined, "token")
                   .groupBy("row", "bad").agg(F.sort_array(F.collect_list("token")).alias("items"))
                   .select("items", F.explode(F.sequence(F.lit(1), F.col("bad"))).alias("copy")).select("items"), "url-bad")
    rows = parts.count()
    sets = single
    if rows >= min_urls:
        found = FPGrowth(itemsCol="items", minSupport=min_urls / rows).fit(parts).freqItemsets
        several = staged(found.where(F.size("items") > 1).select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("bad")), "url-sets")
        place = (several.withColumn("token", F.explode("antecedent")).join(tokens.select("token", F.col("n").alias("seen")), "token")
                 .groupBy("antecedent", "bad").agg(F.min(F.struct("seen", "token"))["token"].alias("token")))
        held = (items.select("items", "n", F.explode("items").alias("token")).join(place, "token")
                .where(F.size(F.array_except("antecedent", "items")) == 0)
                .groupBy("antecedent", "bad").agg(F.sum("n").alias("n")))
        sets = single.union(held.select("antecedent", "bad", "n"))
    base = total_bad / total
    far = (F.col("bad") - F.col("n") * F.lit(base)) >= (F.lit(least_z - 1) + F.size("antecedent")) * F.sqrt(F.col("n") * F.lit(base * (1 - base)))
    rules = staged(sets.withColumn("confidence", F.col("bad") / F.col("n")).where((F.col("confidence") >= min_confidence) & far)
                   .select("antecedent", "confidence", (F.col("bad") / F.lit(float(total))).alias("support")), "url-rules")
    # A rule adds nothing beside a shorter one that is at least as sure; both share a token, so an equi-join finds it.
    long_rules = rules.withColumn("t", F.explode("antecedent"))
    short = long_rules.select("t", F.col("antecedent").alias("short"), F.col("confidence").alias("sure"))
    covered = (long_rules.join(short, "t").where((F.size("short") < F.size("antecedent")) & (F.col("sure") >= F.col("confidence"))
                                                 & (F.size(F.array_except("short", "antecedent")) == 0))
               .select("antecedent").distinct())
    kept = rules.join(covered, "antecedent", "left_anti")
    frequency = tokens.select(F.col("token").alias("rarest"), "n")
    return staged(kept.withColumn("rarest", F.explode("antecedent")).join(frequency, "rarest")
                  .groupBy("antecedent", "confidence", "support")
                  .agg(F.min(F.struct("n", "rarest"))["rarest"].alias("rarest"))
                  .select("rarest", "antecedent", "confidence", "support"), "url-index")


def explicit_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest ``(verdict, host, path)`` that fits, as ``host + path``, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, index: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, confidence)``, one row per input row.

    An explicit rule decides where one fits; else a url that a mined rule matches
    is blocked (``confidence`` is that of the surest), and any other allowed.
    Null urls and urls without :// have an empty host and path, no token and are
    allowed. Rows that repeat a url are judged once and alike; ids may be null;
    other columns are ignored.
    """
    urls = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    asked = (urls.select("url").distinct().withColumn("tokens", url_tokens(F.col("url")))
             .withColumn("rarest", F.explode("tokens")))
    matched = (asked.join(index, "rarest").where(F.size(F.array_except("antecedent", "tokens")) == 0)
               .groupBy(F.col("url").alias("matched")).agg(F.max("confidence").alias("confidence")))
    host, path = host_and_path(F.col("url"))
    name, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return (urls.join(matched, urls["url"].eqNullSafe(matched["matched"]), "left")
            .withColumn("host", host).withColumn("path", path)
            .select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "confidence"))
