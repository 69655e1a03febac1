"""URL filter: given host and path rules first; beyond them association rules. Spark's FP-growth mines combinations of
URL tokens from labelled URLs, rules are pruned by support and confidence, and an inverted index finds the rules of
a URL.

Tokens that occur in exactly the same labelled URLs are one item: each of them says what all say, so a URL with any of
them has the item. This loses no rule (one with two of them is beaten by the one with either), and keeps a long URL that
is repeated often from listing every subset of its tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

#: (rule, verdict); a rule is a host, then a path from its first slash.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
VERDICTS = ("allow", "block")
DEFAULT = "allow"
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.9
#: Labelled URLs that a rule must rest on at least, however few there are.
MIN_URLS = 3


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#``
    or the end. Both are empty for null and where there is no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls. A rule fits its host and subdomains where the path starts
    with the rule's."""
    rule = verdict = F.when(F.lit(False), F.lit(""))
    for name, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        own, slash, rest = name.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = rule.when(fits, name), verdict.when(fits, says)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: top-level and registered domain, words of the other host labels, path segments by place, file
    extension, query keys. Numbers are one token; of a segment that only begins with one the rest stays."""
    labels = F.split(host, r"\.")
    words = F.split(F.regexp_replace(host, r"\.?[^.]*\.[^.]*$", ""), r"[.-]")
    place = lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), F.regexp_replace(s, "^[0-9]+", "0"))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    keys = F.regexp_extract_all(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), F.lit(1))
    tagged = lambda kind, array: F.transform(F.filter(array, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), x))
    return F.array_distinct(F.concat(
        tagged("top", F.slice(labels, -1, 1)), tagged("domain", F.array(F.regexp_extract(host, r"[^.]+\.[^.]+$", 0))), tagged("host", words),
        F.transform(segments, place), tagged("file", F.array(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))), tagged("key", keys)))


def token_items(labelled: DataFrame, least: int) -> DataFrame:
    """``token, item``: of the tokens that at least ``least`` rows of ``labelled`` (``row, tokens``) have, those in the same
    rows share an item, named after the first of them. Rows are compared by their number and two sums of hashes."""
    said = labelled.select("row", F.explode(F.array_distinct("tokens")).alias("token"))
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "row").cast("decimal(38,0)"))
    seen = said.groupBy("token").agg(F.count("*").alias("n"), total(1).alias("a"), total(2).alias("b")).where(F.col("n") >= least)
    seen = staged(seen, "tokens")
    return staged(seen.join(seen.groupBy("n", "a", "b").agg(F.min("token").alias("item")), ["n", "a", "b"]).select("token", "item"), "token_items")


def with_items(rows: DataFrame, items: DataFrame, row: str) -> DataFrame:
    """``row, items``: the distinct items of each row's tokens; rows without any are left out."""
    return (rows.select(row, F.explode("tokens").alias("token")).join(items, "token").groupBy(row)
            .agg(F.sort_array(F.collect_set("item")).alias("items")))


def mine_rules(labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_urls: int = MIN_URLS) -> tuple[DataFrame, DataFrame]:
    """``items, verdict, confidence, support`` of the association rules from sets of items to a verdict, and the items
    (:func:`token_items`). ``labelled``: ``tokens, verdict``. A rule rests on a share ``min_support`` of the rows, and on
    ``min_urls`` of them, at least; it is dropped if one with an item less says the same with the same confidence or more."""
    spark = labelled.sparkSession
    rows = staged(labelled.select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "labelled")
    n = rows.count()
    least = max(min_urls, -(-int(min_support * n * 1e9) // 10**9), 1)
    items = token_items(rows, least)
    if n < least:
        return spark.createDataFrame([], "items array<string>, verdict string, confidence double, support double"), items
    verdict = F.array(F.concat(F.lit("="), F.col("verdict")))
    bought = rows.select("row", "verdict").join(with_items(rows, items, "row"), "row", "left").select(
        F.concat(F.coalesce("items", F.array().cast("array<string>")), verdict).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(staged(bought, "transactions"))
    found = model.associationRules.where(F.get("consequent", F.lit(0)).startswith("=")).select(
        F.sort_array("antecedent").alias("items"), F.substring(F.get("consequent", F.lit(0)), 2, 100).alias("verdict"), "confidence", "support")
    rules = staged(found, "rules")
    shorter = rules.select("verdict", "confidence", F.col("items").alias("whole"), F.explode("items").alias("one")).select(
        "verdict", "confidence", "whole", F.array_remove("whole", F.col("one")).alias("items"))
    better = rules.select("items", "verdict", F.col("confidence").alias("other"))
    beaten = shorter.join(better, ["items", "verdict"]).where("other >= confidence").select(F.col("whole").alias("items"), "verdict").distinct()
    return rules.join(beaten, ["items", "verdict"], "left_anti"), items


def inverted_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule under the item that the fewest URLs have."""
    often = urls.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    listed = rules.select("*", F.explode("items").alias("item"), F.concat_ws(" ", F.array("verdict"), "items").alias("rule_id"))
    return (listed.join(often, "item", "left").groupBy("rule_id", F.col("items").alias("needs"), F.col("verdict").alias("says"), "confidence", "support")
            .agg(F.min(F.struct("n", "item")).alias("rarest")).select(F.col("rarest.item").alias("item"), "rule_id", "needs", "says", "confidence", "support"))


def judge_urls(pages: DataFrame, *, url: str = "url", keep: list[str] | None = None, rules=RULES,
               min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_urls: int = MIN_URLS) -> DataFrame:
    """The ``keep`` columns (default: all) of every row with ``host``, ``path``, ``rule`` (the given rule that decides, or null), ``verdict`` (allow or
    block) and ``mined`` (the URL's tokens that the association rule that decides asks for, or null).

    URLs that a given rule fits are the labels from which token combinations are mined. A URL that none fits goes by
    the mined rule of highest confidence, then support, then fewest tokens; on a tie block goes first, then
    the items that sort last; without one it is allowed. URLs are read whole, however long. Null and malformed URLs have an empty host and path and no tokens: they are allowed. Repeated rows and
    null ids are rows like others. An input column with the name of a result column is left out. An empty table gives
    no rows.
    """
    added = ["host", "path", "rule", "verdict", "mined"]
    keep = [c for c in (pages.columns if keep is None else keep) if c not in added]
    own = F.col(url).cast("string")
    host, path = host_and_path(own)
    parts = pages.select(*(F.col(f"`{c}`") for c in keep), own.alias("__url"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    urls = staged(parts.select(*(F.col(f"`{c}`") for c in keep), "host", "path", rule.alias("rule"), verdict.alias("given"),
                               url_tokens(F.col("__url"), F.col("host"), F.col("path")).alias("tokens"),
                               F.monotonically_increasing_id().alias("__row")), "urls")
    mined, items = mine_rules(urls.where("given IS NOT NULL AND host <> ''").select("tokens", F.col("given").alias("verdict")),
                              min_support=min_support, min_confidence=min_confidence, min_urls=min_urls)
    open_urls = staged(with_items(urls.where("given IS NULL"), items, "__row"), "open_urls")
    index = staged(inverted_index(mined, open_urls), "url_index")
    hits = open_urls.select("__row", "items", F.explode("items").alias("item")).join(index, "item").where(F.size(F.array_except("needs", "items")) == 0)
    best = hits.groupBy("__row").agg(F.max(F.struct("confidence", "support", (-F.size("needs")).alias("short"), "says", "needs")).alias("best"))
    asked = (urls.join(best.select("__row", "best.needs"), "__row").select("__row", "needs", F.explode("tokens").alias("token")).join(items, "token")
             .where(F.array_contains("needs", F.col("item"))).groupBy("__row").agg(F.sort_array(F.collect_set("token")).alias("mined")))
    return urls.join(best, "__row", "left").join(asked, "__row", "left").select(
        *(F.col(f"`{c}`") for c in keep), "host", "path", "rule",
        F.coalesce("given", "best.says", F.lit(DEFAULT)).alias("verdict"), "mined")
