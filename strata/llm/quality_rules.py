"""Quality rules: plain counts per document, and a hashed n-gram log-likelihood ratio between a trusted target and
the raw corpus. Only DataFrame functions: no Python runs on the executors.

Words and neighbouring word pairs are hashed into a fixed number of buckets. Two multinomials over the buckets are
counted, one over the trusted documents, one over all; a document's ratio is the mean over its n-grams of
log p_target - log p_raw, so its length doesn't matter, and one fixed threshold, with a margin for the scatter of
short documents, decides every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bound, staged

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
BUCKETS = 1 << 14
#: Documents whose mean log ratio is lower are rejected; the mean of few n-grams scatters, so a document of n is
#: rejected below MIN_RATIO - SLACK / sqrt(n).
MIN_RATIO, SLACK = -0.08, 0.6
#: Added to each bucket's counts.
SMOOTHING = 1.0


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def repeated_words(tokens: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words within windows that occur at least twice in the text; windows are compared by a 64-bit hash."""
    def positions(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = bound(placed, lambda s: F.filter(s, lambda x, j: F.coalesce(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]),
            F.get(s, j - 1)["h"] == x["h"], F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - p, F.lit(window)))),
                           F.lit(0).cast("long"), lambda n, x: n + x)

    def counted(w: Column) -> Column:
        hashes = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - (window - 1), F.lit(0))),
                             lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, window))))
        return bound(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), bound(positions(h), covered))
                     .otherwise(F.lit(0).cast("long")))

    return bound(tokens, counted)


def base_counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return bound(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))


def ngram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all lower-cased words and neighbouring pairs, repeats included."""
    def pairs(h: Column) -> Column:
        return F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(buckets))),
                        F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - 1, F.lit(0))),
                                    lambda x, i: F.pmod(F.shiftleft(x, 1).bitwiseXOR(F.shiftrightunsigned(F.get(h, i + 1), 3)), F.lit(buckets))))

    return bound(F.transform(words(F.lower(text)), lambda w: F.xxhash64(w)), pairs)


def fit_ratios(docs: DataFrame, trusted: DataFrame, *, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, weight``: log p_target - log p_raw of every bucket, counted over all documents. ``trusted`` holds the
    ids of the target's documents. A bucket seen nowhere weighs by the smoothing alone; without any trusted document
    all weights are 0."""
    ids = trusted.select(F.col(id).alias("__id")).where("__id IS NOT NULL").distinct().withColumn("target", F.lit(1))
    read = docs.select(F.col(id).alias("__id"), F.col(text).cast("string").alias("t"))
    # merge join at every size: the ids grow with the corpus, so they are never broadcast
    found = (read.join(ids.hint("merge"), "__id", "left").select("target", F.explode(ngram_buckets(F.col("t"), buckets)).alias("bucket"))
             .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("target").alias("target")))
    counts = staged(docs.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(found, "bucket", "left")
                    .na.fill(0, ["raw", "target"]), "ratio_counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    share = lambda c, n: F.log((F.col(c) + SMOOTHING) / F.lit(float(n + SMOOTHING * buckets)))
    weight = share("target", target) - share("raw", raw) if target else F.lit(0.0)
    return counts.select("bucket", weight.alias("weight"))


def judge(docs: DataFrame, trusted: DataFrame, *, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
          min_ratio: float = MIN_RATIO, slack: float = SLACK) -> DataFrame:
    """Every row with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``ratio`` and ``kept``.

    A null or empty text has no words: its counts are 0, its ratio is 0 and it fails the base rules. Repeated rows are
    judged and counted each; null ids are judged, but belong to no target. An input column with the name of a result
    column is left out. An empty table gives no rows. The model is one row of ``buckets`` numbers.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept"]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    model = (fit_ratios(docs, trusted, id=id, text=text, buckets=buckets)
             .agg(F.sort_array(F.collect_list(F.struct("bucket", "weight"))).alias("w"))
             .select(F.transform("w", lambda x: x["weight"])).scalar())
    own = F.col(f"`{text}`").cast("string")
    total = bound(F.struct(F.col("__w").alias("w"), ngram_buckets(own, buckets).alias("b")), lambda m: F.aggregate(
        m["b"], F.lit(0.0), lambda s, b: s + F.get(m["w"], b.cast("int")), lambda s: s / F.greatest(F.size(m["b"]), F.lit(1))))
    least = F.lit(min_ratio) - slack / F.sqrt(F.greatest(2 * F.col("n_words") - 1, F.lit(1)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = docs.withColumn("__w", model).select(*keep, own.alias("__text"), F.coalesce(total, F.lit(0.0)).alias("__ratio"))
    # a generator's columns are computed once, also for a filter on them, which would else repeat the expressions
    judged = F.inline(F.array(F.struct(base_counts(F.col("__text")).alias("__base"), F.col("__ratio").alias("ratio"))))
    return (scored.select(*keep, judged)
            .select(*keep, "__base.*", "ratio").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least))
            .select(*keep, *added))


def trusted_ids(labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """The trusted target: documents labelled good and not toxic."""
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select(id)
