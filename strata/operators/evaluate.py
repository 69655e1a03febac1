"""Binary-classification evaluation (E1-E15) over a scored frame ``(label, score, pred)``.

* Counting metrics: ONE conditional-count aggregation (partial agg, no shuffle
  of rows); zero denominators give 0 (``try_divide`` + ``coalesce``).
* Curves / AUC: the distinct scores with positive/negative counts and exact
  descending cumulative sums from :func:`strata.operators.rank.ordered_counts`
  -- never a single-task global window.  ROC AUC is the rank-sum form (ties
  count one half), PR AUC the trapezoid through (recall 0, precision 1).
* Threshold sweep: each score is bucketed to its last threshold <= score,
  counted per bucket (<= 100 rows), then reverse-cumulated -- no n x 100 join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.rank import ordered_counts


def _div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(p, r):
    return _div(F.lit(2.0) * p * r, p + r)


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """One row ``tp, fp, fn, tn, n``."""
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
                  F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy, precision, recall, F1 for the positive class."""
    c = confusion_counts(df, label, pred)
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select(_div(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), _f1(prec, rec).alias("f1"))


def weighted_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")

    def wavg(a0, a1):
        return _div(a0 * s0 + a1 * s1, n)

    return c.select(_div(tp + tn, n).alias("accuracy"), wavg(p0, p1).alias("precision"),
                    wavg(r0, r1).alias("recall"), wavg(_f1(p0, r0), _f1(p1, r1)).alias("f1"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Four cells ``(label, pred, n, row_share)``, zero cells included."""
    c = confusion_counts(df, label, pred)
    c2 = c.withColumn("_s0", F.col("tn") + F.col("fp")).withColumn("_s1", F.col("tp") + F.col("fn"))
    cells = c2.select(F.inline(F.array(
        *[F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(name).alias("n"),
                   F.col(row_tot).alias("_row"))
          for y, p, name, row_tot in ((0, 0, "tn", "_s0"), (0, 1, "fp", "_s0"), (1, 0, "fn", "_s1"),
                                      (1, 1, "tp", "_s1"))])))
    return cells.select("label", "pred", "n", _div(F.col("n"), F.col("_row")).alias("row_share"))


def sensitivity_specificity(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """E5: one row ``sensitivity, specificity``."""
    c = confusion_counts(df, label, pred)
    return c.select(_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("sensitivity"),
                    _div(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with precision/recall/f1/support.

    All five rows come from the single confusion-count row (one scan, one aggregate).
    """
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f0, f1 = _f1(p0, r0), _f1(p1, r1)
    s0, s1 = tn + fp, tp + fn
    acc = _div(tp + tn, n)

    def wavg(a0, a1):
        return _div(a0 * s0.cast("double") + a1 * s1.cast("double"), s0 + s1)

    def row(name, p_, r_, f_, sup):
        return F.struct(F.lit(name).alias("class"), p_.alias("precision"), r_.alias("recall"), f_.alias("f1"),
                        sup.cast("bigint").alias("support"))
    return c.select(F.inline(F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1), row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
        row("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), s0 + s1))))


def score_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Distinct scores (descending) with exact cumulative positives/negatives."""
    y = F.col(label).cast("long")
    return ordered_counts(df.select(label, score), [score], weights={"pos": y, "neg": F.lit(1) - y},
                          descending=True)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """E3 (+E8 area, E9 prevalence): one row ``roc_auc, pr_auc, prevalence, n``.

    ROC AUC = sum_s pos_s * (negatives below s + neg_s / 2) / (P * N).
    PR AUC = trapezoid over (recall, precision) from (0, 1) through every threshold.
    """
    sc = score_curve(df, label, score)
    P, N = F.col("total_pos"), F.col("total_neg")
    below = N - F.col("cum_neg")
    recall = _div(F.col("cum_pos"), P)
    prec = _div(F.col("cum_pos"), F.col("cum"))
    prev_recall = _div(F.col("cum_before_pos"), P)
    prev_prec = F.when(F.col("cum_before") == 0, F.lit(1.0)).otherwise(
        _div(F.col("cum_before_pos"), F.col("cum_before")))
    return sc.agg(
        _div(F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0))), F.first(P) * F.first(N)).alias("roc_auc"),
        F.sum((recall - prev_recall) * (prec + prev_prec) / F.lit(2.0)).alias("pr_auc"),
        _div(F.first(P), F.first(P) + F.first(N)).alias("prevalence"),
        (F.first(P) + F.first(N)).alias("n"))


def grouped_auc(counted: DataFrame, by: str) -> DataFrame:
    """``by, roc_auc`` from rows of ``by``, ``score`` and how many positives and negatives have it (``pos``, ``neg``)."""
    sc = ordered_counts(counted, ["score"], [by], weights={"p": F.col("pos"), "n": F.col("neg")}, descending=True)
    below = F.col("total_n") - F.col("cum_n")
    area = F.sum(F.col("p") * (below + F.col("n") / F.lit(2.0)))
    return sc.groupBy(by).agg(F.try_divide(area, F.first("total_p").cast("double") * F.first("total_n").cast("double")).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              drop_intermediate: bool = False) -> DataFrame:
    """``(threshold, fpr, tpr)`` for every distinct score plus the (NULL, 0, 0) start point.

    ``drop_intermediate`` keeps only the corners of the curve: a point is dropped
    when the second differences of both the false- and true-positive counts are
    zero (collinear with its neighbours); the first and last points stay.  The
    previous point's counts are on the row itself (cumulative before), the next
    point's come from an equi-join on the dense position ``idx + 1`` -- no global
    window, no single task.
    """
    sc = score_curve(df, label, score)
    if drop_intermediate:
        nxt = sc.select((F.col("idx") - 1).alias("idx"), F.col("cum_pos").alias("_np"),
                        F.col("cum_neg").alias("_nn"))
        j = sc.join(nxt, "idx", "left")
        d2_pos = F.col("cum_before_pos") - F.lit(2) * F.col("cum_pos") + F.col("_np")
        d2_neg = F.col("cum_before_neg") - F.lit(2) * F.col("cum_neg") + F.col("_nn")
        keep = (F.col("idx") == 1) | F.col("_np").isNull() | (d2_pos != 0) | (d2_neg != 0)
        sc = j.where(keep)
    pts = sc.select(F.col(score).cast("double").alias("threshold"),
                    _div(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
                    _div(F.col("cum_pos"), F.col("total_pos")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(threshold, precision, recall)`` per distinct score plus the (NULL, 1, 0) end point."""
    sc = score_curve(df, label, score)
    pts = sc.select(F.col(score).cast("double").alias("threshold"),
                    _div(F.col("cum_pos"), F.col("cum")).alias("precision"),
                    _div(F.col("cum_pos"), F.col("total_pos")).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", steps: int = 100) -> DataFrame:
    """Thresholds ``t_i = i/(steps-1)``; pred = score >= t_i.

    P/R/F1 are 0 where only one class is predicted.  ``is_best`` marks the first
    threshold with the maximal F1.
    """
    m = steps - 1
    s = F.col(score).cast("double")
    i0 = F.floor(s * F.lit(float(m))).cast("int")
    # correct float rounding against the actual thresholds i/m
    i1 = F.when((i0 + 1 <= m) & ((i0 + 1) / F.lit(float(m)) <= s), i0 + 1) \
        .when(i0 / F.lit(float(m)) > s, i0 - 1).otherwise(i0)
    b = F.when(s < 0, F.lit(-1)).when(s >= 1, F.lit(m)).otherwise(i1)
    y = F.col(label).cast("long")
    per = df.where(s.isNotNull()).groupBy(b.alias("i")).agg(
        F.sum(y).alias("pos"), F.count(F.lit(1)).alias("cnt"))
    # bounded from here on: the grid has steps + 1 rows (bucket -1 = scores below 0,
    # counted in the totals but never predicted positive)
    grid = df.sparkSession.range(-1, steps).select(F.col("id").cast("int").alias("i"))
    dense = grid.join(per, "i", "left").fillna(0, ["pos", "cnt"])
    everything = Window.partitionBy(F.lit(0))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding,
                                                                       Window.currentRow)
    cum = (dense.withColumn("P", F.sum("pos").over(everything)).withColumn("n", F.sum("cnt").over(everything))
           .withColumn("tp", F.sum("pos").over(w)).withColumn("pp", F.sum("cnt").over(w))
           .where(F.col("i") >= 0))
    one_class = (F.col("pp") == 0) | (F.col("pp") == F.col("n"))
    prec = F.when(one_class, 0.0).otherwise(_div(F.col("tp"), F.col("pp")))
    rec = F.when(one_class, 0.0).otherwise(_div(F.col("tp"), F.col("P")))
    res = cum.select("i", (F.col("i") / F.lit(float(m))).alias("threshold"), prec.alias("precision"),
                     rec.alias("recall"))
    res = res.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, _f1(F.col("precision"),
                                                                                  F.col("recall"))).otherwise(0.0))
    wb = Window.orderBy(F.desc("f1"), F.asc("i"))
    return res.withColumn("is_best", (F.row_number().over(wb) == 1))


# Grade bands -- accuracy .85 / .75 / .65, ROC AUC .9 / .8 / .7.
ACCURACY_BANDS = (0.85, 0.75, 0.65)
AUC_BANDS = (0.9, 0.8, 0.7)


def grade(metrics: DataFrame) -> DataFrame:
    """Accuracy and AUC bands on a metrics row (accuracy, roc_auc)."""
    def band(c, cuts):
        return (F.when(c >= cuts[0], "excellent").when(c >= cuts[1], "good")
                .when(c >= cuts[2], "fair").otherwise("poor"))
    return metrics.select("accuracy", "roc_auc",
                          band(F.col("accuracy"), ACCURACY_BANDS).alias("accuracy_grade"),
                          band(F.col("roc_auc"), AUC_BANDS).alias("auc_grade"))


def headline_metrics(scored: DataFrame, label: str = "label", score: str = "score", pred: str = "pred") -> DataFrame:
    """One row (accuracy, roc_auc): the two single-row results are combined by union + max (no join)."""
    acc = binary_metrics(scored, label, pred).select("accuracy", F.lit(None).cast("double").alias("roc_auc"))
    auc = roc_auc(scored, label, score).select(F.lit(None).cast("double").alias("accuracy"), "roc_auc")
    return acc.unionByName(auc).agg(F.max("accuracy").alias("accuracy"), F.max("roc_auc").alias("roc_auc"))


def evaluation_summary(scored: DataFrame, label: str = "label", score: str = "score",
                       pred: str = "pred") -> DataFrame:
    """E15 headline: long ``(metric, value)`` -- accuracy, support-weighted precision / recall / F1,
    ROC AUC and PR AUC; the two single-row results are combined by union (no join)."""
    w = weighted_metrics(scored, label, pred).select(F.inline(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in
          (("accuracy", "accuracy"), ("precision_weighted", "precision"), ("recall_weighted", "recall"),
           ("f1_weighted", "f1"))])))
    a = roc_auc(scored, label, score).select(F.inline(F.array(
        F.struct(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")),
        F.struct(F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value")))))
    return w.unionByName(a)


def evaluate(scored: DataFrame, label: str = "label", score: str = "score", pred: str = "pred") -> dict:
    """The whole bundle over one persisted scored frame (each output lazy)."""
    s = scored.select(label, score, pred).cache()
    return {
        "binary": binary_metrics(s, label, pred),
        "weighted": weighted_metrics(s, label, pred),
        "auc": roc_auc(s, label, score),
        "confusion": confusion_matrix(s, label, pred),
        "report": classification_report(s, label, pred),
        "roc": roc_curve(s, label, score),
        "pr": pr_curve(s, label, score),
        "sweep": threshold_sweep(s, label, score),
    }
